"""Typing semi-structured rows: absent keys, JSON nulls, source errors and values stay apart.

Payloads are VARIANT columns: a JSON null is a value there, an absent key is SQL NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"
#: Stands for null in surrogate keys; a fixed value of the public macro whose keys these equal.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def _path(key: str) -> str:
    return "$" + "".join(f".{k}" if k.isidentifier() else f"['{k}']" for k in key.split("."))


def text_at(payload: Column, key: str, kind: str = "string") -> Column:
    """The value of a key, dots reaching into objects; null for an absent key and for a JSON null alike. Casts raise."""
    return F.variant_get(payload, _path(key), kind)


def part_at(payload: Column, key: str) -> Column:
    """The sub-document of a key, as VARIANT."""
    return F.variant_get(payload, _path(key), "variant")


def has_key(payload: Column, key: str) -> Column:
    """Whether the key is there, be it with a null."""
    return part_at(payload, key).isNotNull()


def maybe_decimal(payload: Column, key: str, name: str | None = None) -> list[Column]:
    """Two columns of a value that may be a source error: the decimal (null for an object), and whether it was an object."""
    part = part_at(payload, key)
    is_object = F.coalesce(F.schema_of_variant(part).startswith("OBJECT"), F.lit(False))
    value = F.when(~is_object, text_at(payload, key)).cast(DECIMAL)
    return [value.alias(name or key), is_object.alias(f"{name or key}_is_cell_error")]


def percent_fraction(text: Column) -> Column:
    """A percentage in text as a fraction; multiplied, so the scale of the source stays."""
    return (F.replace(text, F.lit("%"), F.lit("")).cast(DECIMAL) * F.lit("0.01").cast("decimal(3,2)")).cast(DECIMAL)


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the values' texts, a null standing for itself."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def least_in_map(values: Column, field: str | None = None) -> Column:
    """The least value (of a field) over a map's entries, nulls left out."""
    found = F.map_values(values)
    return F.array_min(F.transform(found, lambda v: v[field]) if field else found)


def difference_if_vetted(a: Column, b: Column, *statuses: Column, untrusted: Sequence[str]) -> Column:
    """a - b, null if any of the statuses is untrusted."""
    bad = F.lit(False)
    for s in statuses:
        bad = bad | s.isin(*untrusted)
    return F.when(~bad, a - b)


def first_match(*cases: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    out = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, value in cases[1:]:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(otherwise))
