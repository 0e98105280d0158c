"""Hashes of what a source says: canonical values, filtered by how they were read, one sha256 a document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_space, nfkc

HASH_VERSION = 1
#: Ways of reading that depend on the document alone; a fixed value.
SOURCE_DETERMINED = ("deterministic_cell", "table_parse", "regex_anchor")


#: What parts and what stands for a null among a list's texts while they are normalized; control characters that texts lack.
_PART, _NULL = "\x1f", "\x1e"


def _without_zeros(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def canonical_decimal(value: Column, kind: str = "decimal") -> Column:
    """Digits without trailing zeros or exponent; all zeros are 0. A double is read as it prints, whatever its size, with the
    first 38 places; those that no decimal holds stay as they print."""
    if kind == "decimal":
        return F.when(value == 0, "0").otherwise(_without_zeros(value.cast("string")))
    shown = value.cast("string")
    size = F.abs(value)
    exact = F.when(size < 1, shown.try_cast("decimal(38,38)").cast("string")).when(size < 1e15, shown.try_cast("decimal(38,22)").cast("string")).otherwise(shown.try_cast("decimal(38,0)").cast("string"))
    return F.when(value == 0, "0").when(exact.isNull(), shown).when(exact.contains("."), _without_zeros(exact)).otherwise(exact)


def canonical_text(value: Column) -> Column:
    """NFKC, with runs of white space as one space. ASCII is composed already, so only other texts go to Python."""
    plain = F.octet_length(value) == F.char_length(value)
    return collapse_space(F.when(plain, value).otherwise(nfkc(F.when(~plain, value))))


def canonical_list(value: Column, kind: str) -> Column:
    """The elements' canonical values, in the list's order."""
    if kind == "string":
        joined = canonical_text(F.array_join(value, _PART, _NULL))
        parts = F.transform(F.split(joined, _PART, -1), lambda t: F.when(t != _NULL, F.trim(t)))
        return F.when(F.size(value) == 0, F.array().cast("array<string>")).otherwise(parts)
    if kind in ("decimal", "double", "float"):
        return F.transform(value, lambda x: canonical_decimal(x, kind))
    return value


def canonical(df: DataFrame, column: str) -> Column:
    """The JSON text of a column's canonical value."""
    field, c = df.schema[column].dataType, F.col(column)
    kind = field.typeName()
    if kind in ("decimal", "double", "float"):
        value = canonical_decimal(c, kind)
    elif kind in ("string", "varchar", "char"):
        value = canonical_text(c)
    elif kind == "array":
        value = canonical_list(c, field.elementType.typeName())
    else:
        value = c.cast("string") if kind == "date" else c
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.when(c.isNull(), "null").otherwise(F.regexp_replace(text, r'(?s)^\{"v":(.*)\}$', "$1"))


def row_json(df: DataFrame, fields: Sequence[str], methods: Column | None = None) -> Column:
    """Sorted-key JSON of a row's canonical fields; with methods (field -> method), only those read deterministically."""
    parts = [F.when(F.lit(True) if methods is None else F.coalesce(methods[f].isin(*SOURCE_DETERMINED), F.lit(False)), F.concat(F.lit(f'"{f}":'), canonical(df, f))) for f in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def normalized_hash(df: DataFrame, keys: Sequence[str], fields: Sequence[str], methods: Column | None = None) -> DataFrame:
    """keys, normalized_field_hash (null without any field), normalized_field_count and version; the order of rows doesn't matter."""
    used = sum(((F.lit(1) if methods is None else F.coalesce(methods[f].isin(*SOURCE_DETERMINED), F.lit(False)).cast("int")) for f in fields), F.lit(0))
    rows = df.select(*keys, row_json(df, fields, methods).alias("__json"), used.alias("__n"))
    whole = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(F.when(F.col("__n") > 0, F.col("__json")))), ","), F.lit("]"))
    hashed = rows.groupBy(*keys).agg(F.concat(F.lit("sha256:"), F.sha2(whole, 256)).alias("__hash"), F.sum("__n").alias("normalized_field_count"))
    named = F.when(F.col("normalized_field_count") > 0, F.col("__hash")).alias("normalized_field_hash")
    return hashed.select(*keys, named, "normalized_field_count", F.lit(HASH_VERSION).alias("normalized_hash_version"))
