"""One row per entity from several sources, field by field by precedence, and trust as a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typing import first_match
from .select import preferred

#: Statuses under which a measure isn't vetted.
UNTRUSTED = ("quarantined", "cell_error", "missing")


def conform(df: DataFrame, keys: Sequence[str], source: str, prefer: Mapping[str, tuple[str, bool]] = {}, plain: Mapping[str, object] = {}, flags: Sequence[str] = ()) -> DataFrame:  # noqa: B006
    """prefer: field -> (source, whether that source comes first or last); plain: field -> aggregate; flags: fields with
    an _is_cell_error column, which the result has where the chosen value is null and any source's was unusable."""
    picks = []
    for name, (which, first) in prefer.items():
        picks.append(preferred(name, F.col(source) == which if first else F.col(source) != which).alias(name))
    picks += [f(name).alias(name) for name, f in plain.items()]
    picks += [F.bool_or(f"{name}_is_cell_error").alias(f"__any_{name}") for name in flags]
    out = df.groupBy(*keys).agg(*picks, F.count("*").alias("source_row_count"))
    return out.withColumns({f"{name}_is_cell_error": F.col(name).isNull() & F.col(f"__any_{name}") for name in flags}).drop(*[f"__any_{name}" for name in flags])


def trust_status(marks: Column, cell_error: Column, value: Column, structural: Column, *validated: tuple[Column, str], otherwise: str = "unvalidated_parse") -> Column:
    """The first that holds: quarantined, cell_error, missing, structural_zero, then the given kinds of validation."""
    return first_match((marks, "quarantined"), (cell_error, "cell_error"), (value.isNull(), "missing"), (structural, "structural_zero"), *validated, otherwise=otherwise)


def vetted(value: Column, status: Column) -> Column:
    """The value where its status is trusted."""
    return F.when(~status.isin(*UNTRUSTED), value)


def marks(findings: DataFrame, keys: Sequence[str], name: str, *conditions: Column, **others: Column) -> DataFrame:
    """The sorted distinct rules of the findings that meet all conditions, by key, and other aggregates of the same rows."""
    for c in conditions:
        findings = findings.where(c)
    return findings.groupBy(*keys).agg(F.array_sort(F.collect_set("rule_id")).alias(name), *[a.alias(n) for n, a in others.items()])
