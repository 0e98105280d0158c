"""Ordered reports: what is shown is sorted, and nothing else is. Ordering is the last step and goes over few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COUNTS = ("evaluated", "passed", "violated", "inapplicable", "not_evaluated", "adopted", "resolved")


def by_findings(results: DataFrame) -> DataFrame:
    """Rules with most findings, found or adopted, first; then by id."""
    return results.orderBy((F.col("violated") + F.col("adopted")).desc(), F.asc("rule_id"))


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by several keys, nulls last; a key after a minus sign falls."""
    return df.orderBy(*[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys])


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The rows of a report with their position from 1. A report has few rows, so one task numbers them."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def lines(results: Sequence, width: int = 42) -> list[str]:
    """The rows of by_findings as a table of text."""
    head = f"{'rule':{width}s} {'severity':8s} " + " ".join(f"{c:>13s}" for c in COUNTS)
    return [head, "-" * len(head), *(f"{r['rule_id']:{width}s} {r['severity']:8s} " + " ".join(f"{r[c]:13d}" for c in COUNTS) for r in results)]
