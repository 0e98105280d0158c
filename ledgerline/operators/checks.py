"""Assertions as queries that must come back empty."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import as_columns


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def repeated_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Key combinations that occur more than once; keys with a null don't count."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)).groupBy(column).agg(F.count("*").alias("n"))


def outside_range(df: DataFrame, column: str, low: object = None, high: object = None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return df.where(bad)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    there = parent.select(F.col(parent_column).alias("__parent"))
    return child.where(F.col(column).isNotNull()).join(there, F.col(column) == F.col("__parent"), "left_anti")


def breaches(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that break an invariant: any of the conditions holds."""
    return df.where(reduce(lambda a, b: a | b, conditions))


def vetted_matches_status(df: DataFrame, measure: str, status: str, untrusted: Sequence[str]) -> DataFrame:
    """A vetted measure is null exactly when its status is an untrusted one."""
    bad = F.col(status).isin(*untrusted)
    return breaches(df, bad & F.col(measure).isNotNull(), ~bad & F.col(measure).isNull())


def windows_sane(versions: DataFrame, key: str) -> DataFrame:
    """Type 2 histories without exactly one current version, and windows with gaps or overlaps."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(key).orderBy("valid_from")
    gaps = versions.withColumn("__next", F.lead("valid_from").over(w)).where(F.col("__next").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") != F.col("__next"))))
    current = versions.groupBy(key).agg(F.count_if("is_current").alias("n")).where("n <> 1")
    return union_failures({"current versions": current.select(key), "gap or overlap": gaps.select(key)})


def union_failures(parts: dict[str, DataFrame]) -> DataFrame:
    """The failures of several checks, each with the problem's name."""
    return reduce(DataFrame.unionByName, [df.withColumn("problem", F.lit(name)) for name, df in parts.items()])


def failing(checks: dict[str, Callable[[], DataFrame] | DataFrame], threads: int = 8) -> dict[str, int]:
    """Runs the checks, several at a time, and counts the rows of those that aren't empty."""
    with ThreadPoolExecutor(threads) as pool:
        counts = pool.map(lambda c: (c() if callable(c) else c).count(), checks.values())
        return {name: n for name, n in zip(checks, counts, strict=True) if n}


def never_reported(rows: DataFrame, reported: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*as_columns(keys)).distinct().join(reported.select(*keys), list(keys), "left_anti")
