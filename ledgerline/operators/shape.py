"""Reshaping: transpose, richest row, best page, merges that keep both sides, coverage both ways, sections and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .select import first_row


def transpose(df: DataFrame, row: str, columns: Sequence[str], names: Sequence[object], field: str = "field") -> DataFrame:
    """Columns become rows and the given values of row become columns; naming them spares Spark a pass to find them."""
    kinds = {df.schema[c].dataType.simpleString() for c in columns}
    cast = df.select(row, *[F.col(c).cast("string") if len(kinds) > 1 else F.col(c) for c in columns])
    long = cast.unpivot([row], list(columns), field, "__value")
    return long.groupBy(field).pivot(row, list(names)).agg(F.first("__value", ignorenulls=True))


def richest_row(df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with most fields filled; the first in order of several."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))
    return first_row(df.withColumn("n_filled", filled), keys, [F.col("n_filled").desc(), *[F.col(c).asc_nulls_last() for c in order]])


def best_by(df: DataFrame, keys: Sequence[str], value: str, *measures: Column) -> DataFrame:
    """The value with the greatest measures; the least value of several."""
    return first_row(df.select(*keys, value, *[m.alias(f"__m{i}") for i, m in enumerate(measures)]), keys, [*[F.col(f"__m{i}").desc_nulls_last() for i in range(len(measures))], F.col(value).asc()]).select(*keys, value)


def full_merge(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Both sides' columns for every key of either."""
    return a.join(b, key, "full")


def coverage_both_ways(expected: DataFrame, seen: DataFrame, keys: Sequence[str], missing: str = "missing", unexpected: str = "unexpected") -> DataFrame:
    """Keys expected but not seen, and seen but not expected, with the problem's name. Null keys match nothing."""
    e, s = expected.select(*keys).distinct(), seen.select(*keys).distinct()
    return e.join(s, list(keys), "left_anti").withColumn("problem", F.lit(missing)).unionByName(s.join(e, list(keys), "left_anti").withColumn("problem", F.lit(unexpected)))


def single_value(value: str) -> Column:
    """The group's value if it has exactly one distinct one, else null."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def numbered_repeats(df: DataFrame, keys: Sequence[str], role: str, order: Sequence[str]) -> DataFrame:
    """A role that repeats within its keys gets -2, -3 and so on in the given order."""
    w = Window.partitionBy(*keys, role).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    n = F.row_number().over(w)
    return df.withColumn("__n", n).withColumn(role, F.when(F.col("__n") > 1, F.concat_ws("-", F.col(role), F.col("__n").cast("string"))).otherwise(F.col(role))).drop("__n")


def label_neighbours(cells: DataFrame, row: Sequence[str], column: str, value: str, is_label: str) -> DataFrame:
    """What stands to the right of each cell that is a label: row, column, label and each value of the next column, null if
    there is none. One window over the row's cells: a column's values are gathered once and met by those of the column before."""
    each = cells.groupBy(*row, column).agg(F.collect_list(F.when(F.col(is_label), F.col(value))).alias("label"), F.collect_list(value).alias("__values"))
    w = Window.partitionBy(*row).orderBy(column)
    beside = F.when(F.lead(column).over(w) == F.col(column) + 1, F.lead("__values").over(w))
    return each.withColumn("__next", beside).select(*row, column, F.explode("label").alias("label"), "__next").select(*row, column, "label", F.explode_outer("__next").alias("neighbour"))
