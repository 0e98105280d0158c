"""Choosing rows from append-only logs: latest live, latest complete, last status, first and last by an order.

All orders spell out where nulls go and end in a tie-break, so results don't depend on how rows are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_row(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order given. Spark limits each group before and after its shuffle."""
    w = Window.partitionBy(*as_columns(keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def newest_row(df: DataFrame, keys: Sequence[str | Column], *order: str) -> DataFrame:
    """The row with the greatest values of the order columns; nulls come last of all."""
    return first_row(df, keys, [F.col(c).desc_nulls_last() for c in order])


def latest_live(df: DataFrame, keys: Sequence[str], run: str, dry: str | Column) -> DataFrame:
    """keys and the greatest run that is not dry; the greatest dry one only for keys without a live run."""
    dry = F.coalesce(F.col(dry) if isinstance(dry, str) else dry, F.lit(False))
    return df.groupBy(*keys).agg(F.coalesce(F.max(F.when(~dry, F.col(run))), F.max(run)).alias(run))


def rows_of_current_run(df: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys, the run among them, are current."""
    return df.join(current.select(*keys), list(keys), "left_semi")


def latest_complete(results: DataFrame, run: str = "run_id", scope: str = "scope", has_scope: str = "has_scope") -> DataFrame:
    """One row: the greatest run of corpus scope. Rows from before scopes were recorded count as corpus. Null without any."""
    return results.where(~F.col(has_scope) | (F.col(scope) == "corpus")).agg(F.max(run).alias(run))


def last_status(df: DataFrame, identity: Sequence[str], at: str, line: str) -> DataFrame:
    """The last row of each business identity by time and place in the log; a null part of the identity equals an empty one."""
    return newest_row(df, [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity], at, line)


def value_at_first(value: str, *order: str) -> Column:
    """The value in the group's first row, its null kept; nulls in the order come last."""
    keys = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))])
    return F.min_by(F.struct(F.col(value).alias("v")), keys)["v"]


def value_at_last(value: str, *order: str) -> Column:
    return F.max_by(F.struct(F.col(value).alias("v")), F.struct(*[F.col(c) for c in order]))["v"]


def preferred(value: str, when: Column, pick=F.max) -> Column:
    """An aggregate over the rows where a condition holds, else over all: precedence between sources, field by field."""
    return F.coalesce(pick(F.when(when, F.col(value))), pick(F.col(value)))


def distinct_sorted(value: str) -> Column:
    """The sorted distinct non-null values of a group; null instead of an empty array."""
    found = F.array_sort(F.collect_set(value))
    return F.when(F.size(found) > 0, found)


def last_known(value: Column, partition: Sequence[str], order: Sequence[str], before: bool = False) -> Column:
    """The last non-null value up to the row, or strictly before it."""
    w = Window.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1 if before else 0))
