"""History from an append-only log: episodes, Type 2 windows, point-in-time joins, change and currency classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .select import value_at_first

#: Type 2 windows open here for the first version of an entity; a fixed value, before any run stamp.
FLOOR = "00000000T000000Z"


def ordered(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def with_episode(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "episode_seq") -> DataFrame:
    """Numbers the runs of equal adjacent values from 1. A value that returns opens a new episode. Both windows share one sort."""
    w = ordered(keys, order)
    opens = F.coalesce(F.lag(value).over(w) != F.col(value), F.lit(True)).cast("int")
    return df.withColumn("__opens", opens).withColumn(name, F.sum("__opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__opens")


def episodes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, first_sight: Sequence[str] = (), seq: str = "episode_seq") -> DataFrame:
    """One row per episode: its value, first and last place in the first order column, size, and columns as first seen."""
    numbered = with_episode(df, keys, order, value, seq)
    at = order[0]
    return numbered.groupBy(*keys, seq).agg(
        F.min(value).alias(value),
        F.min(at).alias("first_seen_at"),
        F.max(at).alias("last_seen_at"),
        F.count("*").alias("sighting_count"),
        *[value_at_first(c, *order).alias(c) for c in first_sight],
    )


def moved(now: Column, before: Column) -> Column:
    """True if two values differ, a null being a value like any other."""
    return ~now.eqNullSafe(before)


def moved_if_known(now: Column, before: Column) -> Column:
    """True, false, or null while either side is unknown."""
    return now != before


def with_previous(df: DataFrame, keys: Sequence[str], seq: str, columns: Sequence[str]) -> DataFrame:
    w = ordered(keys, [seq])
    return df.select("*", *[F.lag(c).over(w).alias(f"prior_{c}") for c in columns])


def type2(observations: DataFrame, key: str, order: str, at: str, label: str, floor: object = None) -> DataFrame:
    """Versions of a label with half-open windows [valid_from, valid_to); the first one opens at floor, or when first seen."""
    w = ordered([key], [order])
    opens = observations.withColumn("__prior", F.lag(label).over(w)).where(F.col("__prior").isNull() | (F.col("__prior") != F.col(label))).drop("__prior")
    windowed = opens.withColumn("version_seq", F.row_number().over(w)).withColumn("valid_to", F.lead(at).over(w))
    start = F.col(at) if floor is None else F.when(F.col("version_seq") == 1, F.lit(floor)).otherwise(F.col(at))
    return windowed.select(key, label, "version_seq", start.alias("valid_from"), "valid_to", F.col(at).alias("first_observed_at"), F.col("valid_to").isNull().alias("is_current"))


def point_in_time(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: Sequence[str], version_key: str | None = None, sort: bool = False) -> DataFrame:
    """Facts with the columns of the version valid at their time; windows are disjoint, so rows don't multiply.

    An equi-join on the entity with the window as a residual condition: hash or sort-merge, never nested loops, and Spark splits
    an entity that holds a large share of the facts. Each fact meets all versions of its entity, so this is for entities of few
    versions, as Type 2 dimensions have. With sort, for entities of many versions, facts and versions are sorted together by
    entity and time and each fact takes the last version before it: one shuffle and one sort, in which an entity is one task's."""
    if sort:
        both = F.struct(*[F.col(c).alias(c) for c in facts.columns])
        fact = facts.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1).alias("__kind"), both.alias("__fact"))
        version = versions.select(F.col(version_key or key).alias("__key"), F.col("valid_from").alias("__at"), F.lit(0).alias("__kind"), F.struct(F.col("valid_to").alias("__to"), *[F.col(c).alias(c) for c in columns]).alias("__version"))
        w = Window.partitionBy("__key").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = fact.unionByName(version, True).withColumn("__version", F.last("__version", ignorenulls=True).over(w)).where("__kind = 1")
        held = F.col("__key").isNotNull() & F.col("__at").isNotNull() & (F.col("__version.__to").isNull() | (F.col("__at") < F.col("__version.__to")))
        return met.select("__fact.*", *[F.when(held, F.col(f"__version.{c}")).alias(c) for c in columns])
    v = versions.select(F.col(version_key or key).alias("__key"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"), *columns)
    on = (F.col(key) == F.col("__key")) & (F.col(at) >= F.col("__from")) & (F.col("__to").isNull() | (F.col(at) < F.col("__to")))
    return facts.join(v, on, "left").drop("__key", "__from", "__to")


def change_class(error: Column, prior_hash: Column, not_modified: Column, unchanged: Column) -> Column:
    """What a re-check of a document found; the first that holds."""
    return (
        F.when(error.isNotNull(), "failed")
        .when(prior_hash.isNull(), "first_sight")
        .when(not_modified, "unchanged_by_validator")
        .when(unchanged, "unchanged_by_bytes")
        .otherwise("changed")
    )


CHANGE_CLASSES = ("failed", "first_sight", "unchanged_by_validator", "unchanged_by_bytes", "changed")


def sightings_with_prior(manifest: DataFrame, keys: Sequence[str], order: Sequence[str], ok: Column, columns: Sequence[str]) -> DataFrame:
    """Each sighting with the named columns of the last successful one before it (prior_ok_*), in one window pass."""
    w = ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.last(F.when(ok, F.struct(*columns)), ignorenulls=True).over(w)
    return manifest.withColumn("__prior", kept).select("*", *[F.col(f"__prior.{c}").alias(f"prior_ok_{c}") for c in columns]).drop("__prior")


def currency(known_hash: Column, extracted_hash: Column, has_row: Column, last_failed: Column | None = None) -> Column:
    """Whether what was extracted is what was last seen: unknown without a good sighting, never_extracted without an outcome,
    current if its bytes are those of the last good sighting, else stale. If the last sighting failed, the same bytes can't be
    said to be current: unknown. An outcome without a hash is of no known bytes, so stale."""
    same = F.coalesce(extracted_hash == known_hash, F.lit(False))
    failed = F.lit(False) if last_failed is None else F.coalesce(last_failed, F.lit(False))
    return (
        F.when(known_hash.isNull(), "unknown")
        .when(~F.coalesce(has_row, F.lit(False)), "never_extracted")
        .when(same & failed, "unknown")
        .when(same, "current")
        .otherwise("stale")
    )


CURRENCIES = ("current", "stale", "never_extracted", "unknown")


def histogram(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Counts of every category, those without rows as zero."""
    counted = df.where(F.col(column).isin(*categories)).groupBy(column).count()  # as many rows as categories at most
    named = df.sparkSession.createDataFrame([(c,) for c in categories], f"{column} string")
    return named.join(F.broadcast(counted), column, "left").select(column, F.coalesce("count", F.lit(0)).alias("n"))


def transition_reading(validator: Column, fields: Column) -> Column:
    """What moved with a new content version, as two codes: its validator (moved or same) and its fields (moved, same, or unknown)."""
    return F.concat(
        F.when(validator, "validator_moved").otherwise("validator_same"),
        F.lit("/"),
        F.when(fields, "fields_moved").when(~fields, "fields_same").otherwise("fields_unknown"),
    )


def drift_pairs(runs: DataFrame, keys: Sequence[str], run: str, dry: str, columns: Sequence[str]) -> DataFrame:
    """Pairs of runs over the same bytes, in order of run, at least one of them live: run_a, run_b, pair_kind, c_a and c_b."""
    side = lambda s: runs.select(*keys, F.col(run).alias(f"run_{s}"), F.coalesce(F.col(dry), F.lit(False)).alias(f"dry_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    pairs = side("a").join(side("b"), list(keys)).where("run_a < run_b").where("not (dry_a and dry_b)")
    kind = F.when(F.col("dry_a") | F.col("dry_b"), "live-dry").otherwise("live-live")
    return pairs.withColumn("pair_kind", kind).drop("dry_a", "dry_b")


def drift_steps(runs: DataFrame, keys: Sequence[str], run: str, dry: str, columns: Sequence[str]) -> DataFrame:
    """Each run with the one before it over the same bytes, in the columns of drift_pairs: n copies make n - 1 rows, where their
    pairs are of the order of n squared. Steps between two dry runs are left out."""
    w = ordered(list(keys), [run])
    before = F.lag(F.struct(F.col(run).alias("run"), F.coalesce(F.col(dry), F.lit(False)).alias("dry"), *columns)).over(w)
    rows = runs.withColumn("__a", before).where(F.col("__a").isNotNull() & ~(F.col("__a.dry") & F.coalesce(F.col(dry), F.lit(False))))
    kind = F.when(F.col("__a.dry") | F.coalesce(F.col(dry), F.lit(False)), "live-dry").otherwise("live-live")
    return rows.select(*keys, F.col("__a.run").alias("run_a"), F.col(run).alias("run_b"), kind.alias("pair_kind"), *[x for c in columns for x in (F.col(f"__a.{c}").alias(f"{c}_a"), F.col(c).alias(f"{c}_b"))])


def drift_reading(hash_a: Column, hash_b: Column, version_a: Column, version_b: Column) -> Column:
    """How the field hashes of two runs over the same bytes compare; hashes of different versions don't."""
    return (
        F.when(moved(version_a, version_b), "hash_versions_differ")
        .when(hash_a.isNull() & hash_b.isNull(), "no_hash")
        .when(hash_a.isNull() | hash_b.isNull(), "one_hash")
        .when(hash_a == hash_b, "equal_hashes")
        .otherwise("unequal_hashes")
    )
