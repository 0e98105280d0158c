"""Bounded samples of labelled documents, and single-task training over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labels of this remainder of crc32(doc_id) are held out.
FOLDS, HELD_OUT = 5, 0
_SLOTS = 1 << 30


def labelled_sample(labels: DataFrame, column: str, bound: int) -> tuple[DataFrame, list[float]]:
    """(doc_id, y) of at most bound labels outside the held-out fold, half of each class where there are as many, and
    the share taken of each class. Chosen by a hash of the id. Repeated labels of an id count by their mean; nulls don't count."""
    usable = labels.select("doc_id", F.col(column).alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    usable = usable.where(common.bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    usable = common.staged(usable, "labels")
    there = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    shares = [min(1.0, bound / 2 / max(1, there.get(y, 0))) for y in (0, 1)]
    while True:
        slot = F.pmod(F.xxhash64(F.lit(column), "doc_id"), F.lit(_SLOTS))
        cut = F.when(F.col("y") == 1, F.lit(round(shares[1] * _SLOTS))).otherwise(F.lit(round(shares[0] * _SLOTS)))
        sample = common.staged(usable.where(slot < cut), "sample")
        if sample.count() <= bound:
            return sample, shares
        shares = [x * 0.95 for x in shares]  # a hash can put a few more than expected below the cut


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the sample's documents, repeated rows once; the sample is bounded, so it is broadcast, and no
    other text is shuffled. Of several texts of one id the least counts, so the bound holds."""
    found = docs.select("doc_id", common.text_of(F.col("text")).alias("text")).join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def trained(examples: DataFrame, order: list[str], work: Callable) -> bytes:
    """The one blob that work makes of all examples in order, in one task. The examples are a bounded sample."""
    one = examples.repartition(1).sortWithinPartitions(*order)
    row = common.map_arrow(one, work, "model binary").first()
    return bytes(row["model"]) if row else next(iter(work(iter(())))).column(0)[0].as_py()  # no example, no task


def log_odds_shift(shares: list[float]) -> float:
    """What the log odds in a sample with these shares of the classes exceed the log odds in all rows by."""
    import math

    return math.log(max(shares[1], 1e-12) / max(shares[0], 1e-12))
