"""Structured Streaming forms of the ledger operators. The reference has no streams: these are extensions.

All keep bounded state: deduplication and windows by watermark, one small state per document otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_ledger(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """An append-only folder of JSONL files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def new_contents(sightings: DataFrame, at: str, late: str, *keys: str) -> DataFrame:
    """The first sighting of each key within the watermark."""
    return sightings.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def counts_by_window(sightings: DataFrame, at: str, late: str, width: str, *keys: str) -> DataFrame:
    return sightings.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("sightings"))


EPISODE_SCHEMA = "filing_id string, document_role string, content_version_seq long, content_hash string, first_seen_at string"
_STATE = "content_hash string, seq long, waiting string"
#: How stamps are written; a fixed value.
STAMP = "yyyyMMdd'T'HHmmss'Z'"


def episodes(sightings: DataFrame, late: str = "1 hour") -> DataFrame:
    """A row whenever a document's content changes, numbered from 1 in order of time, as the batch form numbers them. Failed
    sightings (error, or no hash) change nothing.

    Sightings wait until the watermark, late behind the newest stamp, has passed them, and are numbered in order of time then,
    in whatever order they came. Those that come after the watermark are lost, as late says. Kept per document: its last hash
    and number, and the sightings of the time that the watermark still leaves open.

    sightings: filing_id, document_role, retrieved_at, content_hash, error."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, seq, waiting = state.get if state.exists else (None, 0, "[]")
        held = json.loads(waiting)
        if not state.hasTimedOut:
            for rows in frames:
                good = rows[rows["error"].isna() & rows["content_hash"].notna()]
                held += [[int(ms), at, content] for ms, at, content in zip(good["__ms"], good["retrieved_at"], good["content_hash"], strict=True)]
        held.sort()
        passed = state.getCurrentWatermarkMs()
        ready = [h for h in held if h[0] <= passed]
        held = held[len(ready) :]
        out = []
        for _, at, content in ready:
            if content != last:
                last, seq = content, seq + 1
                out.append((*key, seq, content, at))
        state.update((last, seq, json.dumps(held)))
        if held:
            state.setTimeoutTimestamp(max(held[0][0], passed + 1))
        yield pd.DataFrame(out, columns=["filing_id", "document_role", "content_version_seq", "content_hash", "first_seen_at"])

    timed = sightings.withColumn("__at", F.to_timestamp("retrieved_at", STAMP)).withColumn("__ms", F.unix_millis("__at")).withWatermark("__at", late)
    return timed.groupBy("filing_id", "document_role").applyInPandasWithState(step, EPISODE_SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


#: Folders that a key's observations are dealt to, so that a batch reads only those of its own keys.
BUCKETS = 64


def upsert_history(spark: SparkSession, path: str, key: str, at: str, label: str):
    """A foreachBatch sink: the Type 2 windows of the keys in a batch are rebuilt from their observations, so that late labels
    close and open the right windows. Observations are appended by a hash of their key, and a batch reads the folders of its own
    keys only; history is written for the keys of the batch, one folder a batch, and ``current_history`` reads the newest of
    each key."""
    from ..operators.history import type2

    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(key, at, label, F.lit(batch_id).alias("batch"), bucket)
        kept = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch")
        kept.parquet(f"{path}/observations")
        touched = batch.select(key, bucket).distinct()
        folders = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # BUCKETS at most
        seen = spark.read.parquet(f"{path}/observations").where(F.col("bucket").isin(*folders) & (F.col("batch") <= batch_id))
        daily = seen.join(touched.select(key), key, "left_semi").groupBy(key, at).agg(F.min(label).alias(label))
        type2(daily, key, at, at, label).write.mode("overwrite").parquet(f"{path}/history/batch={batch_id}")

    return write


def current_history(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest batch's windows of each key; a replayed batch overwrites its own folder, so nothing doubles."""
    rows = spark.read.parquet(f"{path}/history")
    newest = rows.groupBy(key).agg(F.max("batch").alias("batch"))
    return rows.join(newest, [key, "batch"]).drop("batch")
