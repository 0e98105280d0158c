"""What the corpus operators share: table access, word rules, staged tables, Arrow helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word and line rules: space and bytes 9 to 13.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: An input of so few splits is dealt out to all cores before it is worked on; larger ones are read as they are split.
FEW_SPLITS = 4


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_splits(df: DataFrame) -> int:
    """How many tasks read a table."""
    return df.rdd.getNumPartitions()


def read_texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of texts, all of it; one of a few splits, so of a few hundred MB at most, is spread over the cores."""
    df = read_table(spark, sf_dir, name)
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if n_splits(df) <= min(FEW_SPLITS, cores - 1) else df


_OWN_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only where none is set, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_SCRATCH:
        _OWN_SCRATCH.append("file://" + tempfile.mkdtemp(prefix="ledgerline-"))
    return _OWN_SCRATCH[0]


_STAGED: list[str] = []


def staged_tables() -> tuple[str, ...]:
    return tuple(_STAGED)


def drop_staged(spark: SparkSession, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables that this driver staged, but for those to keep. Call it once results are written: they read these
    tables lazily."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    gone = [p for p in _STAGED if p not in keep]
    _STAGED[:] = [p for p in _STAGED if p in keep]
    for p in gone:
        path = hadoop.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: lineage is cut, and losing executors loses nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_ledgerline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline")
    context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    context._ledgerline_shipped = True


#: What a Python worker keeps from one task for the next, under the name of the operator that it serves; of one at a time.
_KEPT: dict[str, dict] = {}


def kept(name: str) -> dict:
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = {}
    return _KEPT[name]


def _begin(keeps: str | None) -> None:
    if keeps not in _KEPT:
        _KEPT.clear()


def _release() -> None:
    """Gives memory that is free back to the system: workers live on, and what one stage took is missed by the next."""
    pa.default_memory_pool().release_unused()
    try:
        import ctypes

        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: object, keeps: str | None = None) -> DataFrame:
    """mapInArrow by a function of this package. keeps: the name under which its workers keep things between tasks, if they do."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(keeps)
        yield from work(batches)
        _release()

    return df.mapInArrow(task, schema)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure-ASCII strings take the byte-wise path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_of(column: Column) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(column.cast("string"), F.lit(""))


def bucket_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def words_of(text: str) -> list[bytes]:
    """Words of non-white-space with A-Z lower-cased: bytes.split and bytes.lower know ASCII only, as the rule wants."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def batch(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A record batch with the columns in the schema's order."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f in schema for c in [columns[f.name]]], schema=schema)


#: A slice of a batch holds at most so many rows and, but for single rows that are larger, so many bytes of texts and lists.
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def _weights(column: pa.Array) -> np.ndarray | None:
    kind = column.type
    if pa.types.is_list(kind):
        return pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * 8
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        return pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return None


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches, bounded in rows and bytes, so that what one slice makes stays small for very long texts."""
    for b in batches:
        weights = [w for w in map(_weights, b.columns) if w is not None]
        ends = np.cumsum(sum(weights)) if weights else np.zeros(b.num_rows, np.int64)
        at, before = 0, 0
        while at < b.num_rows:
            stop = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
            yield b.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])
