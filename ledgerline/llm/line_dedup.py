"""Line deduplication that returns keep ranges, not text. DataFrame operations only.

A line's key is the line without ASCII white space at its ends, with A-Z in lower case. A key of at least
``min_chars`` code points that two or more documents hold keeps its lines in the smallest doc_id alone.

Method: 128-bit key hashes are range-partitioned and sorted by document and position; a window streams the first
document of each key. A key with more than 1/``HOT_PARTS`` of all lines, or an eighth of a partition's share where there are
over ``HOT_PARTS`` / 8 partitions, never enters that window: there are fewer such keys than that divisor by arithmetic, so
their first documents are found by a pre-aggregated group-by and joined back as a broadcast of bounded size. What is returned per document is a run-length compressed keep bitmap: the ranges
(start, len) of lines that stay.

Defined cases: a null text is one empty line; lines with a null doc_id neither count nor go; rows with equal doc_id and
equal text are one document with one result; rows with equal doc_id and different texts are one document for the rule
"in at least two documents", each with its own bitmap; extra columns are ignored by ``keep_ranges`` and kept by
``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

HOT_PARTS = 1024
#: Below this many lines no key is hot.
HOT_LEAST = 4096
RANGES = "array<struct<start:int,len:int>>"


def _lines(text: Column) -> Column:
    return F.split(common.text_of(text), "\n", -1)


def _line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that can be a duplicate: document, position, two 64-bit hashes of the key."""
    text = common.text_of(F.col("text"))
    lines = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    bare = lines.withColumn("line", F.trim(F.col("line"), F.lit(common.ASCII_SPACE))).where(F.char_length("line") >= min_chars)
    key = bare.withColumn("line", common.ascii_lower(F.col("line")))
    return key.select("doc_id", "text_hash", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, pos) of every line that goes."""
    spark = docs.sparkSession
    lines = common.staged(_line_table(docs.select("doc_id", "text"), min_chars), "lines")
    part = F.pmod(F.col("h1"), F.lit(1 << 16))
    sums = lines.groupBy(part.alias("part")).count()
    total = sums.agg(F.sum("count")).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(HOT_LEAST, total // max(HOT_PARTS, 8 * width))
    parts = [r["part"] for r in sums.where(F.col("count") > least).collect()]  # fewer than the divisor, as they sum to the total
    cold, gone = lines, None
    if parts:
        hot = lines.where(part.isin(parts)).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where(F.col("n") > least).drop("n")
        rows = hot.collect()  # as many at most
        if rows:
            hot = F.broadcast(spark.createDataFrame(rows, hot.schema))
            cold = lines.join(hot, ["h1", "h2"], "left_anti")
            gone = lines.join(hot, ["h1", "h2"]).where(F.col("doc_id") != F.col("first_doc")).select("doc_id", "text_hash", "pos")
    sorted_by_key = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    repeats = cold.repartitionByRange(width, "h1", "h2").withColumn("first_doc", F.first("doc_id").over(sorted_by_key)).where(F.col("doc_id") != F.col("first_doc")).select("doc_id", "text_hash", "pos")
    return repeats if gone is None else repeats.unionByName(gone)


def _kept_ranges(gone: Column, n_lines: Column) -> Column:
    """The ranges between the runs of dropped positions, empty ones left out."""
    first = F.filter(gone, lambda p, i: (i == 0) | (F.get(gone, i - 1) < p - 1))
    last = F.filter(gone, lambda p, i: (i == F.size(gone) - 1) | (F.get(gone, i + 1) > p + 1))
    before = F.transform(first, lambda s, i: F.when(i == 0, F.lit(0)).otherwise(F.get(last, i - 1) + 1))
    ranges = F.zip_with(before, first, lambda a, b: F.struct(a.alias("start"), (b - a).alias("len")))
    end = F.array_max(gone) + 1
    return F.filter(F.concat(ranges, F.array(F.struct(end.alias("start"), (n_lines - end).alias("len")))), lambda r: r["len"] > 0)


def keep_ranges(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, gone): the sorted dropped positions of each document that loses lines."""
    return dropped_lines(docs, min_chars).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def with_bitmaps(docs: DataFrame, min_chars: int = 10, names: tuple[str, str, str] = ("n_lines", "n_dropped", "keep")) -> DataFrame:
    """docs with n_lines, n_dropped and keep (the compressed bitmap) beside its own columns; columns of these names are replaced."""
    marks = keep_ranges(docs, min_chars).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("gone").alias("__gone"))
    out = docs.withColumn("__th", F.xxhash64(common.text_of(F.col("text"))))
    out = out.join(marks, (F.col("doc_id") == F.col("__id")) & (F.col("__th") == F.col("__hash")), "left")
    n = F.size(_lines(F.col("text")))
    whole = F.array(F.struct(F.lit(0).alias("start"), n.alias("len"))).cast(RANGES)
    return out.select(
        *[c for c in docs.columns if c not in names],
        n.cast("long").alias(names[0]),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias(names[1]),
        F.when(F.col("__gone").isNull(), whole).otherwise(_kept_ranges(F.col("__gone"), n).cast(RANGES)).alias(names[2]),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The text that a keep bitmap leaves."""
    lines = _lines(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n")


def _left(n_dropped: str = "n_dropped", keep: str = "keep") -> Column:
    return F.when(F.col(n_dropped) == 0, common.text_of(F.col("text"))).otherwise(kept_text(F.col("text"), F.col(keep)))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """docs with the lines that go taken out of text; n_chars, where there is one, follows."""
    names = ("__n_lines", "__n_dropped", "__keep")
    marked = with_bitmaps(docs, min_chars, names).withColumn("text", _left(*names[1:]))
    if "n_chars" in docs.columns:
        marked = marked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return marked.select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    marked = with_bitmaps(docs)
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(_left(), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.first_doc AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
