"""Benchmark decontamination by spaced seeds. DataFrame operations only.

Words are runs of non-white-space (ASCII) with A-Z in lower case. A document is contaminated by a benchmark item if some
``WINDOW`` = 13 consecutive words of the item, laid on one diagonal of the document, agree in at least 0.8 of the places
(11 of 13); an item of 5 to 12 words must occur whole.

Method: the seed ``MASK`` reads places 0, 1, 3, 6 and 7 of eight words and ignores the rest. Every placing of up to two
substitutions in 13 words leaves one seed of this mask untouched, so one mask finds every window asked for
(``tests/llm`` checks all placings). The hashes of the document's seeds meet those of the benchmark in an equi-join that
carries places only; the hits of one diagonal become one row, its least and greatest place, before any words are fetched.
So text that repeats itself (p hits by q) costs one verification a diagonal, of which there are no more than words in both.
Every window asked for holds a hit, so the stretch from WINDOW - 1 places before the first hit to as many after the last
one is laid over the document's words and holds them all. Items of 5 to 7 words are shorter than the mask and use five
adjacent words.

The benchmark's seeds are broadcast if Spark finds their table small by its file sizes, else they are joined by a shuffle,
and so are the hits with their documents: no size is set here.

Defined cases: a null text has no words; items under five words, null items and empty tables match nothing; repeated
rows and items give one pair each; a null doc_id or item_id is reported as such; extra columns are ignored by ``leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
NEED = 11
MASK = (0, 1, 3, 6, 7)
SHORT_MASK = (0, 1, 2, 3, 4)


def words_column(text: Column) -> Column:
    return F.array_remove(F.split(common.ascii_lower(common.text_of(text)), "[ \\t-\\r]+", -1), "")


def _seeds(words: Column, mask: tuple[int, ...]) -> Column:
    """The hash of each placing of a mask, by position. To be exploded with posexplode_outer: for an inner explode the
    optimizer derives a filter on the array's size and computes all the hashes once more for it."""
    n = F.size(words) - mask[-1]
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(mask[-1]), *[F.get(words, i + o) for o in mask]))


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, item_words, their hash, the window and the words that must agree in it; items equal in both count once."""
    items = benchmark.select("item_id", words_column(F.col("text")).alias("item_words")).where(F.size("item_words") >= len(SHORT_MASK)).distinct()
    width = F.least(F.size("item_words"), F.lit(WINDOW))
    return items.select("item_id", "item_words", F.xxhash64("item_words").alias("item_hash"), width.alias("width"), F.when(width < WINDOW, width).otherwise(F.lit(NEED)).alias("need"))


def _hits(docs: DataFrame, items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """One row for each document, item and diagonal with hits: the least and greatest place in the item."""
    short = F.size("item_words") <= MASK[-1]
    seeds = [items.where(short if mask == SHORT_MASK else ~short).select("item_id", "item_hash", F.posexplode(_seeds(F.col("item_words"), mask)).alias("q", "hash")) for mask in masks]
    seeds = common.staged(seeds[0].unionByName(seeds[-1]) if len(masks) > 1 else seeds[0], "seeds")
    read = docs.select("doc_id", F.xxhash64(common.text_of(F.col("text"))).alias("text_hash"), words_column(F.col("text")).alias("words"))
    n = F.greatest(F.lit(0), F.size("words") - masks[0][-1])
    placed = read.select("doc_id", "text_hash", n.alias("n"), F.concat(*[_seeds(F.col("words"), mask) for mask in masks]).alias("seeds"))
    placed = placed.select("doc_id", "text_hash", "n", F.posexplode_outer("seeds").alias("p", "hash"))
    met = placed.join(seeds, "hash").withColumn("p", F.when(F.col("p") < F.col("n"), F.col("p")).otherwise(F.col("p") - F.col("n")))
    met = met.groupBy("doc_id", "text_hash", "item_id", "item_hash", (F.col("p") - F.col("q")).alias("diagonal"))
    return met.agg(F.min("q").alias("q1"), F.max("q").alias("q2"))


def _widest(ends: Column, k: int) -> Column:
    """The widest stretch between two ends with k others inside."""
    return F.array_max(F.transform(ends, lambda e, i: F.get(ends, i + (k + 1)) - e - 1))


def _verified(hits: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The most words that agree in a window of each hit diagonal, where they are enough."""
    read = docs.select("doc_id", F.xxhash64(common.text_of(F.col("text"))).alias("text_hash"), "text")
    wanted = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    same_doc = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    read = read.join(wanted.distinct(), same_doc, "left_semi").select("doc_id", "text_hash", words_column(F.col("text")).alias("words"))
    on = hits.withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash", "item_id": "of_id", "item_hash": "of_hash"})
    on = on.join(items, F.col("item_id").eqNullSafe(F.col("of_id")) & (F.col("item_hash") == F.col("of_hash")))
    met = read.join(on, same_doc)
    first = F.greatest(F.lit(0), -F.col("diagonal"), F.col("q1") - F.col("width") + 1)
    last = F.least(F.size("item_words"), F.size("words") - F.col("diagonal"), F.col("q2") + MASK[-1] + F.col("width"))
    length = F.greatest(F.lit(0), last - first)
    # the grouping takes repeated rows together and keeps the verification, which isn't compiled, out of the join
    cut = met.groupBy("doc_id", "text_hash", "item_id", "item_hash", "width", "need", "diagonal").agg(
        F.first(F.struct(F.slice("words", first + F.col("diagonal") + 1, length).alias("d"), F.slice("item_words", first + 1, length).alias("i"))).alias("parts")
    )
    cut = cut.where(F.size("parts.d") >= F.col("width"))
    differ = F.filter(F.transform("parts.d", lambda w, i: F.when(w == F.get("parts.i", i), F.lit(-1)).otherwise(i)), lambda i: i >= 0)
    out = cut.select("doc_id", "item_id", "width", "need", "diagonal", F.concat(F.array(F.lit(-1)), differ, F.array(F.size("parts.d"))).alias("ends"))
    matched = F.lit(None).cast("int")
    for k in reversed(range(WINDOW - NEED + 1)):  # a window with k words that differ lies between two such words, k of them inside
        matched = F.when((_widest(F.col("ends"), k) >= F.col("width")) & (F.col("width") - k >= F.col("need")), F.col("width") - k).otherwise(matched)
    return out.withColumn("matched", matched).where(F.col("matched").isNotNull()).select("doc_id", "item_id", "width", "diagonal", "matched")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it leaks: the window's width, the most words matched in one, and the diagonals."""
    docs = docs.select("doc_id", "text")
    items = common.staged(_items(benchmark.select("item_id", "text")), "items")
    sizes = items.agg(F.min(F.size("item_words")), F.max(F.size("item_words"))).first()
    if sizes[0] is None:
        found = docs.select("doc_id").limit(0).crossJoin(benchmark.select("item_id").limit(0)).select("doc_id", "item_id", *[F.lit(0).alias(c) for c in ("width", "diagonal", "matched")])
    else:
        masks = [mask for mask, there in ((MASK, sizes[1] > MASK[-1]), (SHORT_MASK, sizes[0] <= MASK[-1])) if there]
        found = _verified(common.staged(_hits(docs, items, masks), "hits"), docs, items)
    return found.groupBy("doc_id", "item_id").agg(F.max("width").alias("window_words"), F.max("matched").alias("matched_words"), F.countDistinct("diagonal").alias("n_places"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that leak an item; rows without a doc_id stay."""
    ids = common.staged(leaks(docs, benchmark).select(F.col("doc_id").alias("__leaked")).where(F.col("__leaked").isNotNull()).distinct(), "leaked")
    return docs.join(ids, F.col("doc_id") == F.col("__leaked"), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    found = leaks(common.read_texts(spark, sf_dir, "documents", "doc_id", "text"), common.read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("window_words").cast("long"), F.col("matched_words").cast("long"), F.col("n_places").cast("long"))


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda w: w <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda w: w <> '') AS words FROM benchmark),
bw AS (SELECT item_id, len(words) AS n_item, least(len(words), 13) AS width, CASE WHEN len(words) >= 13 THEN 11 ELSE len(words) END AS need,
         unnest(words) AS word, generate_subscripts(words, 1) AS q FROM b WHERE len(words) >= 5),
dw AS (SELECT doc_id, len(words) AS n_doc, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
m AS (SELECT doc_id, item_id, p - q AS diagonal, q, width, need, n_item, n_doc FROM dw JOIN bw USING (word)),
g AS (SELECT doc_id, item_id, diagonal, width, need,
        count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS in_window,
        least(n_item, n_doc - diagonal) - greatest(1, 1 - diagonal) + 1 AS laid FROM m)
SELECT doc_id, item_id, max(width)::BIGINT AS window_words, max(in_window)::BIGINT AS matched_words, count(DISTINCT diagonal)::BIGINT AS n_places
FROM g WHERE in_window >= need AND laid >= width GROUP BY doc_id, item_id
"""
