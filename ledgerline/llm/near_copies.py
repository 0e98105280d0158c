"""Near copies by SimHash and by the Jaccard similarity of word shingles: all pairs at ``SIMILARITY`` or more, none by chance.

SimHash alone can't give them: texts that agree in 0.8 of their shingles differ in about ten of 64 bits, where no choice of
blocks tells them from others. So its pigeonhole search finds the closest candidates, those within three bits, and a search
by prefixes, which is exact, completes them; both kinds are verified on the whole sets.

A document is the set of XXH64 hashes (seed 42) of its runs of ``SHINGLE`` words; a shorter text is one shingle. Sets that
agree in a share t have at least t of the larger one's hashes in common, so they share one of the (1 - t) n + 1 least
hashes of each (prefix filtering). Equal sets meet first. Then, over the sets that share a prefix hash:

1. each is compared with the least set of the hash, and with those that ``simhash.links`` finds; what agrees gets a label by
   its connected component;
2. over the sets of one hash whose labels still differ, a forest of the likeliest pairs is compared, and labels grow;
3. all pairs of one hash whose labels still differ are compared. A large group of near copies has one label by then and
   makes no pairs; a parity bitmap, whose distance never exceeds that of the sets, rules out most others.

Candidates are verified on the whole sets. Groups are the connected components of verified links.

Defined cases: a null text is an empty one; empty texts are equal; classes whose rows all lack a doc_id link nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, simhash
from .components import components

SHINGLE, SIMILARITY, SEED = 5, 0.8, simhash.SEED
LEAST_BITS, MOST_BITS = 512, 8192
_ROWS = 1 << 16


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; empty for an empty text."""
    return np.unique(simhash.shingle_hashes(text, shingle))


def key_of(hashes: np.ndarray) -> int:
    """A signed hash of a whole set."""
    return xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED) - (1 << 63)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parities of the hashes by residue, about a bit a hash: two sets differ in at least as many hashes as their bitmaps in bits."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, len(hashes) - 1).bit_length()))
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap as 64-bit words, halved to size bytes: residues by half as many are the halves' exclusive or."""
    words = np.frombuffer(bits, "<u8")
    while 8 * len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def _marked(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(doc_id, key, n, fp, bits, prefix)"""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    longs = pa.list_(pa.int64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            sets, marks = [], np.zeros(b.num_rows, np.uint64)
            for i, t in enumerate(b.column(1).to_pylist()):
                hashes = simhash.shingle_hashes(t, shingle)
                marks[i] = simhash.fingerprint_of(hashes)
                sets.append(np.unique(hashes))
            columns = [pa.array([key_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(marks.view(np.int64)), pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([s[: prefix_length(len(s), similarity)].view(np.int64) for s in sets], longs)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "key", "n", "fp", "bits", "prefix"])

    return common.map_arrow(docs.select("doc_id", F.col("text").cast("string")), work, f"doc_id {id_type}, key long, n int, fp long, bits binary, prefix array<long>")


def _within(size: object, distance: object, similarity: float) -> object:
    """Whether sets of so many hashes together, which differ in at least distance ones, may agree well enough."""
    return distance * (1 + similarity) <= size * (1 - similarity) + 1e-6


def _unlike(similarity: float, forest: bool):
    """Streams (h, key, label, n, bits) sorted by h; emits pairs of different labels that may be near copies: all, or a forest."""

    def pairs(key: np.ndarray, label: np.ndarray, n: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, first = np.unique(key, return_index=True)
        by_size = np.argsort(n[first], kind="stable")
        key, first = key[by_size], first[by_size]
        label, n, bits = label[first], n[first], bits[first]
        ends = np.searchsorted(n, n / similarity + 1e-6, side="right")
        sizes = np.fromiter(map(len, bits), np.int64, len(bits))
        for size in np.unique(sizes):
            start, stop = np.searchsorted(sizes, size), np.searchsorted(sizes, size, side="right")
            table = np.stack([folded(x, size) for x in bits[start : ends[start:stop].max()]])
            for i in range(start, stop):
                others = np.arange(i + 1, ends[i])
                others = others[label[others] != label[i]]
                if len(others):
                    distance = np.bitwise_count(table[others - start] ^ table[i - start]).sum(axis=1, dtype=np.int64)
                    fits = _within(n[others] + n[i], distance, similarity)
                    others = others[fits]
                    if forest and len(others):  # the likeliest of each other tree, which then is one with this tree
                        others = others[np.argsort(distance[fits] / (n[others] + n[i]), kind="stable")]
                        trees, first = np.unique(label[others], return_index=True)
                        others = others[first]
                        label[np.isin(label, trees)] = label[i]
                    near = key[others]
                    if len(near):
                        yield np.maximum(near, key[i]), np.minimum(near, key[i])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        open_h = None

        def solve(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            if len(held) == 0:
                return
            a, b, rows = [], [], 0
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            for x, y in pairs(*columns):
                a.append(x)
                b.append(y)
                rows += len(x)
                if rows > _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                    a, b, rows = [], [], 0
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            h, key, label, n, bits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            cut = np.flatnonzero(h[1:] != h[:-1]) + 1
            for s, e in zip([0, *cut], [*cut, len(h)], strict=True):
                if h[s] != open_h:
                    yield from solve(held)
                    held, open_h = [], h[s]
                held.append((key[s:e].copy(), label[s:e].copy(), n[s:e].copy(), bits[s:e].copy()))
        yield from solve(held)

    return work


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of keys that sizes and bitmaps don't rule out."""
    one, other = classes.select("key", "n", "bits").toDF("a", "na", "bits_a"), classes.select("key", "n", "bits").toDF("b", "nb", "bits_b")
    met = pairs.join(one, "a").join(other, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-6)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            keep = []
            for n, x, y in zip(*(b.column(i).to_pylist() for i in range(2, 5)), strict=True):
                size = min(len(x), len(y))
                keep.append(bool(_within(n, int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()), similarity)))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return common.map_arrow(met.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "bits_a", "bits_b"), work, "a long, b long")


def _verified(likely: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of keys whose whole sets agree."""
    keys = likely.select(F.col("a").alias("key")).union(likely.select(F.col("b").alias("key"))).distinct()
    wanted = common.staged(classes.join(keys, "key", "left_semi").select("rep").distinct(), "wanted")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            sets = [shingles(t, shingle) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([key_of(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["key", "hashes"])

    texts = docs.join(wanted, F.col("doc_id") == F.col("rep"), "left_semi").select(F.col("text").cast("string"))
    sets = common.map_arrow(texts, hashed, "key long, hashes binary").groupBy("key").agg(F.first("hashes").alias("hashes"))
    sets = common.staged(sets, "sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches, 64):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common_ = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common_ >= similarity * (len(x) + len(y) - common_) - 1e-6)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    met = likely.join(sets.toDF("a", "hashes_a"), "a").join(sets.toDF("b", "hashes_b"), "b").select("a", "b", "hashes_a", "hashes_b")
    return common.staged(common.map_arrow(met, verify, "a long, b long"), "verified")


def _apart(rows: DataFrame, links: DataFrame, classes: DataFrame, similarity: float, forest: bool) -> DataFrame:
    """Pairs of sets with a hash in common that may be near copies and that links don't connect: all, or a forest. rows: h, key."""
    labels = common.staged(components(links), "labels")
    rows = rows.join(labels, rows["key"] == labels["node"], "left").select("h", "key", F.coalesce("root", "key").alias("label"))
    rows = common.staged(rows, "labelled")
    met = F.xxhash64("key")
    mixed = rows.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m"), F.bit_xor(met).alias("met"), F.min(met).alias("low")).where("x < y and m > 2")
    mixed = common.staged(mixed.groupBy("x", "y", "m", "met", "low").agg(F.min("h").alias("h")).select("h"), "mixed")  # hashes of the same sets: one is enough
    left = rows.join(mixed, "h", "left_semi").join(classes.select("key", "n", "bits"), "key").select("h", "key", "label", "n", "bits")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(width, "h").sortWithinPartitions("h")
    return common.staged(common.map_arrow(left, _unlike(similarity, forest), "a long, b long").distinct(), "unlike")


def _close_fingerprints(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys: each set with the least one of its fingerprint, and the least ones of the fingerprints that
    SimHash links."""
    held = common.staged(classes.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("m")), "fingerprints")
    same = classes.join(held.where("m > 1"), "fp").where("key != least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    met = simhash.links(held.select("fp"))
    met = met.join(held.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(held.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    return same.unionByName(met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")))


def near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) for each row of docs; a component is named by its least doc_id."""
    docs = docs.select("doc_id", "text")
    marked = common.staged(_marked(docs, shingle, similarity), "sketches")
    classes = common.staged(marked.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix")), "sets")
    linked = classes.where(F.col("rep").isNotNull())
    rows = linked.select("key", F.explode("prefix").alias("h"))
    shared = common.staged(rows.groupBy("h").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").drop("most"), "shared")
    rows = common.staged(rows.join(shared, "h"), "prefixes")
    starred = rows.where("key != least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    starred = starred.unionByName(_close_fingerprints(linked)).distinct()
    first = _verified(common.staged(_likely(starred, linked, similarity), "likely"), docs, linked, shingle, similarity)
    forest = _apart(rows, first, linked, similarity, True)
    links = common.staged(first.unionByName(_verified(forest, docs, linked, shingle, similarity)), "links")
    links = links.unionByName(_verified(_apart(rows, links, linked, similarity, False), docs, linked, shingle, similarity))
    roots = common.staged(components(links), "roots")
    named = classes.join(roots, classes["key"] == roots["node"], "left").select(classes["key"], "rep", F.coalesce("root", "key").alias("root"))
    named = common.staged(named, "named")
    names = common.staged(named.groupBy("root").agg(F.min("rep").alias("component_id")), "names")
    return marked.select("doc_id", "key").join(common.staged(named.join(names, "root").select("key", "component_id"), "components"), "key").select("doc_id", "component_id")


def dedup_documents(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document, that of the least doc_id, for each group; rows without a doc_id stay."""
    gone = near_copies(docs, shingle, similarity).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(common.staged(gone, "gone"), F.col("doc_id") == F.col("__gone"), "left_anti")
