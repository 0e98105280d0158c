"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, connected components.

A fingerprint bit is set if it is set in over half of the XXH64 hashes (seed 42) of the document's word shingles, repeats
included. Fingerprints link at ``DISTANCE`` = 3 or fewer differing bits.

Method: the 64 bits are split into ``BLOCKS`` = 6 blocks; two fingerprints at distance three or less share at least three
blocks, so each distinct fingerprint goes to 20 buckets, one for each choice of three blocks (about 32 bits), and is
compared inside its buckets only. Copies meet first: a bucket holds distinct fingerprints. A bucket emits a star for each
of its connected groups, at most one link per member, never its pairs. Buckets are counted first: those of more than
``BUCKET_LIMIT`` fingerprints never meet in a task; their members go to the ball join of ``_ball_links``, which is exact,
linear in their number and has groups bounded by geometry (a ball of radius one has 65 points).

Defined cases: a null or blank text has fingerprint zero and links like any other; repeated rows and ties are one class;
ids may be of any type that has an order; rows with a null doc_id link others like any row, and a component of such rows
alone has a null id; empty tables give empty results; extra columns are ignored by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6
BUCKET_LIMIT = 16384
_CHUNK = 1 << 15


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """A 64-bit mask for each choice of blocks - distance blocks."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    parts = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; a shorter text is one shingle, an empty one none."""
    words = common.words_of(text or "")
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    grams = zip(*[words[i:] for i in range(shingle)], strict=False) if len(words) >= shingle else [words]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one whole text."""
    return fingerprint_of(shingle_hashes(text, shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of a text by its shingles' hashes; zero for none."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint16 if len(part) < 65536 else np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), fp as a signed long."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.pieces_of(batches):
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return common.map_arrow(docs.select("doc_id", F.col("text").cast("string")), work, f"doc_id {id_type}, fp long")


def _stars(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each connected group of a bucket of distinct sorted fingerprints: its members without the first, and the first."""
    left = np.arange(len(fp))
    while len(left) > 1:
        group, left = [left[0]], left[1:]
        for at in group:  # grows while it is walked
            if not len(left):
                break
            near = np.bitwise_count(fp[left] ^ fp[at]) <= distance
            group.extend(left[near])
            left = left[~near]
        if len(group) > 1:
            yield fp[group[1:]], fp[group[0]]


def _bucket_links(distance: int):
    """Streams (part, key, fp) sorted by bucket; emits links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held, n = None, [], 0
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []

        def solve() -> None:
            if n > 1:
                for members, least in _stars(np.concatenate(held), distance):
                    a.append(members)
                    b.append(np.full(len(members), least))

        def rows() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
            a.clear()
            b.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            cut = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            start, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
            for k in np.unique(np.concatenate([[0], np.flatnonzero(end - start > 1), [len(start) - 1]])):
                s, e = start[k], end[k]
                this = (part[s], key[s])
                if this != open_key:
                    solve()
                    open_key, held, n = this, [], 0
                held.append(fp[s:e].copy())
                n += e - s
            if a:
                yield rows()
        solve()
        if a:
            yield rows()

    return work


def _ball_links(members: DataFrame) -> DataFrame:
    """Links among fingerprints at distance three or less, by the points between them.

    Such a pair has a point within one bit of one and two bits of the other. At each point all that are within one bit
    are linked to the least of them (any two differ in two bits or less), and so are all within two bits.
    """
    one = [0] + [1 << i for i in range(64)]
    two = one + [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    signed = lambda xs: F.array(*[F.lit(x - (1 << 64) if x >> 63 else x) for x in xs])
    points = lambda xs: members.select("fp", F.explode(F.transform(signed(xs), lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    hubs = common.staged(points(one).groupBy("point").agg(F.min("fp").alias("hub")), "hubs")
    return points(two).join(hubs, "point").where("fp != hub").select(F.col("fp").alias("a"), hubs["hub"].alias("b")).distinct()


def links(classes: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between fingerprints whose components are those of the links at distance three or less. classes: distinct fp."""
    spark = classes.sparkSession
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks()]
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    dealt = classes.select(F.explode(keys).alias("k"), "fp").select("k.part", "k.key", "fp")
    over = common.staged(dealt.groupBy("part", "key").count().where(F.col("count") > limit).drop("count"), "over")
    balls = None
    if not over.isEmpty():
        balls = _ball_links(common.staged(dealt.join(over, ["part", "key"], "left_semi").select("fp").distinct(), "members"))
        dealt = dealt.join(over, ["part", "key"], "left_anti")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(width, "part", "key").sortWithinPartitions("part", "key", "fp")
    out = common.map_arrow(dealt, _bucket_links(DISTANCE), "a long, b long")
    return out if balls is None else out.unionByName(balls)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs; a component is named by its least doc_id."""
    marked = common.staged(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    classes = common.staged(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes.select("fp"), limit))
    named = common.staged(classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "named")
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return marked.join(common.staged(named.join(names, "root").select("fp", "component_id"), "labels"), "fp")


def dedup_documents(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with one document, that of the least doc_id, for each group; rows without a doc_id stay."""
    gone = near_duplicates(docs, shingle).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(common.staged(gone, "gone"), F.col("doc_id") == F.col("__gone"), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    marked = near_duplicates(common.read_texts(spark, sf_dir, "documents", "doc_id", "text"))
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
