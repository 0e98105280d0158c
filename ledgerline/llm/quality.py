"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are hashed unigrams and bigrams of two views of the text: the words as written, and their shapes (letters and
digits collapsed to one sign each, punctuation kept, a word equal to the one before it as its own sign). A document's
vector holds each feature's share of its n-grams. Weights come from FTRL-proximal updates with per-coordinate rates over
``EPOCHS`` passes; a score is the sparse dot product of vector and weights, through the logistic function.

Training reads at most ``SAMPLE`` labelled documents, taken by a hash of their ids, half of each class where there are as
many; the intercept is set back to the classes' shares in all labels. Updates follow one another, so one task trains, in a
fixed order; it holds the weights and, packed, the vectors of the bounded sample. Scoring covers every whole text.

Defined cases: null and empty texts have the intercept's score; repeated rows score alike; with no labels every score is
0.5; labels of unknown documents and nulls count for nothing; extra columns are kept by ``filter_quality``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, sampling

BITS = 20
SAMPLE = 12_000
#: Passes over the sample: at least EPOCHS, and more over a small one, up to EPOCHS_MOST, until STEPS updates are made.
EPOCHS, EPOCHS_MOST, STEPS = 4, 40, 48_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-6, 1e-6
SCALE = 20.0
KEEP_FROM = 0.3
_CACHE = 200_000
_CLASSES = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


class _Words(dict):
    """word -> its hash and, in the upper half, that of its shape; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUNS.sub(rb"\1", word.translate(_CLASSES))
        both = zlib.crc32(word) | zlib.crc32(shape) << 32
        if len(self) < _CACHE:
            self[word] = both
        return both


_SAME = np.uint64(zlib.crc32(b"\x00same"))
_MIX, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)


def features(text: str, words: _Words) -> np.ndarray:
    """The slots of all n-grams of a text, one for each occurrence."""
    split = text.encode("utf-8", "surrogatepass").split()
    if not split:
        return np.zeros(0, np.int64)
    both = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    word, shape = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    shape[1:][word[1:] == word[:-1]] = _SAME
    views = [word, shape + np.uint64(1 << 40)]
    for k, v in enumerate(list(views)):
        views.append((v[:-1] * np.uint64(0x100000001B3) ^ v[1:]) + np.uint64((k + 2) << 41))
    return ((np.concatenate(views) * _MIX) >> _TURN).astype(np.int64)


def vector(slots: np.ndarray) -> bytes:
    """A document's vector, packed: distinct slots and how often each occurs."""
    at, n = np.unique(slots, return_counts=True)
    return zlib.compress(at.astype("<i4").tobytes() + n.astype("<i4").tobytes(), 1)


def unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a vector and each one's share of the n-grams, times SCALE."""
    at, n = np.frombuffer(zlib.decompress(packed), "<i4").reshape(2, -1).astype(np.int64)
    return at, (n * (SCALE / max(1, n.sum()))).astype(np.float32)


def train(examples: Iterator[tuple[int, bytes]]) -> np.ndarray:
    """Weights, the intercept last. examples: (label, packed vector)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = np.array([1 << BITS])

    def step(y: int, at: np.ndarray, x: np.ndarray) -> None:
        at, x = np.concatenate([at, bias]), np.concatenate([x, [1.0]])
        w = -(z[at] - np.clip(z[at], -L1, L1)) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
        n[at] += g * g

    held = list(examples)
    for _ in range(min(EPOCHS_MOST, max(EPOCHS, STEPS // max(1, len(held))))):
        for y, packed in held:
            step(y, *unpacked(packed))
    return (-(z - np.clip(z, -L1, L1)) / ((BETA + np.sqrt(n)) / ALPHA + L2)).astype(np.float32)


def score_text(text: str, weights: np.ndarray, words: _Words) -> float:
    slots = features(text, words)
    dot = float(weights[slots].sum(dtype=np.float64)) * SCALE / len(slots) if len(slots) else 0.0
    return 1 / (1 + float(np.exp(-np.clip(dot + weights[-1], -35, 35))))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", bound: int = SAMPLE) -> np.ndarray:
    """Weights learned from the labels outside the held-out fold; the intercept, last, fits the shares in all labels."""
    sample, shares = sampling.labelled_sample(labels, column, bound)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in common.pieces_of(batches):
            vectors = [vector(features(t, words)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vectors, pa.binary())], names=["y", "vector"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in common.pieces_of(batches) for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(train(rows).tobytes(), 1)], pa.binary())], names=["model"])

    examples = common.map_arrow(sampling.sampled_texts(docs, sample).select("y", "text"), hashed, "y int, vector binary")
    examples = examples.withColumn("place", F.xxhash64("vector"))
    weights = np.frombuffer(zlib.decompress(sampling.trained(examples, ["place", "y"], learn)), np.float32).copy()
    weights[-1] -= sampling.log_odds_shift(shares)
    return weights


def scored(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """docs with a score beside their columns; a column of that name is replaced."""
    docs = docs.drop(name)
    model = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = _Words(), model.value
        for b in common.pieces_of(batches):
            scores = [score_text(t or "", w, words) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return common.map_arrow(docs, work, f"{fields}, `{name}` double")


def filter_quality(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """docs whose score is at least keep_from."""
    name = "__quality_score"
    return scored(docs, fit(docs, labels), name).where(F.col(name) >= keep_from).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    out = scored(docs, fit(docs, common.read_table(spark, sf_dir, "labels")))
    held = common.bucket_of(F.col("doc_id"), sampling.FOLDS) == sampling.HELD_OUT
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
