"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the byte n-grams of ``ORDERS`` of the whole text, A-Z in lower case and white space as one space, hashed to
2**``BITS`` slots, present or absent. The log-count ratio of a slot is the log of its share among toxic documents over its
share among the others, smoothed by ``ALPHA``. The ``KEEP`` slots that tell the classes apart best stay; a logistic
regression with an L2 penalty is fitted on presence times ratio (L-BFGS), and both factors fold into one weight a slot.

Training reads at most ``SAMPLE`` labelled documents, taken by a hash of their ids, half of each class where there are as
many; the intercept is set back to the classes' shares in all labels. The slots are counted in each task and summed by a
shuffle; then each document is cut down to the chosen slots, at most ``KEEP``, and only those go to the one task that fits
the regression. Scoring covers every whole text.

Defined cases: null and empty texts have the intercept's score; repeated rows score alike; with no labels every score is
0.5; labels of unknown documents and nulls count for nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, sampling

BITS = 20
ORDERS = (3, 4, 5)
SAMPLE = 6_000
KEEP = 10_000
ALPHA = 1.0
PENALTY = 1.0
TOXIC_FROM = 0.5
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
_PRIME, _MIX, _TURN = np.uint32(0x01000193), np.uint32(0x9E3779B1), np.uint32(32 - BITS)


def slots(text: str) -> Iterator[np.ndarray]:
    """For each order, the slot of each n-gram of a text, repeats included."""
    raw = b" " + _SPACES.sub(b" ", text.encode("utf-8", "surrogatepass").lower()).strip() + b" "
    if len(raw) < 3:
        return
    codes = np.frombuffer(raw, np.uint8).astype(np.uint32) + np.uint32(1)
    h = codes
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            return
        h = h[:-1] * _PRIME ^ codes[order - 1 :]
        if order in ORDERS:
            yield (((h ^ (h >> np.uint32(15))) * _MIX) >> _TURN).astype(np.int32)


def present(text: str, flags: np.ndarray) -> np.ndarray:
    """The distinct slots of a text; flags is scratch space, all False before and after."""
    for s in slots(text):
        flags[s] = True
    at = np.flatnonzero(flags)
    flags[at] = False
    return at


def _lbfgs(loss, w: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    f, g = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d, back = -g, []
        for s, y, r in reversed(steps):
            a = r * (s @ d)
            d = d - a * y
            back.append(a)
        if steps:
            s, y, r = steps[-1]
            d = d / (r * (y @ y))
        for (s, y, r), a in zip(steps, reversed(back), strict=True):
            d = d + s * (a - r * (y @ d))
        slope, t = g @ d, 1.0 if steps else 1.0 / max(1.0, float(np.linalg.norm(g)))
        for _ in range(25):
            new_f, new_g = loss(w + t * d)
            if new_f <= f + 1e-4 * t * slope:
                break
            t /= 2
        else:
            return w
        s, y = t * d, new_g - g
        w, done = w + s, f - new_f < 1e-7 * max(1.0, abs(f))
        f, g = new_f, new_g
        if s @ y > 1e-12:
            steps = [*steps[1 - memory :], (s, y, 1.0 / (s @ y))] if len(steps) >= memory else [*steps, (s, y, 1.0 / (s @ y))]
        if done:
            return w
    return w


def train(rows: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """One weight a slot, the intercept last. rows: each document's places in chosen; ratio: each chosen slot's log-count ratio."""
    weights = np.zeros((1 << BITS) + 1, np.float32)
    n1, n0 = int(y.sum()), int((1 - y).sum())
    if not n1 or not n0:
        weights[-1] = 0.0 if not n1 + n0 else (4.0 if n1 else -4.0)
        return weights
    row, col = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    value = ratio[col]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(row, value * w[col], len(rows)) + w[-1]
        g = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y
        grad = np.append(np.bincount(col, value * g[row], len(chosen)) + PENALTY * w[:-1], g.sum())
        return float(np.logaddexp(0, margin).sum() - (y * margin).sum() + PENALTY / 2 * (w[:-1] @ w[:-1])), grad

    w = _lbfgs(loss, np.append(np.zeros(len(chosen)), math.log(n1 / n0)))
    weights[chosen] = w[:-1] * ratio
    weights[-1] = w[-1]
    return weights


def _chosen(p: np.ndarray, q: np.ndarray, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """The log-count ratio of every slot, and the slots that tell the classes apart best by the likelihood ratio of
    their presence: what a slot tells, not only how lopsided it is. Slots of fewer than three documents tell nothing."""
    ratio = np.log((p + ALPHA) / (p + ALPHA).sum()) - np.log((q + ALPHA) / (q + ALPHA).sum())
    there, total = p + q, n1 + n0
    a, b = (p + 0.5) / (n1 + 1), (q + 0.5) / (n0 + 1)
    m = (there + 1) / (total + 2)
    worth = p * np.log(a / m) + q * np.log(b / m) + (n1 - p) * np.log((1 - a).clip(1e-9) / (1 - m)) + (n0 - q) * np.log((1 - b).clip(1e-9) / (1 - m))
    worth[there < 3] = 0
    return ratio, np.sort(np.argsort(-worth, kind="stable")[:KEEP])


def score_text(text: str, weights: np.ndarray, known: np.ndarray) -> float:
    """known: which slots have a weight. Each n-gram counts once, so those with a weight are gathered and made distinct."""
    at = [s[known[s]] for s in slots(text)]
    total = float(weights[np.unique(np.concatenate(at))].sum(dtype=np.float64)) if at else 0.0
    return 1 / (1 + math.exp(-min(35.0, max(-35.0, total + float(weights[-1])))))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", bound: int = SAMPLE) -> np.ndarray:
    """Weights learned from the labels outside the held-out fold; the intercept, last, fits the shares in all labels."""
    sample, shares = sampling.labelled_sample(labels, column, bound)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << BITS, bool)
        for b in common.pieces_of(batches):
            rows = [zlib.compress(present(t, flags).astype("<i4").tobytes(), 1) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["y", "slots"])

    def unpacked(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for y, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            yield y, np.frombuffer(zlib.decompress(s), "<i4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.zeros((2, 1 << BITS), np.int64)
        for b in common.pieces_of(batches):
            for y, at in unpacked(b):
                there[y, at] += 1
        at = np.flatnonzero(there.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(there[1, at]), pa.array(there[0, at])], names=["slot", "p", "q"])

    examples = common.staged(common.map_arrow(sampling.sampled_texts(docs, sample).select("y", "text"), hashed, "y int, slots binary"), "examples")
    sizes = {r["y"]: r["count"] for r in examples.groupBy("y").count().collect()}
    sums = common.map_arrow(examples, count, "slot long, p long, q long").groupBy("slot").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).where("p + q >= 3").toArrow()  # a row a slot at most
    p, q = np.zeros((2, 1 << BITS))
    p[sums["slot"].to_numpy()], q[sums["slot"].to_numpy()] = sums["p"].to_numpy(), sums["q"].to_numpy()
    ratio, chosen = _chosen(p, q, sizes.get(1, 0), sizes.get(0, 0))
    ratio = ratio[chosen]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        for b in common.pieces_of(batches):
            rows = [place[at] for _, at in unpacked(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[r >= 0].tobytes() for r in rows], pa.binary())], names=["y", "slots"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y, np.frombuffer(s, np.int32)) for b in common.pieces_of(batches) for y, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        model = train([r for _, r in rows], np.array([float(y) for y, _ in rows]), chosen, ratio)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(model.tobytes(), 1)], pa.binary())], names=["model"])

    examples = common.map_arrow(examples, cut, "y int, slots binary").withColumn("place", F.xxhash64("slots"))
    weights = np.frombuffer(zlib.decompress(sampling.trained(examples, ["place", "y"], learn)), np.float32).copy()
    weights[-1] -= sampling.log_odds_shift(shares)
    return weights


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score)."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        known = w[:-1] != 0
        for b in common.pieces_of(batches):
            scores = [score_text(t or "", w, known) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return common.map_arrow(docs.select("doc_id", F.col("text").cast("string")), work, f"doc_id {id_type}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    out = scored(docs, fit(docs, common.read_table(spark, sf_dir, "labels")))
    held = common.bucket_of(F.col("doc_id"), sampling.FOLDS) == sampling.HELD_OUT
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
