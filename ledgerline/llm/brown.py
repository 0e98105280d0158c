"""Brown class-based bigram scores: exchange clustering, class transitions, word emissions.

P(text) is the product over its tokens of P(class | class before) * P(token | class). Tokens are the words (non-white-space
runs, A-Z in lower case) and one end; the class before the first word is that of the end.

Every word of the training texts is clustered, whatever their number, in two steps:

1. Units start the classes: the ``CORE`` most frequent words, and ``GROUPS`` blocks of the others that share their last
   ``SUFFIX`` bytes. Exchange clustering moves one unit at a time to the class that raises the likelihood of the class
   bigrams most, until a sweep moves nothing (or ``SWEEPS`` sweeps). The matrix of units is of fixed size, so the driver
   does it.
2. Words leave their blocks: the classes before and after each word of the vocabulary are counted over all training texts
   (a shuffle by word, of counts summed in each task), and each word, those of the core included, moves to the class that
   raises the likelihood most, given the class bigrams that the sweep starts with. That is an exchange sweep in parallel.

Class bigrams, class sizes and emissions are then counted under the words' own classes, over all training texts.

Smoothing: transitions back off to class frequency with weight ``BACKOFF``; emissions add one to each of a class's words and
to one unknown word a class, so each distribution sums to one. A word that training never saw has its block's class.

Texts are split into words twice, for counting and for coding: the ``HEAD`` most frequent words go to the workers as a table
of bounded size and are coded by their place in it, the others by their place among the document's own other words, and
all later passes read the codes. These other words, by construction words of which none has more than 1/``HEAD`` of all
tokens, meet their classes and counts in a join without a hot key. Words over ``KEY_BYTES`` bytes are keyed by a 128-bit
digest, and the last bytes of that key name their block.

Defined cases: a null text is empty and consists of its end; without training texts every known share is that of an empty
table (base 0 for one end); repeated rows count and score each; a null id's crc32 is that of empty text; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CLASSES = 64
CORE, GROUPS, SUFFIX = 768, 255, 3
UNITS = CORE + GROUPS + 1
SWEEPS = 12
BACKOFF = 50.0
HEAD = 131_072
KEY_BYTES = 64
END = b"\n"  # no word contains white space
FOLDS, HELD_OUT = 7, 2
_FLUSH = 400_000
_CHUNK = 1 << 16


def word_key(word: bytes) -> bytes:
    return word if len(word) <= KEY_BYTES else b"\xff" + hashlib.blake2b(word, digest_size=16).digest()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts, ends included."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            keys = [word_key(w) for w in counts]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for b in common.pieces_of(batches):
            for text in b.column(0).to_pylist():
                counts.update(common.words_of(text))
                if len(counts) > _FLUSH:
                    yield rows()
                    counts = Counter()
            counts[END] += b.num_rows
        if counts:
            yield rows()

    texts = docs.select(common.text_of(F.col("text")).alias("text"))
    return common.map_arrow(texts, work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _suffix(word: bytes) -> bytes:
    return word[-SUFFIX:]


class _Blocks(dict):
    """A word's suffix -> the number of its block, GROUPS for all suffixes beyond the named ones."""

    def __init__(self, suffixes: list[bytes]) -> None:
        super().__init__(zip(suffixes, range(len(suffixes)), strict=True))

    def __missing__(self, suffix: bytes) -> int:
        return GROUPS

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self[w[-SUFFIX:]] for w in words), np.int64, len(words))


def packed(codes: list[int]) -> bytes:
    """Codes of four bytes, all lowest bytes first: the highest ones are mostly zeros, which compress to nothing."""
    return np.array(codes, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def sequences(docs: DataFrame, learns: object, head: list[bytes], suffixes: list[bytes]) -> DataFrame:
    """(uid, doc_id, learns, codes, blocks, rare): a code of a token is its word's place in head or, beyond, in rare, the distinct
    keys of the document's other words; blocks has the block of each of these, a byte each."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((head, _Blocks(suffixes)))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block_of = sent.value
        known = dict(zip(words, range(len(words)), strict=True))
        size, uid = len(words), TaskContext.get().partitionId() << 40

        def other(word: bytes, own: dict[bytes, int]) -> int:
            key = word_key(word)
            return known[key] if key in known else own.setdefault(key, size + len(own))

        for b in common.pieces_of(batches):
            codes, blocks, rare = [], [], []
            for text in b.column(2).to_pylist():
                split = common.words_of(text)
                own: dict[bytes, int] = {}
                at = [known[w] if w in known else other(w, own) for w in split]
                at.append(0)
                codes.append(packed(at))
                rare.append(list(own))
                blocks.append(block_of.of(rare[-1]).astype(np.uint8).tobytes())
            uids = pa.array(range(uid, uid + b.num_rows), pa.int64())
            uid += b.num_rows
            yield pa.RecordBatch.from_arrays([uids, b.column(0), b.column(1), pa.array(codes, pa.binary()), pa.array(blocks, pa.binary()), pa.array(rare, pa.list_(pa.binary()))], names=["uid", "doc_id", "learns", "codes", "blocks", "rare"])

    texts = docs.select("doc_id", learns.alias("learns"), common.text_of(F.col("text")).alias("text"))
    return common.map_arrow(texts, work, f"uid long, doc_id {id_type}, learns boolean, codes binary, blocks binary, rare array<binary>")


def _coded(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The codes of each row and the blocks of its other words; the columns are codes and blocks."""
    for codes, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
        yield unpacked(codes), np.frombuffer(blocks, np.uint8)


def unit_bigrams(coded: DataFrame, head: list[bytes], suffixes: list[bytes]) -> np.ndarray:
    """How often unit j follows unit i, over all texts; ends precede first words. coded: codes, blocks."""
    spark = coded.sparkSession
    size, core = UNITS, CORE
    units = np.concatenate([np.arange(min(core, len(head))), core + _Blocks(suffixes).of(head[core:])])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        held, n = [], 0
        for b in common.pieces_of(batches):
            for codes, blocks in _coded(b):
                u = np.zeros(len(codes) + 1, np.int64)
                u[1:] = np.concatenate([units, core + blocks.astype(np.int64)])[codes] if len(blocks) else units[codes]
                held.append(u[:-1] * size + u[1:])
                n += len(codes)
                if n > 1_000_000:
                    total += np.bincount(np.concatenate(held), minlength=size * size)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size * size)
        table = total.reshape(size, size)
        there = np.flatnonzero(table.any(axis=1))
        blobs = [(at := np.flatnonzero(table[u])).astype("<u2").tobytes() + table[u][at].astype("<u8").tobytes() for u in there]
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(blobs, pa.binary())], names=["unit", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in common.pieces_of(batches):
            for u, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                m = len(blob) // 10
                sums.setdefault(u, np.zeros(size, np.int64))[np.frombuffer(blob[: 2 * m], "<u2")] += np.frombuffer(blob[2 * m :], "<u8").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["unit", "counts"])

    parts = common.map_arrow(coded.select("codes", "blocks"), count, "unit long, counts binary")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = np.zeros((size, size), np.int64)
    for r in common.map_arrow(parts.repartition(width, "unit"), add, "unit long, counts binary").collect():  # UNITS rows at most
        table[r["unit"]] += np.frombuffer(r["counts"], np.int64)
    return table


def neighbour_counts(coded: DataFrame, head: list[bytes], of_head: np.ndarray, of_block: np.ndarray) -> DataFrame:
    """(word, codes, counts), several rows a word: how often class c comes before it (code c) and after it (CLASSES + c).
    Null counts are ones."""
    sent = coded.sparkSession.sparkContext.broadcast((head, of_head.astype(np.uint8), of_block.astype(np.uint8)))
    sides = 2 * CLASSES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, of, block_class = sent.value
        size = len(words)
        total = np.zeros(size * sides, np.int32)
        held, n = [], 0
        others: dict[bytes, bytearray] = {}
        n_others = 0

        def fold() -> None:
            at, times = np.unique(np.concatenate(held), return_counts=True)
            total[at] += times.astype(np.int32)
            held.clear()

        def batch(keys: list, codes: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (keys, codes, counts)], names=["word", "codes", "counts"])

        for b in common.pieces_of(batches):
            for (codes, blocks), rare in zip(_coded(b), b.column(2).to_pylist(), strict=True):
                c = np.concatenate([of, block_class[blocks]])[codes] if rare else of[codes]
                around = np.zeros(len(codes) + 2, np.int64)
                around[1:-1] = c
                before, after = around[:-2], around[2:] + CLASSES
                common_at = np.flatnonzero((codes < size) & (codes > 0))
                places = codes[common_at].astype(np.int64) * sides
                held += [places + before[common_at], places + after[common_at]]
                n += len(codes)
                if rare:
                    at = np.flatnonzero(codes >= size)
                    pairs = np.stack([before[at], after[at]], axis=1).astype(np.uint8).tobytes()
                    for i, k in enumerate((codes[at] - size).tolist()):
                        others.setdefault(rare[k], bytearray()).extend(pairs[2 * i : 2 * i + 2])
                    n_others += len(at)
                if n > 1_000_000:
                    fold()
                    n = 0
                if n_others > _FLUSH:
                    yield batch(list(others), [bytes(x) for x in others.values()], [None] * len(others))
                    others, n_others = {}, 0
        if others:
            yield batch(list(others), [bytes(x) for x in others.values()], [None] * len(others))
        if held:
            fold()
        table = total.reshape(size, sides)
        there = np.flatnonzero(table.any(axis=1))
        for s in range(0, len(there), 8192):
            rows = [(words[w], (at := np.flatnonzero(table[w])).astype(np.uint8).tobytes(), table[w][at].astype("<u4").tobytes()) for w in there[s : s + 8192].tolist()]
            yield batch(*map(list, zip(*rows, strict=True)))

    return common.map_arrow(coded.select("codes", "blocks", "rare"), work, "word binary, codes binary, counts binary")


def best_classes(m: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood of the class bigrams m most. word (sorted, from 0), code and n list
    the classes beside each word, of is the class that each word has now, with which it is counted in m."""
    k = len(of)
    times = np.bincount(word[code >= CLASSES], n[code >= CLASSES], k)
    row, column = m.sum(axis=1), m.sum(axis=0)
    pairs, which = np.unique(np.stack([code, n]), axis=1, return_inverse=True)
    which = which.ravel()
    c, x = pairs[0].astype(np.int64), pairs[1][:, None].astype(np.float64)
    side = np.where((c < CLASSES)[:, None], m[c % CLASSES], m[:, c % CLASSES].T)  # counts of the pair (beside, own) for each own class
    more, less = _xlogx(side + x) - _xlogx(side), _xlogx(side) - _xlogx(np.maximum(side - x, 0))
    gain = np.zeros((k, CLASSES))
    stay = np.zeros(k)
    for s in range(0, len(word), _CHUNK):
        part, w = which[s : s + _CHUNK], word[s : s + _CHUNK]
        starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        gain[w[starts]] += np.add.reduceat(more[part], starts)
        stay[w[starts]] += np.add.reduceat(less[part, of[w]], starts)
    t = times[:, None]
    gain -= _xlogx(row + t) - _xlogx(row) + _xlogx(column + t) - _xlogx(column)
    stay -= _xlogx(row[of]) - _xlogx(np.maximum(row[of] - times, 0)) + _xlogx(column[of]) - _xlogx(np.maximum(column[of] - times, 0))
    gain[np.arange(k), of] = stay
    gain[:, 0] = -np.inf  # the end's
    best = gain.argmax(axis=1)
    return np.where(gain[np.arange(k), best] > stay + 1e-9, best, of)


def word_classes(beside: DataFrame, m: np.ndarray, head: list[bytes], of_head: np.ndarray, suffixes: list[bytes], of_block: np.ndarray) -> DataFrame:
    """(word, c, class) of every word but the end. beside: what neighbour_counts gives."""
    spark = beside.sparkSession
    sent = spark.sparkContext.broadcast((m, dict(zip(head, of_head.tolist(), strict=True)), _Blocks(suffixes), of_block))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, of_word, blocks, of_block = sent.value

        def solve(words: list, codes: list, counts: list) -> pa.RecordBatch:
            """Rows of whole words, equal ones side by side."""
            names, at = [], []
            for w in words:
                if not names or names[-1] != w:
                    names.append(w)
                at.append(len(names) - 1)
            sizes = [len(x) for x in codes]
            n = np.concatenate([np.ones(k, np.int64) if x is None else np.frombuffer(x, "<u4").astype(np.int64) for x, k in zip(counts, sizes, strict=True)])
            key = np.repeat(np.array(at, np.int64), sizes) * 2 * CLASSES + np.frombuffer(b"".join(codes), np.uint8)
            key, inverse = np.unique(key, return_inverse=True)
            n = np.bincount(inverse, n).astype(np.int64)
            word, code = key // (2 * CLASSES), key % (2 * CLASSES)
            of = np.array([of_word[w] if w in of_word else of_block[blocks[_suffix(w)]] for w in names], np.int64)
            c = np.bincount(word[code >= CLASSES], n[code >= CLASSES], len(names)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(c), pa.array(best_classes(m, word, code, n, of).astype(np.int32))], names=["word", "c", "class"])

        held: list[tuple] = []  # the rows of the last word, which may go on
        for b in common.pieces_of(batches, 16_384):
            rows = held + list(zip(*(x.to_pylist() for x in b.columns), strict=True))
            cut = len(rows)
            while cut and rows[cut - 1][0] == rows[-1][0]:
                cut -= 1
            if cut:
                yield solve(*map(list, zip(*rows[:cut], strict=True)))
            held = rows[cut:]
        if held:
            yield solve(*map(list, zip(*held, strict=True)))

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = beside.repartition(width, "word").sortWithinPartitions("word")
    return common.map_arrow(dealt, work, "word binary, c long, class int")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(table: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit. Unit 0, the end, stays alone in class 0; units that never occur go to class 1."""
    n = table.astype(np.float64)
    left, right = n.sum(axis=1), n.sum(axis=0)
    order = np.argsort(-(left + right), kind="stable")
    order = order[(order != 0) & ((left + right)[order] > 0)]
    of = np.ones(len(n), np.int64)
    of[0] = 0
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    chosen = np.zeros((len(n), classes))
    chosen[np.arange(len(n)), of] = 1
    m = chosen.T @ n @ chosen
    for _ in range(sweeps):
        moved = 0
        for u in order:
            a, own = of[u], n[u, u]
            r, k = np.bincount(of, n[u], classes), np.bincount(of, n[:, u], classes)
            r[a] -= own
            k[a] -= own
            m[a] -= r
            m[:, a] -= k
            m[a, a] -= own
            lsum, rsum, h = m.sum(axis=1), m.sum(axis=0), _xlogx(m)
            rows, cols = _xlogx(m + r) - h, _xlogx(m + k[:, None]) - h
            d = np.arange(classes)
            gain = rows.sum(axis=1) - rows[d, d] + cols.sum(axis=0) - cols[d, d] + _xlogx(m[d, d] + r + k + own) - h[d, d]
            gain -= _xlogx(lsum + left[u]) - _xlogx(lsum) + _xlogx(rsum + right[u]) - _xlogx(rsum)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            m[b] += r
            m[:, b] += k
            m[b, b] += own
            of[u] = b
            moved += b != a
        if not moved:
            break
    return of


class Model:
    """The counts, the coded texts, every word's class, and what smoothing needs."""

    def __init__(self, docs: DataFrame, learns: object) -> None:
        learns = F.coalesce(learns, F.lit(False))
        counts = common.staged(word_counts(docs.where(learns)), "counts")
        scale = F.floor(F.log2("c") * 8).cast("int")
        steps = sorted(((r["step"], r["types"], r["c"]) for r in counts.groupBy(scale.alias("step")).agg(F.count("*").alias("types"), F.sum("c").alias("c")).collect()), reverse=True)
        self.tokens, self.types = sum(c for _, _, c in steps), sum(t for _, t, _ in steps)
        least, taken = None, 0
        for step, n, _ in steps:  # as many of the highest steps as fit the head: the rest are rarer than HEAD words each
            if taken + n > HEAD:
                break
            least, taken = step, taken + n
        found = counts.where(scale >= least).toArrow() if least is not None else None
        found = sorted(zip(found["c"].to_pylist(), found["word"].to_pylist(), strict=True), key=lambda x: (x[1] != END, -x[0], x[1])) if found else []
        self.head, self.c = [w for _, w in found], np.array([x for x, _ in found], np.float64)
        if not self.head or self.head[0] != END:
            self.head, self.c = [END, *self.head], np.append(0.0, self.c)
        ends = counts.groupBy(F.expr(f"substring(word, greatest(1, octet_length(word) - {SUFFIX - 1}), {SUFFIX})").alias("suffix"))
        ends = ends.agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "suffix").limit(GROUPS).collect()
        self.suffixes = [bytes(r["suffix"]) for r in ends]
        self.coded = common.staged(sequences(docs, learns, self.head, self.suffixes), "coded")
        lessons = self.coded.where("learns")
        table = unit_bigrams(lessons, self.head, self.suffixes)
        of = exchange(table)
        self.of_block = of[CORE:]
        of_head = np.concatenate([of[: min(CORE, len(self.head))], self.of_block[_Blocks(self.suffixes).of(self.head[CORE:])]])
        chosen = np.eye(CLASSES)[of]
        m = chosen.T @ table.astype(np.float64) @ chosen
        beside = neighbour_counts(lessons, self.head, of_head, self.of_block)
        self.classes = common.staged(word_classes(beside, m, self.head, of_head, self.suffixes, self.of_block), "classes")
        n, v = np.zeros(CLASSES), np.zeros(CLASSES)
        n[0], v[0] = self.c[0], self.c[0] > 0
        for r in self.classes.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("types")).collect():
            n[r["class"]], v[r["class"]] = n[r["class"]] + r["c"], v[r["class"]] + r["types"]
        self.class_tokens, self.class_types = n, v
        place = dict(zip(self.head, range(len(self.head)), strict=True))
        self.of_head = np.zeros(len(self.head), np.int64)
        if least is not None:
            frequent = self.classes.where(scale >= least).select("word", "class").toArrow()  # the head's words
            for w, k in zip(frequent["word"].to_pylist(), frequent["class"].to_pylist(), strict=True):
                self.of_head[place[w]] = k

    def class_sequences(self) -> DataFrame:
        """(doc_id, learns, n_tokens, n_known, base_score, emission, classes): each text as the classes of its tokens, a
        byte each, with its sums over emissions."""
        rare = self.coded.select("uid", F.posexplode("rare").alias("k", "word")).join(self.classes, "word")
        rare = rare.groupBy("uid").agg(F.collect_list(F.struct("k", "class", "c")).alias("seen")).withColumnRenamed("uid", "seen_uid")
        rows = self.coded.drop("rare").join(rare, F.col("uid") == F.col("seen_uid"), "left")
        rows = rows.select("doc_id", "learns", "codes", "blocks", F.col("seen.k").alias("k"), F.col("seen.class").alias("class"), F.col("seen.c").alias("c"))
        known, value = (self.c > 0).astype(np.int64), np.log10(self.c + 1)
        norm = float(np.log10(self.tokens + self.types + 1))
        class_norm = np.log10(self.class_tokens + self.class_types + 1)
        sent = rows.sparkSession.sparkContext.broadcast((self.of_head, known, value, self.of_block))
        id_type = rows.schema["doc_id"].dataType.simpleString()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of_head, known, value, of_block = sent.value
            for b in common.pieces_of(batches):
                out: list[list] = [[] for _ in range(5)]
                beside = zip(*(b.column(i).to_pylist() for i in (4, 5, 6)), strict=True)
                for (codes, blocks), (k, found, c) in zip(_coded(b.select(["codes", "blocks"])), beside, strict=True):
                    of, there, worth = of_head, known, value
                    if len(blocks):
                        of, there, worth = of_block[blocks], np.zeros(len(blocks), np.int64), np.zeros(len(blocks))
                        if k:
                            of[k], there[k], worth[k] = found, 1, np.log10(np.array(c, np.float64) + 1)
                        of, there, worth = np.concatenate([of_head, of]), np.concatenate([known, there]), np.concatenate([value, worth])
                    classes, total = of[codes], float(worth[codes].sum())
                    for column, x in zip(out, (len(codes), int(there[codes].sum()), total - len(codes) * norm, total - float(class_norm[classes].sum()), classes.astype(np.uint8).tobytes()), strict=True):
                        column.append(x)
                types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, t) for x, t in zip(out, types, strict=True)]], names=["doc_id", "learns", "n_tokens", "n_known", "base_score", "emission", "classes"])

        return common.map_arrow(rows, work, f"doc_id {id_type}, learns boolean, n_tokens long, n_known long, base_score double, emission double, classes binary")

    def transitions(self, texts: DataFrame) -> np.ndarray:
        """The log10 probability of a class after a class, counted over the training texts of class_sequences."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(CLASSES * CLASSES, np.int64)
            for b in common.pieces_of(batches):
                for classes in b.column(0).to_pylist():
                    c = np.frombuffer(b"\0" + classes, np.uint8).astype(np.int64)
                    total += np.bincount(c[:-1] * CLASSES + c[1:], minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["cell", "n"])

        m = np.zeros((CLASSES, CLASSES))
        for r in common.map_arrow(texts.where("learns").select("classes"), count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # a row a cell
            m[r["cell"] // CLASSES, r["cell"] % CLASSES] = r["n"]
        share = (self.class_tokens + 1) / (self.class_tokens.sum() + CLASSES)
        return np.log10((m + BACKOFF * share) / (m.sum(axis=1, keepdims=True) + BACKOFF))


def scored(model: Model) -> DataFrame:
    """For each row of the model's texts: doc_id, n_tokens, n_known, train_tokens, base_score and score."""
    texts = common.staged(model.class_sequences(), "classed")
    sent = texts.sparkSession.sparkContext.broadcast(model.transitions(texts))
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = sent.value.ravel()
        for b in common.pieces_of(batches):
            total = []
            for classes, emission in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                c = np.frombuffer(b"\0" + classes, np.uint8).astype(np.int64)
                total.append(emission + float(step[c[:-1] * CLASSES + c[1:]].sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(total, pa.float64())], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = common.map_arrow(texts.select("doc_id", "n_tokens", "n_known", "base_score", "classes", "emission"), work, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(int(model.tokens)).cast("long"))


def score(docs: DataFrame, learns: object) -> DataFrame:
    """The scores of all rows of docs by a model of those rows for which the condition learns holds."""
    return scored(Model(docs, learns))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    out = score(docs, common.bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    held = common.bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    log2 = F.lit(float(np.log2(10)))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", F.pow(F.lit(2.0), -F.col("score") * log2 / F.col("n_tokens")).alias("perplexity"))
