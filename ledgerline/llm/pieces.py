"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads a text once; at each position its output links give every piece that ends there, longest first, and
each relaxes the best score of the position from the best score where the piece starts. A character that no piece covers
costs ``UNKNOWN`` under the least piece score and becomes its bytes. Equal scores go to the longer piece.

Best scores need nothing from beyond a point that no piece crosses. When the vocabulary has no piece with a space mark
after another character, each word is such a unit, and when no piece holds a line break, so is each line; both are checked
when the model is read, and units that come again are looked up. Otherwise the whole text is one unit. Either way the
result is that of the whole text.

The scores are those stored with the pieces. The bundled vocabulary was made by merges, so its ids here are those of its
scores' best path (as the unigram algorithm finds it), not those of replaying its merges.

Defined cases: null and empty texts have no pieces; texts of any length are encoded whole; decoding ignores control ids,
null ids and ids that the vocabulary doesn't have, and puts U+FFFD for bytes that are no UTF-8; repeated rows encode alike; extra columns are kept.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN = 10.0
NORMAL, UNKNOWN_TYPE, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_CACHE = 300_000
_LONG = 4096
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message: numbers for varints, bytes for all else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        size = varint() if size is None else size
        yield tag >> 3, data[at : at + size]
        at += size


class Model:
    """Pieces, scores and kinds of a model file, and what can be said of its spaces and line breaks."""

    def __init__(self, data: bytes) -> None:
        self.pieces, self.scores, self.kinds = [], [], []
        self.prefix, self.squeeze, self.name = True, True, "identity"
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 3:
                norm = dict(_fields(value))
                self.name = norm.get(1, b"").decode()
                self.prefix, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        if self.name not in ("identity", ""):
            raise ValueError(f"normalization {self.name!r} is not supported")
        plain = [p for p, k in zip(self.pieces, self.kinds, strict=True) if k in (NORMAL, USER_DEFINED)]
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in plain)
        self.by_line = not any("\n" in p for p in plain)


def read_model(path: str = MODEL) -> Model:
    with open(path, "rb") as f:
        return Model(f.read())


class Codec:
    """Encodes and decodes with one model; remembers a bounded number of units."""

    def __init__(self, model: Model) -> None:
        self.model = model
        scores = [s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL]
        self.unknown = min(scores, default=0.0) - UNKNOWN
        highest = max(scores, default=0.0)
        self.unknown_id = model.kinds.index(UNKNOWN_TYPE) if UNKNOWN_TYPE in model.kinds else 0
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score, kind) in enumerate(zip(model.pieces, model.scores, model.kinds, strict=True)):
            if kind in (NORMAL, USER_DEFINED) and piece:
                self.automaton.add_word(piece, (len(piece), len(piece) * highest - 0.1 if kind == USER_DEFINED else score, i))
        self.automaton.make_automaton()
        self.is_byte = np.array([k == BYTE for k in model.kinds])
        of = {BYTE: lambda p: bytes([int(p[3:5], 16)]), CONTROL: lambda p: b"", UNKNOWN_TYPE: lambda p: " ⁇ ".encode()}
        self.raw = [of.get(k, lambda p: p.replace(SPACE, " ").encode())(p) for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.known: dict[str, tuple[int, ...]] = {}

    def unit(self, text: str) -> tuple[int, ...]:
        """The ids of the best path through one unit."""
        n = len(text)
        if n < _LONG:
            best, back_from, back_piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        else:  # sixteen bytes a character
            best, back_from, back_piece = array("d", [-np.inf]) * (n + 1), array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        done = 0  # positions up to here are final, but for unknown characters
        single = False

        def close(upto: int) -> None:
            nonlocal done, single
            while done < upto:
                if not single and best[done] + self.unknown > best[done + 1]:
                    best[done + 1], back_from[done + 1], back_piece[done + 1] = best[done] + self.unknown, done, -1
                done, single = done + 1, False

        for end, (length, score, i) in self.automaton.iter(text):
            if done < end:
                close(end)
            start = end + 1 - length
            if best[start] + score > best[end + 1]:
                best[end + 1], back_from[end + 1], back_piece[end + 1] = best[start] + score, start, i
            single |= length == 1
        close(n)
        out: list[int] = []
        while n:
            start, i = back_from[n], back_piece[n]
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(text[start:n].encode("utf-8", "surrogatepass"))]
            else:
                out.append(self.unknown_id)
            n = start
        return tuple(reversed(out))

    def _look(self, unit: str) -> tuple[int, ...]:
        ids = self.known.get(unit)
        if ids is None:
            ids = self.unit(unit)
            if len(self.known) < _CACHE and len(unit) < 64:
                self.known[unit] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return np.zeros(0, np.int32)
        text = ((SPACE if self.model.prefix else "") + text).replace(" ", SPACE)
        if not self.model.by_word:
            return np.array(self.unit(text), np.int32)
        if not self.model.by_line or 10 not in self.bytes:
            return np.fromiter(chain.from_iterable(map(self._look, _UNITS.findall(text))), np.int32)
        parts: list = []
        for k, line in enumerate(text.split("\n")):
            if k:
                parts.append((self.bytes[10],))
            words = line.split(SPACE)
            if "" in words[1:]:  # runs of spaces belong to the word after them
                parts.extend(map(self._look, _UNITS.findall(line)))
                continue
            if words[0]:
                parts.append(self._look(words[0]))
            parts.extend(map(self._look, map(str.__add__, repeat(SPACE, len(words) - 1), words[1:])))
        return np.fromiter(chain.from_iterable(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids[(ids >= 0) & (ids < len(self.raw))].tolist()))
        if self.model.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


KEEPS = "pieces"


def _codec(key: int, model: Model) -> Codec:
    """One codec a worker process and model, so that what it remembers serves its later tasks as well."""
    codecs = common.kept(KEEPS)
    if key not in codecs:
        codecs.clear()
        codecs[key] = Codec(model)
    return codecs[key]


def encode(df: DataFrame, path: str = MODEL, column: str = "text", check: bool = True) -> DataFrame:
    """df with ids (array<int>), n_pieces, n_byte_pieces and, if check, round_trip: whether decoding gives the text back.
    Columns of these names are replaced."""
    df = df.drop("ids", "n_pieces", "n_byte_pieces", "round_trip")
    model = read_model(path)
    key = hash((path, len(model.pieces), tuple(model.scores[-50:])))
    sent = df.sparkSession.sparkContext.broadcast(model)
    at, names = df.columns.index(column), df.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, sent.value)
        for b in common.pieces_of(batches, 256):
            ids, same = [], []
            for text in b.column(at).to_pylist():
                ids.append(codec.encode(text or ""))
                if check:
                    same.append(codec.decode(ids[-1]) == (text or ""))
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat, pa.int32()))
            fallen = np.concatenate([[0], np.cumsum(codec.is_byte[flat])]) if len(flat) else np.zeros(1, np.int64)
            ends = np.cumsum(sizes)
            new = [lists, pa.array(sizes), pa.array((fallen[ends] - fallen[ends - sizes]).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*b.columns, *new, *([pa.array(same, pa.bool_())] if check else [])], names=[*names, "ids", "n_pieces", "n_byte_pieces", *(["round_trip"] if check else [])])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return common.map_arrow(df, work, f"{fields}, ids array<int>, n_pieces long, n_byte_pieces long" + ", round_trip boolean" * check, KEEPS)


def decode(df: DataFrame, path: str = MODEL, column: str = "ids") -> DataFrame:
    """df with decoded, the text of an id array; null for a null array. A column of that name is replaced."""
    df = df.drop("decoded")
    model = read_model(path)
    key = hash((path, len(model.pieces), tuple(model.scores[-50:])))
    sent = df.sparkSession.sparkContext.broadcast(model)
    at, names = df.columns.index(column), df.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, sent.value)
        for b in common.pieces_of(batches, 256):
            texts = [None if x is None else codec.decode(np.array([i for i in x if i is not None], np.int64)) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return common.map_arrow(df, work, f"{fields}, decoded string", KEEPS)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    return encode(docs).select("doc_id", "n_pieces", "n_byte_pieces", "round_trip", "ids")
