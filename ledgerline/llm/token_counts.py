"""Token counts of fields and sections: whole documents are encoded once, tokens are attributed by their offsets.

Byte-level BPE tokens are pieces of the text's UTF-8 bytes, so the running sum of their lengths gives each token's span. An
interval join by binary search lays the spans on the sections, sorted and made disjoint. A token within one section
counts there. A token that crosses a boundary is allocated by an explicit rule:

- ``largest`` (default): to the section that holds most of its bytes, the first of several;
- ``first`` / ``last``: to the section of its first / last byte that lies in one;
- ``share``: to each section by its share of the token's bytes that lie in sections.

A token that touches no section counts for section -1, so the counts of a document add up to its tokens.

Defined cases: null and empty texts have no tokens; null or empty sections leave all tokens to section -1; sections are cut
to the text; they may come in any order and keep their numbers; where sections overlap, what they share belongs to the one
that starts first (the first listed of several); a section that is null, has a null bound or ends before it starts is empty
and holds no tokens; repeated rows count each; extra columns are kept by ``attribute``, those named like its results are
replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that cuts texts into words before merging; a fixed value of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("largest", "first", "last", "share")


class Encoder:
    """Token byte lengths of whole texts."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def token_ends(self, text: str) -> np.ndarray:
        """The byte offset at which each token of a text ends."""
        return np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), np.int64)])


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


KEEPS = "tokens"


def _encoder(key: int, ranks: dict[bytes, int]) -> Encoder:
    """One encoder a worker process and vocabulary."""
    encoders = common.kept(KEEPS)
    if key not in encoders:
        encoders.clear()
        encoders[key] = Encoder(ranks)
    return encoders[key]


def byte_offsets(raw: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets, those beyond the text cut to its end."""
    codes = np.frombuffer(raw, np.uint8)
    starts = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(raw))
    return starts[np.clip(at, 0, len(starts) - 1)]


def disjoint(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sections in order of start, each cut to what those before it leave; and their numbers."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum(start, end)[order]
    before = np.concatenate([[0], np.maximum.accumulate(end)[:-1]]) if len(end) else end
    start = np.maximum(start, before)
    return start, np.maximum(start, end), order


def allocate(ends: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str = "largest") -> tuple[np.ndarray, np.ndarray]:
    """Tokens for each section and, last, for none; and how many that cross a boundary touch each. Offsets are bytes."""
    k = len(start)
    if k and ((end < start).any() or (start[1:] < end[:-1]).any()):
        start, end, order = disjoint(start, end)
        count, crossing = allocate(ends, start, end, rule)
        out, crossed = count.copy(), crossing.copy()
        out[order], crossed[order] = count[:-1], crossing[:-1]
        return out, crossed
    count, crossing = np.zeros(k + 1), np.zeros(k + 1, np.int64)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if not k:
        count[-1] = len(ends)
        return count, crossing
    first = np.searchsorted(end, begins, "right")  # the first section that ends after the token's start
    last = np.searchsorted(start, ends, "left") - 1  # the last one that starts before its end
    inside = (first == last) & (start[np.minimum(first, k - 1)] <= begins) & (ends <= end[np.minimum(first, k - 1)])
    count[:k] += np.bincount(first[inside], minlength=k)[:k]
    for t in np.flatnonzero(~inside):
        i, j = int(first[t]), int(last[t])
        held = np.minimum(end[i : j + 1], ends[t]) - np.maximum(start[i : j + 1], begins[t])
        touched = np.flatnonzero(held > 0)
        if not len(touched):
            count[-1] += 1
            continue
        crossing[i + touched] += 1
        if rule == "share":
            count[i + touched] += held[touched] / held[touched].sum()
        else:
            count[i + {"largest": int(np.argmax(held)), "first": touched[0], "last": touched[-1]}[rule]] += 1
    return count, crossing


def attribute(df: DataFrame, path: str = RANKS, rule: str = "largest") -> DataFrame:
    """One row per section: the columns of df without text and sections, then section, n_tokens and n_crossing.

    df has text and sections, an array of (start, end) in characters; section counts from 0 and is -1
    for tokens in none, given only if there are any."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = read_ranks(path)
    sent = df.sparkSession.sparkContext.broadcast(ranks)
    key = hash((path, len(ranks)))
    others = [c for c in df.columns if c not in ("text", "sections", "section", "n_tokens", "n_crossing")]
    spans = F.col("sections").cast("array<struct<start:long,end:long>>")
    known = F.transform(spans, lambda s: F.when(s["start"].isNull() | s["end"].isNull(), F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))).otherwise(s))
    df = df.select(*others, common.text_of(F.col("text")).alias("text"), known.alias("sections"))
    m = len(others)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, sent.value)
        for b in common.pieces_of(batches, 256):
            row, section, tokens, crossings = [], [], [], []
            spans = b.column(m + 1)
            flat, offsets = spans.flatten(), np.concatenate([[0], np.cumsum(np.array(spans.value_lengths().fill_null(0)))])
            start, end = (np.asarray(flat.field(i)).astype(np.int64) for i in (0, 1))
            for i, text in enumerate(b.column(m).to_pylist()):
                raw = text.encode("utf-8")
                s, e = start[offsets[i] : offsets[i + 1]], end[offsets[i] : offsets[i + 1]]
                if len(raw) != len(text):
                    s, e = byte_offsets(raw, s), byte_offsets(raw, e)
                else:
                    s, e = np.clip(s, 0, len(raw)), np.clip(e, 0, len(raw))
                count, crossing = allocate(encoder.token_ends(text), s, e, rule)
                n = len(s) + bool(count[-1])
                row.append(np.full(n, i))
                section.append(np.append(np.arange(len(s)), [-1] if count[-1] else []))
                tokens.append(count[:n])
                crossings.append(crossing[:n])
            row = np.concatenate(row).astype(np.int64)
            new = [pa.array(np.concatenate(section).astype(np.int32)), pa.array(np.concatenate(tokens)), pa.array(np.concatenate(crossings))]
            kept = b.select(list(range(m))).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*others, "section", "n_tokens", "n_crossing"])

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in others)
    return common.map_arrow(df, work, f"{fields}section int, n_tokens double, n_crossing long", KEEPS)


def with_line_sections(docs: DataFrame) -> DataFrame:
    """docs with sections: each line with its line break, so that the sections cover the text. A column sections is replaced."""
    docs = docs.drop("sections")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at, names = docs.columns.index("text"), docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in common.pieces_of(batches):
            bounds = [np.concatenate([[0], np.cumsum([len(x) + 1 for x in (t or "").split("\n")])]) for t in b.column(at).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) - 1 for x in bounds])]).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(np.concatenate([x[:-1] for x in bounds])), pa.array(np.concatenate([x[1:] for x in bounds]))], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(offsets), spans).cast(kind)], names=[*names, "sections"])

    return common.map_arrow(docs, work, f"{fields}, sections array<struct<start:long,end:long>>")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.read_texts(spark, sf_dir, "documents", "doc_id", "text")
    counts = attribute(with_line_sections(docs))
    return counts.select("doc_id", "section", F.col("n_tokens").cast("long"), "n_crossing")
