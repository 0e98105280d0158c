"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Stages take (spark, docs, sf_dir) and return the columns of documents, the last one those and the encoding. Decisions take
effect: rejected, near-duplicate and contaminated documents go, repeated lines go from the texts. Null texts count as
empty, extra columns are kept, and empty input passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common, decontaminate, line_dedup, near_copies, pieces, quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.filter_quality(docs, common.read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in the first one only."""
    return line_dedup.dedup_lines(docs)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id: SimHash links and all others of five-word
    shingles at a Jaccard similarity of 0.8, verified on the whole texts."""
    return near_copies.dedup_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return decontaminate.decontaminate(docs, common.read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text's pieces are added; decoding them gives the text back."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode),
]

#: The classifier, the XXH64 fingerprints and the Viterbi search are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder first. What a stage staged on the way is
    dropped once its result is written; the last stage reads the result before it lazily, so that one stays."""
    docs = common.read_table(spark, sf_dir, "documents")
    before = common.staged_tables()
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.staged(docs, f"stage{i + 1}")
            common.drop_staged(spark, (*before, common.staged_tables()[-1]))
    return docs
