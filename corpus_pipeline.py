"""Corpus pipeline over ``documents``: toxicity, line dedup, MinHash near-dedup, benchmark decontamination, SentencePiece ids.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; ``run`` stores each
stage's result in the shared checkpoint folder and reads it again. All but the last return the columns of documents.
No stage's rows can be had in SQL (learned scores, whole-text shingles and alignments), so ``ORACLE_SQL`` is None and
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm import decontam, linededup, neardup, pieces, toxicity
from batchlens.llm.queries import tokenizer
from batchlens.llm.shared import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.drop_toxic(docs, toxicity.fit_on_labels(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are deleted; n_chars follows. A document that loses all its text goes."""
    out = linededup.dedup_lines(docs)
    cut = F.col("n_deleted") > 0
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.where(~(cut & (F.col("n_deleted") == F.col("n_lines")))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip of every document that is left."""
    return pieces.encode_pieces(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
