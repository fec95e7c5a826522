"""Registered queries of the training-data operators and their DuckDB SQL.

Every query works on its whole table with the operators' production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.llm import chat, collocations, decontam, idfiles, linededup, merkle, neardup, pieces, simhash, tokens, topk, toxicity, warc
from batchlens.llm.shared import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; the package is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = warc.new_root(spark)
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), root)
    return warc.read_warc(manifest, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), limit=2048)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.valid_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", scale=1024)
    return topk.top_k(rows, F.col("vec_id") % 100 == 0, k=10)


def op7_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = idfiles.new_root(spark)
    manifest = idfiles.write_ids(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1, root=root)
    return idfiles.read_ids(manifest, root)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.read_chat(stored(chat.format_chat(rows), "chat")))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_deleted", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(docs, merkle.row_digest(own), merkle.row_digest([*own[:-1], text]))
    return out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = (
        op1_toxicity, op2_warc, op3_decontamination, op4_token_counts, op5_near_duplicates, op6_topk, op7_id_files, op8_chat,
        op9_pieces, op10_line_dedup, op11_merkle, op12_simhash, op13_collocations,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.SQL, "op6_topk": topk.SQL, "op8_chat": chat.SQL, "op11_merkle": merkle.SQL, "op13_collocations": collocations.SQL}
