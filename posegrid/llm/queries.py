"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    chat_format,
    decontaminate,
    fingerprint,
    hard_negatives,
    html_text,
    language_id,
    minhash,
    packing,
    span_dedup,
    token_counts,
    token_files,
    vector_codes,
)

COUNT_TOKENIZER = "byte_bpe_50k.json"
ROUND_TRIP_RANKS = "byte_bpe_multi_50k.tiktoken"
OVER_LIMIT = 512
END_ID = 2
PACK_TOKENIZER = "word_bpe_49k.json"
PACK_END_ID = 0
PACK_CAPACITY = 2048
#: The conversation that every run of op2 has besides the table's.
ODD_TEXT = r"\### Assistant: </turn> ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_TOKENIZER))
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {OVER_LIMIT} AS over_limit")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as long) AS conv_id", "cast(turn as long) AS turn", "role", "text"
    )
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ODD_TEXT).alias("text"),
    )
    return chat_format.read_back(chat_format.format_turns(rows.unionByName(odd)))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path(ROUND_TRIP_RANKS))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, a row for each item."""
    found = decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "edits", "match_start", "match_end")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return token_files.round_trip(docs, public_tokenizers.path(COUNT_TOKENIZER), END_ID)


def op8_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose sentences, and what is left of them."""
    left = span_dedup.stripped(_read(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_sentences", "n_removed", F.length("text").alias("n_chars_left"), F.sha2("text", 256).alias("left_sha256")
    )


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(_read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.page_texts(_read(spark, sf_dir, "pages"))
    return texts.select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.fit(_read(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(found.rows).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.books_sha256(found.books)).alias("codebooks_sha256"),
    )


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _read(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER)
    cut = packing.pieces(docs, path, PACK_END_ID, PACK_CAPACITY)
    digested = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "nth")
    return packing.place(digested, PACK_CAPACITY).withColumn("length", F.col("length").cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_chat_format": op2_chat_format,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_minhash": op4_minhash,
        "op5_decontamination": op5_decontamination,
        "op6_language_id": op6_language_id,
        "op7_token_files": op7_token_files,
        "op8_span_dedup": op8_span_dedup,
        "op9_fingerprint": op9_fingerprint,
        "op10_html_text": op10_html_text,
        "op11_vector_codes": op11_vector_codes,
        "op12_best_fit_packing": op12_best_fit_packing,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """No operator here has a SQL twin that runs on whole tables; the tests
    hold them against brute force, the libraries and exact round trips."""
    return {}
