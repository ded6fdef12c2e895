"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes all its predecessor kept, and its decisions take effect:

1. language ID: documents without a letter, or of no sure language, go;
2. MinHash near-dedup: of documents linked at a similarity of 0.8 on five-word
   shingles, directly or not, the one with the least id stays;
3. substring dedup: sentences covered by a repeated run go, but for the run's
   first occurrence; a document of which nothing is left goes;
4. benchmark decontamination: documents that hold a benchmark item go;
5. byte-level BPE: the ids of what is left, decoded again, as digests.

Stages 1 to 4 return the columns they get (those of ``documents``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid.llm import byte_bpe, decontaminate, language_id, minhash, span_dedup
from posegrid.llm.runtime import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = span_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.length("text").cast(kind))
    return left


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("span_dedup", drop_repeated_spans),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL expresses neither the language model nor the verified links; the tests
#: hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
