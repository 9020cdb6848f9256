"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchback.llm import bpe, line_dedup, mixing, near_dedup, repetition
from switchback.llm.common import fresh_name
from switchback.session import shared_folder


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    verdict = fresh_name(docs, "verdict")
    return repetition.quality(docs, out=verdict).filter(f"`{verdict}`.kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return out.withColumns(new).select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return near_dedup.keep_first(docs)


def sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with packed token ids and their number, round trip checked."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.round_trip(docs, path, pattern)
    return both.select(
        "doc_id", "source", bpe.n_tokens(F.col("ids")).alias("n_tokens"), "ids",
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"),
    )


STAGES = [("quality rules", rules), ("line dedup", lines), ("near-dedup", copies), ("mixing", sources), ("byte-level BPE", tokens)]

#: SQL can't express suffix arrays or BPE; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each is written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
