"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

1. quality rules: documents that the rules reject go;
2. n-gram Jaccard join: of each group of near duplicates the document of least id stays;
3. benchmark decontamination: documents that hold a window of a benchmark item go;
4. secret scans: secrets, also inside encoded layers, are replaced by a mark;
5. BPE: the texts as token ids, with the digest of the text that they decode to.

All stages but the last return the columns of ``documents``.  Null texts do not pass stage 1;
an empty table passes as an empty table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from encore.llm import bpe, decontaminate, jaccard_join, quality, secret_scan
from encore.llm.common import stored

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokenised(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", tokenise),
]

#: Rolling hashes, layered decoding and byte-pair merging have no SQL form; tests compare the
#: stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k + 1}")
    return docs
