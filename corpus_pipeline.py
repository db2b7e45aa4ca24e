"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of ``documents``; the last returns the packed pieces. ``run`` writes each stage's rows as Parquet to the shared folder and
reads them again, so a lost executor costs at most one stage.

The stages tokenize, align and pack, which SQL cannot state as a whole, so ``ORACLE_SQL`` is None; the tests hold the
rows of ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import decontaminate, jaccard, packing, quality, secrets
from leadlake.session import shared_dir

ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    return jaccard.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality rules", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", clean),
    ("secret scans", redacted),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
