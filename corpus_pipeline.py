"""Corpus pipeline: documents through toxicity, near duplicates, benchmark passages, secrets and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kinlink.llm import decontaminate, jaccard, packing, secrets, toxicity
from kinlink.llm.common import shared_folder, table
from kinlink.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels that the documents have."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, a similarity of 0.8 or more."""
    return jaccard.keep_one(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words (or the whole) of a benchmark item go."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret in them becomes a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, none of which crosses documents."""
    return packing.pack(docs, TOKENIZER, limit=1024, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: No SQL: the classifier and the tokenizer have none. tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(path := f"{folder}/{i}-{name}")
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
