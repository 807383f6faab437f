"""The queries of the subpackage, each a thin layer over its operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, extraction, fingerprints, jaccard, licenses, oracle, packing, ppm, secrets, substrings, toxicity
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_edit_embedding_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op2_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(table(spark, sf_dir, "documents"))
    found = decontaminate.search(index, table(spark, sf_dir, "benchmark"), window=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op3_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("spans", lambda x: x["kind"] == kind)
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, limit=1024, end_id=0)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op6_suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    found = ppm.score_with_base(docs, ~held, ppm.train(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_ngram_bayes_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held), "toxic")
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_token_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"), size=3, percent=90)


def op10_license_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _license_labels(licenses.scan(table(spark, sf_dir, "documents")))


def op10_license_containment_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op10_license_containment, with blocks that span lines; without SQL."""
    return _license_labels(licenses.scan(table(spark, sf_dir, "documents"), wrapped=True))


def _license_labels(found: DataFrame) -> DataFrame:
    base = F.transform("places", lambda x: x["label"])
    own = F.transform("found", lambda x: x["label"])
    said = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.transform("places", lambda x: x["start"].cast("long"))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["containment"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        said(base).alias("base_labels"),
        said(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return oracle.oracles()
