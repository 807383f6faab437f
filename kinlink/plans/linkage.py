"""The whole task: blocking experiments, training, inference. Each is one lazy plan up to its sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.config import CONFIG_A, CONFIG_B, CONFIG_C, CONFIG_INFERENCE, CONFIG_TRAINING, BlockingConfig
from kinlink.operators import channels, evaluate, features, matching
from kinlink.operators.normalize import normalize, with_source


def prepared(s1: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normalized S1 and pool. Used several times; call persist() on them where memory allows."""
    return with_source(normalize(s1)), with_source(normalize(others))


@dataclass
class Blocking:
    fired: DataFrame | None
    pairs: DataFrame
    entities: DataFrame | None = None
    metrics: DataFrame | None = None


def block(s1: DataFrame, pool: DataFrame, cfg: BlockingConfig, truth: DataFrame | None = None, n_pool: int | None = None) -> Blocking:
    """Candidates of normalized records, and with ground truth their metrics."""
    pairs = channels.best(s1, pool, cfg)
    out = Blocking(channels.pair_firings(s1, pool, cfg, pairs), pairs)
    if truth is not None:
        out.entities = evaluate.per_entity(s1, truth, pairs)
        out.metrics = evaluate.blocking_metrics(out.entities, n_pool)
    return out


def experiment(s1: DataFrame, pool: DataFrame, truth: DataFrame) -> tuple[dict[str, Blocking], str]:
    """Configurations A, B and C on the same records, and the better of B and C."""
    n = pool.count()
    runs = {k: block(s1, pool, c, truth, n) for k, c in (("A", CONFIG_A), ("B", CONFIG_B), ("C", CONFIG_C))}
    recall = {k: r.metrics.first()["pair_recall"] for k, r in runs.items()}
    return runs, evaluate.better_config(recall["B"], recall["C"])


def train(s1: DataFrame, pool: DataFrame, truth: DataFrame, validation: DataFrame, trees: int = 350):
    """(model, threshold, curve). validation: ids of the S1 records that stop the training and choose the threshold."""
    blocked = block(s1, pool, CONFIG_TRAINING)
    rows = matching.labelled(features.pair_features(blocked.pairs, s1, pool), truth)
    held = validation.select(F.col("entity_id").alias("s1_id"), F.lit(True).alias("held")).distinct()
    rows = rows.join(held, "s1_id", "left").withColumn("held", F.coalesce("held", F.lit(False))).persist()
    model = matching.train(rows, "held", trees)
    curve = evaluate.sweep(held.select("s1_id"), matching.score(rows.filter("held"), model), truth.join(held, "s1_id", "left_semi")).persist()
    return model, evaluate.best_threshold(curve), curve


def infer(s1: DataFrame, pool: DataFrame, model, threshold: float, cfg: BlockingConfig = CONFIG_INFERENCE) -> tuple[DataFrame, DataFrame]:
    """(matching results, candidate pairs), a row for every S1 record. model: fitted, or None for the linear score."""
    blocked = block(s1, pool, cfg)
    rows = features.pair_features(blocked.pairs, s1, pool)
    scored = matching.score(rows, model) if model is not None else matching.linear_score(rows)
    found = matching.only_candidates(matching.matches(scored, threshold), blocked.pairs)
    return matching.id_lists(s1, found, "place", "matched_entity_ids"), matching.id_lists(s1, blocked.pairs, "cand_pos", "candidate_entity_ids")
