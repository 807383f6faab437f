"""Diagnostics of blocking and of matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.config import THRESHOLDS


def per_entity(s1: DataFrame, truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each S1 record: true matches, candidates, retained matches, by source."""
    t = truth.groupBy("s1_id").agg(F.count("*").alias("true_matches_count"))
    joined = pairs.join(truth.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left")
    c = joined.groupBy("s1_id").agg(F.count("*").alias("candidates_count"), F.count("hit").alias("retained_true_matches"), F.count_if(F.col("source") == "S2").alias("s2_candidates"), F.count_if(F.col("source") == "S3").alias("s3_candidates"))
    out = s1.select(F.col("entity_id").alias("s1_id"), F.col("country_normalized").alias("country")).join(t, "s1_id", "left").join(c, "s1_id", "left").na.fill(0)
    return _marked(out)


def per_entity_lists(rows: DataFrame) -> DataFrame:
    """per_entity of s1_id, country, true_ids (each once) and cands (channels.ranked), where no pair need be made."""
    some = lambda source: F.size(F.filter("ids", lambda x: x.startswith(source))).cast("long")
    rows = rows.select("s1_id", "country", "true_ids", F.col("cands.cand_id").alias("ids"))
    counts = {"true_matches_count": F.size("true_ids").cast("long"), "candidates_count": F.size("ids").cast("long"), "retained_true_matches": F.size(retained()).cast("long"), "s2_candidates": some("S2"), "s3_candidates": some("S3")}
    return _marked(rows.select("s1_id", "country", *(c.alias(k) for k, c in counts.items())))


def retained() -> Column:
    """Of true_ids those in ids."""
    return F.filter("true_ids", lambda x: F.array_contains("ids", x))


def _marked(out: DataFrame) -> DataFrame:
    return out.withColumns({"all_matches_retained": (F.col("retained_true_matches") == F.col("true_matches_count")).cast("int"), "is_singleton": (F.col("true_matches_count") == 0).cast("int")})


def _metrics() -> list[Column]:
    truth, kept, count = F.sum("true_matches_count"), F.sum("retained_true_matches"), F.col("candidates_count")
    real = F.count_if(F.col("is_singleton") == 0)
    return [
        F.count("*").alias("n_entities"),
        truth.alias("true_pairs"),
        kept.alias("retained_pairs"),
        F.sum("candidates_count").alias("n_candidates"),
        F.when(truth > 0, kept / truth).otherwise(1.0).alias("pair_recall"),
        F.when(real > 0, F.count_if((F.col("is_singleton") == 0) & (F.col("all_matches_retained") == 1)) / real).otherwise(1.0).alias("entity_recall"),
        F.avg(count).alias("mean_candidates"),
        F.percentile(count, F.lit(0.5)).alias("median_candidates"),
        F.percentile(count, F.lit(0.9)).alias("p90_candidates"),
        F.percentile(count, F.lit(0.95)).alias("p95_candidates"),
        F.max(count).alias("max_candidates"),
    ]


def blocking_metrics(entities: DataFrame, n_pool: int | None = None) -> DataFrame:
    """One row over all entities. n_pool: records that could have been candidates; without it reduction is 0.9999."""
    out = entities.agg(*_metrics())
    possible = F.col("n_entities") * F.lit(n_pool)
    return out.withColumn("reduction_ratio", F.when(possible > 0, 1 - F.col("n_candidates") / possible).otherwise(0.9999) if n_pool else F.lit(0.9999))


def blocking_by_country(entities: DataFrame) -> DataFrame:
    return entities.groupBy("country").agg(*_metrics())


def blocking_by_source(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """True and retained pairs of each source."""
    hit = truth.join(pairs.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left")
    out = hit.groupBy(F.substring("cand_id", 1, 2).alias("source")).agg(F.count("*").alias("true_pairs"), F.count("hit").alias("retained_pairs"))
    return out.withColumn("pair_recall", F.col("retained_pairs") / F.col("true_pairs"))


def blocking_by_source_lists(rows: DataFrame) -> DataFrame:
    """blocking_by_source of true_ids and cands."""
    each = rows.select(F.col("cands.cand_id").alias("ids"), "true_ids").select(F.inline(F.transform("true_ids", lambda x: F.struct(F.substring(x, 1, 2).alias("source"), F.array_contains("ids", x).alias("hit")))))
    out = each.groupBy("source").agg(F.count("*").alias("true_pairs"), F.count_if("hit").alias("retained_pairs"))
    return out.withColumn("pair_recall", F.col("retained_pairs") / F.col("true_pairs"))


def rule_attribution(fired: DataFrame, truth: DataFrame) -> DataFrame:
    """Firings of each rule on true pairs that were kept."""
    return fired.join(truth, ["s1_id", "cand_id"], "left_semi").groupBy("rule").agg(F.count("*").alias("firings")).orderBy(F.desc("firings"), "rule")


def missed(truth: DataFrame, pairs: DataFrame, s1: DataFrame, pool: DataFrame, entities: DataFrame) -> DataFrame:
    """True pairs that are no candidates, with the records' texts, a likeness of the names, and a likely reason."""
    from kinlink.functions.similarity import sort_ratio

    lost = truth.select("s1_id", "cand_id").join(pairs, ["s1_id", "cand_id"], "left_anti")
    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("country_normalized").alias("country"), F.col("business_name").alias("s1_raw_name"), F.col("business_address").alias("s1_raw_address"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("missed_raw_name"), F.col("business_address").alias("missed_raw_address"))
    n = entities.select("s1_id", F.col("candidates_count").alias("cands_generated_count"))
    out = lost.join(a, "s1_id").join(b, "cand_id", "left").join(n, "s1_id", "left").na.fill("")
    out = out.withColumn("name_token_sort_sim", sort_ratio("s1_raw_name", "missed_raw_name"))
    return out.withColumnRenamed("cand_id", "missed_id").withColumn("reason", reason(F.col("name_token_sort_sim")))


def reason(similarity: Column) -> Column:
    return F.when(similarity < 25, "alias").when(similarity < 50, "spelling").otherwise("token_pruned")


def better_config(recall_b: float, recall_c: float, margin: float = 0.01) -> str:
    """The fuller configuration if its recall is higher by more than the margin, else the lean one."""
    return "B" if recall_b - recall_c > margin else "C"


def entity_scores(ids: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """precision, recall, f05 and counts of each S1 record (and of each threshold, if predicted has one in ids too)."""
    key = [c for c in ids.columns if c in ("s1_id", "tau")]
    t = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    p = predicted.join(truth.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").groupBy(*key).agg(F.count("*").alias("n_pred"), F.count("hit").alias("n_hit"))
    return _graded(ids.join(t, "s1_id", "left").join(p, key, "left").na.fill(0, ["n_true", "n_pred", "n_hit"]))


def _graded(out: DataFrame) -> DataFrame:
    """precision, recall and f05 of n_true, n_pred and n_hit."""
    none, empty = F.col("n_true") == 0, F.col("n_pred") == 0
    pr, re = F.when(empty, 1.0).otherwise(F.col("n_hit") / F.col("n_pred")), F.when(none, 1.0).otherwise(F.col("n_hit") / F.col("n_true"))
    out = out.withColumns({"precision": pr, "recall": re})
    f = F.when(none & empty, 1.0).when(none | empty | (F.col("n_hit") == 0), 0.0).otherwise(1.25 * F.col("precision") * F.col("recall") / (0.25 * F.col("precision") + F.col("recall")))
    return out.withColumn("f05", f)


def macro(scores: DataFrame, *by: str) -> DataFrame:
    """Averages over S1 records, micro figures, accuracy on singletons."""
    hit, pred, true = F.sum("n_hit"), F.sum("n_pred"), F.sum("n_true")
    alone = F.count_if(F.col("n_true") == 0)
    return scores.groupBy(*by).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f05").alias("macro_f05"),
        F.when(pred > 0, hit / pred).otherwise(1.0).alias("micro_precision"),
        F.when(true > 0, hit / true).otherwise(1.0).alias("micro_recall"),
        F.when(alone > 0, F.count_if((F.col("n_true") == 0) & (F.col("n_pred") == 0)) / alone).otherwise(1.0).alias("singleton_accuracy"),
    )


def sweep(ids: DataFrame, scored: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """The macro figures at each threshold. A pair counts once, under the number of thresholds that it reaches; only the S1
    records are exploded by the thresholds, a fixed short list."""
    hit = scored.join(truth.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left")
    return sweep_told(ids, hit.select("s1_id", "p", F.col("hit").isNotNull().alias("hit")), truth, thresholds)


def sweep_told(ids: DataFrame, scored: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """sweep() of s1_id, p, hit: pairs that tell whether they are true. A score is taken once a pair, as a grouping key:
    inside the lambda or in a filter it would be taken again for each threshold."""
    taus = F.array(*map(F.lit, sorted(thresholds)))
    scores = scored.groupBy("s1_id", "p").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"))
    level = F.size(F.filter(taus, lambda t: F.col("p") >= t)).alias("level")
    levels = scores.groupBy("s1_id").agg(F.collect_list(F.struct(level, "n", "hits")).alias("levels"))
    t = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    each = ids.select("s1_id").join(t, "s1_id", "left").join(levels, "s1_id", "left").select("s1_id", "n_true", "levels", F.posexplode(taus).alias("place", "tau"))
    over = lambda c: F.aggregate("levels", F.lit(0).cast("long"), lambda s, x: s + F.when(x["level"] > F.col("place"), x[c]).otherwise(0))
    rows = each.select("s1_id", "tau", "n_true", over("n").alias("n_pred"), over("hits").alias("n_hit")).na.fill(0, ["n_true", "n_pred", "n_hit"])
    return macro(_graded(rows), "tau")


def best_threshold(curve: DataFrame) -> float:
    return curve.orderBy(F.desc("macro_f05"), "tau").first()["tau"]
