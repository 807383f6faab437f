"""Profiles of sources and ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def empty_cells(df: DataFrame) -> DataFrame:
    """Rows, empty (or null) cells and their share for each column."""
    counts = df.agg(F.count("*").alias("n"), *(F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(c) for c in df.columns))
    return counts.select("n", F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*map(F.col, df.columns)))).alias("column_name", "n_empty")).select("column_name", F.col("n").alias("n_rows"), "n_empty", F.when(F.col("n") > 0, F.col("n_empty") / F.col("n")).otherwise(0.0).alias("share_empty"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def match_histogram(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """S1 records by their number of matches: 0, 1, 2, 3, 4+."""
    n = ids.join(truth.groupBy("s1_id").agg(F.count("*").alias("k")), "s1_id", "left").select(F.coalesce("k", F.lit(0)).alias("k"))
    return n.groupBy(F.when(F.col("k") >= 4, "4+").otherwise(F.col("k").cast("string")).alias("matches")).agg(F.count("*").alias("n"))


def source_split(truth: DataFrame) -> DataFrame:
    """Pairs by source; S1 records with matches in both sources, and with several in one."""
    s2, s3 = F.count_if(F.col("cand_id").startswith("S2-")).alias("k2"), F.count_if(F.col("cand_id").startswith("S3-")).alias("k3")
    each = truth.groupBy("s1_id").agg(s2, s3)
    return each.agg(F.sum("k2").alias("s2_pairs"), F.sum("k3").alias("s3_pairs"), F.count_if((F.col("k2") > 0) & (F.col("k3") > 0)).alias("in_both"), F.count_if(F.col("k2") > 1).alias("several_s2"), F.count_if(F.col("k3") > 1).alias("several_s3"), F.max(F.col("k2") + F.col("k3")).alias("most"))


def crossing_countries(truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """True pairs whose records name different countries."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("c2"))
    return truth.join(a, "s1_id").join(b, "cand_id").agg(F.count("*").alias("n_pairs"), F.count_if(F.col("c1") != F.col("c2")).alias("n_crossing"))


def id_correlation(truth: DataFrame) -> DataFrame:
    """Whether the numbers in matched ids go together."""
    number = lambda c: F.regexp_extract(c, r"-(\d+)", 1).cast("double")
    p = truth.select(number("s1_id").alias("a"), number("cand_id").alias("b"))
    return p.agg(F.corr("a", "b").alias("correlation"), F.avg(F.abs(F.col("a") - F.col("b"))).alias("mean_difference"), F.stddev_pop(F.abs(F.col("a") - F.col("b"))).alias("std_difference"))


def hardest_pairs(truth: DataFrame, s1: DataFrame, pool: DataFrame, n: int = 10) -> DataFrame:
    """The n true pairs with the least 0.6 * name + 0.4 * address likeness of the raw texts."""
    from kinlink.functions.similarity import sort_ratio

    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("business_name").alias("n1"), F.col("business_address").alias("a1"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("n2"), F.col("business_address").alias("a2"))
    both = truth.join(a, "s1_id").join(b, "cand_id").na.fill("")
    both = both.withColumns({"name_sim": sort_ratio("n1", "n2"), "addr_sim": sort_ratio("a1", "a2")}).withColumn("score", F.round(0.6 * F.col("name_sim") + 0.4 * F.col("addr_sim"), 6))
    return both.select("s1_id", "cand_id", "name_sim", "addr_sim", "score").orderBy("score", "s1_id", "cand_id").limit(n)
