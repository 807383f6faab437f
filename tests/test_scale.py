"""Record linkage where many records share names: the same rows as the plain way, without its pairs."""

import random
from dataclasses import replace

import pytest
from kinlink.config import CONFIG_B, DEFAULT
from kinlink.operators import channels
from kinlink.operators.normalize import normalize, with_source
from kinlink.plans import linkage
from pyspark.sql import functions as F

SOURCE = "entity_id string, business_name string, business_address string, country string"


def records(spark, ids, seed):
    rng = random.Random(seed)
    names = [f"{a}{x} {y}{z}" for a in ("", "LLP ") for x, y in (("red", "mill"), ("mill", "red"), ("oak", "the"), ("the", "oak")) for z in ("", " Inc", " SARL", " Services")]
    rows = [(i, rng.choice([*names, "", "Inc"]), rng.choice(["", f"{rng.randrange(9)} Main St, Springfield {10001 + rng.randrange(5)}"]), rng.choice(["US", "usa", "France"])) for i in ids]
    return with_source(normalize(spark.createDataFrame(rows, SOURCE))).localCheckpoint()


@pytest.fixture(scope="module")
def crowd(spark):
    s1 = records(spark, [f"S1-{i}" for i in range(60)], 1)
    return s1, records(spark, [f"S{2 + i % 2}-{i}" for i in range(300)] + ["S1-7"], 2)


@pytest.mark.parametrize("cfg", [replace(DEFAULT, total_cap=4), replace(DEFAULT, total_cap=25), replace(DEFAULT, total_cap=1000), replace(DEFAULT, total_cap=3, exact_core=False), replace(DEFAULT, total_cap=5, rare_token=False, postal=False, house=False), replace(DEFAULT, total_cap=6, signature=False, exact_full=False)])
def test_best_is_the_capped_union(spark, crowd, cfg):
    s1, pool = crowd
    fired = channels.firings(s1, pool, cfg)
    plain = channels.candidates(fired, cfg.total_cap)
    got = channels.best(s1, pool, cfg).localCheckpoint()
    assert got.columns == plain.columns and got.dtypes == plain.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    rows = lambda df: sorted(map(tuple, df.select("s1_id", "cand_id", "rule", "detail", "source", "rule_ord", "tok_pos").collect()))
    if cfg.total_cap == 4:
        assert rows(channels.pair_firings(s1, pool, cfg, got)) == rows(channels.kept_firings(fired, got))


def most_rows(spark, df):
    """The most rows that any operator of the plan gives."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run = df._jdf.queryExecution()
        run.toRdd().count()
        most, nodes = 0, [run.executedPlan()]
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            said = node.metrics().get("numOutputRows")
            most = max(most, said.get().value() if said.isDefined() else 0)
        return most
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_pair_of_equal_names_is_made_in_vain(spark):
    s1, pool = (with_source(normalize(spark.createDataFrame([(f"{p}-{i}", "Red Mill", "", "US") for i in range(300)], SOURCE))) for p in ("S1", "S2"))
    pairs = linkage.block(s1, pool, replace(DEFAULT, total_cap=3)).pairs
    assert {r.cand_id for r in pairs.collect()} == {"S2-0", "S2-1", "S2-10"}
    assert most_rows(spark, pairs) <= 3 * 900  # and not 300 x 300


def test_likeness_is_taken_once_a_text(spark):
    s1, pool = (with_source(normalize(spark.createDataFrame([(f"{p}-{i}", "Red Mill" if i else "Oak House", "", "US") for i in range(300)], SOURCE))) for p in ("S1", "S2"))
    near = channels.similar(s1, pool, "char_tfidf", CONFIG_B)
    assert {(r.s1_id, r.cand_id) for r in near.collect() if r.s1_id in ("S1-0", "S1-7")} == {("S1-7", f"S2-{i}") for i in (1, 10, 100, 101, 102)}
    assert most_rows(spark, near) <= 3000  # and not 299 x 299


@pytest.mark.parametrize("cfg", [replace(DEFAULT, total_cap=None), replace(CONFIG_B, signature=False), replace(DEFAULT, rare_token=False, postal=False, house=False)])
def test_counted_is_the_uncapped_union(spark, crowd, cfg):
    s1, pool = crowd
    plain = channels.firings(s1, pool, cfg).groupBy("s1_id", "cand_id").agg(F.count("*").alias("n_rules"), F.countDistinct("rule").alias("n_kinds"))
    got = channels.counted(s1, pool, cfg)
    assert got.dtypes == plain.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def operators(df):
    """The names of the plan's operators, without adaptive execution."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        names, nodes = [], [df._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            names.append(node.nodeName())
        return names
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_names_do_not_travel_to_the_pairs(spark, crowd):
    s1, pool = crowd
    parts = [x.localCheckpoint() for x in channels.bounded(s1, pool, DEFAULT)]
    joins = [x for x in operators(channels.known_pairs(parts, DEFAULT)) if "Join" in x]
    assert not joins  # a pair's equal names are told where it is found
