"""TF-IDF neighbours in blocks: those of all pairs, and what travels for them."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from kinlink.config import CONFIG_B, CONFIG_C
from kinlink.operators import channels, tfidf

from tests.test_scale import crowd  # noqa: F401


def vectors(rng, n, size, vocabulary, idf):
    lists = [[int(x) for x in np.minimum(rng.geometric(0.08, rng.integers(0, 9)), size + 3)] for _ in range(n)]
    return tfidf._Vectors(pa.array(lists, pa.list_(pa.int64())), vocabulary, idf)


def dense(v, size):
    out = np.zeros((v.n, size))
    out[v.row, v.code] = v.w
    return out


@pytest.mark.parametrize(("k", "floor", "n"), [(3, 0.4, 400), (1, 0.0001, 300), (5, 0.9, 700), (50, 0.3, 20), (2, 0.45, 1)])
def test_nearest_texts_are_those_of_all_pairs(k, floor, n):
    rng, size = np.random.default_rng(n), 60
    vocabulary, idf = np.arange(1, size + 1), 1 + rng.random(size)
    ours, theirs = vectors(rng, 80, size, vocabulary, idf), vectors(rng, n, size, vocabulary, idf)
    sims = np.round(dense(ours, size) @ dense(theirs, size).T, 9)
    own, near, sim = tfidf._nearest_texts(ours, theirs, size, k, floor)
    for i, row in enumerate(sims):
        least = max(floor, np.sort(row)[-k]) if n >= k else floor
        over, tied = np.flatnonzero(row > least), np.flatnonzero(row == least)
        want = set(over) | set(tied if len(over) + len(tied) <= k else tied[:k] if len(tied) > k else tied)
        got = set(near[own == i])
        assert set(over) <= got <= want | set(tied) and len(got) >= min(k, len(over) + len(tied))
        assert got - set(over) == set(tied[: len(got - set(over))])
        assert np.allclose(sim[own == i], row[near[own == i]], atol=1e-9)


def exchanges(df):
    nodes, out = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange":
            out.append(node.simpleString(1000))
    return out


@pytest.mark.parametrize("rule", ["char_tfidf", "combined_tfidf"])
def test_blocks_and_what_travels(spark, crowd, monkeypatch, rule):  # noqa: F811
    s1, pool = crowd
    rows = lambda: sorted(map(tuple, channels.similar(s1, pool, rule, CONFIG_B).collect()))
    one = rows()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # no text is dealt once for each of its terms
        assert not [x for x in exchanges(channels.similar(s1, pool, rule, CONFIG_B)) if "text#" in x and "term#" in x]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    monkeypatch.setattr(tfidf, "OURS", 7)
    monkeypatch.setattr(tfidf, "THEIRS", 11)
    assert one and rows() == one


@pytest.mark.parametrize("cfg", [replace(CONFIG_B, total_cap=6), replace(CONFIG_C, total_cap=5)])
def test_capped_candidates_of_small_blocks(spark, crowd, monkeypatch, cfg):  # noqa: F811
    s1, pool = crowd
    want = channels.candidates(channels.firings(s1, pool, cfg), cfg.total_cap).collect()
    monkeypatch.setattr(tfidf, "OURS", 7)
    monkeypatch.setattr(tfidf, "THEIRS", 11)
    assert sorted(map(tuple, channels.best(s1, pool, cfg).collect())) == sorted(map(tuple, want))
