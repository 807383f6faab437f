"""The Jaccard join against brute force, and on odd inputs."""

import random

import numpy as np
import pytest

from kinlink.llm import jaccard
from kinlink.llm.common import mix

from . import brute

SCHEMA = "doc_id long, text string, node string, n string, component string"


def plain(rows, size, percent):
    sets = []
    for _, t in rows:
        w = brute.blank_words(t)
        k = min(size, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), d), d)
    return sorted((d, len(sets[k]), least[top(k)]) for k, (d, _) in enumerate(rows))


def corpus(seed, families=14):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of"] * 10
    passage = rng.choices(words, k=40)
    out = []
    for _ in range(families):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 9, 12, 30, 120, 400]))
        if rng.random() < 0.4:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.choice([1, 2, 8, 25])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                i = rng.randrange(len(t) + 1)
                t[i : i + rng.choice([0, 1])] = [rng.choice(words)]
            out.append(rng.choice([" ", "\n"]).join(t))
    rng.shuffle(out)
    return list(enumerate(out + [None, "", "  ", "The of", "the OF"]))


@pytest.mark.parametrize(("size", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (3, 90, 3), (1, 90, 4)])
def test_against_brute_force(spark, size, percent, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rows = corpus(seed) + [(3, "repeated row"), (3, "repeated row")]
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], SCHEMA).repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(df, size, percent).collect())
    assert got == plain(rows, size, percent)


def test_keys_are_shared():
    """Whatever tokens are frequent, linked sets have a common key that one of them wants."""
    rng = np.random.default_rng(7)
    for percent in (50, 70, 80, 85, 90, 100):
        for _ in range(4000):
            n, m = rng.integers(1, 60, 2)
            universe = rng.permutation(200)
            s = int(rng.integers(0, min(n, m) + 1))
            x, y = universe[:n], np.concatenate([universe[:s], universe[n : n + m - s]])
            if 100 * s < percent * (n + m - s) or n == m == s:
                continue
            often = rng.random(200) < rng.random()
            keys = []
            for v in (x, y):
                h = mix(v.astype(np.uint64))
                order = np.argsort(h)[: jaccard.head_length(len(v), percent)]
                keys.append([set(k.tolist()) for k in jaccard.keys_of(h[order], often[v[order]], len(v), percent)])
            (r1, w1, o1), (r2, w2, o2) = keys
            assert r1 & r2 or w1 & (w2 | o2) or w2 & o1, (percent, n, m, s)


def test_extended_prefixes():
    """A linked set has no more tokens alone in its prefix than may_lack says."""
    rng = np.random.default_rng(8)
    for percent in (70, 80, 90):
        for _ in range(4000):
            n, m = rng.integers(1, 120, 2)
            universe = rng.permutation(300)
            s = int(rng.integers(min(n, m) * percent // 100, min(n, m) + 1))
            x, y = np.sort(universe[:n]), np.sort(np.concatenate([universe[:s], universe[n : n + m - s]]))
            if 100 * s < percent * (n + m - s):
                continue
            p, q = (set(v[: jaccard.prefix_length(len(v), percent)].tolist()) for v in (x, y))
            assert len(p - q) <= jaccard.may_lack(n, percent) and len(q - p) <= jaccard.may_lack(m, percent), (percent, n, m, s)


def test_dense_and_loose_families(spark, monkeypatch):
    """Families larger than a block: one whose members link with a representative, one that only chains connect."""
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    rng = random.Random(6)
    base = [f"a{i}" for i in range(100)]
    texts = [" ".join([*base[:50], f"x{i}", *base[50:]]) for i in range(40)]
    chain = [f"c{i}" for i in range(160)]
    texts += [" ".join(chain[i : i + 60]) for i in range(0, 60)]
    line = " ".join(f"l{i}" for i in range(8))
    texts += [" ".join(rng.choices(base, k=20)) + " " + line for _ in range(40)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], SCHEMA).repartition(4)
    for size, percent in ((1, 90), (3, 90), (2, 80)):
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(df, size, percent).collect())
        assert got == plain(rows, size, percent)


def test_keep_one(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in rows + [rows[0], (None, "a b c d e f")]], SCHEMA)
    kept = sorted(r.doc_id for r in jaccard.keep_one(df).collect() if r.doc_id is not None)
    assert kept == [d for d, _, c in plain(rows, 5, 80) if d == c]


def test_keep_one_knows_documents_by_id_and_text(spark):
    rows = [(1, "one two three four five six", "a"), (1, "quite another text under this one id", "b"), (2, "one two three four five six", "c"), (1, "one two three four five six", "d"), (None, "one two three four five six", "e"), (None, None, "f"), (3, " ", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `id` string")
    kept = jaccard.keep_one(df.withColumn("row", df.doc_id))
    assert kept.columns == ["doc_id", "text", "id", "row"]
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("1", rows[0][1]), ("1", rows[1][1]), ("None", ""), ("3", " ")])


def test_empty(spark):
    assert jaccard.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_hot_nodes_and_chains(spark):
    from kinlink.llm.common import components

    edges = [(0, i) for i in range(1, 3000)] + [(9999, i) for i in range(7000, 8000)] + [(20000 + i, 20001 + i) for i in range(20)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = dict.fromkeys(range(3000), 0) | dict.fromkeys([*range(7000, 8000), 9999], 7000) | dict.fromkeys(range(20000, 20021), 20000)
    assert got == want
