"""Substring deduplication against brute force, the automaton, odd inputs."""

import random

import numpy as np
import pytest

from kinlink.llm import substrings

from . import brute

SCHEMA = "doc_id long, text string, row string, runs string, words string"


def plain(rows, least):
    first = {}
    texts = [(d, brute.blank_words(t, lower=False)) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - least + 1):
            k = tuple(w[i : i + least])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - least + 1):
            if first[tuple(w[i : i + least])] < d:
                gone |= set(range(i, i + least))
        out.append((d, len(w), len(gone), brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "é"] + [f"w{i}" for i in range(40)]
    passages = [rng.choices(words, k=k) for k in (49, 50, 51, 70, 130)] + [["a"] * 80, ["a", "b"] * 60]
    out = []
    for _ in range(70):
        t = []
        for _ in range(rng.choice([1, 2, 4])):
            t += rng.choices(words, k=rng.choice([0, 1, 20, 90]))
            p = rng.choice(passages)
            a = rng.choice([0, 0, 5])
            t += p[a : len(p) - rng.choice([0, 0, 1, 9])]
        out.append(rng.choice([" ", "\n", "\t "]).join(t))
    return list(enumerate(out + [out[0], out[3], None, "", "x " * 49, "y " * 50, "y " * 51]))


@pytest.mark.parametrize(("seed", "shard"), [(1, 16), (2, 3), (3, 0), (4, 200)])
def test_against_brute_force(spark, seed, shard, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", shard)
    rows = corpus(seed)
    rows = [(d * 7 % 1000 - 20, t) for d, t in rows] + [(-20, rows[0][1])]
    df = spark.createDataFrame([(d, t, "", "", "") for d, t in rows], SCHEMA).repartition(4)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(df).collect())
    assert got == plain(rows, substrings.LEAST)


def test_automaton():
    rng = random.Random(3)
    for _ in range(60):
        seqs = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(4)]
        a = substrings.SuffixAutomaton()
        for k, s in enumerate(seqs):
            a.add(s, k)
        q, least = [rng.randrange(3) for _ in range(40)], 4
        want = {}
        for i in range(len(q) - least + 1):
            for k, s in enumerate(seqs):
                if any(s[j : j + least] == q[i : i + least] for j in range(len(s))):
                    want[i] = k
                    break
        assert dict(a.statistics(q, least)) == want


def test_sliding_argmin():
    rng = np.random.default_rng(1)
    for n, w in ((5, 5), (40, 7), (41, 1), (100, 35)):
        v = rng.integers(0, 20, n).astype(np.uint64) << np.uint64(40)
        assert substrings.sliding_argmin(v, w).tolist() == [i + int(v[i : i + w].argmin()) for i in range(n - w + 1)]


def test_odd_inputs(spark):
    assert substrings.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    t = " ".join(f"w{i}" for i in range(60))
    rows = substrings.dedup(spark.createDataFrame([(None, t, "", "", ""), (5, t, "", "", ""), (5, t, "", "", "")], SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 60), (5, 0), (5, 0)]
