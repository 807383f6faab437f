"""PPM: the trie against a plain coder, base scores against a plain count, odd inputs."""

import math
import random
import zlib
from collections import Counter

import pytest

from kinlink.llm import ppm, queries

from . import brute

SCHEMA = "doc_id long, text string, row string, word string, score string"


def texts(n=60):
    rng = random.Random(6)
    words = ["tion", "the", "Ré", "reading", "a", "b\tc", "stone", "zé"]
    return [" ".join(rng.choices(words, k=rng.choice([0, 1, 6, 60]))) for _ in range(n)] + [None, ""]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "", "", "") for i, t in rows], SCHEMA).repartition(3)


def test_trie_against_plain_coder(spark):
    rows = list(enumerate(texts()))
    train, rest = frame(spark, rows[:30]), rows[25:] + [(99, "unseen Ω bytes")]
    plain = ppm.Adaptive()
    for _, t in rows[:30]:
        b = bytes([ppm.START] * ppm.ORDER) + (t or "").encode() + bytes([ppm.END])
        for i in range(ppm.ORDER, len(b)):
            plain.learn(b[i - ppm.ORDER : i], b[i])
    got = {r.doc_id: r.score for r in ppm.score(frame(spark, rest), ppm.train(train)).collect()}
    for i, t in rest:
        assert got[i] == pytest.approx(plain.text(t or "", learn=False), rel=1e-4, abs=1e-4)
    small = ppm.train(train, nodes=100)
    assert len({x for x in small.slots.tolist() if x}) <= 100
    assert all(-1e6 < r.score < 0 for r in ppm.score(frame(spark, rest), small).collect())


@pytest.mark.parametrize("nodes", [1 << 20, 100, 0])
def test_scores_do_not_depend_on_what_travels(spark, nodes):
    rows = list(enumerate(texts()))
    train, rest = frame(spark, rows[:30]), rows[25:] + [(99, "unseen Ω bytes"), (98, "Zebra \x00 \x01tone stone")]
    plain = ppm.Adaptive()
    for _, t in rows[:30]:
        b = bytes([ppm.START] * ppm.ORDER) + (t or "").encode() + bytes([ppm.END])
        for i in range(ppm.ORDER, len(b)):
            plain.learn(b[i - ppm.ORDER : i], b[i])
    model = ppm.train(train, nodes)
    got = {r.doc_id: r.score for r in ppm.score(frame(spark, rest), model).collect()}
    based = {r.doc_id: r.score for r in ppm.score_with_base(frame(spark, rest), ppm.F.lit(True), model).collect()}
    for i, t in rest:
        assert got[i] == pytest.approx(plain.text(t or "", learn=False), rel=1e-9, abs=1e-9)
        assert based[i] == pytest.approx(got[i], rel=1e-9)


def test_adaptive(spark):
    got = {r.doc_id: r.score for r in ppm.score_adaptive(frame(spark, [(1, "abcabcabcabcabcabcabcabc"), (2, "abczkqhvnbclamqpwoeirutx"), (3, None)])).collect()}
    assert got[1] > got[2] and got[3] == pytest.approx(-math.log10(256))


@pytest.mark.parametrize("common", [1 << 18, 3, 0])
def test_base_against_plain_count(spark, common):
    rows = list(enumerate(texts())) + [(3, "repeated row"), (3, "repeated row")]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, t in rows:
        if not held(i):
            count.update(brute.blank_words(t) + [None])
    n, v = sum(count.values()), len(count)
    docs = frame(spark, rows)
    F = ppm.F
    training = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    out = ppm.score_with_base(docs, training, ppm.train(docs.filter(training)), common).collect()
    want = []
    for i, t in rows:
        own = brute.blank_words(t) + [None]
        want.append((i, len(own), sum(count[w] > 0 for w in own), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), 6)))
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == sorted(want)


def test_empty(spark, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *a: frame(spark, [(0, "x")]).limit(0))
    assert queries.op7_ppm_scores(spark, "").count() == 0
    rows = ppm.score(frame(spark, [(1, "ab")]), ppm.train(frame(spark, [(0, "x")]).limit(0))).collect()
    assert rows[0].score < 0
