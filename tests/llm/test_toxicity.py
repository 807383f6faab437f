"""The toxicity classifier on labelled toy texts and odd inputs."""

import random

import numpy as np

from kinlink.llm import toxicity

SCHEMA = "doc_id long, text string, y string, features string, score string"


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    words = ["la", "mer", "and", "river", "stone", "tür", "clowning"]
    texts, labels = [], []
    for i in range(n):
        body = rng.choices(words, k=rng.choice([5, 40, 300]))
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                body.insert(rng.randrange(len(body)), rng.choice(["vilest", "Dreck!"]))
        texts.append((i, " ".join(body), "a", "b", "c"))
        labels.append((i, int(bad)))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    docs = spark.createDataFrame(texts, SCHEMA).repartition(4)
    train = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int")
    model = toxicity.fit(docs, train)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert np.mean([got[i].predicted == y for i, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, *"abc"), (2, "", *"abc"), (None, "x" * 200_000, *"abc"), (2, "", *"abc")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(2, 1), (2, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(rows) == 4 and len({r.score for r in rows}) == 1
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), one)).count() == 0
