"""License scan against a plain version and on odd inputs."""

import random
import textwrap

from kinlink.llm import licenses, queries

from . import brute

SCHEMA = "doc_id long, text string, n_words string, found string, line string"


def plain(text):
    words = brute.alnum_words(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    labels, best = {x for _, x in places}, 1.0 if places else 0.0
    for line in (text or "").split("\n"):
        own = set(brute.alnum_words(line))
        for t, label in licenses.TEMPLATES.items():
            want = set(licenses._plain(t))
            if len(own & want) >= licenses.THRESHOLD * len(want) - 1e-9:
                labels.add(label)
                best = max(best, len(own & want) / len(want))
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), best


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    parts = ["MIT", "mit", "License", "licenses", "Apache", "Apache License", "CC", "by", "CC-BY", "CC BY-NC 4.0", "GNU General", "GNU General Public License", "\n", "é", "Licensed under", "Released under the", "2.0", "version", "the", "of", "élicense", "K", "CC by CC by"]
    parts += list(licenses.TEMPLATES)
    texts = [rng.choice([" ", "; "]).join(rng.choices(parts, k=rng.choice([0, 2, 6, 25]))) for _ in range(400)]
    texts += [" ".join(w for w in t.upper().split() if rng.random() < 0.85) for t in licenses.TEMPLATES for _ in range(6)]
    texts += [None, "", "\n\n", "word " * 30_000 + "mit license", "cc by"]
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {r[0]: tuple(r)[1:] for r in queries.op10_license_containment(spark, "").collect()}
    for i, t in enumerate(texts):
        want = plain(t)
        assert got[i][:6] == want[:6], t
        assert abs(got[i][6] - want[6]) < 1e-9


def test_plan_is_native_and_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    out = licenses.scan(none)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'


def test_wrapped_license_texts(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["\n".join(textwrap.wrap(t, k)) for t in (BSD, MIT) for k in (30, 70, 75, 80)]
    texts += ["\n".join(textwrap.wrap(" ".join(["one two"] * rng.randint(0, 9) + [w for w in rng.choice(list(licenses.TEMPLATES)).split() if rng.random() < 0.9] + ["end"] * rng.randint(0, 9)), 20)) for _ in range(60)]
    texts += [None, "", "\n", "cc\nby\n" * 500, "copy\n" + "x " * 40 + MIT[:60]]
    monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA).repartition(3))
    got = {r.doc_id: r for r in queries.op10_license_containment_wrapped(spark, "").collect()}
    for i, t in enumerate(texts):
        words, want = brute.alnum_words(t), plain(t)
        labels, best = set(filter(None, want[5].split(","))), want[6]
        for template, label in licenses.TEMPLATES.items():
            size, own = len(brute.alnum_words(template)), set(licenses._plain(template))
            share = max((len(own & set(words[j : j + size])) / len(own) for j in range(len(words))), default=0)
            if share >= licenses.THRESHOLD - 1e-9:
                labels.add(label)
                best = max(best, share)
        assert got[i].labels == ",".join(sorted(labels)), t
        assert abs(got[i].score - best) < 1e-9
    assert all("bsd-text" in got[i].labels for i in range(4)) and all("mit-text" in got[i].labels for i in range(4, 8))
