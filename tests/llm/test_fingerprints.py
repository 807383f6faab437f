"""Edit-embedding fingerprints: the walk against a plain version, neighbours, likeness, odd inputs."""

import hashlib
import random

import numpy as np

from kinlink.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, n_chars string, fingerprint string"


def plain_walk(text):
    bits, steps = fp._tables()
    codes = [max(1, (ord(c) ^ ord(c) >> 8 ^ ord(c) >> 16) & 255) for c in text] + [0] * 8
    at, seen, j = 0, {}, 0
    while at < len(text):
        c = codes[at : at + 4]
        h = sum(a * b for a, b in zip(c, (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F), strict=True)) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x2C1B3C6D & 0xFFFFFFFF
        seen[j] = (h >> 24) % 255 + 1
        at += int(bits[j % fp.PERIOD, codes[at]])
        j += 1
    out = b"".join(bytes(seen.get(int(s), 0) for s in x) for x in steps)
    used = max([i for i, b in enumerate(out) if b], default=-1)
    return out[: (used // fp.SAMPLES + 1) * fp.SAMPLES]


def test_walk_and_likeness():
    rng = random.Random(2)
    texts = ["", "a", "é\U0001f600" * 50, "".join(rng.choices("abcdefgh ", k=3000)), "".join(rng.choices("abcdefgh ", k=300))]
    got = fp.Embedder()(texts)
    assert got == [plain_walk(t) for t in texts]
    near = [t[:k] + "zz" + t[k:] for t, k in ((texts[3], 700), (texts[3], 2000))]
    a, b, c = fp.Embedder()([texts[3], *near])
    assert fp.likeness(a, a) == 1 and fp.likeness(b"", b"") == 1 and fp.likeness(a, b"") == 0
    assert fp.likeness(a, b) > 0.6 and fp.likeness(a, c) > 0.6 and fp.share_band(a, b)
    assert fp.likeness(a, got[4]) < 0.2


def test_edited_against_brute_force(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-50, 4000), 150)
    rows = [(i, "".join(rng.choices("abc dé\U0001f600", k=rng.choice([0, 1, 5, 90, 800]))), "x", "y") for i in ids]
    rows += [(ids[0], rows[0][1], "x", "y"), (None, "null id", "x", "y"), (9000, None, "x", "y")]
    want = []
    order = sorted(((i if i is not None else 1 << 63, t or "", i) for i, t, *_ in rows))
    embed = fp.Embedder()
    for (_, t, i), (_, u, _) in zip(order, [*order[1:], order[0]], strict=True):
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b, c = embed([t, e, u])
        want.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), a.hex(), b.hex(), fp.likeness(a, b), fp.likeness(a, c)))
    got = [(str(r[0]), *r[1:7]) for r in fp.edited(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    assert sorted(got) == sorted(want)


def test_odd_tables(spark):
    assert fp.edited(spark.createDataFrame([], SCHEMA)).count() == 0
    (r,) = fp.edited(spark.createDataFrame([(1, "abcdef", "", "")], SCHEMA)).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1


def test_near_pairs(spark):
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdefghij  ", k=900)) for _ in range(6)]
    texts = base + [base[0], base[1][:890] + "?" + base[1][890:], base[2] + "!"]
    prints = fp.fingerprints(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA))
    links, members = fp.near_pairs(prints)
    joined = {(r.a, r.b) for r in links.collect()} | {(r.class_id, r.doc_id) for r in members.collect() if r.class_id != r.doc_id}
    assert joined == {(0, 6), (1, 7), (2, 8)}
    assert np.all([r.likeness >= 0.8 for r in links.collect()])


def test_near_pairs_under_a_shared_header(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK", 4)
    rng = random.Random(5)
    draw = lambda: bytes(rng.randrange(1, 256) for _ in range(32))
    head, prints = draw()[:8], []
    for _ in range(8):  # each with one copy that has other bytes in six bands, so that only the header's bands are shared
        one = head + draw()[8:]
        two = bytearray(one)
        for i in range(8, 32, 4):
            two[i] ^= 1 if two[i] > 1 else 2
        prints += [one, bytes(two)]
    prints = [head + draw()[8:] for _ in range(3)] + prints
    frame = spark.createDataFrame([(i, 32, p.hex()) for i, p in enumerate(prints)], "doc_id long, n_chars long, fingerprint string")
    links, _ = fp.near_pairs(frame)
    want = {(a, b) for a in range(len(prints)) for b in range(a + 1, len(prints)) if fp.share_band(prints[a], prints[b]) and fp.likeness(prints[a], prints[b]) >= 0.8}
    assert {(r.a, r.b) for r in links.collect()} == want and len(want) == 8
