"""The pipeline's stages against plain versions on a small corpus."""

import random

import corpus_pipeline
from kinlink.llm import packing, secrets

from . import brute
from .test_jaccard import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(80)] + ["the"] * 8
    item = " ".join(rng.choices(words, k=14))
    out, toxic = [], {}
    for i in range(160):
        t = rng.choices(words, k=rng.choice([30, 60, 200]))
        if i % 4 == 0:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), "vilest")
        if i % 10 == 3:
            t[5:5] = item.split()
        if i % 10 == 5:
            t[3:3] = ["password=abcdefghijklmn1234"]
        toxic[i] = int(i % 4 == 0)
        out.append((i, " ".join(t)))
    out += [(200 + i, out[i][1]) for i in (1, 2, 6)] + [(300 + i, out[i][1] + " w1") for i in (5, 9)] + [(400, ""), (401, None)]
    return out, toxic, item


def test_pipeline(spark, tmp_path):
    rows, toxic, item = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs.collect()
    clean = [(i, t) for i, t in rows if not toxic.get(i)]
    assert {r.doc_id for r in kept["toxicity"]} == {i for i, _ in clean}
    single = [d for d, _, c in plain(clean, 5, 80) if d == c]
    assert sorted(r.doc_id for r in kept["ngram_jaccard_join"]) == single
    by_id = dict(clean)
    free = [d for d in single if not brute.contamination([(d, by_id[d])], [(1, item)])[0][5]]
    assert sorted(r.doc_id for r in kept["benchmark_decontamination"]) == free
    redacted = {r.doc_id: r for r in kept["secret_scan"]}
    assert sorted(redacted) == free
    for d in free:
        t = by_id[d]
        assert redacted[d].text == (t and t.replace("password=abcdefghijklmn1234", "[secret]"))
        assert not brute.base_spans(redacted[d].text)
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, done)) == sorted(map(key, kept["packing"])) and {r.doc_id for r in done} == set(free)
    assert all(packing.lengths(r.doc_tokens) for r in done) and secrets.BASE


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, nulls in every column, repeated rows, clashing names and a very long text; each stage keeps the columns."""
    wide = SCHEMA + ", _hit_id long, row long, `id` string, word long, bits long, `can` string, spans string, score double"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60_000))
    extra = (7, 8, "x", 9, 10, "y", "z", 0.5)
    rows = [(1, "one two three four five six", "en", "s", 27, *extra), (1, "one two three four five six", "en", "s", 27, *extra), (1, "another text under the same id", "en", "s", 30, *extra), (2, long, "en", "s", len(long), *extra), (3, long, "en", "s", len(long), *extra), (4, "", None, None, None, *[None] * 8), (5, None, None, None, None, *[None] * 8), (None, "a null id stands before this text", None, None, None, *[None] * 8)]
    for name, data in (("empty", []), ("odd", rows)):
        docs = spark.createDataFrame(data, wide)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < 4:
                assert out.schema.names == docs.schema.names
            out.write.parquet(path := f"{tmp_path}/{name}-{k}")
            docs = spark.read.parquet(path)
            got = sorted(str(r.doc_id) for r in docs.collect())
            if name == "empty":
                assert got == []
            elif k == 0:
                assert len(got) == 8
            elif k < 4:
                assert got == ["1", "1", "2", "4", "5", "None"]
