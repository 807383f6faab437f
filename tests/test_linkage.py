"""Record linkage: text functions, similarities, channels, metrics, sinks, validator, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from kinlink.config import CONFIG_A, CONFIG_B, BlockingConfig
from kinlink.functions import similarity as S
from kinlink.functions import text as T
from kinlink.operators import channels, evaluate, features, matching, validate
from kinlink.operators.normalize import normalize, with_source
from kinlink.plans import catalog, linkage
from kinlink.sources import tables
from kinlink.streaming import linkage as streaming

SOURCE = "entity_id string, business_name string, business_address string, country string"


def records(spark, rows):
    return with_source(normalize(spark.createDataFrame(rows, SOURCE)))


@pytest.fixture(scope="module")
def small(spark):
    s1 = records(spark, [("S1-1", "Acme Tools Inc.", "12 Main St, Springfield 62701", "US"), ("S1-2", "Gahlot Brothers Private Limited", "Plot No. 7, MG Rd, Pune 411001", "India"), ("S1-3", "Boulangerie Été SARL", "5 bis Rue de Lyon, 69001 Lyon", "France"), ("S1-4", "Solitary Lighthouse", "99 Far Rd", "US")])
    pool = records(spark, [("S2-1", "ACME TOOLS INCORPORATED", "12 Main Street, Springfield 62701", "usa"), ("S3-1", "Gahlot Bros Pvt Ltd", "Plot No 7, M G Road, Pune 411001", "India"), ("S2-2", "Boulangerie Ete", "", "France"), ("S2-9", "Other Company", "1 Elm Ave", "US"), ("S1-4", "Solitary Lighthouse", "99 Far Rd", "US")])
    return s1, pool


@pytest.mark.parametrize(
    ("name", "core", "suffix"),
    [("Acme Inc.", "acme", "inc"), ("LLP Turning Point", "turning point", "llp"), ("Noify Software, L.L.C.", "noify software", "llc"), ("A & B + C", "a and b and c", ""), ("Inc", "inc", "inc"), ("Gahlot Private Limited", "gahlot", "pvt ltd"), ("SCI Les Pins S.A.R.L.", "les pins", "sci"), ("Café Zoë", "cafe zoe", ""), ("", "", ""), (None, "", ""), ("7-Eleven 24x7", "7 eleven 24x7", "")],
)
def test_names(spark, name, core, suffix):
    r = normalize(spark.createDataFrame([("S1-1", name, "", "US")], SOURCE)).first()
    assert (r.name_core, r.name_legal_suffix) == (core, suffix)
    again = normalize(spark.createDataFrame([("S1-1", r.name_normalized, "", "US")], SOURCE)).first()
    assert again.name_normalized == r.name_normalized


def test_addresses(spark):
    rows = [("a", "n", "1212 Main St, Dallas 75201-1234", "US"), ("b", "n", "Door No. 4-B, Nagar Rd, 411001", "India"), ("c", "n", "5 bis Rue X, 69001 Lyon", "France"), ("d", "n", " ", "US"), ("e", "n", "Tower, 44 Lane, 560001", "Peru"), ("f", "n", "G-21 Mkt", None)]
    got = {r.entity_id: r for r in normalize(spark.createDataFrame(rows, SOURCE)).collect()}
    assert [got[k].address_postal_code for k in "abcdef"] == ["75201-1234", "411001", "69001", "", "560001", ""]
    assert [got[k].address_house_number for k in "abcdef"] == ["1212", "4-b", "5 bis", "", "44", "g-21"]
    assert got["d"].address_is_empty == 1 and got["d"].address_tokens == []
    assert got["a"].address_normalized == "1212 main st dallas 75201 1234" and got["a"].address_numeric_tokens == ["1212", "75201", "1234"]
    assert [got[k].country_normalized for k in "abcdef"] == ["US", "India", "France", "US", "Peru", "UNKNOWN"]


def test_fold():
    assert T.fold_text("Straße Ærø Łódź") == "Strasse AEro Lodz"
    assert T.fold_text("Москва") == "Moskva" and T.fold_text("कमल") == "kamala" and T.fold_text("Αθηνα") == "Athena"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarities():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc é", k=rng.randrange(12))) for _ in range(2))
        assert S.lcs(a, b) == plain_lcs(a, b)
        x, y = sorted((a, b), key=len)
        if x and len(x) < len(y):
            parts = [y[max(0, i) : i + len(x)] for i in range(1 - len(x), len(y))]
            assert S.partial_ratio(a, b) == pytest.approx(max(S.ratio(x, p) for p in parts))
    assert S.token_sort_ratio("b a", "a b") == 100 and S.token_set_ratio("a b", "a b c") == 100
    assert S.token_set_ratio("", "a") == 0 and S.ratio("", "") == 100 and S.partial_ratio("", "") == 100


def test_signature_and_grams(spark):
    df = spark.createDataFrame([("the acme of b acme", "apple", "ab")], "a string, b string, c string")
    r = df.select(T.signature(T.tokens("a")).alias("s"), T.gram_set(F.col("b"), 3).alias("g"), T.gram_set(F.col("c"), 3).alias("h"), T.jaccard(T.gram_set(F.lit(""), 3), T.gram_set(F.lit(""), 3)).alias("j")).first()
    assert r.s == "acme acme" and sorted(r.g) == ["app", "ple", "ppl"] and r.h == ["ab"] and r.j == 0


def test_blocking(spark, small):
    s1, pool = small
    fired = channels.firings(s1, pool, CONFIG_B)
    pairs = channels.candidates(fired, 50)
    got = {(r.s1_id, r.cand_id) for r in pairs.collect()}
    assert {("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-3", "S2-2")} <= got
    assert not any(c.startswith("S1-") for _, c in got) and not any(a == "S1-4" for a, _ in got)
    again = channels.candidates(channels.firings(s1.repartition(7), pool.repartition(1), CONFIG_B), 50)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pairs.collect()))
    lists = matching.id_lists(s1, pairs, "cand_pos", "candidate_entity_ids").collect()
    assert len(lists) == 4 and {r.source1_entity_id: r.candidate_entity_ids for r in lists}["S1-4"] == ""


def test_repeats_fire_and_caps_come_before_gates(spark):
    s1 = records(spark, [("S1-1", "zebra zebra north", "", "US"), ("S1-2", "zulu", "7 Oak Rd, 10001", "US")])
    pool = records(spark, [(f"S2-{i}", "zebra", "", "US") for i in range(3)] + [("S2-7", "other", "8 Elm Rd, 10001", "US"), ("S2-8", "zulu", "9 Elm Rd, 10001", "US")])
    cfg = BlockingConfig(token_cap=2, postal_cap=1)
    fired = [r for r in channels.rare_token(s1, pool, cfg).collect() if r.s1_id == "S1-1"]
    assert sorted((r.cand_id, r.tok_pos) for r in fired) == [("S2-0", 0), ("S2-0", 1), ("S2-1", 0), ("S2-1", 1)]
    assert channels.address(s1, pool, "postal_code_block", cfg).count() == 0  # the cap keeps S2-7, the gate drops it
    assert channels.address(s1, pool, "postal_code_block", BlockingConfig(postal_cap=2)).count() == 1


def test_features(spark, small):
    s1, pool = small
    pairs = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-9", 2), ("S1-3", "S2-2", 1)], "s1_id string, cand_id string, cand_pos long")
    got = {(r.s1_id, r.cand_id): r for r in features.pair_features(pairs, s1, pool).collect()}
    a, b, c = got["S1-1", "S2-1"], got["S1-1", "S2-9"], got["S1-3", "S2-2"]
    assert (a.postal_match, a.house_match, a.name_core_sort, a.suffix_match, a.candidate_rank, a.name_sort_diff_to_best) == (1, 1, 1, 1, 1, 0)
    assert b.candidate_rank == 2 and b.total_candidates_for_s1 == 2 and b.name_sort_diff_to_best > 0
    assert (c.postal_match, c.cand_addr_empty, c.both_addr_empty, c.addr_lev, c.name_core_sort, c.is_s2) == (-1, 1, 0, 0, 1, 1)
    assert len(a) == 37


def test_macro_f05_branches(spark):
    ids = spark.createDataFrame([(x,) for x in "abcde"], "s1_id string")
    truth = spark.createDataFrame([("c", "1"), ("d", "1"), ("d", "2"), ("e", "5")], "s1_id string, cand_id string")
    pred = spark.createDataFrame([("b", "9"), ("d", "1"), ("d", "2"), ("d", "3"), ("e", "6")], "s1_id string, cand_id string")
    got = {r.s1_id: (r.precision, r.recall, round(r.f05, 3)) for r in evaluate.entity_scores(ids, pred, truth).collect()}
    assert got == {"a": (1, 1, 1), "b": (0, 1, 0), "c": (1, 0, 0), "d": (pytest.approx(2 / 3), 1, 0.714), "e": (0, 0, 0)}
    m = evaluate.macro(evaluate.entity_scores(ids, pred, truth)).first()
    assert m.singleton_accuracy == 0.5 and m.micro_recall == 0.5


def test_truth_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", "S2-1, S3-2,,S2-1"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    tables.write_tsv(df, f"{tmp_path}/gt")
    assert '""' not in "".join(p.read_text() for p in (tmp_path / "gt").glob("part-*"))
    pairs, universe = tables.read_truth(spark, f"{tmp_path}/gt")
    assert sorted(map(tuple, pairs.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-2")] and universe.count() == 2
    (tmp_path / "src.tsv").write_text('entity_id\tbusiness_name\n1\t"a"\n')
    with pytest.raises(ValueError, match="lacks"):
        tables.read_source(spark, f"{tmp_path}/src.tsv")
    assert tables.empty_by_file(spark, f"{tmp_path}/*.tsv").first().n_rows == 1


def test_validator(spark, tmp_path):
    need = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "entity_id string")
    known = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    good, bad = tmp_path / "good.tsv", tmp_path / "bad.tsv"
    good.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\nS1-3\tS2-1\n")
    bad.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tS1-2\nbroken\nS1-9\tX1,S2-7\n")
    cands = tmp_path / "cands.tsv"
    cands.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\nS1-3\tS2-1\n")
    r = validate.validate(spark, str(good), str(cands), need, known)
    assert r.ok and any("no candidates" in w for w in r.warnings)
    said = " ".join(validate.validate(spark, str(bad), None, need, known).errors)
    assert all(x in said for x in ("duplicate_id", "duplicate_row", "malformed_row", "self_match", "wrong_prefix", "unknown_id", "missing_s1", "unexpected_s1"))
    (tmp_path / "head.tsv").write_text("a,b\n")
    assert "commas" in validate.validate(spark, f"{tmp_path}/head.tsv", None, need).errors[0]
    assert not validate.validate(spark, f"{tmp_path}/none.tsv", None, None).ok


def test_validator_bytes_and_repeated_headers(spark, tmp_path):
    need = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    head = "source1_entity_id\tmatched_entity_ids\n"
    (tmp_path / "bytes.tsv").write_bytes(head.encode() + b"S1-1\tS2-\xff\xfe\nS1-2\t\n")
    assert any("UTF-8" in e for e in validate.validate(spark, f"{tmp_path}/bytes.tsv", None, need).errors)
    (tmp_path / "first.tsv").write_bytes(b"\xff\xfe\n" + head.encode())
    assert any("UTF-8" in e for e in validate.validate(spark, f"{tmp_path}/first.tsv", None, need).errors)
    (tmp_path / "again.tsv").write_text(head + "S1-1\t\n" + head + "S1-2\tS2-1\n")
    r = validate.validate(spark, f"{tmp_path}/again.tsv", None, need)
    assert any("unexpected_s1: 1, as source1_entity_id" in e for e in r.errors) and r.info["n_rows"] == 3
    (tmp_path / "parts").mkdir()  # each part of a written table has its header
    (tmp_path / "parts/part-0.tsv").write_text(head + "S1-1\t\n")
    (tmp_path / "parts/part-1.tsv").write_text(head + "S1-2\tS2-1\n")
    r = validate.validate(spark, f"{tmp_path}/parts", None, need)
    assert r.ok and r.info["n_rows"] == 2


def test_ids_sample_and_report(spark, tmp_path):
    (tmp_path / "ids.tsv").write_text("entity_id\tx\nS1-1\ta\n S1-1 \tb\nS1-2\tc\n")
    assert sorted(r.entity_id for r in tables.read_ids(spark, f"{tmp_path}/ids.tsv").collect()) == ["S1-1", "S1-2"]
    (tmp_path / "ids.txt").write_text("S1-1\n\n  S1-2 \n")
    listed = tables.read_id_list(spark, f"{tmp_path}/ids.txt")
    assert sorted(r.entity_id for r in listed.collect()) == ["S1-1", "S1-2"]
    many = spark.range(50).select(F.concat(F.lit("S1-"), "id").alias("entity_id"))
    one, two = (sorted(matching.random_sample(df, 9).collect()) for df in (many, many.repartition(5)))
    assert one == two and len(set(one)) == 9
    tables.write_report([("Ids", listed.orderBy("entity_id"))], f"{tmp_path}/report", spark)
    assert "| S1-2 |" in "".join(p.read_text() for p in (tmp_path / "report").glob("part-*"))


def test_command_line(spark, tmp_path):
    from kinlink.__main__ import main

    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "s1.tsv").write_text(head + "S1-9\tAcme Tools Inc.\t12 Main St, Springfield 62701\tUS\nS1-2\tSolitary Lighthouse\t99 Far Rd\tUS\nS1-5\tBlue Harbor LLC\t4 Oak Ave, Dover 19901\tUS\n")
    (tmp_path / "s2.tsv").write_text(head + "S2-1\tACME TOOLS INCORPORATED\t12 Main Street, Springfield 62701\tUS\nS2-4\tBlue Harbor\t4 Oak Avenue, Dover 19901\tUS\n")
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-9\tS2-1\nS1-5\tS2-4\nS1-2\t\n")
    sources = ["--s1", f"{tmp_path}/s1.tsv", "--pool", f"{tmp_path}/s2.tsv"]
    assert main(["predict", *sources, "--out", f"{tmp_path}/out"]) == 0
    rows = [x for p in sorted((tmp_path / "out/matching_results.tsv").glob("part-*")) for x in p.read_text().splitlines()[1:]]
    assert rows == ["S1-9\tS2-1", "S1-2\t", "S1-5\tS2-4"]  # the order of the file, not of the ids
    assert main(["validate", f"{tmp_path}/out/matching_results.tsv", "--candidates", f"{tmp_path}/out/candidate_pairs.tsv", *sources]) == 0
    assert main(["validate", f"{tmp_path}/s1.tsv", *sources]) == 1
    assert main(["block", *sources, "--truth", f"{tmp_path}/gt.tsv", "--out", f"{tmp_path}/blocked"]) == 0
    assert "pair_recall" in "".join(p.read_text() for p in (tmp_path / "blocked/report").glob("part-*"))


def test_train_save_load(spark, small, tmp_path):
    s1, pool = small
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1"), ("S1-3", "S2-2")], "s1_id string, cand_id string")
    rows = matching.labelled(features.pair_features(linkage.block(s1, pool, CONFIG_A).pairs, s1, pool), truth)
    model = matching.train(rows, trees=2, depth=2)
    matching.save(model, str(tmp_path), 0.5, {"x": 1})
    again, cfg = matching.load(str(tmp_path))
    assert cfg["optimal_threshold"] == 0.5 and len(cfg["feature_cols"]) == 34 and json.dumps(cfg)
    assert all(0 <= r.p <= 1 for r in matching.score(rows, again).collect()) and len(matching.importance(model)) == 15


def test_streaming(spark, small, tmp_path):
    _, pool = small
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tAcme Tools\t12 Main St, Springfield 62701\tUS\nS1-8\tNobody\t\tUS\n")
    q = streaming.link(streaming.read_sources(spark, f"{tmp_path}/in"), pool, f"{tmp_path}/out", f"{tmp_path}/check", threshold=0.5)
    q.awaitTermination()
    got = {r.source1_entity_id: r.matched_entity_ids for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"S1-1": "S2-1", "S1-8": ""}


def test_capped_split(spark):
    df = spark.createDataFrame([(f"S1-{i}", "US" if i % 3 else "France") for i in range(90)], "entity_id string, country string")
    got = matching.stratified_split(df).groupBy("country").agg(F.sum("is_validation").alias("n")).collect()
    assert {r.country: r.n for r in got} == {"US": 12, "France": 6}


def test_catalog_has_sql():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and len(catalog.ORACLES) > 55


def test_pool_keeps_every_match(spark):
    _, pool, truth = catalog.entities.views(spark, "/root/testdata/sf0.01")
    want = {r.entity_id for r in pool.filter("country IN ('US', 'India')").join(truth, F.col("entity_id") == F.col("cand_id"), "left_semi").collect()}
    got = [r.entity_id for r in catalog.QUERIES["pool_with_distractors"](spark, "/root/testdata/sf0.01").collect()]
    assert want and want <= set(got) and len(got) == len(set(got))
