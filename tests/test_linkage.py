"""Normalization, blocking, features, metric, sinks and validators on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from rowkin.constants import ABBREVIATIONS, KEY_CAPS, MODEL_COLUMNS, REFERENCE_COLUMNS, SCREEN_COLUMNS, SOURCE_COLUMNS, THRESHOLDS
from rowkin.functions import normalize, similarity
from rowkin.operators import blocking, diagnose, evaluate, features, sampling, validate
from rowkin.plans import linkage, queries
from rowkin.sources import sinks, tables

RAW = "entity_id string, business_name string, business_address string, country string, source int"


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


@pytest.mark.parametrize(
    ("said", "want"),
    [("Café & Fils", "cafe and fils"), (None, ""), ("foo.company/x", "foo pany x"), ("https://www.acme.com/a?b Ltd", "acme limited"), ("007 Main Rd", "7 main road"), ("000", "0"), ("000000000012", "000000000012"), ("a_b", "a_b"), ("Straße", "strasse")],
)
def test_clean(spark, said, want):
    assert spark.createDataFrame([(said,)], "t string").select(normalize.clean(F.col("t"))).first()[0] == want


def test_compatibility_forms_fold(spark):
    row = spark.createDataFrame([("ﬁn Łódź ①",)], "t string").select(normalize.clean(F.col("t"), "all")).first()
    assert row[0] == "fin lodz 1"


def test_core_falls_back_to_the_name(spark):
    r = normalize.records(raw(spark, ("S1-a", "The Company Ltd", None, " India ", 1), ("S1-b", "Acme Pvt Ltd", "", "US", 1))).orderBy("entity_id").collect()
    assert [(x.core, x.country) for x in r] == [("the company limited", "india"), ("acme", "us")]


def test_equal_after_abbreviations(spark):
    made = normalize.records(raw(spark, ("S1-a", "Acme Pvt Ltd", "12 Main Road", "India", 1), ("S2-a", "ACME PRIVATE LIMITED", "12 Main Rd", "India", 2)))
    x, y = made.orderBy("entity_id").collect()
    assert x[1:4] == y[1:4]
    found = blocking.candidates(made.where("source = 1"), made.where("source = 2")).collect()
    assert [(r.anchor, r.candidate) for r in found] == [("S1-a", "S2-a")]


def test_keys_of_a_record(spark):
    made = normalize.records(raw(spark, ("S1-a", "Blue Harbor", "12 Main Street 7", "x", 1)))
    got = {(r.tag, r.key) for r in blocking.keys(made).collect()}
    for want in [("n", "blue harbor"), ("s", "blue harbor"), ("p", "blue h"), ("q", "harbor"), ("t", "blue"), ("w", "harbor"), ("j", "blue:harbor"), ("k", "blue:harb"), ("m", "blueharbor"), ("f", "blueharb"), ("h", "12 main street"), ("b", "street"), ("e", "main:street"), ("d", "12:main"), ("d", "7:street"), ("v", "12:7"), ("x", "blue:12"), ("x", "harb:7")]:
        assert want in got or want == ("w", "harbor"), want
    assert ("w", "harbor"[:4] + "or") in got and {t for t, _ in got} <= set(KEY_CAPS)


def test_empty_record_has_no_keys(spark):
    assert blocking.keys(normalize.records(raw(spark, ("S1-a", "", None, "x", 1)))).count() == 0


def test_cap_keeps_at_the_cap_and_drops_above(spark):
    cap = KEY_CAPS["b"]
    for n, kept in ((cap, True), (cap + 1, False)):
        made = normalize.records(raw(spark, *[(f"S1-{i}", f"n{i}", f"harbor {i}x", "x", 1) for i in range(n)]))
        found = blocking.usable_keys(blocking.keys(made, ["b"])).where("key = 'harbor'").count()
        assert bool(found) == kept


def test_countries_never_meet(spark):
    made = normalize.records(raw(spark, ("S1-a", "Acme", "", "a", 1), ("S2-a", "Acme", "", "b", 2)))
    assert blocking.candidates(made.where("source = 1"), made.where("source = 2")).isEmpty()


def test_features_and_gate_of_edge_cases(spark):
    rows = [("S1-a", "Acme Pvt Ltd", "12 Main Road", "India", 1), ("S1-e", "", "", "India", 1), ("S2-a", "ACME PRIVATE LIMITED", "12 Main Rd", "India", 2), ("S3-z", "", "", "India", 3), ("S2-n", "different", "12 Main Street", "India", 2), ("S2-m", "acme", "", "India", 2), ("S2-o", "", "12 main road", "India", 2)]
    found = linkage.split(raw(spark, *rows))
    pairs = found.references.select(F.col("entity_id").alias("anchor")).crossJoin(found.sources.select(F.col("entity_id").alias("candidate")))
    scored = features.scored_for_gate(blocking.paired(pairs, found.references, found.sources))
    passed = {(r.anchor, r.candidate) for r in scored.where(features.gate()).select("anchor", "candidate").collect()}
    assert ("S1-a", "S2-a") in passed and ("S1-a", "S2-n") in passed and ("S1-a", "S2-m") in passed and ("S1-a", "S3-z") not in passed
    assert ("S1-e", "S3-z") in passed  # two empty cores are alike to the gate
    made = {(r["anchor"], r["candidate"]): r for r in features.model_columns(scored).collect()}
    assert len(MODEL_COLUMNS) == len(set(MODEL_COLUMNS)) == 57 and len(SCREEN_COLUMNS) == 14
    same, none = made["S1-a", "S2-a"], made["S1-e", "S3-z"]
    assert same["name_ratio"] == same["address_exact"] == same["core_jw"] == 1 and same["source3"] == 0
    assert none["address_exact"] == 0 and none["address_missing"] == 1 and none["source3"] == 1 and none["name_ratio"] == 0
    screen = {(r["anchor"], r["candidate"]): r for r in scored.select("anchor", "candidate", *[c.alias(n) for n, c in features.screen_columns().items()]).collect()}
    for k, r in screen.items():
        assert all(r[c] == made[k][c] for c in SCREEN_COLUMNS)


def test_metric(spark):
    who = spark.createDataFrame([("a", "x", 2), ("b", "x", 0), ("c", "y", 1), ("d", "y", 0)], "anchor string, country string, true int")
    got = spark.createDataFrame([("a", "p", 1, 1, 0.9), ("a", "q", 0, 1, 0.2), ("c", "r", 0, 1, 0.1), ("d", "r", 0, 1, 0.7)], "anchor string, candidate string, label int, retrieved int, score double")
    f = {r.anchor: r.score for r in evaluate.entity_scores(who, got, 0.5).collect()}
    assert f == {"a": pytest.approx(1.25 / 1.5), "b": 1, "c": 0, "d": 0}
    for t in (0.1, 0.2, 0.5, 0.9, 0.95):
        want = evaluate.macro(evaluate.entity_scores(who, got, t)).first().macro_f05
        assert evaluate.sweep(who, got, [0.1, 0.2, 0.5, 0.9, 0.95]).where(F.col("threshold") == t).first().macro_f05 == pytest.approx(want)
    assert evaluate.best_threshold(spark.createDataFrame([(0.1, 0.5), (0.2, 0.7), (0.3, 0.7)], "threshold double, macro_f05 double")).first().threshold == 0.2
    assert evaluate.chosen_cutoff(spark.createDataFrame([(0.1, 0.7), (0.2, 0.69985), (0.3, 0.6)], "cutoff double, macro_f05 double")).first().cutoff == 0.2


def test_truth(spark):
    t = spark.createDataFrame([("S1-a", " S2-1, S2-1,,S3-2 "), ("S1-b", "")], tables.TRUTH_SCHEMA)
    assert {(r.anchor, r.candidate) for r in sampling.exploded_truth(t).collect()} == {("S1-a", "S2-1"), ("S1-a", "S3-2")}
    with pytest.raises(ValueError):
        sampling.checked_truth(t, spark.createDataFrame([("S1-c",)], "entity_id string"))


def test_wide_output_round_trip(spark, tmp_path):
    refs = spark.createDataFrame([("S1-2", 0), ("S1-1", 1)], "entity_id string, line long")
    links = spark.createDataFrame([("S1-1", "S3-9"), ("S1-1", "S2-9"), ("S1-1", "S2-9")], "anchor string, candidate string")
    sinks.write_wide(sinks.wide(refs, links, "matched_entity_ids"), f"{tmp_path}/out")
    sinks.publish(spark, f"{tmp_path}/out", f"{tmp_path}/m.tsv")
    assert (tmp_path / "m.tsv").read_bytes() == b"source1_entity_id\tmatched_entity_ids\r\nS1-2\t\r\nS1-1\tS2-9,S3-9\r\n"
    assert sinks.file_digests(spark, f"{tmp_path}/m.tsv").first().length == 61


def test_tsv_source(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A ""b"" co"\t\tUS\n')
    assert tuple(tables.read_tsv(spark, f"{tmp_path}/a.tsv").first()) == ("S1-1", 'A "b" co', "", "US")


def test_validator(spark):
    refs = spark.createDataFrame([(0, "S1-1"), (1, "S1-2")], "line long, entity_id string")
    targets = spark.createDataFrame([("S2-1",)], "entity_id string")
    good = spark.createDataFrame([(0, "S1-1", "S2-1"), (1, "S1-2", "")], "line long, anchor string, ids string")
    assert validate.validate(good, good, refs, targets, strict=True).isEmpty()
    bad = spark.createDataFrame([(0, "S1-2", "S2-1,S2-1"), (1, "S1-2", "S1-1,X-1"), (2, "S1-3", "S2-7")], "line long, anchor string, ids string")
    rules = {r.rule for r in validate.validate(bad, good, refs, targets, strict=True).collect()}
    assert rules == {"duplicate_row", "duplicate_id", "self_match", "wrong_prefix", "missing_row", "unknown_row", "unknown_target", "not_a_candidate", "order"}
    loose = validate.validate(good, good.withColumn("ids", F.lit("")), refs)
    assert validate.passed(loose) and [r.rule for r in loose.collect()] == ["not_a_candidate"]
    lines = spark.createDataFrame([(0, " Source1_entity_id\tMatched_entity_ids "), (1, ""), (2, "S1-1 no tab"), (3, "S1-2\tS2-1")], "line long, value string")
    header = ("source1_entity_id", "matched_entity_ids")
    rows, problems = validate.parse_lines(lines, header)
    assert rows.count() == 1 and [r.rule for r in problems.collect()] == ["malformed"]
    assert {r.rule for r in validate.parse_lines(lines, header, strict=True)[1].collect()} == {"header", "malformed"}


def test_diagnose(spark):
    pairs = "anchor string, candidate string"
    got = diagnose.assessed(spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3")], pairs), spark.createDataFrame([("a", "1"), ("a", "2")], pairs), spark.createDataFrame([("a", "1")], pairs)).first()
    assert tuple(got) == (3, 1, 1)


def test_stream_finds_what_the_batch_finds(spark, tmp_path):
    from rowkin.streaming import linkage as streaming

    rows = raw(spark, ("S1-a", "Acme Harbor", "12 Main Road", "x", 1), ("S1-b", "Blue Moon", "7 Elm", "x", 1), ("S2-a", "Acme Harbour", "12 Main Rd", "x", 2), ("S3-b", "Blue Moon Ltd", "", "x", 3))
    sources, refs = rows.where("source != 1"), normalize.records(rows.where("source = 1"))
    sources.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = streaming.read_stream(spark, f"{tmp_path}/in", sources.schema, 1)
    streaming.link_stream(stream, refs, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination(120)
    got = {(r.anchor, r.candidate) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("S1-a", "S2-a"), ("S1-b", "S3-b")}


def test_bundle_round_trip(spark, tmp_path):
    from rowkin.plans import cascade

    d = "/root/testdata/sf0.001"
    rows = tables.parties(spark, d)
    pairs, who = linkage.prepare(rows, tables.party_truth(spark, d))
    pairs = pairs.persist()
    bundle, report = cascade.train(pairs, who, cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=5))
    bundle.save(f"{tmp_path}/m")
    again = cascade.Bundle.load(spark, f"{tmp_path}/m")
    assert again.threshold == bundle.threshold and again.country_thresholds == bundle.country_thresholds
    linked = linkage.link(rows, again).persist()
    found = linked.where("matched")
    assert found.where("substr(anchor, 4) = substr(candidate, 4) AND candidate LIKE 'S2%'").count() >= 0.7 * found.count()
    matches, candidates = linkage.assemble(rows.where("source = 1"), linked)
    assert linkage.verify(matches, candidates, sinks.numbered(rows.where("source = 1")), rows.where("source != 1")).isEmpty()
    assert 0 <= report["retention"]["kept"] <= 1


def test_cascade_query_trains_the_default_models(spark, monkeypatch):
    from rowkin.plans import cascade, queries

    class Seen(Exception):
        pass

    def train(pairs, who, settings=None):
        raise Seen(settings or cascade.Settings())

    monkeypatch.setattr(cascade, "train", train)
    with pytest.raises(Seen) as seen:
        queries.cascade_predict(spark, "/root/testdata/sf0.001")
    assert seen.value.args[0] == cascade.Settings()
    assert [cascade.production_rounds(n) for n in (3, 50, 60)] == [50, 50, 60]


@pytest.mark.parametrize(
    "said, want",
    [
        ("दिल्ली प्राइवेट", "dillii praaivett"),
        ("Москва, ул. Щорса", "moskva ul shchorsa"),
        ("Αθήνα Ψυχή", "athena psukhe"),
        ("محمد", "mhmd"),
        ("שלום", "shlvm"),
        ("서울 한국", "seoul hangug"),
        ("ひらがな カタカナ", "hiragana katakana"),
        ("தமிழ்", "tmilll"),
        ("中文公司 Ltd", "u4e2d u6587 u516c u53f8 limited"),
        ("ﬁne ½ ① ｆｕｌｌ １２ 😀", "fine 12 1 full 12"),
    ],
)
def test_scripts_are_romanized(spark, said, want):
    assert spark.createDataFrame([(said,)], "t string").select(normalize.clean(F.col("t")).alias("c")).first().c == want


def test_texts_with_nothing_to_spell_out_come_out_alike(spark):
    """The short way for whole texts says what the way word by word says."""
    r = random.Random(3)
    parts = ["co", "cocoa", "rd", "x", "0", "00", "007", "0x", "70", "123456789012", "012345678901", "ltd", "a_b", "é"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(0, 6))) for _ in range(300)]

    def plain(t):
        words = [w.replace("é", "e") for w in t.split()]
        return " ".join(ABBREVIATIONS.get(w, str(int(w)) if w.isdigit() and len(w) < 12 else w) for w in words)

    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", normalize.clean(F.col("t")).alias("c")).collect()
    assert {x.i: x.c for x in got} == {i: plain(t) for i, t in enumerate(texts)}


def test_thresholds_reached(spark):
    grid = sorted(THRESHOLDS)
    scores = [t + d for t in (0.0, *grid, 1.0) for d in (-1e-12, 0.0, 1e-12, 0.004, 0.006)] + [i / 1000 for i in range(1001)]
    for given in (grid, [0.3, 0.5], grid[:7] + [0.995]):
        got = spark.createDataFrame([(x,) for x in scores], "s double").select("s", evaluate.reached(F.col("s"), given).alias("n")).collect()
        assert all(x.n == sum(t <= x.s for t in given) for x in got)


def test_places_over_blocks_of_lines(spark, monkeypatch):
    monkeypatch.setattr(validate, "LINES", 7)
    lines = [3, 5, 6, 7, 20, 21, 22, 700, 701, 1 << 33, (1 << 33) + 1]
    rows = spark.createDataFrame([(n, f"a{i}") for i, n in enumerate(lines)], "line long, anchor string").repartition(3)
    assert {x["_a"]: x["_n"] for x in validate.places(rows, "anchor").collect()} == {f"a{i}": i + 1 for i in range(len(lines))}


def test_country_thresholds_are_adopted_for_a_gain_only(spark):
    """One country needs a low threshold, one a high one; by a least gain over what both gain, the common one stays."""
    anchors = spark.createDataFrame([(f"{c}{i}", c, 1) for c in "ab" for i in range(20)], "anchor string, country string, true int")
    rows = [(f"a{i}", f"t{i}", 1, 1, 0.3, "a") for i in range(20)] + [(f"b{i}", f"t{i}", 1, 1, 0.9, "b") for i in range(20)] + [(f"b{i}", f"w{i}", 0, 1, 0.4, "b") for i in range(20)]
    scored = spark.createDataFrame(rows, "anchor string, candidate string, label int, retrieved int, score double, country string")
    overall, each = evaluate.country_thresholds(anchors, scored)
    assert each == {"a": 0.01, "b": 0.41} and overall in (0.01, 0.41)
    gain = evaluate.best_threshold(evaluate.sweep(anchors, scored)).first()["macro_f05"]
    assert evaluate.country_thresholds(anchors, scored, least_gain=1 - gain + 1e-9)[1] == {}


def test_cascade_decides_by_threshold_override_and_cutoff(spark):
    from rowkin.plans import cascade

    raw_rows = tables.parties(spark, "/root/testdata/sf0.001")
    pairs, who = linkage.prepare(raw_rows, tables.party_truth(spark, "/root/testdata/sf0.001"))
    pairs = pairs.persist()
    bundle, report = cascade.train(pairs, who, cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=1))
    assert report["rounds"] <= 3 and bundle.main.stages[-1].getNumTrees == cascade.production_rounds(report["rounds"])
    shares = [x for _, x in report["importance"]]
    assert shares == sorted(shares, reverse=True) and sum(shares) == pytest.approx(1) and {n for n, _ in report["importance"]} == set(MODEL_COLUMNS)
    found = linkage.split(raw_rows)
    both = blocking.paired(blocking.candidates(found.references, found.sources), found.references, found.sources)
    # The labels of audit entities are learned from by neither tier.
    part = sampling.part_of(F.col("group"))
    turned = pairs.withColumn("label", F.when(part == "audit", 1 - F.col("label")).otherwise(F.col("label")))
    again, _ = cascade.train(turned, who, cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=1))
    scores = [{(r.anchor, r.candidate): round(r.score, 9) for r in cascade.predict(both, b).collect()} for b in (bundle, again)]
    assert scores[0] == scores[1] and (again.threshold, again.cutoff) == (bundle.threshold, bundle.cutoff)
    assert cascade.predict(both, bundle, 0.0).where("NOT matched").isEmpty() and cascade.predict(both, bundle, 1.1).where("matched").isEmpty()
    bundle.cutoff = 1.1
    assert cascade.predict(both, bundle).isEmpty()
    pairs.unpersist()


def test_fields_of_any_length(spark, tmp_path):
    long = "x" * 300_000
    (tmp_path / "t.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t{long}\t\"a \"\"quoted\"\" one\"\tUS\n")
    row = tables.read_tsv(spark, str(tmp_path / "t.tsv")).first()
    assert row["business_name"] == long and row["business_address"] == 'a "quoted" one'


def test_links_by_country(spark, tmp_path):
    made = spark.createDataFrame([("S1-1", "S2-1", 0.5, "us"), ("S1-2", "S3-1", 0.75, "fr")], "anchor string, candidate string, score double, country string")
    sinks.write_links(made, str(tmp_path / "l"))
    back = spark.read.option("sep", "\t").csv(str(tmp_path / "l"))
    assert sorted(tuple(r) for r in back.collect()) == [("S1-1", "S2-1", "0.5", "us"), ("S1-2", "S3-1", "0.75", "fr")]


def copies(spark):
    """References and sources with copies, more than a row of a class holds, and keys at their caps and above."""
    rows = [(f"S1-{i}", f"Acme {i % 3} Ltd", f"{i % 2} Main Road", "x", 1) for i in range(KEY_CAPS["n"] * 3 + 2)]
    rows += [(f"S2-{i}", ("ACME 2", "Acme 0 Limited", "Bolt 7")[i % 3], "1 Main Road", "x" if i % 5 else "y", 2) for i in range(30)]
    return normalize.records(raw(spark, *rows, *[(f"S3-{i}", "Zeta", "9 Side Street", "x", 3) for i in range(blocking.MEMBERS * 3)], ("S1-z", "Zeta Ltd", "9 Side Street", "x", 1)))


def test_classes_of_like_records_bring_the_pairs_of_records(spark):
    made = copies(spark)
    found = linkage.Records(made.where("source = 1"), made.where("source != 1"))
    one = linkage.alike(found)
    assert one.references.count() < found.references.count() / 50 and one.sources.agg(F.max("alike")).first()[0] < 2 * blocking.MEMBERS
    assert {c.entity_id for c in found.sources.collect()} == {i for c in one.sources.collect() for i in c.members}
    pairs = blocking.paired(blocking.candidates(one.references, one.sources), one.references, one.sources)
    got = sorted(map(tuple, blocking.expanded(pairs.selectExpr("x.members AS _x", "y.members AS _y")).collect()))
    assert got and got == sorted(map(tuple, blocking.candidates(found.references, found.sources).collect()))


def test_pairs_that_were_made_distinct_are_dealt_to_all_tasks(spark):
    pairs = spark.range(2000).selectExpr("id % 40 AS anchor", "id AS candidate").distinct()
    assert features.spread(pairs).select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("names", [["worst_token", "mean_token"], ["replaced", "inserted", "deleted"], ["name_partial", "core_jw"]])
def test_scores_asked_for_are_those_of_all(spark, names):
    x = "named_struct('name', concat('ab ', id % 3), 'core', concat('b ', id), 'address', 'c')"
    pairs = spark.range(30).selectExpr(f"{x} AS x", f"{x.replace('id', '(7 - id)')} AS y")
    both = pairs.select(similarity.full_scores().alias("all"), similarity.full_scores(names).alias("some"))
    assert both.select("some.*").columns == names and both.where(" OR ".join(f"all.{n} != some.{n}" for n in names)).count() == 0


@pytest.mark.parametrize("name", ["best_token_pairs", "feature_vector", "edit_ops_pairs", "feature_columns", "partial_ratio_pairs", "screen_features"])
def test_pair_queries_score_classes_once(spark, tmp_path, monkeypatch, name):
    for table in ("region", "nation", "customer", "supplier"):
        whole = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        if table in ("customer", "supplier"):
            key = whole.columns[0]
            whole = whole.where(f"{key} < 20").crossJoin(spark.range(3)).withColumn(key, F.col(key) + 1000 * F.col("id")).drop("id")
        whole.write.parquet(f"{tmp_path}/{table}.parquet")
    seen = []
    real = features.spread
    monkeypatch.setattr(features, "spread", lambda pairs: seen.append(real(pairs)) or seen[-1])
    made = queries.QUERIES[name](spark, str(tmp_path))
    want = queries.gate_pairs(spark, str(tmp_path)) if name.startswith(("screen", "feature")) else queries.pairs(spark, str(tmp_path)).select("anchor", "candidate")
    assert sorted(map(tuple, made.select("anchor", "candidate").collect())) == sorted(map(tuple, want.collect()))
    assert seen[0].count() < made.count() / 3


def test_cascade_scores_like_records_once(spark, tmp_path, monkeypatch):
    """Training pairs and links of tables with copies are those of a run over pairs of records, of which few are scored."""
    from rowkin.plans import cascade

    for table in ("region", "nation", "customer", "supplier"):
        whole = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        if table in ("customer", "supplier"):
            key = whole.columns[0]
            whole = whole.where(f"{key} < 40").crossJoin(spark.range(4)).withColumn(key, F.col(key) + 1000 * F.col("id")).drop("id")
        whole.write.parquet(f"{tmp_path}/{table}.parquet")
    found, seen = linkage.split(tables.parties(spark, str(tmp_path))), []
    one = features.model_columns(linkage.gated_pairs(found)).drop("x", "y", "s")
    both = blocking.paired(blocking.candidates(found.references, found.sources), found.references, found.sources)
    real = features.spread
    monkeypatch.setattr(features, "spread", lambda pairs: seen.append(real(pairs)) or seen[-1])
    made, who = linkage.prepared(found, tables.party_truth(spark, str(tmp_path)))
    made = made.persist()
    assert sorted(map(tuple, made.where("retrieved = 1").select(one.columns).collect())) == sorted(map(tuple, one.collect()))
    monkeypatch.setattr(cascade, "LEAST_ROUNDS", 2)
    bundle, _ = cascade.train(made, who, cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=5))
    before = len(seen)
    linked = linkage.linked(found, bundle)
    assert max(s.count() for s in (seen[0], *seen[before:])) < both.count() / 3
    assert sorted(map(tuple, rounded(linked))) == sorted(map(tuple, rounded(cascade.predict(both, bundle)))) and not linked.isEmpty()


def rounded(linked):
    return linked.select("anchor", "candidate", "country", F.round("score", 9), "matched").collect()


def test_trees_learn_from_counted_rows(spark, tmp_path):
    """The least rows of a leaf are counted by weight; neither order nor place of rows matters; a longer training begins like a shorter one."""
    from rowkin.plans import cascade

    few = cascade.Settings(depth=2, least_rows=30, row_share=1.0)
    for copies, splits in ((30, True), (29, False)):
        rows = cascade.counted(spark.range(2 * copies).selectExpr("cast(id % 2 AS double) AS u", "id % 2 AS label"), ["u"])
        assert rows.count() == 2 and {r._n for r in rows.collect()} == {copies}
        assert (cascade.fitted(rows, ["u"], 1, few).stages[-1].trees[0].depth > 0) is splits
    table = spark.range(3000).selectExpr("cast(id % 300 AS double) AS u", "cast(id % 7 AS double) AS v", "cast(id % 300 > 150 OR id % 7 = 3 OR id % 31 = 0 AS int) AS label")
    rows, some = cascade.counted(table, ["u", "v"]).persist(), cascade.Settings(depth=3, least_rows=5)
    one, turned, short = (cascade.fitted(r, ["u", "v"], n, some) for r, n in ((rows, 6), (rows.repartition(7).orderBy(F.desc("v")), 6), (rows, 4)))
    scores = lambda model: sorted((r.u, r.v, round(r.p, 9)) for r in cascade.probability(model, rows, "p").collect())
    cut = cascade.first_rounds(one, 4)
    assert scores(one) == scores(turned) and scores(one) != scores(short) == scores(cut)
    cut.save(f"{tmp_path}/cut")
    assert scores(cascade.PipelineModel.load(f"{tmp_path}/cut")) == scores(short)
    assert cut.stages[-1].getNumTrees == 4 and cut.stages[-1].numFeatures == 2 and len(cut.stages[-1].featureImportances) == 2
    rows.unpersist()


def test_feature_columns_compute_no_other_scores(spark, monkeypatch):
    """What SQL cannot say is not scored for it, and the columns are those of the vector."""
    asked, real = [], features.full_scores
    monkeypatch.setattr(features, "full_scores", lambda names: asked.append(names) or real(names))
    d = "/root/testdata/sf0.001"
    some, whole = queries.feature_columns(spark, d), queries.feature_vector(spark, d)
    assert asked[0] == ["name_sort", "name_set", "name_jw", "core_jw", "address_jw", "compact_ratio"] and asked[1] == similarity.FULL_SCORES
    assert some.columns == [c for c in whole.columns if c not in queries._NOT_IN_SQL]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(some.columns).collect()))


def test_frequencies_of_classes_are_those_of_records(spark):
    made = copies(spark)
    classes, by_record = linkage.alike_of(made), linkage.with_frequencies(made)
    for one, each, columns in ((classes.references, by_record.references, REFERENCE_COLUMNS), (classes.sources, by_record.sources, SOURCE_COLUMNS)):
        got = one.select(F.explode("members").alias("entity_id"), *columns).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, each.select("entity_id", *columns).collect()))


def test_records_of_one_file_are_normalized_by_all_tasks(spark, tmp_path):
    rows = spark.range(60_000).coalesce(1).selectExpr("concat('S1-', id) AS entity_id", "sha2(cast(id AS string), 256) AS business_name", "sha2(cast(-id AS string), 512) AS business_address", "'x' AS country", "1 AS source")
    rows.write.parquet(f"{tmp_path}/in")
    made = tables.normalized(spark.read.parquet(f"{tmp_path}/in"), [f"{tmp_path}/in"], f"{tmp_path}/cache")
    assert made.count() == 60_000 and made.select(F.input_file_name().alias("f")).distinct().count() == 4


def with_copies(spark, folder, customers=40, copies=4):
    """A folder of tables whose few customers and suppliers are repeated with shifted keys."""
    for table in ("region", "nation", "customer", "supplier"):
        whole = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        if table in ("customer", "supplier"):
            key = whole.columns[0]
            whole = whole.where(f"{key} < {customers}").crossJoin(spark.range(copies)).withColumn(key, F.col(key) + 1000 * F.col("id")).drop("id")
        whole.write.parquet(f"{folder}/{table}.parquet")
    return folder


def test_cascade_learns_from_pairs_of_classes(spark, tmp_path):
    """Pairs of classes, with the number of pairs of records, bring the models, thresholds and report of the pairs of records."""
    from rowkin.plans import cascade

    d = with_copies(spark, str(tmp_path / "in"))
    rows, truth = tables.parties(spark, d), tables.party_truth(spark, d)
    one, found = linkage.alike_of_raw(rows), linkage.split(rows)
    by_class, by_record = linkage.prepared_classes(one, truth), linkage.prepared(found, truth)
    pairs = [by_class[0].persist(), by_record[0].persist()]
    both = [sorted(map(tuple, cascade.counted(p, MODEL_COLUMNS, "retrieved", "group").collect())) for p in pairs]
    assert both[0] == both[1] and both[0] and pairs[0].count() < pairs[1].count() / 3
    anchors = [sorted(map(tuple, a.select("anchor", "country", "group", "true").collect())) for a in (by_class[1], by_record[1])]
    assert anchors[0] == anchors[1]
    some = cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=5)
    (a, said), (b, want) = (cascade.train(p, who, some) for p, (_, who) in zip(pairs, (by_class, by_record)))
    assert (a.threshold, a.country_thresholds, a.cutoff) == (b.threshold, b.country_thresholds, b.cutoff)
    flat = lambda x: [y for z in x for y in flat(z)] if isinstance(x, (list, tuple)) else flat(sorted(x.items())) if isinstance(x, dict) else [x]
    for report in (said, want):
        report["audit"].sort(key=lambda r: r["country"] or "")
    got, expected = flat(said), flat(want)
    assert len(got) == len(expected) and all(u == pytest.approx(v) if isinstance(u, float) else u == v for u, v in zip(got, expected))
    assert sorted(map(tuple, rounded(linkage.linked_classes(one, a)))) == sorted(map(tuple, rounded(linkage.linked(found, b))))
    for p in pairs:
        p.unpersist()


def test_cascade_query_makes_no_pairs_of_records_to_train(spark, tmp_path, monkeypatch):
    from rowkin.plans import cascade

    class Seen(Exception):
        pass

    def train(pairs, who, settings=None):
        raise Seen(pairs.count(), pairs.agg(F.sum("_n")).first()[0])

    monkeypatch.setattr(cascade, "train", train)
    with pytest.raises(Seen) as seen:
        queries.cascade_predict(spark, with_copies(spark, str(tmp_path / "in"), 20))
    rows, pairs = seen.value.args
    assert rows < pairs / 4


def test_gate_computes_its_scores_once(spark):
    """The filter on the scores stays behind the dealing out to all tasks: moved before it, it would need them too."""
    x = "named_struct('name', concat('ab ', id), 'core', concat('b ', id), 'address', 'c')"
    pairs = spark.range(30).selectExpr("id AS anchor", "-id AS candidate", f"{x} AS x", f"{x.replace('id', '(7 - id)')} AS y").distinct()
    gated = features.scored_for_gate(pairs).where(features.gate()).select("anchor", "s.core_ratio", "s.address_set")
    assert gated._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_raw_records_that_are_alike_are_normalized_once(spark, monkeypatch):
    rows = raw(spark, *[(f"S1-{i}", ("Acme Ltd", "ACME limited")[i % 2], "1 Main Rd", "x", 1) for i in range(40)], *[(f"S2-{i}", None, "", "x", 2) for i in range(blocking.MEMBERS + 40)])
    seen, real = [], linkage.records
    monkeypatch.setattr(linkage, "records", lambda given: seen.append(given.count()) or real(given))
    one, want = linkage.alike_of_raw(rows), linkage.alike_of(normalize.records(rows))
    assert len(seen) == 1 and seen[0] <= 2 + 2
    assert [sorted(r.members) for r in one.references.collect()] == [sorted(r.members) for r in want.references.collect()] == [sorted(f"S1-{i}" for i in range(40))]
    listed = lambda t: sorted((i, *r) for r in t.select("name", "address", "country", "core", "source", *SOURCE_COLUMNS, "members").collect() for i in r.members for r in [tuple(r)[:-1]])
    assert listed(one.sources) == listed(want.sources) and one.sources.agg(F.sum("alike")).first()[0] == blocking.MEMBERS + 40


def test_customers_of_one_file_are_read_by_all_tasks(spark):
    """Their table has few bytes for its rows; nations are sent to them, not they to the nations."""
    plan = tables.parties(spark, "/root/testdata/sf0.001").where("source = 1")
    assert plan.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
