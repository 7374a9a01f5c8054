"""Whole runs in steps: state, integrity, resume, verification."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from rowkin.plans import cascade, stages
from rowkin.sources import sinks, tables
from rowkin.sources.shared import written

SMALL = cascade.Settings(rounds=3, screen_rounds=2, depth=3, least_rows=1)


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Both splits from the parties, as tables with tabs."""
    folder = tmp_path_factory.mktemp("dataset")
    made = tables.parties(spark, "/root/testdata/sf0.001").toPandas()
    truth = tables.party_truth(spark, "/root/testdata/sf0.001").toPandas()
    for split in ("train", "test"):
        (folder / split).mkdir()
        for i in (1, 2, 3):
            made[made.source == i].drop(columns="source").to_csv(folder / split / f"{split}_source{i}.tsv", sep="\t", index=False)
    truth.to_csv(folder / "train" / "train_ground_truth.tsv", sep="\t", index=False)
    return str(folder)


def test_steps_of_a_run(spark, data, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cascade, "LEAST_ROUNDS", 3)
    out = str(tmp_path / "out")
    call = lambda step, *more: stages.main(["--data", data, "--out", out, "--sample-rate", "1", "--step", step, *more], spark, SMALL)
    run = stages.Run(spark, data, out)
    with pytest.raises(ValueError, match="manifest is missing"):
        call("fit")
    assert call("prepare") == 0
    said = run.recorded("manifest")
    assert said["scanned"] == {"1": 150, "2": 150, "3": 10} and said["pairs"]["retrieved_positives"] + said["pairs"]["injected_positives"] <= 150
    assert said["pairs"]["rows"] == run.table("pairs").count() and said["anchors"]["rows"] == 150

    whole = written(run.table("pairs"), "whole")
    whole.unionByName(whole.limit(1)).write.mode("overwrite").parquet(run.path("pairs"))
    with pytest.raises(ValueError, match="incomplete"):
        call("fit")
    run.record("manifest", {**said, "pairs": {**said["pairs"], "rows": said["pairs"]["rows"] + 1}})
    with pytest.raises(ValueError, match="twice"):
        call("fit")
    run.record("manifest", {**said, "columns": said["columns"][1:]})
    with pytest.raises(ValueError, match="other columns"):
        call("fit")
    assert call("prepare") == 0 and call("fit") == 0
    assert 0 < run.recorded("metrics")["threshold"] < 1 and spark.read.option("sep", "\t").option("header", True).csv(run.path("audit_errors")).columns[0] == "anchor"

    with pytest.raises(ValueError, match="inference is missing"):
        call("assemble")
    assert call("predict") == 0
    counts = stages.predict(run, resume=True)
    assert set(counts) == set(run.recorded("inference")["countries"]) and "done before" in capsys.readouterr().out
    assert sum(c["scanned"] for c in counts.values()) == 160
    for c in counts.values():
        assert c["blocked"] >= c["gated"] >= c["screened"] == c["pairs"] >= c["matches"]
    with pytest.raises(ValueError, match="another model"):
        stages.predict(run, threshold=0.123, resume=True)

    assert call("assemble") == 0 and call("check") == 0
    report = run.recorded("verification")
    assert report["passed"] and report["references"] == 150 == report["matches"]["rows"] and report["candidates"]["ids"] == sum(c["pairs"] for c in counts.values())
    assert set(report["sha256"]) == {"matching_results.tsv", "candidate_pairs.tsv"} and "PASS" in capsys.readouterr().out
    lines = (tmp_path / "out" / "results" / "matching_results.tsv").read_text().split("\n")
    want = pathlib.Path(f"{data}/test/test_source1.tsv").read_text().splitlines()[1:]
    assert [x.split("\t")[0] for x in lines[1:151]] == [x.split("\t")[0] for x in want]

    got = stages.diagnose_errors(run)
    assert got["examples"] >= 0 and run.table("development_records").columns[0] == "entity_id"
    assert set(stages.assess(run)) == {"total", "recovered", "gate_rejected"}
    assert stages.profile(run, "test")["core"] > 0 and stages.benchmark(run, rows=50)["records_a_second"] > 0
    assert stages.pilot(run, rows=20)["scanned"] <= 40

    path = tmp_path / "out" / "results" / "matching_results.tsv"
    (path.parent / f".{path.name}.crc").unlink()  # the store's own sum would notice the changes below
    path.write_bytes(path.read_bytes().replace(lines[3].encode() + b"\r\n", b""))
    assert call("check") == 1 and any(p["rule"] == "missing_row" for p in run.recorded("verification")["problems"])
    path.write_bytes(b"source1_entity_id\tmatched_entity_ids\r\nS1-1\t\xff\xfe\r\n")
    assert call("check") == 1 and any(p["rule"] == "encoding" for p in run.recorded("verification")["problems"])
    path.unlink()
    assert call("check") == 1 and "could not read" in capsys.readouterr().out


def test_selftest(spark):
    assert stages.main(["--step", "selftest"], spark) == 0


def test_normalized_cache_follows_its_inputs(spark, tmp_path):
    file, cache = tmp_path / "in.tsv", str(tmp_path / "cache")
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"

    def names():
        raw = tables.read_tsv(spark, str(file)).withColumn("source", F.lit(1))
        return sorted((r["name"], r["country"]) for r in tables.normalized(raw, [str(file)], cache).collect())

    file.write_text(head + "S1-1\tAcme Ltd\tx\t\n")
    assert names() == [("acme limited", "")]
    first = sorted(p.name for p in (tmp_path / "cache").iterdir())
    assert names() == [("acme limited", "")] and sorted(p.name for p in (tmp_path / "cache").iterdir()) == first
    file.write_text(head + "S1-1\tOther Co\tx\tUS\n")
    assert names() == [("other company", "us")] and len(list((tmp_path / "cache").iterdir())) == 2


def test_publish_keeps_a_whole_file(spark, tmp_path):
    target = tmp_path / "result.tsv"

    def publish(text):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(str(tmp_path / "parts"))
        sinks.publish(spark, str(tmp_path / "parts"), str(target))

    publish("one")
    publish("two")
    assert target.read_text() == "two\n" and not (tmp_path / "result.tsv.older").exists() and not (tmp_path / "parts").exists()
    # A crash between the two renames leaves the older file aside; the next call has it back, then replaces it.
    target.rename(tmp_path / "result.tsv.older")
    publish("three")
    assert target.read_text() == "three\n" and not (tmp_path / "result.tsv.older").exists()


def test_digest_of_a_file(spark, tmp_path):
    import hashlib

    (tmp_path / "f").write_bytes(b"some bytes")
    assert sinks.file_digests(spark, str(tmp_path / "f")).first()["sha256"] == hashlib.sha256(b"some bytes").hexdigest()
    sinks.write_report(spark, {"a": [1, None]}, str(tmp_path / "r"))
    assert sinks.read_report(spark, str(tmp_path / "r")) == json.loads('{"a": [1, null]}')
