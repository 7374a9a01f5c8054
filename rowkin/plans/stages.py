"""Whole runs in steps with stored state, each of which checks what the step before it left.

    python -m rowkin.plans.stages --data dataset --out output --step all

``data`` holds {split}/{split}_source{1,2,3}.tsv and train/train_ground_truth.tsv; ``out`` everything a run makes. Both can be
in any store that Spark reads. A step's record (a JSON report) is written last, so a step that ended early is not taken for done.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import resource
import sys
import time
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_COLUMNS, SCREEN_COLUMNS
from ..operators import blocking, diagnose, evaluate, features, sampling, validate
from ..sources import sinks, tables
from ..sources.shared import dropped, file_system, signature, written
from . import cascade, linkage

VERSION = 1
RATE = 0.008
OUTPUTS = {"matches": ("matching_results.tsv", "matched_entity_ids"), "candidates": ("candidate_pairs.tsv", "candidate_entity_ids")}
STEPS = ("prepare", "fit", "predict", "assemble", "check")


@dataclass
class Run:
    """Where a run reads and writes."""

    spark: SparkSession
    data: str
    out: str
    began: float = field(default_factory=time.monotonic)

    def log(self, text: str) -> None:
        print(f"[{(time.monotonic() - self.began) / 60:7.2f} min] {text}", flush=True)

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def has(self, name: str) -> bool:
        place, system = file_system(self.spark, f"{self.path(name)}/_SUCCESS")
        return system.exists(place)

    def record(self, name: str, said: dict) -> dict:
        sinks.write_report(self.spark, said, self.path(name))
        return said

    def recorded(self, name: str) -> dict:
        if not self.has(name):
            raise ValueError(f"{name} is missing: an earlier step did not end")
        return sinks.read_report(self.spark, self.path(name))

    def inputs(self, split: str) -> list[str]:
        return [tables.source_path(self.data, split, i) for i in (1, 2, 3)]

    def normalized(self, split: str) -> DataFrame:
        return tables.normalized(tables.read_sources(self.spark, self.data, split), self.inputs(split), self.path("cache"))

    def saved(self, rows: DataFrame, name: str, **counts) -> dict[str, int]:
        """Writes ``rows`` and returns what ``counts`` (aggregates by name) say of them."""
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite").parquet(self.path(name))
        return {k: int(v or 0) for k, v in seen.get.items()}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def prepare(run: Run, rate: float = RATE) -> dict:
    """Training pairs with all columns, their anchors, and a manifest of both."""
    dropped(run.spark, run.path("manifest"))
    made = run.normalized("train")
    scanned = {str(r["source"]): r["n"] for r in made.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    run.log(f"normalized records by source: {scanned}")
    found = linkage.with_frequencies(made)
    found = linkage.Records(written(found.references, "references"), written(found.sources, "sources"))
    pairs, anchors = linkage.prepared(found, tables.read_truth(run.spark, f"{run.data}/train/train_ground_truth.tsv"), rate)
    who = run.saved(anchors, "anchors", true=F.sum("true"))
    got = run.saved(pairs, "pairs", retrieved_positives=F.sum(F.col("label") * F.col("retrieved")), injected_positives=F.sum(F.col("label") * (1 - F.col("retrieved"))))
    run.log(f"pairs: {got}")
    return run.record("manifest", {"version": VERSION, "columns": MODEL_COLUMNS, "rate": rate, "scanned": scanned, "anchors": who, "pairs": got, "inputs": signature(run.spark, run.inputs("train"))})


def checked_pairs(run: Run) -> tuple[DataFrame, DataFrame]:
    """(pairs, anchors) of ``prepare``; an error if they are not what its manifest says, or if a pair stands twice."""
    said = run.recorded("manifest")
    if said["version"] != VERSION or said["columns"] != MODEL_COLUMNS:
        raise ValueError("the prepared pairs have other columns; prepare again")
    pairs, anchors = run.table("pairs"), run.table("anchors")
    missing = [c for c in MODEL_COLUMNS if c not in pairs.columns]
    if missing or pairs.count() != said["pairs"]["rows"] or anchors.count() != said["anchors"]["rows"]:
        raise ValueError("the prepared pairs are incomplete; prepare again")
    if not sampling.repeated_pairs(pairs).isEmpty():
        raise ValueError("a prepared pair stands twice; sets of pairs could not be scored")
    return pairs, anchors


def fit(run: Run, settings: cascade.Settings | None = None) -> dict:
    """The model, its metrics, and the audit entities that it gets wrong."""
    pairs, anchors = checked_pairs(run)
    bundle, report = cascade.train(pairs, anchors, settings)
    bundle.save(run.path("model"))
    wrong = audit_errors(run, bundle, pairs, anchors)
    wrong.select("anchor", "country", "name", "address", "score", "truth", "predicted").coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(run.path("audit_errors"))
    run.record("metrics", report)
    run.log(f"threshold {bundle.threshold}, cutoff {bundle.cutoff}")
    return report


def decided(bundle: cascade.Bundle, pairs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Retrieved ``pairs`` over the screening cutoff with country and score, and whether they are predicted."""
    both = cascade.probability(bundle.main, cascade.probability(bundle.screen, pairs, "screen"), "score")
    kept = both.where((F.col("retrieved") == 1) & (F.col("screen") >= bundle.cutoff)).select("anchor", "candidate", "label", "retrieved", "score")
    return kept.join(anchors.select("anchor", "country"), "anchor").withColumn("said", F.col("score") >= bundle.decision(F.col("country")))


def audit_errors(run: Run, bundle: cascade.Bundle, pairs: DataFrame, anchors: DataFrame) -> DataFrame:
    audit = anchors.where(sampling.part_of(F.col("group")) == "audit").select("anchor", "country", "true")
    scored = written(decided(bundle, pairs.where(sampling.part_of(F.col("group")) == "audit"), audit), "audit")
    scores = evaluate.entity_scores(audit, scored.drop("country").withColumn("score", F.col("said").cast("double")), 0.5)
    truth = sampling.exploded_truth(tables.read_truth(run.spark, f"{run.data}/train/train_ground_truth.tsv"))
    return diagnose.audit_errors(scores, truth, scored.where("said"), run.normalized("train").where("source = 1"))


def predict(run: Run, model: str | None = None, threshold: float | None = None, resume: bool = False) -> dict:
    """Candidates and links of the test split, a country at a time; with ``resume`` countries that are done stay as they are.

    What another model, threshold or input made is never mixed with this run's: the manifest names them.
    """
    bundle = cascade.Bundle.load(run.spark, model or run.path("model"))
    made = run.normalized("test")
    countries = {r["country"]: r["n"] for r in made.where("source = 1").groupBy("country").agg(F.count(F.lit(1)).alias("n")).orderBy("country").collect()}
    trees = [signature(run.spark, [model or run.path("model")]), signature(run.spark, run.inputs("test"))]
    said = hashlib.sha256(json.dumps([VERSION, threshold, trees]).encode()).hexdigest()
    if run.has("inference"):
        if run.recorded("inference")["signature"] != said:
            if resume:
                raise ValueError("the stored predictions belong to another model, threshold or input")
            dropped(run.spark, run.path("predicted"))
    run.record("inference", {"signature": said, "countries": countries})
    out = {}
    for number, country in enumerate(countries):
        name = f"predicted/{number}"
        if resume and run.has(f"{name}/done"):
            run.log(f"{country}: done before")
            out[country] = run.recorded(f"{name}/done")
            continue
        dropped(run.spark, run.path(f"{name}/done"))
        out[country] = run.record(f"{name}/done", predict_country(run, made.where(F.col("country") == country), bundle, threshold, name))
        run.log(f"{country}: {out[country]}")
    return out


def predict_country(run: Run, made: DataFrame, bundle: cascade.Bundle, threshold: float | None, name: str) -> dict:
    """Writes the scored candidates of normalized records; returns the counts on the way."""
    found = linkage.with_frequencies(made)
    sources = Observation()
    found = linkage.Records(written(found.references, "references"), written(found.sources.observe(sources, F.count(F.lit(1)).alias("n")), "sources"))
    counters = {k: Observation() for k in ("blocked", "gated", "screened")}
    pairs = blocking.paired(blocking.candidates(found.references, found.sources), found.references, found.sources)
    got = run.saved(cascade.predict(pairs, bundle, threshold, counters), f"{name}/pairs", matches=F.count_if("matched"))
    return {"scanned": int(sources.get["n"]), **{k: int(v.get["n"]) for k, v in counters.items()}, "pairs": got["rows"], "matches": got["matches"]}


def all_pairs(run: Run) -> DataFrame:
    """The scored candidates of all countries; an error if one is not done."""
    countries = run.recorded("inference")["countries"]
    missing = [c for i, c in enumerate(countries) if not run.has(f"predicted/{i}/done")]
    if missing:
        raise ValueError(f"prediction is incomplete: {missing}")
    return run.spark.read.parquet(*[run.path(f"predicted/{i}/pairs") for i in range(len(countries))])


def assemble(run: Run) -> dict[str, str]:
    """Both wide tables, a row a reference in the order of the test file, published as single files."""
    linked = all_pairs(run)
    lines = sinks.numbered(tables.read_tsv(run.spark, run.inputs("test")[0])).select("entity_id", "line")
    sinks.write_links(linked.where("matched").select("anchor", "candidate", "score", "country"), run.path("links"))
    out = {}
    for (name, column), rows in zip(OUTPUTS.values(), (linked.where("matched"), linked)):
        sinks.write_wide(sinks.wide(lines, rows, column), run.path(f"{name}.parts"))
        out[column] = run.path(f"results/{name}")
        place, system = file_system(run.spark, run.path("results"))
        system.mkdirs(place)
        sinks.publish(run.spark, run.path(f"{name}.parts"), out[column])
    return out


def read_output(run: Run, path: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of a published table; bytes that are not UTF-8 are a problem."""
    lines = run.spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    rows, problems = validate.parse_lines(lines.select("line", "value"), ("source1_entity_id", column), strict=True)
    broken = lines.where(~F.is_valid_utf8("value")).select(F.lit("encoding").alias("rule"), F.lit("error").alias("severity"), F.col("line").cast("string").alias("offender"))
    return rows, problems.unionByName(broken)


def check(run: Run) -> int:
    """0 if the published tables meet every rule of the strict check, else 1; the report (counts, digests, problems) is stored."""
    began = time.monotonic()
    try:
        read = {name: read_output(run, run.path(f"results/{file}"), column) for name, (file, column) in OUTPUTS.items()}
        sources = tables.read_sources(run.spark, run.data, "test")
        references = sinks.numbered(tables.read_tsv(run.spark, run.inputs("test")[0])).select("entity_id", "line")
        (matches, one), (candidates, two) = ((written(r, "read"), p) for r, p in read.values())
        found = validate.validate(matches, candidates, references, sources.where("source != 1"), strict=True)
        for name, problems in (("matches", one), ("candidates", two)):
            found = found.unionByName(problems.withColumn("table", F.lit(name)).select("table", "rule", "severity", "offender"))
        problems = [r.asDict() for r in validate.summary(found).orderBy("table", "rule").collect()]
        size = F.size(validate.id_list(F.col("ids")))
        count = lambda t: t.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("ids"), F.count_if(size == 0).alias("empty")).first().asDict()
        counts = {"matches": count(matches), "candidates": count(candidates), "references": references.count()}
        digests = {r["path"].rsplit("/", 1)[1]: r["sha256"] for f, _ in OUTPUTS.values() for r in sinks.file_digests(run.spark, run.path(f"results/{f}")).collect()}
    except (PySparkException, Py4JJavaError) as wrong:
        run.log(f"FAIL: could not read a table: {str(wrong).splitlines()[0]}")
        return 1
    bad = [p for p in problems if p["severity"] == "error"]
    run.record("verification", {"passed": not bad, **counts, "problems": problems, "sha256": digests, "seconds": time.monotonic() - began})
    for p in problems:
        run.log(f"{p['severity'].upper()}: {p['table']}: {p['rule']}: {p['n']} ({p['examples']})")
    run.log(f"{'FAIL' if bad else 'PASS'}: {counts}")
    return int(bool(bad))


def diagnose_errors(run: Run, limit: int = 100) -> dict[str, int]:
    """The first ``limit`` tune references with an error, and the raw records of their candidates."""
    pairs, anchors = checked_pairs(run)
    bundle = cascade.Bundle.load(run.spark, run.path("model"))
    tune = anchors.where(sampling.part_of(F.col("group")) == "tune")
    truth = sampling.exploded_truth(tables.read_truth(run.spark, f"{run.data}/train/train_ground_truth.tsv")).join(tune.select("anchor"), "anchor", "left_semi")
    mine = pairs.join(tune.select("anchor"), "anchor", "left_semi")
    said = decided(bundle, mine, tune).where("said").select("anchor", "candidate", F.lit(1.0).alias("score"))
    scored = written(mine.select("anchor", "candidate", "retrieved").join(said, ["anchor", "candidate"], "left").fillna(0.0, ["score"]), "scored")
    wrong = written(diagnose.differences(truth, scored, 0.5), "wrong")
    examples = diagnose.examples(wrong, run.normalized("train").where("source = 1"), limit)
    got = run.saved(examples, "development_errors")
    about = wrong.join(run.table("development_errors").select("anchor"), "anchor", "left_semi").select(F.col("candidate").alias("entity_id")).distinct()
    raw = tables.read_sources(run.spark, run.data, "train").where("source != 1").join(about, "entity_id", "left_semi")
    return {"examples": got["rows"], "records": run.saved(raw, "development_records")["rows"]}


def assess(run: Run) -> dict[str, int]:
    """Of the retrieval misses that ``diagnose_errors`` stored, how many blocking finds now, and how many of those the gate rejects."""
    misses = run.table("development_errors").select("anchor", F.explode("retrieval_miss").alias("candidate"))
    found = linkage.with_frequencies(run.normalized("train"))
    one = found.references.join(misses.select(F.col("anchor").alias("entity_id")).distinct(), "entity_id", "left_semi")
    rest = found.sources.join(misses.select(F.col("candidate").alias("entity_id")).distinct(), "entity_id", "left_semi")
    pairs = written(blocking.paired(blocking.candidates(one, rest, found.references), one, rest), "assessed")
    gated = features.scored_for_gate(pairs).where(features.gate())
    return run.record("retrieval_assessment", {k: int(v) for k, v in diagnose.assessed(misses, pairs, gated).first().asDict().items()})


def profile(run: Run, split: str) -> dict[str, int]:
    """Both frequency profiles of a split's sources, by country."""
    out = {}
    for name, rows in zip(("core", "core_address"), features.source_profile(run.normalized(split).where("source != 1"))):
        rows.write.mode("overwrite").partitionBy("country").parquet(run.path(f"profile_{split}_{name}"))
        out[name] = run.table(f"profile_{split}_{name}").count()
    return run.record(f"profile_{split}", out)


def memory(spark: SparkSession) -> dict[str, float]:
    """GB that the driver's JVM uses and that Python had at most."""
    vm = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return {"jvm_gb": (vm.totalMemory() - vm.freeMemory()) / 1e9, "python_gb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1e6}


def benchmark(run: Run, rows: int = 50_000, references: int = 1_000_000) -> dict:
    """Records a second through keys, join, gate and screening columns: up to ``rows`` of source 2 against up to ``references`` of its largest country."""
    made = run.normalized("test")
    country = made.where("source = 1").groupBy("country").count().orderBy(F.desc("count"), "country").first()["country"]
    found = linkage.with_frequencies(made.where(F.col("country") == country))
    one, two = written(found.references.limit(references), "references"), written(found.sources.where("source = 2").limit(rows), "sources")
    began = time.monotonic()
    gated = features.scored_for_gate(blocking.paired(blocking.candidates(one, two), one, two)).where(features.gate())
    got = run.saved(gated.select("anchor", "candidate", *[c.alias(n) for n, c in features.screen_columns().items()]), "benchmark_pairs")
    took, n = time.monotonic() - began, two.count()
    return run.record("benchmark", {"country": country, "references": one.count(), "records": n, "pairs": got["rows"], "seconds": took, "records_a_second": n / took, **memory(run.spark)})


def pilot(run: Run, rows: int = 5000, country: str | None = None) -> dict:
    """Prediction of one country with up to ``rows`` records of each source, timed; the plan of its pairs is stored beside."""
    made = run.normalized("test")
    country = country or made.where("source = 1").agg(F.min("country")).first()[0]
    mine = made.where(F.col("country") == country)
    small = mine.where("source = 1").unionByName(mine.where("source = 2").limit(rows)).unionByName(mine.where("source = 3").limit(rows))
    began = time.monotonic()
    got = predict_country(run, small, cascade.Bundle.load(run.spark, run.path("model")), None, "pilot")
    return run.record("pilot_report", {"country": country, **got, "seconds": time.monotonic() - began, **memory(run.spark)})


def selftest(spark: SparkSession) -> None:
    """The engine's own basics, on two records that say the same in other words."""
    rows = [("S1-a", "Acme Pvt Ltd", "12 Main Road", "India", 1), ("S2-a", "ACME PRIVATE LIMITED", "12 Main Rd", "India", 2)]
    found = linkage.split(spark.createDataFrame(rows, tables.SOURCE_SCHEMA + ", source int"))
    gated = linkage.gated_pairs(found)
    made = features.model_columns(gated).collect()
    if len(made) != 1 or any(made[0][c] != 1 for c in ("name_exact", "core_exact", "address_exact")) or gated.select(*features.screen_columns().values()).first() is None:
        raise AssertionError("equal records are not found equal")
    if set(SCREEN_COLUMNS) - set(MODEL_COLUMNS) or len(set(MODEL_COLUMNS)) != 57:
        raise AssertionError("the model's columns are not what they should be")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None, settings: cascade.Settings | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--step", choices=[*STEPS, "diagnose", "assess", "profile", "profile_test", "benchmark", "pilot", "selftest", "all"], default="all")
    p.add_argument("--data", default="dataset")
    p.add_argument("--out", default="output")
    p.add_argument("--sample-rate", type=float, default=RATE, help="share of the training references; all other records are read")
    p.add_argument("--threshold", type=float, help="takes the place of the model's own")
    p.add_argument("--model", help="another stored model")
    p.add_argument("--resume", action="store_true", help="countries that are done, by the same model and threshold, stay as they are")
    said = p.parse_args(arguments)
    run = Run(spark or SparkSession.builder.getOrCreate(), said.data, said.out)
    steps = {
        "prepare": lambda: prepare(run, said.sample_rate),
        "fit": lambda: fit(run, settings),
        "predict": lambda: predict(run, said.model, said.threshold, said.resume),
        "assemble": lambda: assemble(run),
        "diagnose": lambda: diagnose_errors(run),
        "assess": lambda: assess(run),
        "profile": lambda: profile(run, "train"),
        "profile_test": lambda: profile(run, "test"),
        "benchmark": lambda: benchmark(run),
        "pilot": lambda: pilot(run),
        "selftest": lambda: selftest(run.spark),
    }
    for step in STEPS if said.step == "all" else (said.step,):
        run.log(step)
        if step == "check":
            return check(run)
        run.log(f"{step}: {steps[step]()}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
