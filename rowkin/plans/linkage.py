"""Whole runs: prepare training pairs, train, predict, assemble, verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MODEL_COLUMNS
from ..functions.normalize import records
from ..operators import blocking, features, sampling, validate
from ..sources import tables
from ..sources.shared import written
from ..sources.sinks import numbered, wide
from . import cascade


@dataclass
class Records:
    """Normalized references (with their frequencies) and sources of one split."""

    references: DataFrame
    sources: DataFrame


def with_frequencies(made: DataFrame) -> Records:
    """From normalized records of sources 1, 2, 3: references with reference frequencies, sources with source frequencies."""
    return Records(features.with_reference_frequencies(made.where("source = 1")), features.with_source_frequencies(made.where("source != 1")))


def split(raw: DataFrame) -> Records:
    """From raw records: references and sources. Records are normalized once and kept as a table, and so are both results, as each is read several times."""
    found = with_frequencies(written(records(tables.dealt(raw)), "records", ("source",)))
    return Records(written(found.references, "references"), written(found.sources, "sources"))


def alike(found: Records) -> Records:
    """``found`` with a row for records that differ by id alone (``blocking.classes``), written, as both are read several times."""
    return Records(written(blocking.classes(found.references), "references"), written(blocking.classes(found.sources), "sources"))


def alike_of(made: DataFrame) -> Records:
    """``alike`` of normalized records and their frequencies, which are then found for classes, far fewer than records where many are alike."""
    one = lambda: written(tables.dealt(features.with_reference_frequencies(written(blocking.classes(made.where("source = 1")), "classes"))), "references")
    rest = lambda: written(tables.dealt(features.with_source_frequencies(written(blocking.classes(made.where("source != 1")), "classes"))), "sources")
    return Records(*cascade._at_once(made.sparkSession, one, rest))


def alike_of_raw(raw: DataFrame) -> Records:
    """``alike_of`` of raw records. Of raw ones that differ by id alone one is normalized; what is alike only then is brought together after."""
    return alike_of(written(records(tables.dealt(blocking.classes(raw))), "records", ("source",)))


def gated_pairs(found: Records, sample: DataFrame | None = None) -> DataFrame:
    """anchor, candidate, x, y, s of blocked pairs that pass the gate; of the references in ``sample`` if given, keys counted over all."""
    references = found.references if sample is None else sample
    pairs = blocking.candidates(references, found.sources, None if sample is None else found.references)
    return features.scored_for_gate(blocking.paired(pairs, references, found.sources)).where(features.gate())


def prepare(raw: DataFrame, truth: DataFrame, rate: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(pairs, anchors) to train on. Matches that blocking missed are added for fit groups only. Pairs of like records are scored once."""
    return prepared(split(raw), truth, rate)


def prepared(found: Records, truth: DataFrame, rate: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """``prepare`` for records that are normalized already."""
    sample = sampling.sampled(found.references, rate)
    matches = sampling.checked_truth(truth, sample)
    grouped = sample.withColumn("group", sampling.group_of())
    true = matches.groupBy("anchor").agg(F.count(F.lit(1)).alias("true"))
    anchors = written(grouped.select(F.col("entity_id").alias("anchor"), "country", "group").join(true, "anchor", "left").fillna(0, ["true"]), "anchors")
    scored = features.model_columns(gated_pairs(alike(found), written(blocking.classes(sample), "sample"))).select(F.col("x.members").alias("_x"), F.col("y.members").alias("_y"), *MODEL_COLUMNS)
    retrieved = blocking.expanded(written(scored, "retrieved"))
    same = matches.join(anchors.where("group < 6").select("anchor", "country"), "anchor").join(found.sources.select(F.col("entity_id").alias("candidate"), "country"), ["candidate", "country"])
    missed = same.select("anchor", "candidate").distinct().join(retrieved, ["anchor", "candidate"], "left_anti")
    more = features.model_columns(features.scored_for_gate(blocking.paired(missed, sample, found.sources))).drop("x", "y", "s")
    whole = retrieved.withColumn("retrieved", F.lit(1)).unionByName(more.withColumn("retrieved", F.lit(0)))
    return sampling.labelled(whole, matches).join(anchors.select("anchor", "group"), "anchor"), anchors


def prepared_classes(one: Records, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``prepared`` makes of all references, for classes of like records, whose pairs are never made.

    A row says of two classes how many pairs of their records (_n) have a label, and for groups that are judged by anchor, which
    anchors have how many of these (whose). Records of a class share a group, as they share all that a group is told by.
    """
    references = one.references.withColumn("group", sampling.group_of())
    members = references.select(F.col("entity_id").alias("_x"), "country", "group", F.explode("members").alias("anchor"))
    # Dealt to all tasks, as records are: a truth table of few bytes would be read by one.
    dealt = truth.repartition(int(truth.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    matches = written(sampling.checked_truth(dealt, members.select(F.col("anchor").alias("entity_id"))), "truth")
    true = matches.groupBy("anchor").agg(F.count(F.lit(1)).alias("true"))
    anchors = written(members.join(true, "anchor", "left").fillna(0, ["true"]), "anchors")
    others = one.sources.select(F.col("entity_id").alias("_y"), "country", F.explode("members").alias("candidate"))
    met = matches.join(anchors, "anchor").join(others, ["candidate", "country"]).groupBy("_x", "_y", "group", "anchor").agg(F.count(F.lit(1)).alias("_n"))
    hits = written(met.groupBy("_x", "_y", "group").agg(F.collect_list(F.struct("anchor", "_n")).alias("hits"), F.sum("_n").alias("matches")), "hits")

    scored = features.model_columns(gated_pairs(Records(references, one.sources)))
    retrieved = written(scored.select(F.col("anchor").alias("_x"), F.col("candidate").alias("_y"), F.col("x.group").alias("group"), F.col("x.members").alias("members"), F.col("y.alike").alias("alike"), *MODEL_COLUMNS), "retrieved")
    known = F.map_from_entries("hits")
    rest = F.filter(F.transform("members", lambda a: F.struct(a.alias("anchor"), (F.col("alike") - F.coalesce(F.try_element_at(known, a), F.lit(0))).alias("_n"))), lambda w: w["_n"] > 0)
    judged = lambda whose: F.when(sampling.part_of(F.col("group")) != "fit", whose)
    one_label = lambda label, n, whose: F.struct(F.lit(label).alias("label"), n.alias("_n"), judged(whose).alias("whose"))
    found = F.coalesce("matches", F.lit(0))
    both = F.array(one_label(1, found, F.col("hits")), one_label(0, F.size("members") * F.col("alike") - found, rest))
    labelled = retrieved.join(hits.drop("group"), ["_x", "_y"], "left").select("group", F.explode(both).alias("_l"), *MODEL_COLUMNS).select("_l.*", F.lit(1).alias("retrieved"), "group", *MODEL_COLUMNS).where("_n > 0")

    # Matches that blocking missed are added for fit groups only.
    missed = hits.where(sampling.part_of(F.col("group")) == "fit").join(retrieved, ["_x", "_y"], "left_anti").select(F.col("_x").alias("anchor"), F.col("_y").alias("candidate"), F.col("matches").alias("_n"), "group")
    more = features.model_columns(features.scored_for_gate(blocking.paired(missed, references, one.sources)))
    injected = more.select(F.lit(1).alias("label"), "_n", F.lit(None).cast(labelled.schema["whose"].dataType).alias("whose"), F.lit(0).alias("retrieved"), "group", *MODEL_COLUMNS)
    return labelled.unionByName(injected), anchors.drop("_x")


def link(raw: DataFrame, bundle: cascade.Bundle, override: float | None = None) -> DataFrame:
    """Candidates of a split with score and matched."""
    return linked(split(raw), bundle, override)


def linked(found: Records, bundle: cascade.Bundle, override: float | None = None) -> DataFrame:
    """``link`` for records that are normalized already. Pairs of like records are scored once."""
    return linked_classes(alike(found), bundle, override)


def linked_classes(one: Records, bundle: cascade.Bundle, override: float | None = None) -> DataFrame:
    """``linked`` for classes of like records."""
    return cascade.predict(blocking.paired(blocking.candidates(one.references, one.sources), one.references, one.sources), bundle, override)


def assemble(references: DataFrame, linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) tables in the order of ``references``, one row a reference."""
    lines = references if "line" in references.columns else numbered(references)
    base = lines.select("entity_id", "line")
    return wide(base, linked.where("matched"), "matched_entity_ids"), wide(base, linked, "candidate_entity_ids")


def verify(matches: DataFrame, candidates: DataFrame, references: DataFrame, sources: DataFrame) -> DataFrame:
    """Problems of assembled tables by the strict rules."""
    rows = [t.select("line", F.col("source1_entity_id").alias("anchor"), F.col(t.columns[1]).alias("ids")) for t in (matches, candidates)]
    return validate.validate(*rows, references, sources, strict=True)
