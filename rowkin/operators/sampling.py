"""Deterministic samples and splits, truth, labels and injected positives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MILLION = 1_000_000


def sampled(records: DataFrame, rate: float) -> DataFrame:
    """Records whose id's CRC-32 falls under ``rate`` of a million."""
    return records.where(F.crc32("entity_id") % MILLION < rate * MILLION)


def group_of() -> Column:
    """0 to 9; equal descriptions share a group, whatever their ids. 0-5 fit, 6-7 tune, 8-9 audit."""
    return (F.crc32(F.concat_ws("|", "country", "name", "address")) % 10).cast("int")


def part_of(group: Column) -> Column:
    return F.when(group < 6, "fit").when(group < 8, "tune").otherwise("audit")


def exploded_truth(truth: DataFrame) -> DataFrame:
    """anchor, candidate of each listed match; blanks are dropped, repeats counted once."""
    ids = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))
    return truth.select(F.col("source1_entity_id").alias("anchor"), F.explode(ids).alias("candidate")).distinct()


def missing_truth(truth: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted ids that have no row in the truth table."""
    return wanted.select("entity_id").join(truth.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_anti")


def checked_truth(truth: DataFrame, wanted: DataFrame) -> DataFrame:
    """``exploded_truth`` of the wanted ids; an error if one has no row."""
    n = missing_truth(truth, wanted).count()
    if n:
        raise ValueError(f"ground truth lacks {n} of the wanted records")
    return exploded_truth(truth).join(wanted.select(F.col("entity_id").alias("anchor")), "anchor", "left_semi")


def labelled(pairs: DataFrame, matches: DataFrame) -> DataFrame:
    """``pairs`` with label: 1 where (anchor, candidate) is a match."""
    return pairs.join(matches.select("anchor", "candidate", F.lit(1).alias("_y")).distinct(), ["anchor", "candidate"], "left").withColumn("label", F.coalesce("_y", F.lit(0))).drop("_y")


def injected(retrieved: DataFrame, matches: DataFrame) -> DataFrame:
    """anchor, candidate, retrieved: found pairs (1) and the ``matches`` that were not found (0). Give it the matches of fit groups only."""
    both = retrieved.select("anchor", "candidate", F.lit(1).alias("retrieved")).unionByName(matches.select("anchor", "candidate", F.lit(0).alias("retrieved")))
    return both.groupBy("anchor", "candidate").agg(F.max("retrieved").alias("retrieved"))


def repeated_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs that stand more than once in a prepared table."""
    return pairs.groupBy("anchor", "candidate").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
