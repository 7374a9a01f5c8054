"""Exact duplicate removal by a tree-merge of sorted digest runs; DataFrame functions only.

Every input partition is a leaf run: its rows, reduced to one entry a digest. In each
round ``FAN`` neighbouring runs exchange their entries, range by range of the digest
(the exchange is keyed by digest and run, so no task holds a whole run), and a sorted
multiway merge keeps, for each digest, the entry to stay, the number of rows and the
values that verify that its texts are equal. After the last round one run is left.
Entries are a few dozen bytes; texts never move, and a group of copies of any size
shrinks to one entry a run before the first exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_RUN, checked, cut

#: Runs that one round merges into one, and the number of leaf runs.
FAN, LEAVES = 16, 4096
ROUNDS = math.ceil(math.log(LEAVES, FAN))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """_id, _sha, _check, _rank for each row of ``docs`` (and the columns ``keep``).

    _sha: SHA-256 of the text without white space. _check: a second digest and the length,
    so that equality never rests on one hash. _rank: the smaller stays (more code points of
    the original text, then the smaller id, null ids last).
    """
    plain = docs.select(*keep, F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    plain = plain.withColumn("_norm", F.regexp_replace("_text", BLANK_RUN, ""))
    return plain.select(
        *keep,
        "_id",
        F.sha2(F.encode("_norm", "UTF-8"), 256).alias("_sha"),
        F.struct(F.octet_length("_norm").alias("n"), F.xxhash64("_norm").alias("x")).alias("_check"),
        F.struct((-F.length("_text").cast("long")).alias("n"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id")).alias("_rank"),
    )


def merge_tree(rows: DataFrame) -> DataFrame:
    """One entry (_sha, _check, _best, _size) for each distinct text of ``digests`` rows."""
    runs = rows.withColumn("_run", F.pmod(F.spark_partition_id(), F.lit(LEAVES)))
    runs = runs.groupBy("_sha", "_check", "_run").agg(F.min("_rank").alias("_best"), F.count(F.lit(1)).alias("_size"))
    for _ in range(ROUNDS):
        merged = F.floor(F.col("_run") / FAN).cast("int").alias("_run")
        runs = runs.groupBy("_sha", "_check", merged).agg(F.min("_best").alias("_best"), F.sum("_size").alias("_size"))
    return runs.drop("_run")


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: _id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty texts are one group. Of rows that repeat a doc_id
    and tie in everything else, one stays. An empty table gives an empty result.
    """
    rows = digests(docs, text, doc_id)
    # Counted before the join and on the id as well: a hot group is many keys here, and a join that Spark can split there.
    same = Window.partitionBy("_sha", "_check", "_id").orderBy("_rank")
    found = rows.withColumn("_turn", F.row_number().over(same)).join(merge_tree(rows), ["_sha", "_check"])
    return found.select(
        F.col("_id").alias(doc_id),
        F.col("_best.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        ((F.col("_rank") == F.col("_best")) & (F.col("_turn") == 1)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    What stays is settled on rows without texts. Only digests that occur twice or more go back to the texts, as a broadcast table
    while they are few (they are counted); then a copy is lost where it is read, and just the texts that stay of such groups are
    shuffled, to drop rows that repeat one in everything. Null text counts as empty. An empty table gives an empty result.
    """
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    keyed = digests(whole, f"_row.`{text}`", f"_row.`{doc_id}`", keep=("_row",))
    several = cut(merge_tree(keyed.select("_sha", "_check", "_rank")).where("_size > 1"))
    found = keyed.join(checked(several.select("_sha", "_check", "_best")), ["_sha", "_check"], "left")
    alone = found.where("_best IS NULL").select("_row.*")
    one = Window.partitionBy("_sha", "_check").orderBy("_rank")
    stay = found.where(F.col("_rank").eqNullSafe(F.col("_best"))).withColumn("_turn", F.row_number().over(one)).where("_turn = 1").select("_row.*")
    return alone.unionByName(stay)
