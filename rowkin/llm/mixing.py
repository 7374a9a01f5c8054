"""Mixing sources to target token counts by entropy balancing.

Of all document rates r (copies of a document) the ones closest to 1 in relative entropy
are sought whose tokens meet each source's target, none above ``LIMIT`` copies. They are
exponentially tilted: r = min(LIMIT, exp(lambda_s * size / mean size of s)), with one dual
variable a source. Distributed Newton iterations find the duals. They need the counts of
documents by source and size only, so a hot source is reduced before the first shuffle,
and no text is read again. Sums are exact decimals: a rerun gives the same mix.

Rates are then rounded into copies: classes of equal source and size, largest first,
carry their rounding error to the next class; within a class, copies go to the documents
with the smallest hashes, class parts of bounded size counting on their own.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, released, uniform, words_of

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
#: Newton ends when every source's tokens are this near to its target, or after so many steps (then bisection has 2^-STEPS).
TOLERANCE, STEPS = 1e-4, 40
#: Documents of one class that are ranked together, about.
PART_ROWS = 2000


def ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with rank: the place of each source by code point from 0, null last. Ranges of sources count for themselves, a row a range is summed up."""
    order = F.asc_nulls_last("source")
    ranged = cut(sizes.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select("_range", (F.sum("_c").over(Window.orderBy("_range")) - F.col("_c")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranged.withColumn("_i", inside).join(before, "_range").withColumn("rank", F.col("_before") + F.col("_i")).select(*sizes.columns, "rank")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``sizes`` (source, source_size and other columns; one row a source) with target: ``share`` of all sizes dealt by weight.

    Sources by code point, null last, weigh ``weights``, repeating. No target exceeds ``limit`` times
    its source's size; the excess is reshared by weight among the others until none is above. So a source has its weight times
    one level, or its limit where that is less; the level rises until it deals out all there is. Only sums reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = cut(ranked(sizes).withColumn("weight", weight).withColumn("cap", limit * F.col("source_size").cast("double")))
    all_, level = float(rows.agg(F.sum("source_size")).first()[0] or 0), 0.0
    while True:
        full = (F.col("cap") < level * F.col("weight")) | (F.col("cap") == 0)
        got = rows.agg(F.sum(F.when(full, F.col("cap")).cast("decimal(38,6)")).cast("double").alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if not got["weight"]:
            break
        new = max(0.0, share * all_ - (got["cap"] or 0.0)) / got["weight"]
        if new <= level:
            break
        level = new
    return rows.select(*sizes.columns, F.least(F.col("cap"), level * F.col("weight")).alias("target"))


def exact_sum(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,6)")).cast("double")


def by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right`` (a row a source) where the sources agree, null with null."""
    other = right.withColumnRenamed("source", "_other")
    return left.join(other, left["source"].eqNullSafe(other["_other"]), how).drop("_other")


def duals(classes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """source, dual of each source: Newton on the convex dual, kept inside a bracket that halves when a step leaves it.

    ``classes``: source, size, n, source_size, target, mean. A source whose target is all it may give has
    dual +64 (rate ``limit`` for every document with a token).
    """
    classes = cut(classes.where("size > 0"))
    x = F.col("size") / F.col("mean")
    now = classes.groupBy("source").agg(F.lit(0.0).alias("dual"), F.lit(-64.0 * 64).alias("lo"), F.lit(64.0 * 64).alias("hi"), F.first("target").alias("target"), F.lit(False).alias("done"))
    now = cut(now)
    for turn in range(STEPS):
        raw = F.exp(F.least(F.col("dual") * x, F.lit(50.0)))
        tokens = F.col("size") * F.col("n")
        both = by_source(classes.drop("target"), now)
        got = both.groupBy("source", "dual", "lo", "hi", "target", "done").agg(
            exact_sum(tokens * F.least(raw, F.lit(float(limit)))).alias("tokens"), exact_sum(F.when(raw < limit, tokens * x * raw).otherwise(0.0)).alias("slope")
        )
        off = F.col("tokens") - F.col("target")
        done = (F.abs(off) <= TOLERANCE * F.col("target")) | F.col("done")
        lo, hi = F.when(off < 0, F.col("dual")).otherwise(F.col("lo")), F.when(off > 0, F.col("dual")).otherwise(F.col("hi"))
        step = F.when(F.col("slope") > 0, F.col("dual") - off / F.col("slope"))
        inside = (step > lo) & (step < hi)
        moved = F.when(done, F.col("dual")).when(inside, step).otherwise((lo + hi) / 2)
        now = cut(got.select("source", F.round(moved, 12).alias("dual"), lo.alias("lo"), hi.alias("hi"), "target", done.alias("done")), now)
        if turn % 3 == 2 and now.where("NOT done").isEmpty():  # a source that is done stays as it is
            break
    return now.select("source", "dual")


def rounded(part: pd.DataFrame) -> pd.DataFrame:
    """Copies of each class of one source, largest sizes first, the rounding error carried on."""
    part = part.sort_values("size", ascending=False)
    error, out = 0.0, []
    for size, n, rate, limit in zip(part["size"], part["n"], part["rate"], part["limit"]):
        want = n * rate * size + error
        k = min(max(math.floor(want / size + 0.5), 0), n * int(limit)) if size else n
        error = want - k * size
        out.append(k)
    return part[["source", "size", "n"]].assign(copies=out)


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, _source, size, source_size, target, copies of each row of ``docs``.

    Null text has size 0; documents of size 0 have one copy, and take no tokens. A null source is
    a source. Rows that repeat an id are rounded one by one. An empty table gives an empty result.
    """
    sized = cut(docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), F.monotonically_increasing_id().alias("_row")))
    hist = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("_docs"))
    mean = F.greatest(F.col("source_size") / F.col("_docs"), F.lit(1e-9))
    goal = cut(targets(sizes, weights, share, limit).select("source", "source_size", "target", mean.alias("mean")))
    classes = cut(by_source(hist, goal))
    dual = duals(classes, limit)
    full = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
    rate = F.when(full, F.lit(float(limit))).otherwise(F.least(F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(limit))))
    rates = by_source(classes, dual, "left").select("source", "size", "n", F.coalesce(rate, F.lit(1.0)).alias("rate"), F.lit(limit).alias("limit"))
    copies = rates.groupBy("source").applyInPandas(rounded, "source string, size long, n long, copies long")
    copies = by_source(copies, goal).select(F.col("source").alias("_s"), F.col("size").alias("_z"), "n", F.col("copies").alias("_k"), "source_size", "target")
    copies = cut(copies.withColumn("_parts", F.ceil(F.col("n") / PART_ROWS).cast("long")))

    released(docs.sparkSession)
    # Documents of a class are dealt to parts by hash; each part has its share of the class's copies.
    dealt = sized.join(copies, sized["source"].eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")))
    # Rows without an id are told apart by their place alone: any of a class may have its copies.
    dealt = dealt.withColumn("_u", uniform(F.col("_id"), F.when(F.col("_id").isNull(), F.col("_row")), seed=11)).withColumn("_part", F.floor(F.col("_u") * F.col("_parts")).cast("long"))
    counts = dealt.groupBy("_s", "_z", "_part").agg(F.count(F.lit(1)).alias("_m"))
    before = F.sum("_m").over(Window.partitionBy("_s", "_z").orderBy("_part"))
    counts = counts.withColumn("_upto", before).select(F.col("_s").alias("_s2"), F.col("_z").alias("_z2"), F.col("_part").alias("_p2"), "_m", "_upto")
    both = dealt.join(counts, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("size") == F.col("_z2")) & (F.col("_part") == F.col("_p2")))
    # Whole numbers throughout: products of two row counts need more than 64 bits.
    upto = lambda m: F.expr(f"CAST(_k AS DECIMAL(19, 0)) * CAST({m} AS DECIMAL(19, 0)) div CAST(n AS DECIMAL(19, 0))")
    quota = upto("_upto") - upto("_upto - _m")
    rank = F.row_number().over(Window.partitionBy("_s", "size", "_part").orderBy("_u", "_id", "_row"))
    both = both.withColumn("_quota", quota.cast("long")).withColumn("_rank", rank)
    made = F.floor(F.col("_quota") / F.col("_m")) + F.when(F.col("_rank") <= F.pmod("_quota", "_m"), 1).otherwise(0)
    return both.select(F.col("_id").alias(doc_id), F.col("source").alias("_source"), "size", "source_size", "target", made.cast("long").alias("copies"))


def size_of(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.size(words_of(text)).cast("long")


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (rows of no copies go), columns unchanged.

    Texts are shuffled once. Rows that agree in id, source and size share their copies evenly.
    """
    keys = ["_i", "_s", "_z"]
    taken = mix(docs, text, doc_id, source, **how).groupBy(F.col(doc_id).alias("_i"), F.col("_source").alias("_s"), F.col("size").alias("_z")).agg(F.sum("copies").alias("_k"), F.count(F.lit(1)).alias("_m")).where("_k > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).withColumn("_z", size_of(F.col(f"_row.`{text}`")))
    rows = rows.select("_row", F.col(f"_row.`{doc_id}`").alias("_ri"), F.col(f"_row.`{source}`").alias("_rs"), F.col("_z").alias("_rz"))
    both = rows.join(taken, F.col("_ri").eqNullSafe(F.col("_i")) & F.col("_rs").eqNullSafe(F.col("_s")) & (F.col("_rz") == F.col("_z")))
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(f"_row.`{text}`")))
    copies = F.floor(F.col("_k") / F.col("_m")) + F.when(turn <= F.pmod("_k", "_m"), 1).otherwise(0)
    both = both.withColumn("_copies", copies.cast("int"))
    return both.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_turn")).select("_row.*")
