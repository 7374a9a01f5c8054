"""Rules that an output table must meet; each broken one is a row (rule, severity, offender)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_lines(lines: DataFrame, header: tuple[str, str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of a text table (line long, value string). rows: line, anchor, ids.

    strict: the header must match exactly; otherwise case and blanks around its names are ignored.
    Blank lines are passed over; a line without a tab (strict: not of two columns) is malformed.
    """
    body = lines.withColumn("value", F.regexp_replace("value", "\r$", ""))
    first = body.agg(F.min("line").alias("_l"))
    rows = body.crossJoin(F.broadcast(first))
    wanted = "\t".join(header)
    said = F.col("value") if strict else F.array_join(F.transform(F.split(F.lower("value"), "\t"), lambda x: F.trim(x)), "\t")
    wrong = rows.where((F.col("line") == F.col("_l")) & (said != wanted)).select(F.lit("header").alias("rule"), F.lit("error").alias("severity"), F.col("value").alias("offender"))
    empty = first.where("_l IS NULL").select(F.lit("empty").alias("rule"), F.lit("error").alias("severity"), F.lit("").alias("offender"))
    data = rows.where((F.col("line") > F.col("_l")) & (F.trim("value") != "")).withColumn("_p", F.split("value", "\t"))
    fits = F.size("_p") == 2 if strict else F.size("_p") >= 2
    bad = data.where(~fits).select(F.lit("malformed").alias("rule"), F.lit("error").alias("severity"), F.col("value").alias("offender"))
    return data.where(fits).select("line", F.trim(F.col("_p")[0]).alias("anchor"), F.trim(F.col("_p")[1]).alias("ids")), wrong.unionByName(empty).unionByName(bad)


def id_list(ids: Column) -> Column:
    return F.filter(F.transform(F.split(ids, ","), lambda x: F.trim(x)), lambda x: x != "")


def _problem(rows: DataFrame, rule: str, offender: Column, severity: str = "error") -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), offender.alias("offender"))


def check_lists(rows: DataFrame, required: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Problems of one table (anchor, ids). ``required``: entity_id of the references. ``targets``: entity_id of all that may be listed, or None."""
    listed = rows.select("anchor", id_list(F.col("ids")).alias("_ids"))
    each = listed.select("anchor", F.explode("_ids").alias("_id"))
    wanted = required.select(F.col("entity_id").alias("anchor")).distinct()
    ours, theirs = F.col("_id").startswith("S1-"), F.col("_id").startswith("S2-") | F.col("_id").startswith("S3-")
    found = [
        _problem(rows.groupBy("anchor").count().where("count > 1"), "duplicate_row", F.col("anchor")),
        _problem(listed.where(F.size("_ids") != F.size(F.array_distinct("_ids"))), "duplicate_id", F.col("anchor")),
        _problem(each.where(ours).distinct(), "self_match", F.concat_ws(" ", "anchor", "_id")),
        _problem(each.where(~ours & ~theirs).distinct(), "wrong_prefix", F.concat_ws(" ", "anchor", "_id")),
        _problem(wanted.join(rows, "anchor", "left_anti"), "missing_row", F.col("anchor")),
        _problem(rows.join(wanted, "anchor", "left_anti").select("anchor").distinct(), "unknown_row", F.col("anchor")),
    ]
    if targets is not None:
        known = targets.select(F.col("entity_id").alias("_id")).distinct()
        found.append(_problem(each.where(theirs).join(known, "_id", "left_anti").distinct(), "unknown_target", F.concat_ws(" ", "anchor", "_id")))
    return reduce(DataFrame.unionByName, found)


#: Lines that one task numbers.
LINES = 1 << 16


def places(rows: DataFrame, of: str) -> DataFrame:
    """_a, _n: ``of`` and its place among the rows by line, from 1. Blocks of ``LINES`` line numbers count for themselves; only a row a block is summed up in one task."""
    block = rows.select(F.col(of).alias("_a"), "line", F.floor(F.col("line") / LINES).alias("_b"))
    counts = block.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select("_b", (F.sum("_c").over(Window.orderBy("_b")) - F.col("_c")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("line", "_a"))
    return block.withColumn("_i", inside).join(before, "_b").select("_a", (F.col("_before") + F.col("_i")).alias("_n"))


def check_order(rows: DataFrame, references: DataFrame) -> DataFrame:
    """References whose place among the lines differs: both tables carry line, places are counted from the first; rows of one line by anchor."""
    got, want = places(rows, "anchor"), places(references, "entity_id").withColumnRenamed("_a", "_e")
    return _problem(want.join(got, "_n", "full").where(~F.col("_a").eqNullSafe(F.col("_e"))), "order", F.coalesce("_e", "_a"))


def check_subset(matches: DataFrame, candidates: DataFrame, severity: str = "warning") -> DataFrame:
    """Matches that the candidate table does not list for the same reference."""
    each = lambda df: df.select("anchor", F.explode(id_list(F.col("ids"))).alias("_id")).distinct()
    return _problem(each(matches).join(each(candidates), ["anchor", "_id"], "left_anti"), "not_a_candidate", F.concat_ws(" ", "anchor", "_id"), severity)


def validate(matches: DataFrame, candidates: DataFrame, references: DataFrame, targets: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """All problems of both tables: table, rule, severity, offender. strict also asks for the order of the references and for known targets, and takes a match that is no candidate for an error."""
    if strict and targets is None:
        raise ValueError("the strict check needs the targets")
    out = check_lists(matches, references, targets).withColumn("table", F.lit("matches")).unionByName(check_lists(candidates, references, targets).withColumn("table", F.lit("candidates")))
    out = out.unionByName(check_subset(matches, candidates, "error" if strict else "warning").withColumn("table", F.lit("matches")))
    if strict:
        for name, rows in (("matches", matches), ("candidates", candidates)):
            out = out.unionByName(check_order(rows, references).withColumn("table", F.lit(name)))
    return out.select("table", "rule", "severity", "offender")


def summary(problems: DataFrame, examples: int = 5) -> DataFrame:
    """table, rule, severity, n and the first few offenders in order."""
    first = F.array_join(F.slice(F.array_sort(F.collect_set("offender")), 1, examples), ", ")
    return problems.groupBy("table", "rule", "severity").agg(F.count(F.lit(1)).alias("n"), first.alias("examples"))


def passed(problems: DataFrame) -> bool:
    return problems.where("severity = 'error'").isEmpty()
