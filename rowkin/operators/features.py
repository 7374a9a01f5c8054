"""Frequencies, gate and model columns of candidate pairs.

Built-in functions wherever they can say it; strings are compared in two Arrow calls, one for
what the gate and the screening model need, one for the rest, which only survivors reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BASE_COLUMNS, EXTRA_COLUMNS, MODEL_COLUMNS, REFERENCE_COLUMNS, SCREEN_COLUMNS, SOURCE_COLUMNS
from ..functions.normalize import compact, numbers, tokens
from ..functions.similarity import FULL_SCORES, best_number_ratio, full_scores, screen_scores


def _log_count(n: Column, text: Column) -> Column:
    return F.when(text == "", 0.0).otherwise(F.log1p(F.least(F.lit(1000), n).cast("double")))


def _number(records: DataFrame) -> Column:
    """How many records a group of rows is (``alike`` of them in a row, if there is such a column)."""
    return F.sum("alike") if "alike" in records.columns else F.count(F.lit(1))


def _counted(records: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """``records`` with the number of records that agree in each group of columns.

    Counts are aggregated before they are shuffled and joined back, so that a frequent value
    is no task of its own: skewed joins are split, windows are not.
    """
    out = records
    for name, columns in groups.items():
        counts = records.groupBy(*columns).agg(_number(records).alias(name))
        out = out.join(counts, columns)
    return out.select(*records.columns, *groups)


def with_reference_frequencies(references: DataFrame, all_references: DataFrame | None = None) -> DataFrame:
    """``references`` with reference_{name,core,address}_frequency: log(1 + min(1000, count in the country)), 0 for empty."""
    fields = ["name", "core", "address"]
    base = references if all_references is None else all_references
    out = references
    for f in fields:
        counts = base.groupBy("country", f).agg(_number(base).alias(f"_{f}"))
        out = out.join(counts, ["country", f], "left")
    return out.select(*references.columns, *[_log_count(F.coalesce(F.col(f"_{f}"), F.lit(0)), F.col(f)).alias(f"reference_{f}_frequency") for f in fields])


def source_profile(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by (country, core) and by (country, core, address)."""
    return tuple(sources.groupBy("country", *c).agg(F.count(F.lit(1)).alias("n")) for c in (["core"], ["core", "address"]))


def with_source_frequencies(sources: DataFrame) -> DataFrame:
    """``sources`` with source_core_frequency and source_core_address_frequency."""
    counted = _counted(sources, {"_c": ["country", "core"], "_ca": ["country", "core", "address"]})
    log = lambda c: F.log1p(F.least(F.lit(1000), F.col(c)).cast("double"))
    return counted.select(*sources.columns, log("_c").alias("source_core_frequency"), log("_ca").alias("source_core_address_frequency"))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets, 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def contained(a: Column, b: Column) -> Column:
    """Share of the smaller set that is common."""
    smaller = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), smaller)


def spread(pairs: DataFrame) -> DataFrame:
    """``pairs`` dealt out by pair: Spark sizes tasks by bytes, but comparing strings costs time, and hot anchors have many pairs.

    By a hash of the pair: dealt by its columns, as ``distinct`` leaves them, Spark takes the two for one and coalesces both to a few tasks.
    """
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("anchor", "candidate"))


def scored_for_gate(pairs: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with s, the screening scores 0 to 100 of every pair."""
    return spread(pairs).withColumn("s", screen_scores())


def gate() -> Column:
    """Which pairs of ``scored_for_gate`` pass the broad filter. Two empty cores are alike here; empty addresses are not."""
    some = lambda f: (F.col(f"x.{f}") != "") & (F.col(f"y.{f}") != "")
    core = (F.greatest("s.core_ratio", "s.core_sort") >= 45) | (some("core") & (F.col("s.core_set") >= 85))
    return core | (some("address") & ((F.col("s.address_sort") >= 55) | (F.col("s.address_set") >= 85)))


def _both(field: str) -> Column:
    return (F.col(f"x.{field}") != "") & (F.col(f"y.{field}") != "")


def _score(field: str, score: str, top: float = 100.0) -> Column:
    return F.when(_both(field), F.col(score) / top).otherwise(0.0)


def screen_columns() -> dict[str, Column]:
    """The columns of the screening model."""
    out = {n: _score(n.split("_")[0], f"s.{n}") for n in SCREEN_COLUMNS[:7]}
    out |= {f"{f}_missing": (~_both(f)).cast("double") for f in ("core", "address")}
    out |= {c: F.col(f"x.{c}") for c in REFERENCE_COLUMNS} | {c: F.col(f"y.{c}") for c in SOURCE_COLUMNS}
    return {c: out[c] for c in SCREEN_COLUMNS}


def _set_columns(field: str) -> dict[str, Column]:
    a, b = F.col(f"x.{field}"), F.col(f"y.{field}")
    ta, tb = tokens(a), tokens(b)
    return {
        f"{field}_jaccard": overlap(ta, tb),
        f"{field}_contain": contained(ta, tb),
        f"{field}_length_ratio": F.least(F.length(a), F.length(b)) / F.greatest(F.lit(1), F.length(a), F.length(b)),
        f"{field}_exact": (_both(field) & (a == b)).cast("double"),
        f"{field}_missing": (~_both(field)).cast("double"),
    }


def number_columns() -> dict[str, Column]:
    """What the numbers in both addresses, and in both names, say."""
    na, nb = numbers(F.col("x.address")), numbers(F.col("y.address"))
    ma, mb = F.array_sort(F.array_distinct(numbers(F.col("x.name")))), F.array_sort(F.array_distinct(numbers(F.col("y.name"))))
    some = (F.size(na) > 0) & (F.size(nb) > 0)
    shared = F.size(F.array_intersect(na, nb))
    return {
        "number_jaccard": overlap(na, nb),
        "number_conflict": (some & (shared == 0)).cast("double"),
        "number_common": shared.cast("double"),
        "number_missing": (~some).cast("double"),
        "first_number_equal": F.coalesce(some & (F.get(na, F.lit(0)) == F.get(nb, F.lit(0))), F.lit(False)).cast("double"),
        "name_number_conflict": ((F.size(ma) > 0) & (F.size(mb) > 0) & (ma != mb)).cast("double"),
    }


def unmatched_number_columns() -> dict[str, Column]:
    """Contrasts of the address numbers that only one side has; those of 12 and more digits have no value to compare."""
    na, nb = numbers(F.col("x.address")), numbers(F.col("y.address"))
    da, db = F.array_except(na, nb), F.array_except(nb, na)
    value = lambda n: F.transform(F.filter(n, lambda w: F.length(w) < 12), lambda w: w.cast("bigint"))
    near = F.array_min(F.flatten(F.transform(value(da), lambda u: F.transform(value(db), lambda v: F.abs(u - v)))))
    return {
        "unmatched_left_numbers": F.size(da).cast("double"),
        "unmatched_right_numbers": F.size(db).cast("double"),
        "number_delta_log": F.log1p(F.least(F.coalesce(near, F.lit(0)), F.lit(1_000_000)).cast("double")),
        "number_near_miss": F.coalesce(near <= 2, F.lit(False)).cast("double"),
    }


#: Scores of ``FULL_SCORES`` that stand in columns of another name.
_SCORES_OF = {
    "compact_name_ratio": "compact_ratio", "compact_name_partial": "compact_partial", "name_substitution_rate": "replaced", "name_insertion_rate": "inserted",
    "name_deletion_rate": "deleted", "worst_name_token_similarity": "worst_token", "mean_name_token_similarity": "mean_token",
}


def model_columns(pairs: DataFrame, columns: list[str] = MODEL_COLUMNS) -> DataFrame:
    """``pairs`` (x, y, s) with the columns of the main model, in order, or some of them: no others are computed. x and y carry their frequencies."""
    asked = {_SCORES_OF.get(c, c) for c in columns}
    rows, names = pairs, [n for n in FULL_SCORES if n in asked]
    if names:
        rows = rows.withColumn("f", full_scores(names))
    if "unmatched_number_similarity" in columns:
        na, nb = numbers(F.col("x.address")), numbers(F.col("y.address"))
        rows = rows.withColumn("_un", best_number_ratio(F.array_except(na, nb), F.array_except(nb, na)))
    made: dict[str, Column] = {}
    for field in ("name", "core", "address"):
        ours = lambda score: "s" if f"{field}_{score}" in SCREEN_COLUMNS[:7] else "f"  # noqa: E731, B023
        made |= {f"{field}_{k}": _score(field, f"{ours(k)}.{field}_{k}", 1.0 if k == "jw" else 100.0) for k in ("ratio", "sort", "set", "partial", "jw")}
        made |= _set_columns(field)
    made |= number_columns() | unmatched_number_columns()
    made |= {
        "name_length": F.least(F.length("x.name"), F.length("y.name")).cast("double"),
        "address_length": F.least(F.length("x.address"), F.length("y.address")).cast("double"),
        "source3": F.col("candidate").startswith("S3").cast("double"),
        "name_addr_product": _score("core", "s.core_ratio") * _score("address", "s.address_ratio"),
        "compact_name_ratio": _score("core", "f.compact_ratio"),
        "compact_name_partial": _score("core", "f.compact_partial"),
        "unmatched_number_similarity": F.col("_un"),
    }
    longest = F.greatest(F.lit(1), F.length(compact(F.col("x.core"))), F.length(compact(F.col("y.core"))))
    made |= {f"name_{k}_rate": F.col(f"f.{v}") / longest for k, v in (("substitution", "replaced"), ("insertion", "inserted"), ("deletion", "deleted"))}
    made |= {"worst_name_token_similarity": F.col("f.worst_token"), "mean_name_token_similarity": F.col("f.mean_token")}
    made |= {c: F.col(f"x.{c}") for c in REFERENCE_COLUMNS} | {c: F.col(f"y.{c}") for c in SOURCE_COLUMNS}
    assert set(made) == {*BASE_COLUMNS, *EXTRA_COLUMNS, *REFERENCE_COLUMNS, *SOURCE_COLUMNS}
    rest = [c for c in pairs.columns if c not in MODEL_COLUMNS]
    return rows.select(*rest, *[made[c].alias(c) for c in columns])
