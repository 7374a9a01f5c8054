"""Candidate pairs: an equi-join on families of keys whose document frequency is capped.

A record's keys are one array of (tag, key), made by built-in functions. A key counts only if at
most its family's cap of reference records of the country hold it. Joining on country and key
keeps any country's weight spread over its keys; the cap bounds what a key can bring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import KEY_CAPS
from ..functions.normalize import compact, numbers, tokens
from ..sources.shared import written


def _left(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def _pairs(items: Column, use) -> Column:
    """``use(u, v)`` for each two items of an array, the earlier first."""
    return F.flatten(F.transform(items, lambda u, i: F.transform(F.filter(items, lambda v, j: j > i), lambda v: use(u, v))))


def _word(x: Column) -> Column:
    return ~x.rlike("^[0-9]+$")


def _parts() -> dict[str, Column]:
    return {
        "_t": F.array_distinct(tokens(F.col("core"))),
        "_at": tokens(F.col("address")),
        "_n": numbers(F.col("address")),
        "_k": compact(F.col("core")),
    }


def _families() -> dict[str, Column]:
    """tag: array of the keys of its family, over the columns of a record and ``_parts``."""
    name, core, address, t, at, n, k = (F.col(c) for c in ("name", "core", "address", "_t", "_at", "_n", "_k"))
    one = lambda ok, key: F.when(ok, F.array(key)).otherwise(F.array().cast("array<string>"))
    ts = F.array_sort(t)
    first8, first4 = F.slice(ts, 1, 8), F.slice(ts, 1, 4)
    joined = lambda u, v: F.concat(u, F.lit(":"), v)
    by_text = F.slice(F.array_sort(F.array_distinct(n)), 1, 6)
    words = F.array_distinct(at)
    sorted_name = F.array_join(ts, " ")
    following = F.transform(at, lambda u, i: F.struct(u.alias("u"), F.get(at, i + 1).alias("v")))
    side = lambda x: (F.length(x) >= 3) & _word(x)
    return {
        "n": one(name != "", name),
        "c": one(core != "", core),
        "s": one(sorted_name != "", sorted_name),
        "a": one(address != "", address),
        "p": one(F.length(core) >= 5, _left(core, 6)),
        "q": one(F.length(core) >= 5, F.right(core, F.lit(6))),
        "t": F.filter(t, lambda w: F.length(w) >= 3),
        "w": F.transform(F.filter(t, lambda w: F.length(w) >= 6), lambda w: F.concat(_left(w, 4), F.right(w, F.lit(2)))),
        "j": _pairs(first8, joined),
        "k": _pairs(F.filter(first8, lambda w: F.length(w) >= 4), lambda u, v: joined(_left(u, 4), _left(v, 4))),
        "m": one(k != "", k),
        "f": one(F.length(k) >= 7, _left(k, 8)),
        "h": one(F.size(at) >= 2, F.array_join(F.slice(at, 1, 3), " ")),
        "b": F.filter(words, lambda w: (F.length(w) >= 5) & _word(w)),
        "e": F.transform(F.filter(following, lambda p: p["v"].isNotNull() & side(p["u"]) & side(p["v"])), lambda p: joined(p["u"], p["v"])),
        "d": F.flatten(F.transform(F.array_distinct(F.slice(n, 1, 3)), lambda x: F.transform(F.filter(words, lambda w: (F.length(w) >= 4) & _word(w)), lambda w: joined(x, w)))),
        "v": _pairs(by_text, joined),
        "x": F.flatten(F.transform(F.filter(first4, lambda w: F.length(w) >= 3), lambda w: F.transform(by_text, lambda x: joined(_left(w, 4), x)))),
    }


def _tagged(tag: str, found: Column) -> Column:
    return F.transform(F.array_distinct(found), lambda x: F.struct(F.lit(tag).alias("tag"), x.alias("key")))


def keys(records: DataFrame, tags: list[str] | None = None, keep: tuple[str, ...] = ("entity_id", "country")) -> DataFrame:
    """``keep``, tag, key: every different key of each record, of the families ``tags`` (all by default)."""
    found = _families()
    parts = records.withColumns(_parts())
    all_ = F.flatten(F.array(*[_tagged(t, found[t]) for t in tags or found]))
    return parts.select(*keep, F.explode(all_).alias("_key")).select(*keep, "_key.tag", "_key.key")


#: Members of a class of like records that one row holds, about.
MEMBERS = 256


def classes(records: DataFrame) -> DataFrame:
    """A row for records that differ by id alone: the least id, their columns, members (their ids) and alike (their number).

    What is said of two records but for their ids is then said once for two classes, and ``expanded`` says it of each pair.
    A class of more than about ``MEMBERS`` records is dealt to several rows, by a hash of the id. ``records`` may be classes
    that have become alike since (they have members and alike): such are made one.
    """
    same = [c for c in records.columns if c not in ("entity_id", "members", "alike")]
    n, ids = (F.sum("alike"), F.flatten(F.collect_list("members"))) if "members" in records.columns else (F.count(F.lit(1)), F.collect_list("entity_id"))
    # A table, so that Spark sees how few they are, and does not move the records to meet them.
    sizes = written(records.groupBy(*same).agg(n.alias("_n")).where(F.col("_n") > MEMBERS), "sizes")
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"z.{c}")) for c in same]
    dealt = records.alias("r").join(sizes.alias("z"), on, "left").select("r.*", F.pmod(F.xxhash64("entity_id"), F.ceil(F.coalesce("_n", F.lit(1)) / MEMBERS)).alias("_part"))
    made = dealt.groupBy(*same, "_part").agg(F.min("entity_id").alias("_id"), ids.alias("members"), n.alias("alike"))
    return made.select(F.col("_id").alias("entity_id"), *same, "members", "alike")


def expanded(pairs: DataFrame) -> DataFrame:
    """``pairs`` of classes (members of both sides in _x and _y) as pairs of records: anchor and candidate first."""
    rest = [c for c in pairs.columns if c not in ("_x", "_y")]
    one = pairs.select(F.explode("_x").alias("anchor"), "_y", *rest)
    return one.select("anchor", F.explode("_y").alias("candidate"), *rest)


def cap_of(tag: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in KEY_CAPS.items() for x in pair]), tag)


def key_frequencies(reference_keys: DataFrame) -> DataFrame:
    """country, tag, key, df: the number of reference records that hold each key (``alike`` of them in a row, if there is such a column)."""
    n = F.sum("alike") if "alike" in reference_keys.columns else F.count(F.lit(1))
    return reference_keys.groupBy("country", "tag", "key").agg(n.alias("df"))


def usable_keys(reference_keys: DataFrame) -> DataFrame:
    """``key_frequencies`` of keys at or under their family's cap."""
    return key_frequencies(reference_keys).where(F.col("df") <= cap_of(F.col("tag")))


def postings(references: DataFrame, all_references: DataFrame | None = None) -> DataFrame:
    """country, tag, key, anchor of usable keys. ``all_references``: whom to count, where ``references`` is a sample of them."""
    counted = lambda r: keys(r, keep=("entity_id", "country", *(c for c in r.columns if c == "alike")))
    usable = usable_keys(counted(references if all_references is None else all_references))
    return keys(references).join(usable, ["country", "tag", "key"], "left_semi").withColumnRenamed("entity_id", "anchor")


def routes(references: DataFrame, sources: DataFrame, all_references: DataFrame | None = None) -> DataFrame:
    """anchor, candidate, tag, key: every way in which blocking finds a pair."""
    probe = keys(sources).withColumnRenamed("entity_id", "candidate")
    return postings(references, all_references).join(probe, ["country", "tag", "key"]).select("anchor", "candidate", "tag", "key")


def candidates(references: DataFrame, sources: DataFrame, all_references: DataFrame | None = None) -> DataFrame:
    """anchor, candidate: pairs that share a usable key in a country, once each."""
    return routes(references, sources, all_references).select("anchor", "candidate").distinct()


def paired(pairs: DataFrame, references: DataFrame, sources: DataFrame) -> DataFrame:
    """``pairs`` with the records of both sides as structs x and y (and further columns of the records inside them)."""
    x = references.select(F.col("entity_id").alias("anchor"), F.struct(*references.columns).alias("x"))
    y = sources.select(F.col("entity_id").alias("candidate"), F.struct(*sources.columns).alias("y"))
    return pairs.join(x, "anchor").join(y, "candidate")
