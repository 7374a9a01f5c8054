"""Language identification by rank-order profiles.

A profile is the list of a language's ``TOP`` most frequent character n-grams, most frequent
first. A document's own list is compared to each profile by the out-of-place distance: the
sum over its n-grams of the difference of ranks, ``TOP`` for one that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import modest, small, uniform

TOP, ORDERS = 300, 3
#: Labelled rows of a language that its profile is learned from, about.
LEARN_ROWS = 2000
UNKNOWN = "und"
_GAP = ord("_")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of 1 to ``ORDERS`` characters; runs of other characters than letters are one gap."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    known = letters()[points]
    if not known.any():
        return np.empty(0, np.int64)
    keep = known.copy()
    keep[1:] |= known[:-1]
    points = np.where(known, points, _GAP)[keep].astype(np.int64)
    if known[0]:
        points = np.concatenate([[_GAP], points])
    if points[-1] != _GAP:
        points = np.append(points, _GAP)
    out, code = [points[points != _GAP]], points
    for n in range(1, ORDERS):
        code = code[:-1] << 21 | points[n:]
        out.append(code)
    return np.concatenate(out)


def ranked(codes: np.ndarray) -> np.ndarray:
    """The ``TOP`` most frequent codes, ties by code."""
    found, n = np.unique(codes, return_counts=True)
    if len(found) > TOP:  # no rarer n-gram can be among the first
        least = np.partition(n, len(n) - TOP)[len(n) - TOP]
        found, n = found[n >= least], n[n >= least]
    return found[np.lexsort((found, -n))][:TOP]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", rows: int = LEARN_ROWS) -> dict[str, np.ndarray]:
    """language: its profile, from about ``rows`` rows of each language, chosen by hash of the id.

    Rows of null language or without a letter teach nothing. The profiles (``TOP`` codes a
    language) are all that reaches the driver.
    """
    plain = modest(labelled).where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    n = {r["lang"]: r["n"] for r in plain.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return {}
    share = F.create_map(*[F.lit(x) for k, v in sorted(n.items()) for x in (k, min(1.0, rows / v))])
    chosen = plain.where(F.coalesce(uniform("_id", seed=5), F.lit(0.5)) < F.element_at(share, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            by: dict[str, list] = {}
            for k, x in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by.setdefault(k, []).append(grams(x))
            for k, found in by.items():
                codes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    counts = chosen.select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top: pd.DataFrame = counts.withColumn("r", place).where(F.col("r") <= TOP).toPandas()
    return {k: x.sort_values("r")["code"].to_numpy(np.int64) for k, x in sorted(top.groupby("lang"))}


def predict(text: str | None, profiles: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[str, float]:
    """Language and score: 1 less the distance as a share of the greatest possible. Ties: the first by name."""
    own = ranked(grams(text))
    if not len(own) or not profiles:
        return UNKNOWN, 0.0
    best, least, at = UNKNOWN, np.inf, np.arange(len(own))
    for name, (codes, rank) in profiles.items():
        i = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        far = np.where(codes[i] == own, np.minimum(np.abs(rank[i] - at), TOP), TOP).sum()
        if far < least:
            best, least = name, far
    return best, float(1 - least / (TOP * len(own)))


def identified(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and lang_pred, score. Null text or text without a letter: 'und', 0. Whole texts are read."""
    ready = {k: (v[o := np.argsort(v)], o) for k, v in profiles.items() if len(v)}
    plain = modest(docs).select(*keep, F.col(text).alias("_text"))
    schema = plain.drop("_text").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            made = [predict(x, ready) for x in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in arrow.names], pa.array([x for x, _ in made], pa.string()), pa.array([y for _, y in made], pa.float64())], [*arrow.names, "lang_pred", "score"])

    return plain.mapInArrow(tell, schema.add("lang_pred", "string").add("score", "double"))
