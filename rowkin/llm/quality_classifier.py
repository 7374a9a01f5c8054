"""A quality classifier by importance resampling.

Two generative models over hashed n-grams (words and pairs of words), one of target text (a
bounded sample of documents labelled good), one of all raw text, give each document the log
ratio of its probabilities. The documents with the k largest sums of log ratio and Gumbel noise
stay: a sample without replacement in proportion to the ratios. k is the good share of the
labels times the number of documents. The noise is a hash of the id, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut, forget, label_sample, mix64, modest, pieces, released, small, uniform

BUCKETS = 1 << 16
#: Labelled documents that the target model is fitted on, at most.
LABEL_ROWS = 20_000
#: Share of the raw model in the target model's mixture.
SMOOTH = 0.1
#: Read in place of a word that repeats the word before it.
REPEAT = np.uint32(1)
#: Keys are compared in steps of 1 / SCALE.
SCALE = 1_000_000


def features(text: str | None) -> np.ndarray:
    """Bucket numbers of the n-grams of a text."""
    h = pieces(text)
    if not len(h):
        return np.empty(0, np.int64)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    h = np.where(same, REPEAT, h).astype(np.uint64)
    return (mix64(np.concatenate([h, h[:-1] << np.uint64(32) | h[1:]])) % np.uint64(BUCKETS)).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[np.ndarray, float]:
    """Log ratio of each bucket (float64), and the good share of the labels.

    The raw model counts every document. Without good labelled documents all ratios are 0.
    """
    sample, share = label_sample(labels, LABEL_ROWS)
    marked = modest(docs).select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(sample), "_doc", "left").select("_text", F.coalesce("_good", F.lit(False)).alias("_good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BUCKETS), np.int64)
        for b in small(batches):
            good: list[list[np.ndarray]] = [[], []]
            for x, g in zip(b.column("_text").to_pylist(), b.column("_good").to_pylist()):
                good[g].append(features(x))
            for g in (0, 1):
                if good[g]:
                    found[g] += np.bincount(np.concatenate(good[g]), minlength=BUCKETS)
        forget()
        for g in (0, 1):
            at = np.flatnonzero(found[g])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, np.int32)), pa.array(at), pa.array(found[g][at])], ["good", "bucket", "n"])

    got = marked.mapInArrow(count, "good int, bucket long, n long").groupBy("good", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, BUCKETS))
    counts[got["good"], got["bucket"]] = got["n"]
    return log_ratio(counts[1], counts.sum(0)), share


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(raw))
    p_raw = (raw + 1) / (raw.sum() + len(raw))
    p_target = (1 - SMOOTH) * target / target.sum() + SMOOTH * p_raw
    return np.log(p_target / p_raw)


def scored(rows: DataFrame, ratios: np.ndarray, text: Column | str, doc_id: Column, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and log_ratio, key (log ratio and noise, in whole steps). Null or blank text: log_ratio 0.

    ``text`` is a column, or the name of a field of the struct _row, which ``keep`` then holds: a text goes to Python once.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    inside, field = isinstance(text, str), text if isinstance(text, str) else ""
    plain = rows.select(*keep, *([] if inside else [text.alias("_text")]), F.coalesce(uniform(doc_id, seed=6), F.lit(0.5)).alias("_u"))
    schema = StructType([f for f in plain.schema.fields if f.name != "_text"])
    names, kinds = list(schema.names), to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in small(batches):
                texts = pc.struct_field(b.column("_row"), [b.schema.field("_row").type.get_field_index(field)]) if inside else b.column("_text")
                made = [float(ratios[features(x)].sum()) for x in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kinds.names], pa.array(made, pa.float64())], [*kinds.names, "log_ratio"])
        finally:
            forget()

    out = plain.mapInArrow(score, schema.add("log_ratio", "double"))
    key = F.floor((F.round("log_ratio", 6) - F.log(-F.log("_u"))) * SCALE).cast("long")
    return out.withColumn("key", key).select(*[n for n in names if n != "_u"], "log_ratio", "key")


def kth_largest(keys: DataFrame, k: int, fan: int = 4096) -> int | None:
    """The k-th largest of the column key, exactly, by counts of ``fan`` ranges at a time; None if k is 0 or more than there are."""
    if k <= 0:
        return None
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return None
    left = k
    while True:
        width = max(1, -(-(high - low + 1) // fan))
        slot = F.expr(f"(key - ({low}L)) div {width}L")
        counts = keys.where(F.col("key").between(low, high)).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: -r["slot"]):
            if r["n"] >= left:
                low, high = low + r["slot"] * width, min(high, low + (r["slot"] + 1) * width - 1)
                break
            left -= r["n"]
        else:
            return None
        if width == 1:
            return low


def resampled(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", share: float | None = None) -> DataFrame:
    """doc_id, log_ratio, key, kept of each row. Rows that tie at the k-th key are all kept. An empty table gives an empty result."""
    ratios, found = fit(docs, labels, text, doc_id)
    made = cut(scored(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")), ratios, F.col("_t"), F.col("_id"), ("_id",)))
    least = kth_largest(made, round(made.count() * (found if share is None else share)))
    return made.select(F.col("_id").alias(doc_id), "log_ratio", "key", (F.col("key") >= least if least is not None else F.lit(False)).alias("kept"))


def selected(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", share: float | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged. Nothing is shuffled but counts."""
    ratios, found = fit(docs, labels, text, doc_id)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    all_ = scored(rows, ratios, text, F.col(f"_row.`{doc_id}`"), ("_row",))
    keys = cut(all_.select("key"))
    least = kth_largest(keys, round(keys.count() * (found if share is None else share)))
    released(docs.sparkSession)
    return all_.where(F.col("key") >= least if least is not None else F.lit(False)).select("_row.*")
