"""What the operators share: written tables, word hashes, samples of labels."""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import dropped, new_folder

#: White space of every operator here: space and the characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def cut(df: DataFrame, *older: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: a table in the shared folder, read again. Tables that it takes the place of go.

    A checkpoint would carry the constraints of the plan it cuts along; over the rounds of an
    iteration they outgrow the driver. A table has none.
    """
    return written(df, "cut", *older)


def written(df: DataFrame, name: str, *older: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, read again: for wide rows. The tables ``older``, made here too and read no more, are removed."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    for x in older:
        dropped(spark, x._folder)
    return out


def released(spark: SparkSession) -> None:
    """After many small tables: the driver collects garbage, so Spark removes shuffle files and broadcasts that no plan holds any more. It does so by itself each half hour only."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows and bytes that go to a Python worker at a time; a single row may be larger.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def modest(df: DataFrame) -> DataFrame:
    """``df``; its session's Arrow batches are made no larger than ours, as texts have any length: the default holds 10,000 of them."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(conf.get(name).rstrip("bB"))
        if not 0 < now <= most:
            conf.set(name, str(most))
    return df


#: Rows of a table that may be broadcast; they are counted first.
BROADCAST_ROWS = 200_000


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has no more than ``rows`` rows; else Spark joins it as it finds best."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words_of(text: Column) -> Column:
    """The runs of other characters than white space, as an array; null text has none."""
    clean = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(F.length(clean) == 0, F.array().cast("array<string>")).otherwise(F.split(clean, BLANK_RUN))


def uniform(*columns: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the values alone."""
    return (F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def word_hashes(text: str | None) -> np.ndarray:
    """CRC-32 of each word of the lower-cased text, as uint32."""
    return np.fromiter(map(zlib.crc32, (text or "").lower().encode("utf-8", "replace").split()), np.uint32)


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: a worker then holds few texts at a time as Python objects."""
    for b in batches:
        if not len(b):
            yield b
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of uint64 values (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Chunks whose pieces a worker remembers at most.
CACHE = 150_000


class Pieces(dict):
    """CRC-32 values (bytes, uint32) of the words and the marks in a chunk of lower-cased text."""

    def shorten(self) -> None:
        if len(self) > CACHE:
            self.clear()

    def __missing__(self, chunk: bytes) -> bytes:
        self.shorten()
        if chunk.isalnum():
            made = zlib.crc32(chunk).to_bytes(4, "little")
        else:
            made = b"".join([zlib.crc32(x.encode()).to_bytes(4, "little") for x in PIECE.findall(chunk.decode())])
        self[chunk] = made
        return made


PIECE = re.compile(r"\w+|[^\w\s]+")
_pieces = Pieces()


def forget() -> None:
    """At the end of a task: what its worker remembered of words, and memory it holds in reserve, are for the tasks of other stages."""
    _pieces.clear()
    pa.default_memory_pool().release_unused()


def pieces(text: str | None) -> np.ndarray:
    """The words and the runs of marks of a text, lower-cased, as uint32 CRC-32 values."""
    chunks = (text or "").lower().encode("utf-8", "replace").split()
    return np.frombuffer(b"".join(map(_pieces.__getitem__, chunks)), "<u4")


def labelled(labels: DataFrame, label: str = "quality") -> DataFrame:
    """_doc, _good of every labelled document. Null ids and labels are left out; a document labelled twice is good if all its labels are."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_doc")).agg((F.min(label) > 0).alias("_good"))


def label_sample(labels: DataFrame, rows: int, label: str = "quality") -> tuple[DataFrame, float]:
    """(_doc, _good) of at most ``rows`` labelled documents, by hash of the id, and the share of good ones of all.

    Of those that ``labelled`` finds. Without labels the share is 1.
    """
    each = labelled(labels, label)
    share = each.agg(F.avg(F.col("_good").cast("double"))).first()[0]
    return each.orderBy(uniform("_doc", seed=3), "_doc").limit(rows), 1.0 if share is None else share
