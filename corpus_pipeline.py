"""From raw documents to packed sequences: five stages, each written and read by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. It works on every row its
predecessor kept, and all but the last return the columns of documents. Stages don't
read what an earlier stage read: a part that fails is done again from the written table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowkin.llm import exact_dedup, mixing, near_dedup, packing, quality_classifier
from rowkin.llm.common import written

#: SQL can't express the classifier, the sketches or the tokens.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps: by the labels' good share, those with the largest noisy log ratios.

    Null or blank text has log ratio 0; a null id draws the middle of the noise; rows that repeat draw alike, ties stay
    together. An empty table gives an empty one. Columns are unchanged, whatever their names.
    """
    return quality_classifier.selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space: the longest, then the smallest id, null ids last.

    Null text counts as empty; of rows that repeat one in everything, one stays. An empty table gives an empty one.
    """
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the smallest id; a row without an id only where none has one.

    Texts without a word (null, blank) are one class. An empty table gives an empty one.
    """
    return near_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, none to two times. A null source is a source; rows without a word stay once.

    Rows that repeat share their copies evenly. An empty table gives an empty one.
    """
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in windows of 4096 tokens, each source with its share of every window.

    Null or empty text is its end token alone; each row is packed for itself, also where it repeats another or lacks an id or
    source. An empty table gives no piece.
    """
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of ``documents``; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
