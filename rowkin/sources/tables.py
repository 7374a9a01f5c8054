"""Scans: TSV tables, truth, and record-linkage tables derived from the synthetic ones."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import ascii_fold, tokens
from .shared import file_system, signature

SOURCE_SCHEMA = "entity_id string, business_name string, business_address string, country string"
TRUTH_SCHEMA = "source1_entity_id string, matched_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str = SOURCE_SCHEMA) -> DataFrame:
    """A TSV with a header; quotes are doubled inside quotes, fields have any length, missing ones are ''."""
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "maxCharsPerColumn": -1, "enforceSchema": False}
    raw = spark.read.options(**options).schema(schema).csv(path)
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in raw.columns])


def source_path(folder: str, split: str, source: int) -> str:
    return f"{folder}/{split}/{split}_source{source}.tsv"


def read_sources(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """The reference table (source 1) and both source tables of a split, with their number."""
    parts = [read_tsv(spark, source_path(folder, split, i)).withColumn("source", F.lit(i)) for i in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH_SCHEMA)


def dealt(raw: DataFrame) -> DataFrame:
    """``raw`` dealt to all tasks: Spark sizes them by bytes, of which compressed tables have few, but to normalize a record costs time."""
    return raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("entity_id"))


#: Changes with what normalization makes of a record; older caches are then passed by.
VERSION = 2


def normalized(raw: DataFrame, inputs: list[str], path: str, refresh: bool = False) -> DataFrame:
    """Normalized records of ``raw``, written once by country and source under ``path``; later calls read them, a country alone if filtered by it.

    ``inputs`` are the files that ``raw`` reads. The folder's name holds their sizes and times of change and the version, so a
    table made of other ones is never read; a writer that ended early leaves no _SUCCESS mark, and is not trusted.
    """
    from ..functions.normalize import records

    spark = raw.sparkSession
    said = json.dumps([VERSION, raw.columns, signature(spark, inputs)])
    folder = f"{path}/{hashlib.sha256(said.encode()).hexdigest()[:16]}"
    mark, system = file_system(spark, f"{folder}/_SUCCESS")
    made = records(dealt(raw))
    if refresh or not system.exists(mark):
        made.write.mode("overwrite").partitionBy("country", "source").parquet(folder)
    # The empty country comes back from the folder's name as null.
    return spark.read.schema(made.schema).parquet(folder).select(*made.columns).fillna("", ["country"])


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as reference records, altered customers as source 2, suppliers as source 3.

    Of five customers one is found again as it is, one in upper case with a legal word, one without its
    last letter, one under another name, and one with its address in another order.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Few nations go to the customers, not customers to them, and these are dealt to all tasks: the table has few bytes for its rows.
    nations = F.broadcast(read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", F.lower("r_name").alias("country")))
    c = read("customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    number = (key * 7 % 1000).cast("string")
    address = F.concat_ws(" ", "c_mktsegment", "n_name", number)
    one = c.select(F.concat(F.lit("S1-"), key).alias("entity_id"), F.col("c_name").alias("business_name"), address.alias("business_address"), "country", F.lit(1).alias("source"))
    kind = key % 5
    name = (
        F.when(kind == 1, F.concat(F.upper("c_name"), F.lit(" Inc")))
        .when(kind == 2, F.substring("c_name", 1, F.length("c_name") - 1))
        .when(kind == 3, F.concat(F.lit("Trading "), key))
        .otherwise(F.col("c_name"))
    )
    moved = F.when(kind == 4, F.concat_ws(" ", number, "n_name", "c_mktsegment")).otherwise(address)
    two = c.select(F.concat(F.lit("S2-"), key).alias("entity_id"), name.alias("business_name"), moved.alias("business_address"), "country", F.lit(2).alias("source"))
    s = read("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    skey = F.col("s_suppkey")
    three = s.select(F.concat(F.lit("S3-"), skey).alias("entity_id"), F.col("s_name").alias("business_name"), F.concat_ws(" ", F.lit("HOUSEHOLD"), "n_name", (skey * 7 % 1000).cast("string")).alias("business_address"), "country", F.lit(3).alias("source"))
    return one.unionByName(two).unionByName(three)


def party_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source1_entity_id, matched_entity_ids: a customer's match is its altered self."""
    key = F.col("c_custkey")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("S1-"), key).alias("source1_entity_id"), F.concat(F.lit("S2-"), key).alias("matched_entity_ids"))


def document_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records made of documents: the first five words are the name, the next eight the address, the language is the country, doc_id tells the source."""
    words = tokens(F.regexp_replace(ascii_fold(F.lower("text")), "[^a-z0-9_]+", " "))
    source = (F.col("doc_id") % 3 + 1).cast("int")
    cut = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", source.alias("source"), words.alias("w"))
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    return cut.select(F.concat(F.lit("S"), "source", F.lit("-"), "doc_id").alias("entity_id"), part(1, 5).alias("business_name"), part(6, 8).alias("business_address"), F.col("lang").alias("country"), "source")
