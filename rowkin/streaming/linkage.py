"""Stream-static linkage: source files as they come, against the references' postings.

All candidates of a source record lie in its own micro-batch, so distinct pairs of a batch are
distinct pairs of the stream; the checkpoint takes the place of progress files, and a batch
that is done again overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import records
from ..operators import blocking, features
from ..sources.shared import written


def read_stream(spark: SparkSession, path: str, schema, files_at_once: int = 8, form: str = "parquet", **options) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).options(**options).format(form).load(path)


def link_stream(raw: DataFrame, references: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes the gated candidates (anchor, candidate, country) of each batch of raw records under ``path``/batch=N."""
    own = written(references, "references")
    postings = written(blocking.postings(own), "postings")

    def batch(rows: DataFrame, number: int) -> None:
        sources = records(rows)
        probe = blocking.keys(sources).withColumnRenamed("entity_id", "candidate")
        pairs = postings.join(probe, ["country", "tag", "key"]).select("anchor", "candidate").distinct()
        made = features.scored_for_gate(blocking.paired(pairs, own, sources)).where(features.gate())
        made.select("anchor", "candidate", F.col("x.country").alias("country")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
