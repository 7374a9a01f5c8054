"""The folder that all executors share, and tables written there once and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only where it is unset (tests, local mode) one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rowkin-"))
    return context._jsc.sc().getCheckpointDir().get()


def file_system(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends, or before by ``dropped``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place, system = file_system(spark, path)
    system.deleteOnExit(place)
    return path


def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the shared folder, read again: its lineage is cut, and lost executors cost no more than a read."""
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def dropped(spark: SparkSession, path: str) -> None:
    place, system = file_system(spark, path)
    system.delete(place, True)


def signature(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(name, size, time of change) of every file under ``paths``, in order."""
    out = []
    for path in paths:
        place, system = file_system(spark, path)
        files = system.listFiles(place, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)
