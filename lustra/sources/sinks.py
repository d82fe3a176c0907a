"""Output: streaming tables, stored results and views."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None, comment: str | None = None
) -> None:
    """Declare a parquet table in the catalog before anything is written to it."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema, description=comment)


def write_stream_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to parquet files, exactly once per source row.

    ``once`` takes what is there and stops; otherwise the query keeps running.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def store(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Recompute and replace a stored result, then return it as stored.

    The new result is written beside the old one, which stays until the new one is
    whole; so a refresh that fails leaves what was there, and a result may be
    computed from its former state.
    """
    fresh = f"{path.rstrip('/')}.refresh-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(fresh)
    _swap(df.sparkSession, fresh, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a folder in the place of another; the former is put back if that fails."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, now, old = (hadoop(p) for p in (fresh, path, f"{fresh}.old"))
    files = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(now)
    if had and not files.rename(now, old):
        raise OSError(f"{path} can't be replaced")
    if not files.rename(new, now):
        if had:
            files.rename(old, now)
        raise OSError(f"{path} can't be replaced")
    if had:
        files.delete(old, True)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Give a frame a session name; it is evaluated anew by every query on it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
