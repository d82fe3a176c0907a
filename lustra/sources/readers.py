"""Bronze input: CSV folders as streams, stored tables as batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lustra.operators.columns import normalize_columns


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or parquet files if the argument is a path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def stream_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as a stream; files need a schema and take the stored one if none is given."""
    if "/" not in name_or_path:
        return spark.readStream.table(name_or_path)
    known = schema if schema is not None else spark.read.parquet(name_or_path).schema
    return spark.readStream.schema(known).parquet(name_or_path)


def infer_csv_schema(spark: SparkSession, folder: str) -> T.StructType:
    """Column types of the CSV files there now, from all of their lines.

    Inference reads the data once; a job at scale passes a declared schema to
    :func:`stream_csv` instead.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(folder).schema


def add_lineage(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Record the source file and the time of ingestion of each row."""
    return df.withColumns(
        {
            "ingested_file": F.col("_metadata.file_path"),
            "ingestion_ts": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )


def stream_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None = None,
    max_files_per_batch: int | None = None,
    misfits: str | None = "misfit_line",
) -> DataFrame:
    """Bronze stream of a CSV folder: each file once, lineage added, names cleaned.

    A file whose header names other columns than the schema, or in another order, fails
    the stream: values never land under a wrong name. A line with values of another
    type, or with more or fewer of them, has NULLs where it does not fit, and its whole
    text in the column ``misfits``; only with ``misfits=None`` is it lost.
    """
    reader = spark.readStream.option("header", True).option("enforceSchema", False)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    known = schema if schema is not None else infer_csv_schema(spark, folder)
    if misfits is not None:
        known = T.StructType([*known.fields, T.StructField(misfits, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", misfits)
    return normalize_columns(add_lineage(reader.schema(known).csv(folder)))
