"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lustra.sources.workspace import fresh_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, whatever executors are lost later."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
