"""Readers of tables and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a folder; only the columns and rows that a query asks for are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
