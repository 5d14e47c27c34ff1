"""Readers of the tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewright.session import use_utc


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``: one file or a folder of files."""
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
