"""Tables and databases in the session's catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from candlewright.schemas import TABLES


def create_databases(spark: SparkSession, names: str) -> list[str]:
    """Create each database of a comma-separated list that isn't there yet; gives their names."""
    wanted = [n.strip() for n in names.split(",") if n.strip()]
    for name in wanted:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return wanted


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Create the stored tables that aren't there yet; the candle tables are laid out by coin and timeframe."""
    for name, schema in TABLES.items():
        layout = "PARTITIONED BY (timeframe)" if "timeframe" in schema.names else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_columns(schema)}) USING parquet {layout}")
    return list(TABLES)


def drop_tables(spark: SparkSession, database: str = "default") -> None:
    """Drop the stored tables, those that refer to others first."""
    for name in reversed(TABLES):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
