"""The given tables as the operators want them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.times import whole_seconds
from candlewright.operators.channels import with_username
from candlewright.sources.tables import read_table

#: What tells a message from another: the channel, its own count and the second.
MESSAGE = ["username", "id", "created_s"]

#: The same in DuckDB's SQL: rows of telegram_messages with username and created_s.
NAMED_SQL = """
spelled AS (
  SELECT lower(username) AS spelled, username FROM telegram_channels WHERE NOT regexp_full_match(username, '[0-9]+')
  UNION ALL SELECT CAST(id AS VARCHAR), username FROM telegram_channels
),
named AS (
  SELECT c.username, m.*, epoch_us(m.created_at) // 1000000 AS created_s
  FROM telegram_messages m LEFT JOIN spelled c ON lower(regexp_replace(trim(m.channel_name), '^@+', '')) = c.spelled
)
"""


def named_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of telegram_messages with ``username`` and ``created_s``."""
    messages = read_table(spark, folder, "telegram_messages").withColumn("created_s", whole_seconds(F.col("created_at")))
    return with_username(messages, read_table(spark, folder, "telegram_channels"), "channel_name")
