"""Coins that messages mention, the items of the pairing and co-occurrence queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.text import strip
from candlewright.plans.feeds import MESSAGE, named_messages

#: The coins of each message, one row per message and coin, in DuckDB's SQL, after ``NAMED_SQL``.
MENTIONS_SQL = """
mentions AS (
  SELECT DISTINCT username, id, created_s, coin FROM (
    SELECT username, id, created_s, upper(trim(regexp_replace(trim(c), '^[$#]', ''))) AS coin
    FROM named, UNNEST(coins_mentioned) AS u(c)
  ) WHERE coin IS NOT NULL AND coin <> ''
)
"""


def clean_coins(coins: Column) -> Column:
    """The distinct coins of an array of loosely written ones, in order; empty for NULL.

    Elements are trimmed, lose one leading ``$`` or ``#`` and are upper-cased. NULL and empty ones go.
    """
    written = F.transform(coins, lambda c: F.upper(strip(F.regexp_replace(strip(c), r"^[$#]", ""))))
    kept = F.filter(written, lambda c: c.isNotNull() & (c != ""))
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def message_coins(spark: SparkSession, folder: str) -> DataFrame:
    """Each message once, with its ``coins`` (distinct and in order; perhaps none)."""
    rows = named_messages(spark, folder).select(*MESSAGE, clean_coins(F.col("coins_mentioned")).alias("coins"))
    return rows.distinct()
