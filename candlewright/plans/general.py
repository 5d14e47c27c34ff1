"""Queries of the general data problems: heavy keys, regular grids, repeated deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.times import period_seconds
from candlewright.operators.heavy_keys import heavy_keys, key_profile
from candlewright.operators.redelivery import one_copy_each
from candlewright.operators.regular_grid import regular_grid
from candlewright.plans.feeds import MESSAGE, NAMED_SQL, named_messages
from candlewright.sources.tables import read_table


def _channel_profile(spark: SparkSession, folder: str) -> DataFrame:
    return key_profile(named_messages(spark, folder), ["username"], "created_at", ties=["id"], quiet_seconds=3600)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Channels that hold at least 4 % of all stored rows."""
    stored = read_table(spark, folder, "telegram_messages")
    return heavy_keys(_channel_profile(spark, folder), stored, "0.04").where("username IS NOT NULL").select("username")


def p1_channel_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, first and last time, longest silence and bursts of every channel."""
    return _channel_profile(spark, folder)


def candle_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The closes of all series on their regular grid, holes filled or marked."""
    candles = read_table(spark, folder, "ohlcv").where("close IS NOT NULL AND close >= 0")
    return regular_grid(candles, ["coin", "timeframe"], "open_time", "close", period_seconds(F.col("timeframe")), latest="id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Grid instants without a usable candle, but for halts."""
    holes = candle_grid(spark, folder).where("status IN ('filled', 'unsupported')")
    return holes.select("coin", "timeframe", F.col("grid_s").cast("bigint").alias("grid_s"))


def p3_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The whole grid: observed closes as they are, holes filled, unsupported and halted stretches marked."""
    return candle_grid(spark, folder).drop("period_s")


def p3_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The observed cells and halts of the grid, whose values don't depend on the factors."""
    fixed = candle_grid(spark, folder).where("status IN ('observed', 'halt')")
    return fixed.select("coin", "timeframe", F.col("grid_s").cast("bigint").alias("grid_s"), "value", "status", "n_periods")


def _deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """What tells messages apart, and when each row was delivered."""
    return named_messages(spark, folder).select(*MESSAGE, "ingested_at")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Messages stored in more than one row."""
    kept = one_copy_each(_deliveries(spark, folder), MESSAGE, ["ingested_at"])
    return kept.where("copies > 1").select(*MESSAGE)


def p6_one_copy_each(spark: SparkSession, folder: str) -> DataFrame:
    """Each message once, its first stored row, with the number of its copies."""
    kept = one_copy_each(_deliveries(spark, folder), MESSAGE, ["ingested_at"])
    return kept.select(*MESSAGE, "ingested_at", "copies")


def p6_whole_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Each message once with all its columns, as its first delivery has them."""
    return one_copy_each(named_messages(spark, folder), MESSAGE, ["ingested_at"])


#: Deliveries from this day on are the new batch of p6_new_batch.
NEW_FROM = "2024-10-28"


def p6_new_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Each message once over the stored rows and a new batch; ``delivery`` tells whose copy is kept."""
    rows = _deliveries(spark, folder)
    stored, new = rows.where(f"ingested_at < '{NEW_FROM}'"), rows.where(f"ingested_at >= '{NEW_FROM}'")
    kept = one_copy_each(stored, MESSAGE, ["ingested_at"], new=new)
    return kept.select(*MESSAGE, "ingested_at", "delivery", "copies")


QUERIES = {f.__name__: f for f in (p1_found, p1_channel_profile, p3_found, p3_grid, p3_observed, p6_found, p6_one_copy_each, p6_whole_rows, p6_new_batch)}

_CELLS_SQL = """
timed AS (
  SELECT coin, timeframe, id, close, epoch_us(open_time) AS t,
    CAST(CASE timeframe WHEN '15m' THEN 900 WHEN '1h' THEN 3600 WHEN '4h' THEN 14400 WHEN '1d' THEN 86400 END AS BIGINT) AS p
  FROM ohlcv WHERE close IS NOT NULL AND close >= 0
),
cells AS (
  SELECT coin, timeframe, p, (2 * t + p * 1000000 - 1) // (2 * p * 1000000) AS slot,
    arg_max(CAST(close AS DOUBLE), row(id, CAST(close AS DOUBLE))) AS value
  FROM timed WHERE p IS NOT NULL AND t IS NOT NULL GROUP BY ALL
),
neighbours AS (
  SELECT *, lag(slot) OVER (PARTITION BY coin, timeframe ORDER BY slot) AS before FROM cells
)
"""

SQL = {
    "p1_found": f"""
WITH {NAMED_SQL}
SELECT username FROM named WHERE username IS NOT NULL GROUP BY username
HAVING count(*) * 100 >= 4 * (SELECT count(*) FROM telegram_messages)
""",
    "p1_channel_profile": f"""
WITH {NAMED_SQL},
steps AS (
  SELECT username, created_at, epoch_us(created_at) - lag(epoch_us(created_at)) OVER (PARTITION BY username ORDER BY created_at) AS step FROM named
)
SELECT username, count(*) AS n_rows, min(created_at) AS first_at, max(created_at) AS last_at, max(step) AS longest_gap_us,
  CAST(count(*) FILTER (step > 3600000000) + 1 AS BIGINT) AS n_bursts
FROM steps GROUP BY username
""",
    "p3_found": f"""
WITH {_CELLS_SQL}
SELECT coin, timeframe, CAST(g * p AS BIGINT) AS grid_s
FROM (SELECT * FROM neighbours WHERE (slot - before) * p <= 604800), UNNEST(range(before + 1, slot)) AS u(g)
""",
    "p3_observed": f"""
WITH {_CELLS_SQL}
SELECT coin, timeframe, CAST(slot * p AS BIGINT) AS grid_s, value, 'observed' AS status, CAST(1 AS BIGINT) AS n_periods FROM cells
UNION ALL
SELECT coin, timeframe, CAST((before + 1) * p AS BIGINT), NULL, 'halt', CAST(slot - before - 1 AS BIGINT)
FROM neighbours WHERE slot - before > 1 AND (slot - before) * p > 604800
""",
    "p6_found": f"""
WITH {NAMED_SQL}
SELECT username, id, created_s FROM named GROUP BY ALL HAVING count(*) > 1
""",
    "p6_one_copy_each": f"""
WITH {NAMED_SQL}
SELECT username, id, created_s, min(ingested_at) AS ingested_at, count(*) AS copies FROM named GROUP BY username, id, created_s
""",
    "p6_new_batch": f"""
WITH {NAMED_SQL}
SELECT username, id, created_s, min(ingested_at) AS ingested_at,
  CAST(CASE WHEN min(ingested_at) < '{NEW_FROM}' THEN 0 ELSE 1 END AS INTEGER) AS delivery, count(*) AS copies
FROM named GROUP BY username, id, created_s
""",
}
