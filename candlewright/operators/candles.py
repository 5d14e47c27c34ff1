"""Candles: parsing raw klines, accepting or rejecting rows, gaps, backfill plans and their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.text import NUMBER, to_double
from candlewright.functions.times import GAP_PERIODS, TIMEFRAME_SECONDS, from_millis, micros, period_seconds
from candlewright.operators.sequences import with_previous

PRICES = ["open", "high", "low", "close"]
#: Microseconds of a series that are sorted together when its gaps are sought.
_STRETCH_US = 90 * 86_400 * 1_000_000


def _field(kline: Column, i: int) -> Column:
    return F.get(kline, F.lit(i))


def parse_klines(raw: DataFrame) -> DataFrame:
    """Raw klines (``coin, timeframe, kline``: an array of text) to candles with ``parse_error``, NULL if all is well.

    Position 0 is epoch milliseconds, 1 to 5 are open, high, low, close and volume; more positions are ignored. A
    kline that is NULL or too short, or a field that is no number, rejects its row only.
    """
    k = F.col("kline")
    ms = F.when(_field(k, 0).rlike(r"^-?\d{1,15}$"), _field(k, 0).cast("bigint"))
    fields = {name: to_double(_field(k, i)) for i, name in enumerate([*PRICES, "volume"], 1)}
    error = F.when(k.isNull() | (F.size(k) < 6), "short kline").when(ms.isNull(), "bad time")
    for name, value in fields.items():
        error = error.when(value.isNull(), f"bad {name}")
    return raw.select("coin", "timeframe", from_millis(ms).alias("open_time"), *(v.alias(n) for n, v in fields.items()), error.alias("parse_error"))


def to_klines(candles: DataFrame) -> DataFrame:
    """Candles as the raw klines that an exchange would send; the inverse of ``parse_klines`` for decimal prices."""
    ms = F.floor(micros(F.col("open_time")) / 1000).cast("string")
    return candles.select("coin", "timeframe", F.array(ms, *(F.col(c).cast("string") for c in [*PRICES, "volume"])).alias("kline"))


def price_decimal(text: Column) -> Column:
    """A number as text to the stored decimal, without a double between; NULL where it is no finite number."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("decimal(20,8)"))


def candle_error(columns: list[str]) -> Column:
    """Why a candle is rejected, NULL if it isn't. Zero prices and volumes are data; NULL fields are rejected."""
    error = F.col("parse_error") if "parse_error" in columns else F.lit(None).cast("string")
    rules = F.when(error.isNotNull(), error)
    for name in ("coin", "timeframe", "open_time"):
        rules = rules.when(F.col(name).isNull(), f"no {name}")
    for name in [*PRICES, "volume"]:
        rules = rules.when(F.col(name).isNull(), f"no {name}").when(F.col(name) < 0, f"negative {name}")
    return rules


def checked_candles(candles: DataFrame) -> DataFrame:
    """``candles`` with ``reject_reason``, NULL for valid rows."""
    return candles.withColumn("reject_reason", candle_error(candles.columns))


def split_candles(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid candles, and the rejected ones with their ``reject_reason``."""
    checked = checked_candles(candles)
    return checked.where("reject_reason IS NULL").drop("reject_reason", "parse_error"), checked.where("reject_reason IS NOT NULL")


def candle_gaps(valid: DataFrame) -> DataFrame:
    """Where a series' next candle comes more than 2.5 periods after the one before: ``coin, timeframe, gap_from, gap_to``.

    The candles themselves stay as they are. An unknown timeframe is an error.
    """
    period = period_seconds(F.col("timeframe"))
    known = F.coalesce(period, F.raise_error(F.concat(F.lit("unknown timeframe "), F.coalesce("timeframe", F.lit("NULL")))).cast("bigint"))
    timed = valid.select("coin", "timeframe", micros(F.col("open_time")).alias("t"), known.alias("period"))
    steps = with_previous(timed, ["coin", "timeframe"], "t", [], _STRETCH_US)
    late = F.col("t") - F.col("previous") > F.col("period") * int(GAP_PERIODS * 1_000_000)
    at = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return steps.where(late).select("coin", "timeframe", at("previous").alias("gap_from"), at("t").alias("gap_to"))


def closed_only(candles: DataFrame, as_of: Column) -> DataFrame:
    """Candles whose period has ended by ``as_of``."""
    ends = F.unix_seconds(F.col("open_time").cast("timestamp")) + period_seconds(F.col("timeframe"))
    return candles.where(ends <= F.unix_seconds(as_of.cast("timestamp")))


def backfill_plan(coins: DataFrame, as_of: Column, days_back: int = 90) -> DataFrame:
    """Every coin with every timeframe: ``coin, timeframe, seconds, since``, and ``expected`` candles without gaps."""
    pairs = coins.select("coin").distinct().select("coin", F.explode(F.array(*(F.lit(t) for t in TIMEFRAME_SECONDS))).alias("timeframe"))
    planned = pairs.withColumn("seconds", period_seconds(F.col("timeframe")))
    return planned.select(
        "coin",
        "timeframe",
        "seconds",
        (as_of - F.make_dt_interval(F.lit(days_back))).cast("timestamp_ntz").alias("since"),
        F.expr(f"{days_back} * 86400 div seconds").cast("bigint").alias("expected"),
    )


def pair_summary(checked: DataFrame) -> DataFrame:
    """Per pair: rows read, accepted and skipped, and ``ok`` or ``no data``."""
    by_pair = checked.groupBy("coin", "timeframe").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("reject_reason").isNull()).alias("n_valid"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("n_skipped"),
    )
    return by_pair.withColumn("status", F.when(F.col("n_valid") > 0, "ok").otherwise("no data"))
