"""Time functions as Column expressions; instants are UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The candle timeframes and their length in seconds.
TIMEFRAME_SECONDS = {"15m": 900, "1h": 3600, "4h": 14400, "1d": 86400}

#: A hole is reported where the step between two candles is longer than this many periods.
GAP_PERIODS = 2.5


def micros(instant: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    return F.unix_micros(instant.cast("timestamp"))


def whole_seconds(instant: Column) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_seconds(instant.cast("timestamp"))


def period_seconds(timeframe: Column) -> Column:
    """The length of a timeframe in seconds; NULL for an unknown one."""
    pairs = [F.lit(x) for pair in TIMEFRAME_SECONDS.items() for x in pair]
    return F.create_map(*pairs)[timeframe].cast("bigint")


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds as a UTC wall clock."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")
