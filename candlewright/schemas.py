"""Declared schemas of the tables at rest and of the rows in flight."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the given tables' columns.

_PRICE = T.DecimalType(20, 8)

CHANNELS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("credibility", T.DecimalType(3, 2)),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

MESSAGES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("channel_name", T.StringType()),
        T.StructField("message_text", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("has_media", T.BooleanType()),
        T.StructField("views", T.IntegerType()),
        T.StructField("forwards", T.IntegerType()),
        T.StructField("reply_count", T.IntegerType()),
        T.StructField("coins_mentioned", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("is_processed", T.BooleanType()),
    ]
)

OHLCV = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("coin", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("open_time", T.TimestampNTZType()),
        *(T.StructField(c, _PRICE) for c in ("open", "high", "low", "close", "volume")),
    ]
)

INDICATORS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("coin", T.StringType()),
        T.StructField("timeframe", T.StringType()),
        T.StructField("calculated_at", T.TimestampNTZType()),
        T.StructField("rsi_14", T.DecimalType(10, 4)),
        *(
            T.StructField(c, _PRICE)
            for c in (
                "macd_line",
                "macd_signal",
                "macd_histogram",
                "bb_upper",
                "bb_middle",
                "bb_lower",
                "ema_20",
                "ema_50",
                "atr_14",
            )
        ),
        T.StructField("support_levels", T.ArrayType(_PRICE)),
        T.StructField("resistance_levels", T.ArrayType(_PRICE)),
        T.StructField("confluence_score", T.DecimalType(5, 4)),
        T.StructField("trend_direction", T.StringType()),
    ]
)

SCRAPE_CHECKPOINTS = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("last_message_id", T.LongType()),
        T.StructField("last_scraped_at", T.TimestampNTZType()),
    ]
)

TABLES = {
    "telegram_channels": CHANNELS,
    "telegram_messages": MESSAGES,
    "ohlcv": OHLCV,
    "technical_indicators": INDICATORS,
    "scrape_checkpoints": SCRAPE_CHECKPOINTS,
}
