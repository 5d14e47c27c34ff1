"""Technical indicators of candle series: declared in the stored schema, with the usual public definitions.

A series is cut into blocks of rows; each block also gets the rows before it as a warm-up, long enough that what came
earlier no longer shows in a double. Blocks are bounded, so no series is one group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.times import micros
from candlewright.operators.sequences import numbered

#: Rows of a block, and of its warm-up: (1 - 2 / 51) ** 1500 is below 1e-26.
BLOCK, WARM_UP = 8192, 2000
_STRETCH_US = 90 * 86_400 * 1_000_000

# Periods of the indicators. The stored columns name 14, 20 and 50; the others are the customary ones.
RSI, ATR, EMAS, BANDS, BAND_WIDTH, MACD = 14, 14, (20, 50), 20, 2.0, (12, 26, 9)

COLUMNS = ["rsi_14", "macd_line", "macd_signal", "macd_histogram", "bb_upper", "bb_middle", "bb_lower", "ema_20", "ema_50", "atr_14"]


def _wilder(values: pd.Series, period: int) -> pd.Series:
    """Wilder's average: an exponential one with weight 1 / period, seeded with the first value."""
    return values.ewm(alpha=1 / period, adjust=False).mean()


def indicators_of(series: pd.DataFrame) -> pd.DataFrame:
    """The indicators of one series in order of time, all from its first row on; bands once they have their rows."""
    close, high, low = (series[c].astype(float) for c in ("close", "high", "low"))
    ema = lambda values, span: values.ewm(span=span, adjust=False).mean()
    out = pd.DataFrame(index=series.index)
    step = close.diff().fillna(0.0)
    gain, loss = _wilder(step.clip(lower=0), RSI), _wilder(-step.clip(upper=0), RSI)
    with np.errstate(divide="ignore", invalid="ignore"):
        out["rsi_14"] = np.where(gain + loss > 0, 100 * gain / (gain + loss), 50.0)
    fast, slow, signal = MACD
    out["macd_line"] = ema(close, fast) - ema(close, slow)
    out["macd_signal"] = ema(out["macd_line"], signal)
    out["macd_histogram"] = out["macd_line"] - out["macd_signal"]
    window = close.rolling(BANDS)
    middle, deviation = window.mean(), window.std(ddof=0)
    out["bb_upper"], out["bb_middle"], out["bb_lower"] = middle + BAND_WIDTH * deviation, middle, middle - BAND_WIDTH * deviation
    for span in EMAS:
        out[f"ema_{span}"] = ema(close, span)
    before = close.shift().fillna(close)
    out["atr_14"] = _wilder(pd.concat([high - low, (high - before).abs(), (low - before).abs()], axis=1).max(axis=1), ATR)
    return out[COLUMNS]


def _blocks(candles: DataFrame) -> DataFrame:
    """Candles in blocks of their series, rows of the warm-up in the block after theirs as well."""
    timed = candles.select("coin", "timeframe", "open_time", "high", "low", "close", micros(F.col("open_time")).alias("t"))
    ordered = numbered(timed, ["coin", "timeframe"], "t", [], _STRETCH_US)
    block, place = F.floor((F.col("row_no") - 1) / BLOCK), (F.col("row_no") - 1) % BLOCK
    blocks = F.when(place >= BLOCK - WARM_UP, F.array(block, block + 1)).otherwise(F.array(block))
    return ordered.withColumn("own", block).withColumn("block", F.explode(blocks))


def indicators(candles: DataFrame) -> DataFrame:
    """``coin, timeframe, calculated_at`` and the indicators of every candle of a series.

    Candles have to be valid and one for each time, as ``split_candles`` and ``first_wins`` give them. Values are doubles;
    bands are NULL for the first 19 candles.
    """
    schema = "coin string, timeframe string, calculated_at timestamp_ntz, " + ", ".join(f"{c} double" for c in COLUMNS)

    def of_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_no", ignore_index=True)
        found = indicators_of(rows)
        found.insert(0, "calculated_at", rows["open_time"])
        found.insert(0, "timeframe", rows["timeframe"])
        found.insert(0, "coin", rows["coin"])
        return found[(rows["own"] == rows["block"]).to_numpy()]

    doubles = _blocks(candles).withColumns({c: F.col(c).cast("double") for c in ("high", "low", "close")})
    return doubles.groupBy("coin", "timeframe", "block").applyInPandas(of_block, schema)


def bollinger(candles: DataFrame) -> DataFrame:
    """The bands alone, within codegen: ``coin, timeframe, calculated_at, bb_upper, bb_middle, bb_lower``."""
    rows = _blocks(candles).withColumn("x", F.col("close").cast("double"))
    last = Window.partitionBy("coin", "timeframe", "block").orderBy("row_no").rowsBetween(1 - BANDS, 0)
    full = F.count(F.lit(1)).over(last) == BANDS
    middle, deviation = F.when(full, F.avg("x").over(last)), F.when(full, F.stddev_pop("x").over(last))
    banded = rows.withColumns({"bb_middle": middle, "__d": deviation * BAND_WIDTH}).where("own = block")
    return banded.select(
        "coin",
        "timeframe",
        F.col("open_time").alias("calculated_at"),
        (F.col("bb_middle") + F.col("__d")).alias("bb_upper"),
        "bb_middle",
        (F.col("bb_middle") - F.col("__d")).alias("bb_lower"),
    )
