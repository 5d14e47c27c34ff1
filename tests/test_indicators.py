from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from candlewright.operators import indicators as I

SCHEMA = "coin string, timeframe string, open_time timestamp_ntz, high double, low double, close double"


def series(n, coin="A"):
    walk = 100 + np.cumsum(np.random.default_rng(1).normal(size=n))
    return [(coin, "15m", datetime(2024, 1, 1) + timedelta(minutes=15 * i), x + 1, x - 1, x) for i, x in enumerate(walk.tolist())]


def test_blocks_equal_the_whole_series(spark, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 2500)
    rows = series(6000) + series(3, "B")
    df = spark.createDataFrame(rows, SCHEMA)
    got = I.indicators(df).toPandas().sort_values(["coin", "calculated_at"], ignore_index=True)
    whole = pd.DataFrame(rows, columns=["coin", "timeframe", "open_time", "high", "low", "close"])
    want = pd.concat([I.indicators_of(g.reset_index(drop=True)) for _, g in whole.groupby("coin")], ignore_index=True)
    pd.testing.assert_frame_equal(got[I.COLUMNS], want, rtol=1e-9, atol=1e-9)
    bands = I.bollinger(df).toPandas().sort_values(["coin", "calculated_at"], ignore_index=True)
    pd.testing.assert_frame_equal(bands[["bb_upper", "bb_middle", "bb_lower"]], want[["bb_upper", "bb_middle", "bb_lower"]], rtol=1e-7)


def test_definitions_by_hand():
    x = [10.0, 11.0, 12.0, 11.0, 13.0]
    frame = pd.DataFrame({"close": x, "high": [v + 1 for v in x], "low": [v - 1 for v in x]})
    found = I.indicators_of(frame)
    ema, gain, loss, atr = x[0], 0.0, 0.0, 2.0
    for before, now in zip(x, x[1:]):
        ema += (now - ema) * 2 / 21
        gain += (max(now - before, 0) - gain) / 14
        loss += (max(before - now, 0) - loss) / 14
        atr += (max(2.0, abs(now + 1 - before), abs(now - 1 - before)) - atr) / 14
    assert found["ema_20"].iloc[-1] == pytest.approx(ema) and found["atr_14"].iloc[-1] == pytest.approx(atr)
    assert found["rsi_14"].iloc[-1] == pytest.approx(100 * gain / (gain + loss)) and found["bb_middle"].isna().all()


def test_nothing_and_a_flat_series(spark):
    assert I.indicators(spark.createDataFrame([], SCHEMA)).count() == 0
    flat = [("A", "1h", datetime(2024, 1, 1) + timedelta(hours=i), 5.0, 5.0, 5.0) for i in range(25)]
    row = I.indicators(spark.createDataFrame(flat, SCHEMA)).toPandas().iloc[-1]
    assert (row.rsi_14, row.ema_50, row.atr_14, row.bb_upper) == (50.0, 5.0, 0.0, 5.0)
