from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewright.operators import candles as C
from candlewright.operators.sequences import numbered, with_previous

MS = 1_711_929_600_000
GOOD = [str(MS), "7.25", "7.5", "6.75", "7.0", "412.5"]
RAW_KLINES = "coin string, timeframe string, kline array<string>"
CANDLE = "coin string, timeframe string, open_time timestamp_ntz, open double, high double, low double, close double, volume double"


def raw(spark, *klines):
    return spark.createDataFrame([("LTCUSDT", "1h", k) for k in klines], RAW_KLINES)


def candle(at=datetime(2024, 1, 1), volume=37.5, **changed):
    row = {"coin": "ADAUSDT", "timeframe": "1h", "open_time": at, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": volume}
    return tuple((row | changed).values())


def test_parse_maps_positions_and_time(spark):
    row = C.parse_klines(raw(spark, [*GOOD, "ignored"])).first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (7.25, 7.5, 6.75, 7.0, 412.5)
    assert row.open_time == datetime(2024, 4, 1) and row.parse_error is None


@pytest.mark.parametrize(
    ("kline", "error"),
    [
        (None, "short kline"), (GOOD[:5], "short kline"), (["x", *GOOD[1:]], "bad time"), ([GOOD[0], "abc", *GOOD[2:]], "bad open"),
        ([GOOD[0], None, *GOOD[2:]], "bad open"), ([*GOOD[:5], "1.5d"], "bad volume"), ([*GOOD[:5], "1_000.5"], "bad volume"), ([*GOOD[:5], "NaN"], None),
        ([*GOOD[:5], "inf"], None), ([*GOOD[:5], " 1e3 "], None),
    ],
)
def test_parse_rejects_one_row_only(spark, kline, error):
    rows = C.parse_klines(raw(spark, kline, GOOD)).collect()
    assert [r.parse_error for r in rows] == [error, None]


@pytest.mark.parametrize(
    ("changed", "reason"),
    [
        ({}, None), ({"open": -1.0}, "negative open"), ({"close": 0.0}, None), ({"close": -0.0}, None), ({"low": -1e-8}, "negative low"),
        ({"high": float("nan")}, None), ({"volume": 0.0}, None), ({"volume": -5.0}, "negative volume"), ({"volume": None}, "no volume"), ({"coin": None}, "no coin"),
    ],
)
def test_candle_rules(spark, changed, reason):
    df = spark.createDataFrame([candle(**changed)], CANDLE)
    assert C.checked_candles(df).first().reject_reason == reason
    valid, rejected = C.split_candles(df)
    assert (valid.count(), rejected.count()) == ((1, 0) if reason is None else (0, 1))


@pytest.mark.parametrize(("hours", "gaps"), [([0, 1, 10, 11], 1), ([0], 0), ([0, 2], 0), ([0, 2.5], 0), ([0, 3], 1), ([0, 0, 1], 0), ([], 0)])
def test_gaps(spark, hours, gaps):
    rows = [candle(datetime(2024, 1, 1) + timedelta(hours=h)) for h in hours]
    assert C.candle_gaps(spark.createDataFrame(rows, CANDLE)).count() == gaps


def test_gap_just_above_and_across_stretches(spark):
    start = datetime(2024, 1, 1)
    rows = [candle(start), candle(start + timedelta(hours=2.5, milliseconds=1)), candle(start + timedelta(days=400))]
    assert C.candle_gaps(spark.createDataFrame(rows, CANDLE)).count() == 2


def test_rejected_candle_widens_the_gap(spark):
    start = datetime(2024, 1, 1)
    rows = [candle(start), candle(start + timedelta(hours=2), close=-1.0), candle(start + timedelta(hours=4))]
    assert C.candle_gaps(C.split_candles(spark.createDataFrame(rows, CANDLE))[0]).count() == 1


def test_unknown_timeframe_is_an_error(spark):
    rows = [candle(timeframe="7m"), candle(datetime(2024, 1, 2), timeframe="7m")]
    with pytest.raises(Exception, match="unknown timeframe 7m"):
        C.candle_gaps(spark.createDataFrame(rows, CANDLE)).collect()


def test_price_decimal_reads_text_directly(spark):
    df = spark.createDataFrame([("1.000000005",), ("abc",), (None,), ("1e13",), ("nan",)], "x string")
    got = [r[0] for r in df.select(C.price_decimal(F.col("x"))).collect()]
    assert got == [Decimal("1.00000001"), None, None, None, None]


def test_plan_and_summary(spark):
    coins = spark.createDataFrame([("A",), ("B",), ("A",)], "coin string")
    plan = C.backfill_plan(coins, F.lit("2024-06-01").cast("timestamp_ntz"), 90)
    assert plan.count() == 8 and plan.where("coin = 'A' AND timeframe = '15m'").first().expected == 8640
    df = spark.createDataFrame([candle(), candle(close=-1.0), candle(coin="B", close=-2.0)], CANDLE)
    got = {r.coin: (r.n_valid, r.n_skipped, r.status) for r in C.pair_summary(C.checked_candles(df)).collect()}
    assert got == {"ADAUSDT": (1, 1, "ok"), "B": (0, 1, "no data")}


def test_sequences_equal_plain_windows(spark):
    rows = [("a" if i % 3 else "b", (i * 37) % 101 if i % 10 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t bigint, id int")
    got = {(r.k, r.id): r.row_no for r in numbered(df, ["k"], "t", ["id"], 7).collect()}
    for key in "ab":
        order = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1], r[2]))
        assert [got[key, r[2]] for r in order] == list(range(1, len(order) + 1))
    timed = df.where("t IS NOT NULL")
    before = {(r.k, r.id): r.previous for r in with_previous(timed, ["k"], "t", ["id"], 7).collect()}
    for key in "ab":
        order = sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: (r[1], r[2]))
        assert [before[key, r[2]] for r in order] == [None, *(r[1] for r in order[:-1])]
