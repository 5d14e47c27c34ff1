"""Heavy keys, regular grids and redelivery on small awkward tables, against plain Python."""

from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewright.functions.times import period_seconds
from candlewright.operators import regular_grid as regular_grid_module
from candlewright.operators.channels import with_username
from candlewright.operators.heavy_keys import _partial_states, heavy_keys, key_profile
from candlewright.operators.redelivery import one_copy_each
from candlewright.operators.regular_grid import regular_grid
from tests.helpers import spark_bag

T0 = datetime(2024, 1, 1)
EVENT = "k string, t timestamp_ntz, id bigint, n_rows string, part int, copies string"
FAST = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def profile_of(rows, quiet=3600):
    """What key_profile must give, by brute force."""
    groups = defaultdict(list)
    for k, t, *_ in rows:
        groups[k].append(t)
    out = []
    for k, times in groups.items():
        known = sorted(t for t in times if t is not None)
        steps = [int((b - a) / timedelta(microseconds=1)) for a, b in zip(known, known[1:])]
        bursts = sum(s > quiet * 1_000_000 for s in steps) + bool(known)
        out.append((k, len(times), known[0] if known else None, known[-1] if known else None, max(steps, default=None), bursts))
    return out


PROFILE = "k string, n_rows bigint, first_at timestamp_ntz, last_at timestamp_ntz, longest_gap_us bigint, n_bursts bigint"


@pytest.mark.parametrize("partitions", [None, 1, 3, 16])
def test_profile_with_heavy_key_nulls_and_ties(spark, partitions):
    rows = [("hot", T0 + timedelta(seconds=(i * 7919) % 90_000), i, "x", i, None) for i in range(900)]
    rows += [("tied", T0, 1, "x", 1, None)] * 40 + [("cold", T0, 1, None, 1, None), (None, T0, 2, "y", 2, None), (None, None, 3, "z", 3, None)]
    rows += [("untimed", None, None, None, None, None)] * 3 + [("", T0 + timedelta(days=1), 5, "", 5, "")]
    got = key_profile(spark.createDataFrame(rows, EVENT), ["k"], "t", ["id"], partitions=partitions)
    assert spark_bag(got) == spark_bag(spark.createDataFrame(profile_of(rows), PROFILE))


@FAST
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(0, 20_000).map(lambda s: T0 + timedelta(seconds=s))), max_size=60))
def test_profile_of_any_rows(spark, rows):
    df = spark.createDataFrame([(*r, 0, None, 0, None) for r in rows], EVENT)
    got = key_profile(df, ["k"], "t", partitions=4)
    assert spark_bag(got) == spark_bag(spark.createDataFrame(profile_of(rows), PROFILE))


def test_profile_spreads_a_heavy_key(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    spread = rows.repartitionByRange(8, "k", "t").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(spread) == 8 and spread.max() < 2 * spread.mean()


def test_one_state_for_each_key_and_partition(spark):
    rows = spark.range(400_000).select(F.when(F.col("id") == 7, "cold").otherwise("hot").alias("k0"), F.col("id").alias("__t"))
    states = _partial_states(rows, 1, 1, 4).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("rows")).collect()
    assert sorted(r.n for r in states) == [1, 1, 1, 2] and sum(r.rows for r in states) == 400_000


def test_heavy_keys_take_the_bound(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)] * 96, "k string").withColumn("t", F.lit(T0).cast("timestamp_ntz"))
    assert {r.k for r in heavy_keys(key_profile(df, ["k"], "t"), df, "0.04").collect()} == {"a", "b"}
    assert {r.k for r in heavy_keys(key_profile(df, ["k"], "t"), df, "0.0401").collect()} == {"b"}


def test_username_of_any_spelling(spark):
    channels = spark.createDataFrame([(77, "NenNhat"), (78, "12")], "id bigint, username string")
    names = [("@nennhat", 1), (" NENNHAT ", 2), ("77", 3), ("12", 4), ("", 5), (None, 6), ("@@NenNhat", 7)]
    got = with_username(spark.createDataFrame(names, "n string, i int"), channels, "n")
    assert {r.i: r.username for r in got.collect()} == {1: "NenNhat", 2: "NenNhat", 3: "NenNhat", 4: None, 5: None, 6: None, 7: "NenNhat"}


COPY = "id bigint, ch string, at int, tags array<string>, extra map<string,int>, copies int, delivery string"


def copies_of(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[:2]].append(r)
    return groups


@pytest.mark.parametrize("hot", [0, 4000])
def test_one_copy_of_each(spark, hot):
    rows = [(i % 50, "c", i, ["x"], {"a": i}, 9, "d") for i in range(60)] + [(None, None, 2, None, None, 9, None), (None, None, 1, None, None, 9, None)]
    rows += [(1000, "hot", 5 + i % 3, None, None, 9, "d") for i in range(hot)]
    got = one_copy_each(spark.createDataFrame(rows, COPY), ["id", "ch"], ["at"]).collect()
    groups = copies_of(rows)
    assert {(r.id, r.ch): (r.at, r.copies, r.delivery) for r in got} == {k: (min(r[2] for r in g), len(g), 0) for k, g in groups.items()}
    assert len(got) == len(groups)


def test_new_batch_never_replaces_what_is_stored(spark):
    stored = spark.createDataFrame([(1, "c", 9, None, None, 0, None)], COPY)
    new = spark.createDataFrame([(1, "c", 1, None, None, 0, None), (2, "c", 3, None, None, 0, None), (2, "c", 2, None, None, 0, None)], COPY)
    got = {r.id: (r.at, r.copies, r.delivery) for r in one_copy_each(stored, ["id", "ch"], ["at"], new=new).collect()}
    assert got == {1: (9, 2, 0), 2: (2, 2, 1)}


def test_copies_of_nothing(spark):
    empty = spark.createDataFrame([], COPY)
    assert one_copy_each(empty, ["id", "ch"], ["at"]).count() == 0
    assert one_copy_each(empty, ["id", "ch"], ["at"], new=spark.createDataFrame([(1, "c", 1, None, None, 0, None)], COPY)).count() == 1


@FAST
@given(rows=st.lists(st.tuples(st.none() | st.integers(0, 3), st.sampled_from(["a", None]), st.integers(0, 2)), max_size=40))
def test_copies_of_any_rows(spark, rows):
    df = spark.createDataFrame([(*r, None, None, 0, None) for r in rows], COPY)
    got = one_copy_each(df, ["id", "ch"], ["at"]).collect()
    assert sorted(map(str, ((r.id, r.ch, r.at, r.copies) for r in got))) == sorted(str((*k, min(r[2] for r in g), len(g))) for k, g in copies_of(rows).items())


READING = "coin string, timeframe string, open_time timestamp_ntz, close decimal(20,8), id bigint, slot string, value string"


def grid_of(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], READING)
    return regular_grid(df, ["coin", "timeframe"], "open_time", "close", period_seconds(F.col("timeframe")), "id", **options)


def test_grid_keeps_observed_fills_holes_and_marks_the_rest(spark):
    from decimal import Decimal as D

    rows = []
    for c, base in (("A", 100), ("B", 200), ("C", 50)):
        rows += [(c, "1h", T0 + timedelta(hours=h, seconds=(h * 13) % 60 - 30), D(base + h), h) for h in range(48) if (c, h) not in {("A", 5), ("A", 6), ("C", 20)}]
    rows += [("A", "1h", T0 + timedelta(hours=10, minutes=10), D(999), 1000), ("A", "1h", T0 + timedelta(hours=5), None, 1001)]
    rows += [("L", "1d", T0, D(1), 1), ("L", "1d", T0 + timedelta(days=3), D(2), 2), ("H", "1h", T0, D(1), 1), ("H", "1h", T0 + timedelta(days=8), D(2), 2)]
    rows += [("X", "7m", T0, D(1), 1), (None, "1h", T0, D(1), 1), ("Y", "1h", None, D(1), 1), ("Z", "1h", T0, D(3), 1)]
    got = grid_of(spark, rows).toPandas()
    status = got.groupby(["coin", "status"]).size().to_dict()
    assert status == {("A", "observed"): 46, ("A", "filled"): 2, ("B", "observed"): 48, ("C", "observed"): 47, ("C", "filled"): 1,
                      ("L", "observed"): 2, ("L", "unsupported"): 2, ("H", "observed"): 2, ("H", "halt"): 1, ("Z", "observed"): 1}
    a = got[got.coin == "A"].set_index("grid_s")["value"]
    at = int((T0 - datetime(1970, 1, 1)).total_seconds())
    assert a[at + 10 * 3600] == 999 and a[at + 4 * 3600] == 104
    filled = got[got.status == "filled"].set_index(["coin", "grid_s"])["value"]
    assert abs(filled["C", at + 20 * 3600] - 70) < 8
    halt = got[got.status == "halt"].iloc[0]
    assert halt.n_periods == 8 * 24 - 1 and halt.grid_s == at + 3600


def fill_errors(spark, readings, hide):
    """Root mean square errors, relative to the value, of the cells that ``hide`` picks: by the grid, and by a straight line between neighbours."""
    shown = [r for r in readings if not hide(r)]
    grid = grid_of(spark, shown).where("status = 'filled'").toPandas().set_index(["coin", "timeframe", "grid_s"])["value"]
    at = lambda r: int((r[2] - datetime(1970, 1, 1)).total_seconds())
    series, mine, line = defaultdict(dict), [], []
    for r in shown:
        series[r[:2]][at(r)] = float(r[3])
    for r in readings:
        if hide(r) and (*r[:2], at(r)) in grid.index:
            times = sorted(series[r[:2]])
            straight = np.interp(at(r), times, [series[r[:2]][t] for t in times])
            mine.append(grid[(*r[:2], at(r))] / float(r[3]) - 1)
            line.append(straight / float(r[3]) - 1)
    return len(mine), float(np.sqrt(np.mean(np.square(mine)))), float(np.sqrt(np.mean(np.square(line))))


def test_grid_fills_what_sources_share(spark):
    """A tenth of the cells of sources that move together is hidden, in holes of several periods: the factors beat a straight line."""
    from decimal import Decimal as D

    rows = []
    for c in range(12):
        for h in range(240):
            shared = 10 * np.sin(h / 2.0 + 0.3) + 6 * np.cos(h / 3.1)
            rows.append((f"S{c:02}", "1h", T0 + timedelta(hours=h), D(str(round(100 + c + (1 + c / 12) * float(shared) + (h * c % 7) / 10, 4))), h))
    hide = lambda r: 3 <= r[4] < 237 and (r[4] // 4 + int(r[0][1:]) * 7) % 10 == 0
    n, mine, line = fill_errors(spark, rows, hide)
    assert n > 250 and mine < 0.02 and mine < line / 2


def test_a_stray_reading_changes_nothing_of_other_sources(spark):
    from decimal import Decimal as D

    second = "1h"
    rows = [(c, second, T0 + timedelta(hours=h), D(100 + h + len(c)), h) for c in ("A", "BB", "CCC") for h in range(30) if (c, h) != ("A", 7)]
    stray = [("Z", second, datetime(1700, 1, 1), D(5), 1), ("Z", second, datetime(2024, 1, 1, 1), D(6), 2)]
    plain = grid_of(spark, rows).toPandas().set_index(["coin", "grid_s"])
    with_stray = grid_of(spark, rows + stray).where("coin <> 'Z'").toPandas().set_index(["coin", "grid_s"])
    assert (plain.status == with_stray.status.reindex(plain.index)).all() and (plain.status == "filled").sum() == 1
    assert (plain.value - with_stray.value.reindex(plain.index)).abs().max() < 1


def test_numbers_are_dense_and_bounded(spark, monkeypatch):
    rows = spark.range(1000).repartition(7)
    got = [r.no for r in regular_grid_module._numbered(rows, "no").collect()]
    assert sorted(got) == list(range(1000))
    monkeypatch.setattr(regular_grid_module, "_MOST_NUMBERS", 999)
    with pytest.raises(Exception, match="too many numbers"):
        regular_grid_module._numbered(rows, "no").collect()


def test_grid_of_nothing_and_of_repeats(spark):
    from decimal import Decimal as D

    assert grid_of(spark, []).count() == 0
    row = ("A", "15m", T0 + timedelta(minutes=7, seconds=30), D("1.5"), 1)
    assert [tuple(r)[2:] for r in grid_of(spark, [row, row]).collect()] == [(900, int((T0 - datetime(1970, 1, 1)).total_seconds()), 1.5, "observed", 1)]
    early = [("A", "1h", datetime(1969, 12, 31, h), D(1), h) for h in (20, 23)]
    assert sorted(r.status for r in grid_of(spark, early).collect()) == ["observed", "observed", "unsupported", "unsupported"]
