"""Nearest-time pairing and co-occurrence on small awkward tables, against plain Python."""

import math
import time
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewright.llm import cooccurrence
from candlewright.llm.cooccurrence import cooccurrences
from candlewright.llm.nearest_time import nearest_in_time

FAST = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LEFT = "e string, at bigint, id int, match_id string, open bigint"
RIGHT = "e string, open bigint, rid bigint, id string"


def nearest(spark, left, right, tolerance=10, **options):
    a = spark.createDataFrame([(*r, "clash", 0) for r in left], LEFT)
    b = spark.createDataFrame([(*r, "clash") for r in right], RIGHT)
    got = nearest_in_time(a, b, "e", "at", "open", "rid", tolerance_us=tolerance, **options)
    assert got.columns == ["e", "at", "id", "open", "match_id", "match_us"]
    return sorted(((r.e, r.at, r.id, r.match_id) for r in got.collect()), key=str)


def brute(left, right, tolerance=10):
    out = []
    for e, at, i in left:
        near = [(abs(t - at), t, rid) for k, t, rid in right if None not in (k, t, rid, e, at) and k == e and abs(t - at) <= tolerance]
        out.append((e, at, i, min(near)[2] if near else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [None, 1, 3, 16])
def test_bounds_ties_nulls_and_repeats(spark, partitions):
    left = [("a", 100, 1), ("a", 100, 1), ("a", 120, 2), ("a", 121, 3), ("b", 0, 4), ("b", -5, 5), (None, 100, 6), ("a", None, 7), ("c", 5, 8)]
    right = [("a", 90, 5), ("a", 110, 6), ("a", 110, 4), ("a", 110, 4), ("b", 10, 9), ("b", -15, 8), (None, 100, 1), ("a", None, 1), ("a", 100, None)]
    assert nearest(spark, left, right, partitions=partitions) == brute(left, right)


@pytest.mark.parametrize("partitions", [None, 7])
def test_hot_entity_spreads_over_ranges(spark, partitions):
    left = [("hot", i * 7 % 5000, i) for i in range(1500)] + [("tied", 50, 1)] * 400
    right = [("hot", i * 13 % 5000, i) for i in range(300)] + [("tied", 45, 2), ("tied", 60, 1)]
    assert nearest(spark, left, right, partitions=partitions) == brute(left, right)


def test_a_million_rows_of_one_entity_in_an_hour(spark):
    hour = 3_600_000_000
    left = spark.range(1_000_000).select(F.lit("hot").alias("e"), (F.col("id") * 7_919 % hour).alias("at"), "id")
    right = spark.range(4).select(F.lit("hot").alias("e"), (F.col("id") * hour / 4).cast("bigint").alias("open"), F.col("id").alias("rid"))
    began = time.perf_counter()
    got = nearest_in_time(left, right, "e", "at", "open", "rid", tolerance_us=300_000_000, partitions=8)
    nearest_candle = F.least(F.round(F.col("at") / (hour / 4)), F.lit(3)).cast("bigint")
    near = F.abs(F.col("at") - nearest_candle * (hour // 4)) <= 300_000_000
    right_one = F.when(near, nearest_candle).eqNullSafe(F.col("match_id"))
    assert got.agg(F.count(F.lit(1)).alias("n"), F.count_if(right_one).alias("right")).first() == (1_000_000, 1_000_000)
    assert time.perf_counter() - began < 60


def test_nearest_of_empty_tables(spark):
    assert nearest(spark, [], [("a", 1, 1)]) == []
    assert nearest(spark, [("a", 1, 1)], []) == [("a", 1, 1, None)]


@FAST
@given(
    left=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(-60, 60), st.integers(0, 3)), max_size=30),
    right=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(-60, 60), st.none() | st.integers(0, 5)), max_size=30),
)
def test_nearest_of_any_tables(spark, left, right):
    assert nearest(spark, left, right) == brute(left, right)


def pairs_of(baskets):
    sets = [s for s in ({x for x in b or [] if x is not None} for b in baskets) if s]
    single, both = Counter(x for s in sets for x in s), Counter(p for s in sets for p in combinations(sorted(s), 2))
    return {p: (n, single[p[0]], single[p[1]], len(sets)) for p, n in both.items()}


def counted(spark, baskets):
    df = spark.createDataFrame([(b, 1, "clash") for b in baskets], "items array<string>, n int, item_a string")
    return {(r.item_a, r.item_b): r for r in cooccurrences(df, "items").collect()}


def test_pairs_with_nulls_repeats_and_long_baskets(spark):
    baskets = [["b", "a"], ["a", "b", "a", None], [], None, [None], ["", "a"], ["é", "z", "a"], [f"w{i}" for i in range(120)], ["solo"]] + [["a", "b"]] * 30
    got = counted(spark, baskets)
    want = pairs_of(baskets)
    assert {k: (r.n_ab, r.n_a, r.n_b, r.n) for k, r in got.items()} == want
    for (a, b), (k, na, nb, n) in want.items():
        table = [(k, na, nb), (na - k, na, n - nb), (nb - k, n - na, nb), (n - na - nb + k, n - na, n - nb)]
        g2 = 2 * sum(x * math.log(x * n / (r * c)) for x, r, c in table if x)
        assert got[a, b].llr == pytest.approx(max(g2, 0), abs=1e-9) and got[a, b].lift == pytest.approx(k * n / (na * nb))


def test_pairs_of_nothing(spark):
    assert counted(spark, []) == {} and counted(spark, [None, [], ["x"]]) == {}


def test_only_significant_pairs(spark):
    baskets = [["a", "b"]] * 40 + [["c", "d"]] * 40 + [["x", "a"]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    every, some = cooccurrences(df, "items").collect(), cooccurrences(df, "items", least_llr=10.83).collect()
    assert 0 < len(some) < len(every) and {tuple(r) for r in some} == {tuple(r) for r in every if r.llr >= 10.83}


@pytest.mark.parametrize(("cells", "items"), [(5, 1000), (1000, 3), (5, 3)])
def test_stripes_passed_on_early_lose_nothing(monkeypatch, cells, items):
    import pyarrow as pa

    monkeypatch.setattr(cooccurrence, "HELD_CELLS", cells)
    monkeypatch.setattr(cooccurrence, "HELD_ITEMS", items)
    baskets = [[f"i{j % 7}", f"i{j % 5}x", f"i{j % 3}y"] for j in range(50)]
    batches = [pa.RecordBatch.from_arrays([pa.array(baskets[i : i + 10])], names=["items"]) for i in range(0, 50, 10)]
    seen = Counter()
    for stripe in cooccurrence._stripes(iter(batches)):
        for row in stripe.to_pylist():
            for other, n in zip(row["neighbours"], row["counts"]):
                seen[row["item"], other] += n
    want = {p: v[0] for p, v in pairs_of(baskets).items()}
    assert {k: n for k, n in seen.items() if k[0] != k[1]} == want and seen[None, None] == 50


@FAST
@given(baskets=st.lists(st.none() | st.lists(st.none() | st.sampled_from(["a", "b", "c", ""]), max_size=5), max_size=25))
def test_pairs_of_any_baskets(spark, baskets):
    assert {k: (r.n_ab, r.n_a, r.n_b, r.n) for k, r in counted(spark, baskets).items()} == pairs_of(baskets)
