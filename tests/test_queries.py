"""Each query with SQL against that SQL, at the smallest size."""

import pytest

from candlewright.plans import general, ingest
from tests.helpers import duck_bag, spark_bag

QUERIES, SQL = {**ingest.QUERIES, **general.QUERIES}, {**ingest.SQL, **general.SQL}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, data, name):
    got = QUERIES[name](spark, data)
    assert spark_bag(got) == duck_bag(data, SQL[name])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_grid_fills_between_observed_values(spark, data):
    grid = general.p3_grid(spark, data).toPandas()
    filled = grid[grid.status == "filled"]
    observed = grid[grid.status == "observed"].groupby(["coin", "timeframe"])["value"]
    low, high = observed.min(), observed.max()
    spread = filled.join(low.rename("low"), on=["coin", "timeframe"]).join(high.rename("high"), on=["coin", "timeframe"])
    assert len(filled) and filled.value.notna().all()
    near = (spread.value > spread.low * 0.7) & (spread.value < spread.high * 1.3)
    assert near.mean() > 0.95
    assert grid[grid.status.isin(["unsupported", "halt"])].value.isna().all()
