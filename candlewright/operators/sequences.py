"""Previous rows and row numbers within keys that may hold most rows.

Both are computed within stretches of the order first and carried over between stretches by a small table with one
row per key and stretch, so that no key is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FIRST = -(1 << 62)


def _stretched(rows: DataFrame, order: str, stretch: int) -> DataFrame:
    return rows.withColumn("__stretch", F.coalesce(F.floor(F.col(order) / stretch), F.lit(_FIRST)))


def with_previous(rows: DataFrame, keys: list[str], order: str, ties: list[str], stretch: int, out: str = "previous") -> DataFrame:
    """``rows`` with ``out``: the integer ``order`` of the row before in its key, NULL for the first. Keys aren't NULL."""
    rows = _stretched(rows.drop(out), order, stretch)
    within = Window.partitionBy(*keys, "__stretch").orderBy(order, *ties)
    placed = rows.withColumn(out, F.lag(order).over(within)).withColumn("__no", F.row_number().over(within))
    ends = rows.groupBy(*keys, "__stretch").agg(F.max(order).alias("__high"))
    before = F.lag("__high").over(Window.partitionBy(*keys).orderBy("__stretch"))
    carried = ends.withColumn("__before", before).drop("__high")
    first = placed.where("__no = 1").drop(out).join(carried, [*keys, "__stretch"], "left").withColumnRenamed("__before", out)
    rest = placed.where("__no > 1")
    return first.select(rest.columns).unionByName(rest).drop("__stretch", "__no")


def numbered(rows: DataFrame, keys: list[str], order: str, ties: list[str], stretch: int, out: str = "row_no") -> DataFrame:
    """``rows`` with ``out``: the row's number within its key from 1, by ``order`` (NULLs first) and ``ties``. Keys aren't NULL."""
    rows = _stretched(rows.drop(out), order, stretch)
    within = Window.partitionBy(*keys, "__stretch").orderBy(F.col(order).asc_nulls_first(), *ties)
    placed = rows.withColumn("__no", F.row_number().over(within))
    counts = rows.groupBy(*keys, "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "__stretch", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    joined = placed.join(offsets, [*keys, "__stretch"])
    return joined.withColumn(out, F.col("__offset") + F.col("__no")).select(*(c for c in rows.columns if c != "__stretch"), out)
