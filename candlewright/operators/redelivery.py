"""Exactly one copy of each record that was delivered at least once.

The identifiers are counted first, which moves only identifiers, pre-aggregated. Singletons then pass as they
are; only repeated groups are ranked. A group that holds a large part of all copies meets its count by broadcast, so
that its rows stay where they are until each task has ranked its own; only the tasks' first copies are moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group of more than 1 in HOT of all rows counts as hot. There are fewer than HOT of those, whatever the size of the table.
HOT = 100_000


def frequencies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with ``copies``, the number of rows that have them."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def one_copy_each(stored: DataFrame, keys: list[str], order: list[str], new: DataFrame | None = None) -> DataFrame:
    """The first copy of each group of rows with equal ``keys``, with ``copies``, the size of its group.

    A stored copy goes before a new one; then ``order`` decides (NULLs first), then a hash of all other columns, so
    that the choice doesn't depend on how the rows are spread. ``copies`` and ``delivery`` (0 stored,
    1 new: of the kept copy) are added; columns of those names in the input are replaced. All columns are moved with
    their rows, as any may break a tie; who needs few of them should select them before.

    Defined results: NULL keys are equal to each other, as in a GROUP BY; repeated rows give one; an empty table
    gives no rows; columns that only one of ``stored`` and ``new`` has are NULL in the other's rows.
    """
    extra = {"copies", "delivery"}
    rows = stored.drop(*extra).withColumn("delivery", F.lit(0))
    if new is not None:
        rows = rows.unionByName(new.drop(*extra).withColumn("delivery", F.lit(1)), allowMissingColumns=True)
    columns = rows.columns
    rows = rows.withColumn("__key", F.struct(*keys))  # equal to another with the same NULLs, and one column to lie by
    counted = frequencies(rows, ["__key"])
    total = counted.agg(F.sum("copies")).scalar()
    is_hot = (F.col("copies") > 1) & (F.col("copies") * HOT > total)
    hot = F.broadcast(counted.where(is_hot))  # fewer than HOT rows, by the condition
    repeated = counted.where((F.col("copies") > 1) & ~is_hot)

    # both branches read the same join inputs, so that rows are moved once at most
    rest = rows.join(hot, "__key", "left_anti").join(repeated, "__key", "left")
    single = rest.where("copies IS NULL").withColumn("copies", F.lit(1).cast("bigint"))
    ranked = _first(rest.where("copies IS NOT NULL"), keys, order)
    in_hot = _first(rows.join(hot, "__key"), keys, order)
    return single.unionByName(ranked).unionByName(in_hot).select(*columns, "copies")


def _first(copies: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group. Spark ranks within each task before it moves rows."""
    others = [c for c, kind in copies.dtypes if c not in (*keys, "__key") and "map<" not in kind and "variant" not in kind]
    place = F.row_number().over(Window.partitionBy("__key").orderBy("delivery", *order, F.xxhash64(*others)))
    return copies.withColumn("__place", place).where("__place = 1").drop("__place")
