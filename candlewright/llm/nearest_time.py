"""Pairing records of two tables by nearest time.

Both tables are unioned and sorted per entity and time; every left row then carries the last right row before
it and the next one after it, and takes the nearer. The sort is a range partition on entity and time, so an
entity, an hour or even an instant with most of the rows is spread over as many tasks as its rows deserve. A part
of an entity that lies in one task gets the last right row before it and the next one after it from the other parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.session import checkpointed

_KEYS = ["__e", "__part"]


def _edges(ranged: DataFrame) -> DataFrame:
    """For each entity's part in a task: the right rows next to it in the entity's other parts, at most two."""
    ends = ranged.groupBy(*_KEYS).agg(F.min("__match").alias("low"), F.max("__match").alias("high"))
    before = F.expr("lag(high) IGNORE NULLS OVER (PARTITION BY __e ORDER BY __part)")
    after = F.expr("lead(low) IGNORE NULLS OVER (PARTITION BY __e ORDER BY __part)")
    edges = ends.withColumns({"before": before, "after": after}).select(*_KEYS, F.explode(F.array("before", "after")).alias("__match"))
    return edges.where("__match IS NOT NULL").select(*_KEYS, F.col("__match.us").alias("__t"), F.lit(1).alias("__side"), "__match")


def nearest_in_time(
    left: DataFrame, right: DataFrame, entity: str, left_us: str, right_us: str, right_id: str, tolerance_us: int, partitions: int | None = None
) -> DataFrame:
    """``left`` with ``match_id`` and ``match_us``: the right row of its ``entity`` nearest in time, or NULLs.

    ``left_us`` and ``right_us`` are microseconds. A right row counts up to ``tolerance_us`` before or after,
    bounds included; at equal distance the earlier one, then the smaller ``right_id``. ``partitions`` is the number
    of ranges; it is the session's number of shuffle partitions unless given.

    Defined results: a left row with NULL entity or time has no match; a right row with NULL entity, time or id
    plays no part; repeated left rows all stay; repeated right rows are one; empty tables work; left columns
    keep their names, and only ``match_id`` and ``match_us`` are replaced.
    """
    points = right.select(F.col(entity).alias("__e"), F.col(right_us).cast("bigint").alias("__t"), F.col(right_id).alias("__id"))
    points = points.where("__e IS NOT NULL AND __t IS NOT NULL AND __id IS NOT NULL").groupBy("__e", "__t").agg(F.min("__id").alias("__id"))
    match = F.struct(F.col("__t").alias("us"), F.col("__id").alias("id")).alias("__match")
    points = points.select("__e", "__t", F.lit(1).alias("__side"), match)

    kept = left.drop("match_id", "match_us")
    rows = kept.select(F.col(entity).alias("__e"), F.col(left_us).cast("bigint").alias("__t"), F.lit(2).alias("__side"), F.struct(*kept.columns).alias("__row"))
    untimed = rows.where("__e IS NULL OR __t IS NULL").select("__row.*")
    both = rows.where("__e IS NOT NULL AND __t IS NOT NULL").unionByName(points, allowMissingColumns=True)

    # equal rows are told apart by where they come from
    hashed = [F.col(f"__row.`{c}`") for c, kind in kept.dtypes if "map<" not in kind and "variant" not in kind]
    by = ["__e", "__t", "__side", "__tie"]
    placed = both.withColumn("__tie", F.xxhash64(*hashed, F.spark_partition_id()))
    ranged = placed.repartitionByRange(partitions, *by) if partitions else placed.repartitionByRange(*by)
    ranged = checkpointed(ranged.withColumn("__part", F.spark_partition_id()).drop("__tie"))

    # at one instant right rows come first; both columns carried share this order, and so one sort
    order = "PARTITION BY __e, __part ORDER BY __t, __side"
    last = F.last("__match", ignorenulls=True).over(
        Window.partitionBy(*_KEYS).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    )
    following = F.expr(f"lead(__match) IGNORE NULLS OVER ({order})")
    carried = ranged.unionByName(_edges(ranged), allowMissingColumns=True).withColumns({"__last": last, "__next": following}).where("__side = 2")

    back, ahead = F.col("__t") - F.col("__last.us"), F.col("__next.us") - F.col("__t")
    back_ok, ahead_ok = F.coalesce(back <= tolerance_us, F.lit(False)), F.coalesce(ahead <= tolerance_us, F.lit(False))
    chosen = F.when(back_ok & (~ahead_ok | (back <= ahead)), F.col("__last")).when(ahead_ok, F.col("__next"))
    matched = carried.withColumn("__match", chosen).select("__row.*", F.col("__match.id").alias("match_id"), F.col("__match.us").alias("match_us"))
    return matched.unionByName(untimed, allowMissingColumns=True)
