"""Irregular readings onto a regular grid, holes filled by low-rank factorisation.

Sources are the rows and grid instants the columns of a matrix whose observed cells are the readings. Spark's
alternating least squares factorises it; a hole's value is the product of its row's and its column's factors.
Observed cells keep their reading. A cell that nothing supports stays marked, without a value.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.times import micros
from candlewright.session import checkpointed

#: Instants in a stretch of a source that gets factors of its own. It bounds the cells of a matrix row, whatever a source holds.
STRETCH = 256
#: ALS takes row and column numbers below this.
_MOST_NUMBERS = 1 << 31
#: Cells of a block of the factorisation: as many blocks as there are cores, as long as each has the first number; more, where a block had more than the second.
_FEW_CELLS, _MANY_CELLS = 50_000, 5_000_000


def nearest_instant(at: Column, period_s: Column) -> Column:
    """The multiple of ``period_s`` nearest to ``at``, as a count of periods since 1970; half way goes to the earlier."""
    period = period_s.cast("bigint") * 1_000_000
    twice = micros(at) * 2 - period
    return -F.floor(-(twice / (period * 2))).cast("bigint")


def observed_cells(readings: DataFrame, source: list[str], at: str, value: str, period_s: Column, latest: str) -> DataFrame:
    """One row per source and occupied grid instant: ``source, period_s, slot, value``.

    Of several readings at one instant the one with the greatest ``latest`` counts, then the greatest value.
    """
    cells = readings.select(
        *source,
        period_s.cast("bigint").alias("period_s"),
        nearest_instant(F.col(at), period_s).alias("slot"),
        F.col(value).cast("double").alias("__value"),
        F.col(latest).alias("__latest"),
    ).where("period_s IS NOT NULL AND slot IS NOT NULL")
    newest = F.max_by("__value", F.struct("__latest", "__value"))
    return cells.groupBy(*source, "period_s", "slot").agg(newest.alias("value"))


def holes(cells: DataFrame, source: list[str], longest_s: int) -> DataFrame:
    """The stretches of empty instants between neighbouring occupied ones: ``source, period_s, before, after, is_halt``.

    Neighbours are sought within stretches of time first and then between them, so that no source is sorted in
    one task. A stretch is a halt where its occupied ends lie more than ``longest_s`` apart.
    """
    keys = [*source, "period_s"]
    stretched = cells.select(*keys, F.floor(F.col("slot") / STRETCH).alias("stretch"), "slot")
    within = Window.partitionBy(*keys, "stretch").orderBy("slot")
    inner = stretched.withColumn("before", F.lag("slot").over(within)).select(*keys, "before", F.col("slot").alias("after"))
    ends = stretched.groupBy(*keys, "stretch").agg(F.min("slot").alias("low"), F.max("slot").alias("high"))
    between = Window.partitionBy(*keys).orderBy("stretch")
    outer = ends.withColumn("before", F.lag("high").over(between)).select(*keys, "before", F.col("low").alias("after"))
    apart = (F.col("after") - F.col("before")) * F.col("period_s")
    return inner.unionByName(outer).where("after - before > 1").withColumn("is_halt", apart > longest_s)


def _numbered(rows: DataFrame, out: str) -> DataFrame:
    """Distinct ``rows`` with ``out``: numbers from 0 on without a hole, given in parallel, the same whenever they are read.

    More rows than ALS has numbers are an error.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = checkpointed(rows.withColumns({"__part": F.spark_partition_id(), "__place": place}))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    number = F.col("__offset") + F.col("__place")
    fitting = F.coalesce(F.when(number < _MOST_NUMBERS, number), F.raise_error(F.lit(f"too many numbers: {out}")).cast("bigint"))
    return placed.join(F.broadcast(offsets), "__part").withColumn(out, fitting.cast("int")).drop("__part", "__place", "__offset")


def _blocks(rows: DataFrame) -> int:
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return max(2, min(cores, n // _FEW_CELLS), -(-n // _MANY_CELLS))


def regular_grid(
    readings: DataFrame,
    source: list[str],
    at: str,
    value: str,
    period_s: Column,
    latest: str,
    longest_s: int = 7 * 86400,
    rank: int = 3,
    iterations: int = 6,
    regularisation: float = 0.02,
) -> DataFrame:
    """One row per source and grid instant: ``source, period_s, grid_s, value, status, n_periods``.

    ``status`` is ``observed`` (the reading itself), ``filled`` (a hole, from the factors), ``unsupported`` (a hole
    in whose column no source has a reading, or whose row has fewer than ``rank`` of them: no value) or ``halt``
    (one row without value for a stretch of more than ``longest_s``; ``n_periods`` tells its length and
    ``grid_s`` its first instant). ``n_periods`` is 1 for all others.

    Each row of the matrix is a stretch of a source, scaled by its own mean and deviation, so that one source
    with most of the readings is many rows. Sources with different periods share no column. Columns are the instants
    that any source has a reading at; a stray instant adds one and changes nothing else.

    Defined results: readings without source, time, finite value, or known period play no part; repeated readings
    are one cell; a source with one reading has no holes; an empty table gives no rows; other columns play no part.
    Before a source's first and after its last reading there is no grid.
    """
    keys = [*source, "period_s"]
    finite = F.abs(F.col(value).cast("double")) < float("inf")  # NaN counts as greater
    usable = readings.where(" AND ".join(f"`{c}` IS NOT NULL" for c in source)).where(finite)
    cells = checkpointed(observed_cells(usable, source, at, value, period_s, latest))
    gaps = checkpointed(holes(cells, source, longest_s))

    stretch = F.floor(F.col("slot") / STRETCH).alias("stretch")
    scales = cells.groupBy(*keys, stretch).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"), F.count(F.lit(1)).alias("n_cells")
    )
    matrix_rows = _numbered(scales, "row_no")
    matrix_columns = _numbered(cells.select("period_s", "slot").distinct(), "column_no")

    scaled = F.coalesce((F.col("value") - F.col("mean")) / F.nullif("deviation", F.lit(0.0)), F.lit(0.0))
    placed = cells.withColumn("stretch", stretch).join(matrix_rows, [*keys, "stretch"]).join(matrix_columns, ["period_s", "slot"])
    ratings = checkpointed(placed.select("row_no", "column_no", scaled.cast("float").alias("rating")))
    empty = gaps.where("NOT is_halt").select(*keys, F.explode(F.sequence(F.expr("before + 1"), F.expr("after - 1"))).alias("slot"))
    wanted = empty.withColumn("stretch", stretch).join(matrix_rows, [*keys, "stretch"], "left").join(matrix_columns, ["period_s", "slot"], "left")
    if ratings.isEmpty():
        predicted = wanted.withColumn("prediction", F.lit(None).cast("float"))
    else:
        blocks = _blocks(ratings)
        als = ALS(
            rank=rank, maxIter=iterations, regParam=regularisation, numUserBlocks=blocks, numItemBlocks=blocks, seed=7,
            userCol="row_no", itemCol="column_no", ratingCol="rating",
        )
        model = als.fit(ratings)
        rows_of = model.userFactors.select(F.col("id").alias("row_no"), F.col("features").alias("__row"))
        columns_of = model.itemFactors.select(F.col("id").alias("column_no"), F.col("features").alias("__column"))
        product = F.aggregate(F.zip_with("__row", "__column", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        predicted = wanted.join(rows_of, "row_no", "left").join(columns_of, "column_no", "left").withColumn("prediction", product)
    supported = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.col("n_cells") >= rank)
    guess = F.when(supported, F.col("mean") + F.col("deviation") * F.col("prediction"))
    grid_s = (F.col("slot") * F.col("period_s")).alias("grid_s")
    filled = predicted.select(
        *keys, grid_s, guess.alias("value"), F.when(supported, "filled").otherwise("unsupported").alias("status"), F.lit(1).cast("bigint").alias("n_periods")
    )
    observed = cells.select(*keys, grid_s, "value", F.lit("observed").alias("status"), F.lit(1).cast("bigint").alias("n_periods"))
    halted = gaps.where("is_halt").select(
        *keys,
        ((F.col("before") + 1) * F.col("period_s")).alias("grid_s"),
        F.lit(None).cast("double").alias("value"),
        F.lit("halt").alias("status"),
        (F.col("after") - F.col("before") - 1).alias("n_periods"),
    )
    return observed.unionByName(filled).unionByName(halted)
