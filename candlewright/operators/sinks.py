"""Insert-or-ignore on parquet tables and in databases, marks, and the projections before a write.

Existing rows always win and are never changed; inside a batch the first row of a key wins. Parquet has no unique
keys, so a single writer per table is assumed; a replayed batch finds its rows stored and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count, groupby

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewright.operators.sequences import numbered

#: Rows of a transaction in a database sink.
CHUNK_ROWS = 2000
#: Ids of a block, and blocks after which they begin anew: a parquet table of messages is laid out by block.
_BLOCK_IDS, _BLOCKS = 4096, 16

# Where a row of each table lies: expressions of its key alone, with few values, so that a batch reads the parts it can touch.
MESSAGE_LAYOUT = {"id_block": f"CAST(pmod(id div {_BLOCK_IDS}, {_BLOCKS}) AS INT)"}
CANDLE_LAYOUT = {"timeframe": "timeframe", "open_month": "year(open_time) * 100 + month(open_time)"}


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, then by all other sortable columns. NULL keys are equal to each other.

    Spark ranks within each task before it moves rows, so that a key with most of the rows is never sorted in one task.
    """
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    sortable = [c for c, kind in rows.dtypes if c in others and "map<" not in kind and "variant" not in kind]
    by = [F.col(c) for c in dict.fromkeys([*order, *sortable])] or [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def _renamed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*(F.col(k).alias(f"__{k}") for k in keys))


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))


def missing_from(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of ``incoming`` that an insert-or-ignore into ``stored`` adds."""
    return first_wins(incoming, keys, order).join(_renamed(stored, keys), _same(keys), "left_anti")


def after_insert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table after an insert-or-ignore: what was stored, and what was missing."""
    return stored.unionByName(missing_from(stored, incoming, keys, order))


def _touched(stored: DataFrame, batch: DataFrame, layout: dict[str, str]) -> DataFrame:
    """The part of ``stored`` that lies where rows of ``batch`` would lie."""
    for name, place in layout.items():
        places = [r[0] for r in batch.select(F.expr(place).alias(name)).distinct().collect()]  # few, by the layout's definition
        known = F.col(name).isin([p for p in places if p is not None])
        stored = stored.where(known | F.col(name).isNull() if None in places else known)
    return stored


def insert_ignore(
    incoming: DataFrame,
    path: str,
    keys: list[str],
    order: list[str],
    layout: dict[str, str] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append to the parquet table at ``path`` the rows whose key it lacks. A table that isn't there yet is made.

    ``layout`` gives the table's partition columns as SQL over the key; only the partitions that the batch touches are
    read, and of these the keys that the batch has. ``finish`` makes the stored columns of the rows that are left, so
    that nothing is derived for rows that are ignored.
    """
    spark, layout = incoming.sparkSession, layout or {}
    added = batch = first_wins(incoming, keys, order)
    if exists(spark, path):
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # looked at several times
        kinds = batch.select(*keys, *(F.expr(e).alias(n) for n, e in layout.items() if n not in keys)).schema
        stored = _touched(spark.read.schema(kinds).parquet(path), batch, layout).select(*keys)
        met = stored.join(_renamed(batch, keys), _same(keys), "left_semi")  # the batch is the small side
        added = batch.join(_renamed(met, keys), _same(keys), "left_anti")
    rows = finish(added) if finish else added
    if layout:
        rows = rows.withColumns({n: F.expr(e) for n, e in layout.items()}).hint("rebalance", *(F.col(c) for c in layout))
    rows.write.mode("append").partitionBy(*layout).parquet(path)
    batch.unpersist()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at ``path``, on whatever file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def numbered_chunks(candles: DataFrame, size: int = CHUNK_ROWS) -> DataFrame:
    """Candles with ``chunk``: each pair's rows by time, then id, in stretches of ``size``; the transactions of a database sink."""
    timed = candles.withColumn("__t", F.unix_micros(F.col("open_time").cast("timestamp")))
    ordered = numbered(timed, ["coin", "timeframe"], "__t", [c for c in ("id",) if c in candles.columns], 90 * 86_400 * 1_000_000, out="__no")
    return ordered.withColumn("chunk", F.floor((F.col("__no") - 1) / size) + 1).drop("__t", "__no")


def insert_chunks(candles: DataFrame, size: int = CHUNK_ROWS) -> DataFrame:
    """Rows of each transaction that ``insert_into_database`` commits for chunked ``candles``."""
    return numbered_chunks(candles, size).groupBy("coin", "timeframe", "chunk").agg(F.count(F.lit(1)).alias("n_rows"))


def insert_into_database(
    rows: DataFrame, connect: Callable[[], object], table: str, columns: list[str], transaction: list[str] | None = None, mark: str = "?"
) -> None:
    """Insert ``columns`` of ``rows`` into a database's ``table``, leaving out rows that its unique keys already hold.

    ``connect`` opens a connection of Python's database interface in each task; ``mark`` is how its statements write a
    parameter. Rows with equal ``transaction`` columns are committed as a whole, or else each ``CHUNK_ROWS`` rows; what
    was committed before a failure is left out when the task is run again.
    """
    named, marks = ", ".join(columns), ", ".join([mark] * len(columns))
    statement = f"INSERT INTO {table} ({named}) VALUES ({marks}) ON CONFLICT DO NOTHING"
    if transaction:
        rows = rows.repartition(*transaction).sortWithinPartitions(*transaction)

    def write(partition: Iterator[Row]) -> None:
        place = count()
        of = (lambda r: tuple(r[c] for c in transaction)) if transaction else (lambda r: next(place) // CHUNK_ROWS)
        connection = connect()
        try:
            for _, group in groupby(partition, key=of):
                connection.cursor().executemany(statement, ([r[c] for c in columns] for r in group))
                connection.commit()
        finally:
            connection.close()

    rows.foreachPartition(write)


def stored_messages(valid: DataFrame, schema: StructType, ingested_at: Column) -> DataFrame:
    """Valid messages with all stored columns; those that ingestion doesn't know get their defaults."""
    defaults = {"has_media": F.lit(False), "reply_count": F.lit(0), "ingested_at": ingested_at, "is_processed": F.lit(False)}
    pick = lambda f: F.col(f.name) if f.name in valid.columns else defaults.get(f.name, F.lit(None))
    return valid.select(*(pick(f).cast(f.dataType).alias(f.name) for f in schema.fields))


def stored_candles(valid: DataFrame) -> DataFrame:
    """Valid candles with decimal prices; NaN and infinite numbers, and such as don't fit, are NULL."""
    numbers = ["open", "high", "low", "close", "volume"]
    return valid.withColumns({c: F.col(c).try_cast("decimal(20,8)") for c in numbers})


def write_marks(marks: DataFrame, folder: str) -> str:
    """Write ``channel, last_message_id, last_scraped_at`` as a new version beside the older ones; gives its path.

    A version counts once its ``_SUCCESS`` file is there, so a failed write changes nothing.
    """
    spark = marks.sparkSession
    version = len(_versions(spark, folder))
    path = f"{folder}/v{version:010d}"
    marks.withColumn("last_scraped_at", F.current_timestamp().cast("timestamp_ntz")).write.mode("overwrite").json(path)
    return path


def _versions(spark: SparkSession, folder: str) -> list[str]:
    if not exists(spark, folder):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in system.listStatus(at))
    return [n for n in names if n.startswith("v") and exists(spark, f"{folder}/{n}/_SUCCESS")]


def read_marks(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest complete version of the marks; an empty table where there is none."""
    versions = _versions(spark, folder)
    return spark.read.schema(schema).json(f"{folder}/{versions[-1]}") if versions else spark.createDataFrame([], schema)


def clear_marks(spark: SparkSession, folder: str) -> None:
    """Forget all marks, so that the next scan cuts nothing."""
    read_marks_schema = "channel string, last_message_id bigint"
    write_marks(spark.createDataFrame([], read_marks_schema), folder)
