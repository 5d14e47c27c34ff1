"""Ordered per-key results when a few keys hold most rows.

Rows are range-partitioned on the key *and* the order within it, at quantiles that Spark samples, so a heavy
key is spread over as many tasks as its rows deserve. Each task folds its sorted run of every key into one
partial state; the states of a key that crosses a boundary are then stitched in order. Only the states, one
per key and partition (two where the key has untimed rows), are shuffled by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_NONE = np.iinfo(np.int64).min


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each row but the first differs from the row before; NULL equals NULL."""
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return codes[1:] != codes[:-1]


def _runs(batch: pa.RecordBatch, n_keys: int, quiet_us: int) -> pa.RecordBatch:
    """One state for each run of a key, timed or untimed, in a batch that is sorted by keys and time."""
    keys = [batch.column(i) for i in range(n_keys)]
    t = pc.fill_null(batch.column(n_keys), _NONE).to_numpy()
    known = t != _NONE
    change = known[1:] != known[:-1]
    for key in keys:
        change |= _changes(key)
    starts = np.concatenate(([0], np.flatnonzero(change) + 1))
    ends = np.append(starts[1:], len(t)) - 1
    step = np.full(len(t), -1, dtype=np.int64)
    step[1:] = t[1:] - t[:-1]
    step[starts] = -1
    step[~known] = -1
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(starts)) for key in keys]
        + [
            pa.array(ends - starts + 1),
            pa.array(t[starts], mask=~known[starts]),
            pa.array(t[ends], mask=~known[starts]),
            pa.array(np.maximum.reduceat(step, starts)),
            pa.array(np.add.reduceat((step > quiet_us).astype(np.int64), starts)),
        ],
        names=[*_names(n_keys), "n", "first_us", "last_us", "step_us", "quiet"],
    )


def _carried_on(run: dict, after: dict, n_keys: int, quiet_us: int) -> dict | None:
    """A run with the one that comes right after it, if both are of one key."""
    timed = run["first_us"] is not None
    if any(run[k] != after[k] for k in _names(n_keys)) or timed != (after["first_us"] is not None):
        return None
    joined = run | {"n": run["n"] + after["n"], "last_us": after["last_us"], "quiet": run["quiet"] + after["quiet"]}
    if timed:
        seam = after["first_us"] - run["last_us"]
        joined |= {"step_us": max(run["step_us"], after["step_us"], seam), "quiet": joined["quiet"] + (seam > quiet_us)}
    return joined


def _names(n_keys: int) -> list[str]:
    return [f"k{i}" for i in range(n_keys)]


def _fold_runs(n_keys: int, quiet_us: int):
    """A task's Arrow batches, sorted by keys and time, to one state for each run of a key, whatever the batches' bounds."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0

        def numbered(runs: pa.RecordBatch) -> pa.RecordBatch:
            place = [pa.array(np.full(len(runs), part, dtype=np.int32)), pa.array(np.arange(seq, seq + len(runs)))]
            at = n_keys
            return pa.RecordBatch.from_arrays(
                [*runs.columns[:at], *place, *runs.columns[at:]], names=[*runs.schema.names[:at], "part", "seq", *runs.schema.names[at:]]
            )

        last = None  # the batch's last run, which the next batch may carry on
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = _runs(batch, n_keys, quiet_us)
            if last is not None:
                joined = _carried_on(last.to_pylist()[0], runs.slice(0, 1).to_pylist()[0], n_keys, quiet_us)
                first = last if joined is None else pa.RecordBatch.from_pylist([joined], schema=runs.schema)
                rest = runs if joined is None else runs.slice(1)
                runs = pa.Table.from_batches([first, rest]).combine_chunks().to_batches()[0]
            last = runs.slice(len(runs) - 1)
            if len(runs) > 1:
                yield numbered(runs.slice(0, len(runs) - 1))
                seq += len(runs) - 1
        if last is not None:
            yield numbered(last)

    return fold


def _partial_states(ordered: DataFrame, n_keys: int, quiet_us: int, partitions: int | None) -> DataFrame:
    """States of the keys in each of the range partitions of ``ordered``, whose columns are keys, ``__t`` and ties."""
    by = ordered.columns
    ranged = ordered.repartitionByRange(partitions, *by) if partitions else ordered.repartitionByRange(*by)
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}
    schema = ", ".join(f"{k} {kinds[k]}" for k in _names(n_keys))
    schema += ", part int, seq bigint, n bigint, first_us bigint, last_us bigint, step_us bigint, quiet bigint"
    return ranged.sortWithinPartitions(*by).select(*_names(n_keys), "__t").mapInArrow(_fold_runs(n_keys, quiet_us), schema)


def key_profile(
    rows: DataFrame, keys: list[str], order: str, ties: list[str] | None = None, quiet_seconds: int = 3600, partitions: int | None = None
) -> DataFrame:
    """One row per key: ``n_rows, first_at, last_at, longest_gap_us, n_bursts``.

    ``longest_gap_us`` is the longest time between two consecutive rows of the key (NULL below two timed
    rows); ``n_bursts`` counts the stretches that a silence of more than ``quiet_seconds`` parts.

    Defined results: a NULL key is a key like any other; rows with a NULL ``order`` count in ``n_rows`` only;
    repeated rows and ties all count; an empty table gives no rows; other columns of ``rows`` play no part,
    whatever their names. A key whose rows all tie on ``order`` is split by ``ties`` and, beyond them, by
    the input partitions that its rows come from, which stay the same when a task is run again.
    """
    ties = ties or []
    ordered = rows.select(
        *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)),
        F.unix_micros(F.col(order).cast("timestamp")).alias("__t"),
        *(F.col(c).alias(f"__tie{i}") for i, c in enumerate(ties)),
        F.spark_partition_id().alias("__from"),
    )
    names = _names(len(keys))
    states = _partial_states(ordered, len(keys), quiet_seconds * 1_000_000, partitions)
    before = Window.partitionBy(*names).orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    seam = F.col("first_us") - F.last("last_us", ignorenulls=True).over(before)
    stitched = states.withColumn("seam_us", seam).groupBy(*names).agg(
        F.sum("n").alias("n_rows"),
        F.timestamp_micros(F.min("first_us")).cast("timestamp_ntz").alias("first_at"),
        F.timestamp_micros(F.max("last_us")).cast("timestamp_ntz").alias("last_at"),
        F.max(F.greatest(F.nullif("step_us", F.lit(-1)), "seam_us")).alias("longest_gap_us"),
        (
            F.sum(F.col("quiet") + F.coalesce((F.col("seam_us") > quiet_seconds * 1_000_000).cast("bigint"), F.lit(0)))
            + F.max(F.col("first_us").isNotNull().cast("bigint"))
        ).alias("n_bursts"),
    )
    return stitched.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), "n_rows", "first_at", "last_at", "longest_gap_us", "n_bursts")


def heavy_keys(profile: DataFrame, rows: DataFrame, share: str) -> DataFrame:
    """The rows of a ``key_profile`` of ``rows`` that hold at least ``share`` (a decimal as text) of all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return profile.where(F.col("n_rows") >= F.lit(Decimal(share)) * total)
