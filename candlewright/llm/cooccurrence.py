"""Items that appear together: stripes, then log-likelihood ratios.

Each task keeps an associative array of neighbours per item, the stripe, and counts into it as it reads; the
stripes of all tasks are merged by item, in blocks of neighbours, so that no item's stripe is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.session import checkpointed

#: Cells of the stripes, and items, that a task holds before it passes them on. Nothing is dropped; further stripes follow.
HELD_CELLS, HELD_ITEMS = 1_000_000, 500_000
#: Parts into which the neighbours of an item are split for merging.
BLOCKS = 32


def _pair_codes(item: np.ndarray, basket: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Codes ``a * n + b`` of each item with itself, then of all two items of a basket, by their distance in it."""
    yield item * n + item
    size = np.bincount(basket)[basket] if len(basket) else basket
    shift = 1
    while shift < len(item) and len(same := np.flatnonzero(basket[shift:] == basket[:-shift])):
        yield item[same] * n + item[same + shift]
        shift += 1
        if shift & (shift - 1) == 0:  # now and then, leave the baskets that are through
            left = size > shift
            item, basket, size = item[left], basket[left], size[left]


def _stripe_rows(names: dict[str, int], held: dict[tuple[int, int], int], records: int) -> pa.RecordBatch:
    """The held cells as one row per item and block of neighbours, and the count of records as an item without name."""
    ends = np.array(list(held), dtype=np.int64).reshape(-1, 2)
    counts = np.array(list(held.values()), dtype=np.int64)
    used, ends = np.unique(ends, return_inverse=True)
    ends = ends.reshape(-1, 2)
    words = np.array(list(names), dtype=object)[used]
    place = np.argsort(np.argsort(words, kind="stable"))
    turned = place[ends[:, 0]] > place[ends[:, 1]]
    item, neighbour = np.where(turned, ends[:, 1], ends[:, 0]), np.where(turned, ends[:, 0], ends[:, 1])
    block = (pd.util.hash_array(words, categorize=False) % BLOCKS).astype(np.int32)[neighbour]
    order = np.lexsort((block, item))
    item, neighbour, counts, block = item[order], neighbour[order], counts[order], block[order]
    first = np.flatnonzero(np.append(True, (np.diff(item) != 0) | (np.diff(block) != 0)))[: len(item)]
    offsets = pa.array([*first, len(item), len(item) + 1], pa.int32())
    named = pa.array([*words, None], pa.string())
    return pa.RecordBatch.from_arrays(
        [
            named.take(pa.array([*item[first], len(words)])),
            pa.array([*block[first], 0], pa.int32()),
            pa.ListArray.from_arrays(offsets, named.take(pa.array([*neighbour, len(words)]))),
            pa.ListArray.from_arrays(offsets, pa.array([*counts, records], pa.int64())),
        ],
        names=["item", "block", "neighbours", "counts"],
    )


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Baskets to stripes. An item's stripe counts its neighbours and, under its own name, its records."""
    names: dict[str, int] = {}
    held: dict[tuple[int, int], int] = {}
    records = 0
    for batch in batches:
        baskets = batch.column(0)
        flat = baskets.flatten().dictionary_encode()
        if not len(flat):
            continue
        records += len(baskets)
        code = np.array([names.setdefault(w, len(names)) for w in flat.dictionary.to_pylist()], dtype=np.int64)
        item = code[flat.indices.to_numpy()]
        basket = np.repeat(np.arange(len(baskets)), baskets.value_lengths().to_numpy())
        order = np.lexsort((item, basket))
        n = len(names)
        for codes in _pair_codes(item[order], basket[order], n):
            cell, count = np.unique(codes, return_counts=True)
            for a, b, k in zip((cell // n).tolist(), (cell % n).tolist(), count.tolist()):
                held[a, b] = held.get((a, b), 0) + k
            if len(held) >= HELD_CELLS:
                yield _stripe_rows(names, held, records)
                held, records = {}, 0
        if len(names) >= HELD_ITEMS:
            yield _stripe_rows(names, held, records)
            names, held, records = {}, {}, 0
    if held or records:
        yield _stripe_rows(names, held, records)


def _surprise(k: Column, row: Column, column: Column, n: Column) -> Column:
    return F.when(k > 0, k * F.log(k * n / (row * column))).otherwise(F.lit(0.0))


def log_likelihood_ratio(n_ab: Column, n_a: Column, n_b: Column, n: Column) -> Column:
    """G2 of the two-by-two table of records with and without a and b."""
    k, a, b, n = (x.cast("double") for x in (n_ab, n_a, n_b, n))
    with_b = _surprise(k, a, b, n) + _surprise(b - k, n - a, b, n)
    without_b = _surprise(a - k, a, n - b, n) + _surprise(n - a - b + k, n - a, n - b, n)
    return F.greatest(F.lit(0.0), 2 * (with_b + without_b))


def cooccurrences(baskets: DataFrame, items: str, least_llr: float | None = None) -> DataFrame:
    """All pairs that occur together: ``item_a < item_b, n_ab, n_a, n_b, n, lift, llr``.

    ``n`` counts the records with at least one item, ``n_a`` and ``n_b`` those with the item. ``lift`` is how
    much more often than chance the two meet; ``llr`` above 10.83 is significant at 0.1 %. With ``least_llr`` only
    the pairs come out that are at least so significant, meeting more or less often than chance.

    Defined results: NULL, empty or all-NULL baskets play no part; an item repeated in a basket counts once,
    NULL items not at all; the empty string is an item like any other; repeated baskets all count; an empty
    table gives no rows; other columns play no part.
    """
    kept = baskets.select(F.array_distinct(F.array_compact(F.col(items).cast("array<string>"))).alias("items")).where(F.size("items") > 0)
    stripes = kept.mapInArrow(_stripes, "item string, block int, neighbours array<string>, counts array<bigint>")
    cells = stripes.repartition("item", "block").select("item", "block", F.explode(F.arrays_zip("neighbours", "counts")).alias("cell"))
    merged = checkpointed(
        cells.groupBy("item", "block", F.col("cell.neighbours").alias("neighbour")).agg(F.sum("cell.counts").alias("n_ab")).drop("block")
    )
    n = merged.where("item IS NULL").select(F.col("n_ab").alias("n"))
    own = merged.where("item = neighbour").select("item", F.col("n_ab").alias("n_own"))
    pairs = merged.where("item <> neighbour").withColumn("n", n.scalar())
    a, b = own.withColumnsRenamed({"item": "item_a", "n_own": "n_a"}), own.withColumnsRenamed({"item": "item_b", "n_own": "n_b"})
    counted = pairs.withColumnsRenamed({"item": "item_a", "neighbour": "item_b"}).join(a, "item_a").join(b, "item_b")
    measured = counted.select(
        "item_a",
        "item_b",
        "n_ab",
        "n_a",
        "n_b",
        "n",
        (F.col("n_ab") * F.col("n") / (F.col("n_a") * F.col("n_b"))).alias("lift"),
        log_likelihood_ratio(F.col("n_ab"), F.col("n_a"), F.col("n_b"), F.col("n")).alias("llr"),
    )
    return measured if least_llr is None else measured.where(F.col("llr") >= least_llr)
