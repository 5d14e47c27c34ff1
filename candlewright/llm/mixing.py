"""Mixing sources to target weights.

Each document has a fixed hash. The budget of a source becomes a hash threshold: documents below it are taken
once more than those above. Thresholds are found from histograms of tokens by source and hash bucket; only the
bucket that holds the boundary is counted anew with finer buckets. Nothing is sorted and no document is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.tokens import VOCABULARY, token_count
from candlewright.session import checkpointed

#: Bits of the hash that each histogram resolves, and how many histograms there are at most.
LEVEL_BITS = 10
LEVELS = 5
_BITS = LEVEL_BITS * LEVELS
#: Sources up to which the targets are broadcast; beyond, they are joined by shuffle.
SMALL = 10_000


def _if_small(rows: DataFrame) -> DataFrame:
    """``rows`` marked for broadcast after a count has shown that they are few."""
    return F.broadcast(rows) if rows.limit(SMALL + 1).count() <= SMALL else rows


def sized_documents(
    documents: DataFrame, targets: DataFrame, doc_id: str, source: str, text: str, vocabulary: str = VOCABULARY, size: Column | None = None
) -> DataFrame:
    """``id, source, n_tokens, hash`` of the documents whose source has a target. A NULL text has no tokens.

    ``size``, an expression of the column ``text``, replaces the vocabulary's tokens by another measure.
    """
    wanted = _if_small(targets.select(F.col("source").alias("__source")).where("__source IS NOT NULL").distinct())
    rows = documents.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.col(text).alias("text"))
    kept = rows.join(wanted, F.col("source") == F.col("__source"), "left_semi")
    measured = token_count(F.col("text"), vocabulary) if size is None else size.cast("bigint")
    sized = kept.select("id", "source", F.coalesce(measured, F.lit(0)).alias("n_tokens"))
    return sized.withColumn("hash", F.shiftrightunsigned(F.xxhash64("id"), 64 - _BITS))


def _histogram(sized: DataFrame) -> DataFrame:
    """Tokens by source and first bits of the hash: at most 2**LEVEL_BITS rows a source."""
    bucket = F.shiftright(F.col("hash"), _BITS - LEVEL_BITS).alias("bucket")
    return checkpointed(sized.groupBy("source", bucket).agg(F.sum("n_tokens").alias("tokens")))


def _budgets(counts: DataFrame, targets: DataFrame) -> DataFrame:
    goals = targets.where("source IS NOT NULL").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("bigint").alias("max_repeats")
    )
    sums = counts.groupBy("source").agg(F.sum("tokens").alias("available"))
    total = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).scalar()
    repeats = F.greatest(F.coalesce(F.col("max_repeats"), F.lit(1)), F.lit(0))
    wanted = F.coalesce(F.col("target_share"), F.lit(0.0)) * total
    most = repeats * F.col("available")
    return (
        goals.join(sums, "source", "left")
        .withColumn("available", F.coalesce("available", F.lit(0)).cast("bigint"))
        .withColumn("wanted", wanted)
        .withColumn("is_short", most < F.col("wanted"))
        .withColumn("budget", F.least(F.floor("wanted"), most))
    )


def source_budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: ``source, target_share, max_repeats, available, wanted, is_short, budget``.

    ``available`` is the source's tokens, ``wanted`` its share of all of them together, ``is_short`` whether
    even ``max_repeats`` uses fall short, ``budget`` what can be used. The first histogram tells all of it.
    """
    return _budgets(_histogram(sized), targets)


def plan_mixture(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows of ``source_budgets`` with ``whole`` and ``threshold``, which say what to use.

    Documents are used ``whole`` times, those with a hash below ``threshold`` once more. The tokens chosen miss the
    budget by at most half the tokens of one document (or of the documents with one hash).
    """
    counts = _histogram(sized)
    budgets = _budgets(counts, targets)
    whole = F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available"))).otherwise(0).cast("bigint")
    plan = (
        budgets.withColumn("whole", whole)
        .withColumn("rest", (F.col("budget") - F.col("whole") * F.col("available")).cast("bigint"))
        .withColumn("threshold", F.lit(0).cast("bigint"))
    )
    plan = checkpointed(plan)
    for level in range(1, LEVELS + 1):
        shift = _BITS - LEVEL_BITS * level
        if level > 1:
            open_now = plan.where("rest > 0").select(F.col("source").alias("__source"), F.shiftright("threshold", shift + LEVEL_BITS).alias("__prefix"))
            inside = (F.col("source") == F.col("__source")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("__prefix"))
            boundary = sized.join(_if_small(open_now), inside, "left_semi")
            counts = boundary.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("n_tokens").alias("tokens"))
        running = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket"))
        summed = counts.withColumn("running", running).join(plan.where("rest > 0").select("source", "rest"), "source")
        fits = F.col("running") <= F.col("rest")
        edge = summed.groupBy("source").agg(
            F.coalesce(F.max(F.when(fits, F.col("running"))), F.lit(0)).alias("__taken"),
            F.min(F.when(~fits, F.col("bucket"))).alias("__edge"),
            F.min(F.when(~fits, F.col("running"))).alias("__beyond"),
        )
        left = F.col("rest") - F.coalesce("__taken", F.lit(0))
        nearer = F.lit(level == LEVELS) & (F.col("__beyond") - F.col("rest") < left)
        plan = checkpointed(
            plan.join(edge, "source", "left")
            .withColumn("threshold", F.coalesce(F.shiftleft(F.col("__edge") + nearer.cast("bigint"), shift), F.col("threshold")))
            .withColumn("rest", left)
            .drop("__taken", "__edge", "__beyond")
        )
    return plan.drop("rest", "budget")


def mixture(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``id, source, n_tokens, copies`` of the documents that the plan uses at least once."""
    uses = _if_small(plan.select(F.col("source").alias("__source"), "whole", "threshold"))
    rows = sized.join(uses, F.col("source") == F.col("__source"))
    rows = rows.withColumn("copies", F.col("whole") + (F.col("hash") < F.col("threshold")).cast("bigint"))
    return rows.where("copies > 0").select("id", "source", "n_tokens", "copies")


def mixture_report(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per target with the tokens used and the share reached of all tokens used."""
    used = mixture(sized, plan).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("used"), F.sum("copies").alias("n_uses"), F.max("copies").alias("most_copies")
    )
    rows = plan.join(used, "source", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    total = used.agg(F.sum("used").alias("n")).scalar()
    return rows.select(
        "source",
        "target_share",
        "max_repeats",
        "available",
        "wanted",
        "used",
        F.coalesce(F.col("used") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("actual_share"),
        F.coalesce("n_uses", F.lit(0)).alias("n_uses"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        "is_short",
    )
