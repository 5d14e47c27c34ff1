"""Messages: scan windows, resuming, accepting or rejecting rows, enrichment, counts and marks."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.language import Detector
from candlewright.functions.text import extract_coins, route_language, strip

#: Least length of a text after trimming, and how many messages a channel's scan takes.
LEAST_TEXT = 10
SCAN_LIMIT = 5000


def _newest(messages: DataFrame, keys: list[str], by: list[Column], limit: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return messages.withColumn("__place", place).where(F.col("__place") <= limit).drop("__place")


def scan_window(messages: DataFrame, limit: int | None = SCAN_LIMIT, before: str | None = None, since: str | None = None) -> DataFrame:
    """The newest ``limit`` messages of each channel by id, among those before and since the given instants.

    The limit counts raw messages, before any check; None takes all of them. Rows with equal ids are ordered by time, then
    by text. A channel's rows are spread over all tasks, which keep the newest of their own; these are then brought
    together, in two steps where there are many tasks.
    """
    if before is not None:
        messages = messages.where(F.col("created_at") < F.lit(before).cast("timestamp_ntz"))
    if since is not None:
        messages = messages.where(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
    if limit is None:
        return messages
    ties = [c for c in ("created_at", "message_text", "ingested_at") if c in messages.columns]
    by = [F.desc("id"), *(F.desc(c) for c in ties)]
    columns = messages.columns
    # copies of one row are told apart by where they come from
    messages = messages.withColumn("__spread", F.xxhash64("id", *ties, F.spark_partition_id()))
    salts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while salts > 1:
        messages = _newest(messages.withColumn("__salt", F.pmod("__spread", F.lit(salts))), ["channel_name", "__salt"], by, limit)
        salts = isqrt(salts) if salts > 64 else 1
    return _newest(messages, ["channel_name"], by, limit).select(*columns)


def resume(messages: DataFrame, marks: DataFrame, channel: str = "channel_name") -> DataFrame:
    """Messages beyond their channel's mark (``channel, last_message_id``); no mark, NULL or 0 cuts nothing."""
    mark = marks.groupBy(F.col("channel").alias("__channel")).agg(F.max("last_message_id").alias("__mark"))
    joined = messages.join(mark, F.col(channel) == F.col("__channel"), "left")
    keep = F.col("__mark").isNull() | (F.col("__mark") == 0) | (F.col("id") > F.col("__mark"))
    return joined.where(keep).drop("__channel", "__mark")


def with_default_metrics(messages: DataFrame) -> DataFrame:
    """Missing views and forwards as 0."""
    return messages.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("views", "forwards")})


def message_error(strict: bool = False) -> Column:
    """Why a message is rejected, NULL if it isn't.

    The lenient rules want a text; the strict ones take a NULL text but no empty one.
    """
    text = F.col("message_text")
    short = F.length(strip(text)) < LEAST_TEXT
    rules = F.when(F.col("id").isNull(), "no id").when(F.col("channel_name").isNull(), "no channel").when(F.col("created_at").isNull(), "no time")
    if not strict:
        rules = rules.when(text.isNull() | (text == ""), "no text")
    rules = rules.when(text.isNotNull() & short, "text too short")
    return rules.when(F.col("views") < 0, "negative views").when(F.col("forwards") < 0, "negative forwards")


def checked_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """``messages`` with default metrics and ``reject_reason``, NULL for valid rows."""
    return with_default_metrics(messages).withColumn("reject_reason", message_error(strict))


def enriched(messages: DataFrame, detector: Detector | None = None) -> DataFrame:
    """Add the coins named in the text and its routed language, which stays NULL where no ``detector`` is given."""
    text = F.col("message_text")
    found = F.lit(None).cast("string") if detector is None else detector.language_of(text)
    return messages.withColumns({"coins_mentioned": extract_coins(text), "language": route_language(text, found)})


def split_messages(messages: DataFrame, strict: bool = False, detector: Detector | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid, enriched messages, and the rejected ones with their ``reject_reason``. The same for batch and stream."""
    checked = checked_messages(messages, strict)
    valid = checked.where("reject_reason IS NULL").drop("reject_reason")
    return enriched(valid, detector), checked.where("reject_reason IS NOT NULL")


def channel_counts(messages: DataFrame) -> DataFrame:
    """Messages by channel name as written."""
    return messages.groupBy("channel_name").agg(F.count(F.lit(1)).alias("n_messages"))


def high_marks(valid: DataFrame) -> DataFrame:
    """The mark to resume from: the greatest valid id of each channel."""
    return valid.groupBy(F.col("channel_name").alias("channel")).agg(F.max("id").alias("last_message_id"))


def with_channel(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Messages with their channel's username and title by ``channel_id``; NULL where it is missing or unknown.

    Messages without ``channel_id``, which are many, take no part in the join and so never meet in one task.
    """
    named = channels.select(F.col("id").alias("__id"), F.col("username").alias("channel_username"), F.col("title").alias("channel_title"))
    known = messages.where("channel_id IS NOT NULL").join(named, F.col("channel_id") == F.col("__id"), "left").drop("__id")
    return known.unionByName(messages.where("channel_id IS NULL"), allowMissingColumns=True)


def coin_counts(messages: DataFrame) -> DataFrame:
    """Messages by coin that their text names."""
    named = messages.select(F.explode(extract_coins(F.col("message_text"))).alias("coin"))
    return named.groupBy("coin").agg(F.count(F.lit(1)).alias("n_messages"))
