"""Backfill and listening jobs: sources, rules, sinks and marks put together.

``python -m candlewright.plans.jobs candles|messages|listen --help``. Each option may also be set in the environment:
``--days-back`` as CANDLEWRIGHT_DAYS_BACK.
"""

from __future__ import annotations

import argparse
import logging
import os
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.language import Detector, fit_detector
from candlewright.functions.times import TIMEFRAME_SECONDS
from candlewright.logs import get_logger
from candlewright.operators import candles as C
from candlewright.operators import messages as M
from candlewright.operators import sinks as S
from candlewright.schemas import MESSAGES, SCRAPE_CHECKPOINTS
from candlewright.session import checkpointed, use_utc
from candlewright.sources import history, klines
from candlewright.sources.channels import read_scrape_marks
from candlewright.streaming import messages as stream

log = logging.getLogger("candlewright")


def backfill_candles(raw: DataFrame, sink: str, gaps: str | None = None, rejects: str | None = None) -> DataFrame:
    """Raw klines (``coin, timeframe, kline``, perhaps ``error``) into the candle table at ``sink``.

    Gives one row per pair: rows, valid and skipped ones, and ``ok``, ``no data`` or ``error`` (the pair couldn't be
    fetched). Gaps between valid candles and rejected rows are written beside, if asked. A second run adds nothing.
    """
    failed = F.col("error") if "error" in raw.columns else F.lit(None).cast("string")
    raw = raw.withColumn("error", failed).persist(StorageLevel.MEMORY_AND_DISK)
    checked = C.checked_candles(C.parse_klines(raw.where("error IS NULL"))).persist(StorageLevel.MEMORY_AND_DISK)
    valid = checked.where("reject_reason IS NULL").drop("reject_reason", "parse_error")
    S.insert_ignore(S.stored_candles(valid), sink, ["coin", "timeframe", "open_time"], [], layout=S.CANDLE_LAYOUT)
    if gaps is not None:
        C.candle_gaps(valid).write.mode("overwrite").parquet(gaps)
    if rejects is not None:
        checked.where("reject_reason IS NOT NULL").write.mode("append").parquet(rejects)
    errors = raw.groupBy("coin", "timeframe").agg(F.max("error").alias("error"))
    summary = errors.join(C.pair_summary(checked), ["coin", "timeframe"], "left")
    status = F.when(F.col("error").isNotNull(), "error").otherwise(F.coalesce("status", F.lit("no data")))
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_valid", "n_skipped")}
    found = checkpointed(summary.withColumns({**counts, "status": status}))
    raw.unpersist()
    checked.unpersist()
    return found


def backfill_messages(
    messages: DataFrame,
    sink: str,
    marks: str,
    limit: int | None = M.SCAN_LIMIT,
    before: str | None = None,
    since: str | None = None,
    keys: list[str] | None = None,
    rejects: str | None = None,
    detector: Detector | None = None,
) -> DataFrame:
    """The newest messages of each channel, beyond its mark, into the table at ``sink``.

    The limit counts raw messages; the mark cuts after it. Marks are written after the rows, so a failed run is simply
    run again. Rejected rows are written beside, if asked. Gives the valid and rejected messages of each channel.
    """
    spark = messages.sparkSession
    known = S.read_marks(spark, marks, SCRAPE_CHECKPOINTS)
    new = M.resume(M.scan_window(messages, limit, before, since), known)
    checked = M.checked_messages(new).persist(StorageLevel.MEMORY_AND_DISK)
    valid = checked.where("reject_reason IS NULL").drop("reject_reason")
    now = F.current_timestamp().cast("timestamp_ntz")
    at = F.coalesce("ingested_at", now) if "ingested_at" in valid.columns else now
    stored = lambda rows: S.stored_messages(M.enriched(rows, detector), MESSAGES, at)
    order = ["ingested_at"] if "ingested_at" in valid.columns else ["created_at"]
    S.insert_ignore(valid, sink, keys or ["id"], order, layout=S.MESSAGE_LAYOUT, finish=stored)
    if rejects is not None:
        checked.where("reject_reason IS NOT NULL").write.mode("append").parquet(rejects)
    both = known.select("channel", "last_message_id").unionByName(M.high_marks(valid))
    S.write_marks(both.groupBy("channel").agg(F.max("last_message_id").alias("last_message_id")), marks)
    counts = checked.groupBy("channel_name").agg(
        F.count_if(F.col("reject_reason").isNull()).alias("n_valid"), F.count_if(F.col("reject_reason").isNotNull()).alias("n_rejected")
    )
    found = checkpointed(counts)
    checked.unpersist()
    return found


def _detector(spark: SparkSession, samples: str | None) -> Detector | None:
    """A detector fitted on the labelled texts at ``samples`` (``lang, text``)."""
    if samples is None:
        log.warning("no --language-samples: languages stay NULL")
        return None
    return fit_detector(spark.read.parquet(samples), "lang", "text")


def _read_klines(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    klines.register(spark)
    since = int((time.time() - options.days_back * 86_400) * 1000)
    read = spark.read.format("klines").options(coins=options.coins, timeframes=options.timeframes, base_url=options.url, since_ms=str(since))
    return read.load()


def _read_history(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.source:
        return spark.read.parquet(options.source)
    return history.read(spark, options.url, options.channels, options.marks, options.limit, options.before, options.since)


def _seed_marks(spark: SparkSession, marks: str, files: str | None) -> None:
    """Take over marks kept as one JSON file a channel, where there are no others yet."""
    if files and S.read_marks(spark, marks, SCRAPE_CHECKPOINTS).isEmpty():
        S.write_marks(read_scrape_marks(spark, files).select("channel", "last_message_id"), marks)


def _options(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    candles = jobs.add_parser("candles", help="fetch klines and store candles")
    history = jobs.add_parser("messages", help="store messages of a history: parquet files, or a service that gives pages")
    listen = jobs.add_parser("listen", help="store new messages as they arrive")

    def option(job: argparse.ArgumentParser, name: str, required: bool = False, **how) -> None:
        default = os.environ.get("CANDLEWRIGHT_" + name.upper().replace("-", "_"), how.pop("default", None))
        job.add_argument(f"--{name}", default=default, required=required and default is None, **how)

    option(candles, "coins", required=True)
    option(candles, "timeframes", default=",".join(TIMEFRAME_SECONDS))
    option(candles, "url", required=True)
    option(candles, "days-back", type=int, default="90")
    option(candles, "gaps", help="where to write gaps between candles")
    option(history, "source", help="parquet files of raw messages")
    option(history, "url", help="a service of message histories, instead of --source")
    option(history, "channels", help="channels to ask the service for")
    option(history, "marks", required=True)
    option(history, "json-marks", help="a folder of marks, one JSON file a channel, to begin with")
    option(history, "limit", type=int, default=str(M.SCAN_LIMIT))
    option(history, "before")
    option(history, "since")
    option(listen, "source", required=True)
    option(listen, "checkpoint", required=True)
    option(listen, "channels")
    listen.add_argument("--once", action="store_true", help="take what is there and stop, for schedulers")
    for job in (history, listen):
        option(job, "language-samples", help="parquet of labelled texts (lang, text) that languages are learnt from")
    for job in (candles, history, listen):
        option(job, "sink", required=True)
        option(job, "rejects", help="where to write rejected rows")
        option(job, "log-file", help="a file for the log, beside standard output")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = _options(arguments)
    get_logger(file=options.log_file)
    spark = SparkSession.builder.appName(f"candlewright-{options.job}").getOrCreate()
    use_utc(spark)
    if options.job == "candles":
        for row in backfill_candles(_read_klines(spark, options), options.sink, options.gaps, options.rejects).toLocalIterator():
            log.info("%s %s: %s, %d valid, %d skipped", row.coin, row.timeframe, row.status, row.n_valid, row.n_skipped)
    elif options.job == "messages":
        _seed_marks(spark, options.marks, options.json_marks)
        found = backfill_messages(
            _read_history(spark, options), options.sink, options.marks, options.limit, options.before, options.since,
            rejects=options.rejects, detector=_detector(spark, options.language_samples),
        )
        for row in found.toLocalIterator():
            log.info("%s: %d valid, %d rejected", row.channel_name, row.n_valid, row.n_rejected)
    else:
        channels = options.channels.split(",") if options.channels else None
        detector = _detector(spark, options.language_samples)
        query = stream.start(stream.read_messages(spark, options.source), options.sink, options.checkpoint, options.rejects, channels, once=options.once, detector=detector)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()


if __name__ == "__main__":
    main()
