"""Data source of channels' message histories from a service that gives pages of them, newest first.

``spark.read.format("history")`` after ``register``; one partition a channel. A page is a JSON list of messages with ``id``,
``date`` (ISO 8601) and perhaps ``text, views, forwards, chat_id, has_media, reply_count``; it is asked for by ``channel``,
``limit``, ``offset_id`` (only smaller ids) and ``offset_date`` (only earlier ones). Options: ``base_url``, ``channels``
(comma-separated), ``limit`` (messages of a channel), ``before`` and ``since``, ``marks`` (JSON: channel to the greatest id
that is stored already), ``page``. All of them are applied while reading, so that no page beyond them is fetched. A channel
that can't be read gives one row with ``error`` after what could be.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from candlewright.operators.sinks import read_marks
from candlewright.schemas import SCRAPE_CHECKPOINTS
from candlewright.sources.http import get_json

SCHEMA = (
    "channel_name string, channel_id bigint, id bigint, message_text string, views int, forwards int, has_media boolean, "
    "reply_count int, created_at timestamp_ntz, error string"
)


def _instant(text: str) -> datetime:
    """An ISO 8601 time as UTC wall clock; one without zone is UTC already."""
    at = datetime.fromisoformat(text)
    return at.astimezone(UTC).replace(tzinfo=None) if at.tzinfo else at


class Channel(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class HistoryReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options.get("base_url", "")
        self.channels = [c.strip() for c in options.get("channels", "").split(",") if c.strip()]
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.before = _instant(options["before"]) if options.get("before") else None
        self.since = _instant(options["since"]) if options.get("since") else None
        self.marks = json.loads(options.get("marks", "{}"))
        self.page = int(options.get("page", "100"))

    def partitions(self) -> list[InputPartition]:
        return [Channel(c) for c in self.channels]

    def read(self, partition: Channel) -> Iterator[tuple]:
        if partition is None:  # no channels were asked for
            return
        left, offset, mark = self.limit, None, self.marks.get(partition.name) or None
        try:
            while left is None or left > 0:
                size = self.page if left is None else min(self.page, left)
                page = self._fetch(partition.name, size, offset)
                for message in page:
                    at = _instant(message["date"])
                    if (mark is not None and message["id"] <= mark) or (self.since is not None and at < self.since):
                        return
                    offset = message["id"]
                    if self.before is None or at < self.before:
                        left = None if left is None else left - 1
                        yield (partition.name, message.get("chat_id"), message["id"], message.get("text"), message.get("views"), message.get("forwards"),
                               message.get("has_media"), message.get("reply_count"), at, None)
                if len(page) < size:
                    return
        except Exception as error:  # one channel's failure must not end the others
            yield partition.name, None, None, None, None, None, None, None, None, f"{type(error).__name__}: {error}"

    def _fetch(self, channel: str, limit: int, offset: int | None) -> list:
        before = self.before.isoformat() if self.before else None
        return get_json(self.url, {"channel": channel, "limit": limit, "offset_id": offset, "offset_date": before})


class HistorySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "history"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HistoryReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HistorySource)


def read(spark: SparkSession, url: str, channels: str, marks: str, limit: int | None = None, before: str | None = None, since: str | None = None) -> DataFrame:
    """The histories of ``channels`` beyond the marks at the folder ``marks``, with the bounds pushed into the requests."""
    register(spark)
    known = read_marks(spark, marks, SCRAPE_CHECKPOINTS).where("last_message_id > 0")
    asked = [c.strip() for c in channels.split(",") if c.strip()]
    held = {r.channel: r.last_message_id for r in known.where(known.channel.isin(asked)).collect()}  # at most one for each channel asked for
    options = {"base_url": url, "channels": channels, "marks": json.dumps(held)}
    options |= {k: str(v) for k, v in (("limit", limit), ("before", before), ("since", since)) if v is not None}
    return spark.read.format("history").options(**options).load()
