"""Data source of raw klines from an exchange's REST interface, one partition per coin and timeframe.

``spark.read.format("klines")`` after ``register``. Options: ``coins`` and ``timeframes`` (comma-separated), ``since_ms``,
``base_url`` and ``limit``. A pair that can't be fetched gives one row with ``error`` instead of failing the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from candlewright.sources.http import get_json

SCHEMA = "coin string, timeframe string, kline array<string>, error string"


class Pair(InputPartition):
    def __init__(self, coin: str, timeframe: str):
        super().__init__((coin, timeframe))
        self.coin, self.timeframe = coin, timeframe


class KlineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.coins = [c.strip() for c in options.get("coins", "").split(",") if c.strip()]
        self.timeframes = [t.strip() for t in options.get("timeframes", "15m,1h,4h,1d").split(",") if t.strip()]
        self.since = options.get("since_ms")
        self.url = options.get("base_url", "")
        self.limit = int(options.get("limit", "1000"))

    def partitions(self) -> list[InputPartition]:
        return [Pair(c, t) for c in self.coins for t in self.timeframes]

    def read(self, partition: Pair) -> Iterator[tuple]:
        if partition is None:  # no pairs were asked for
            return
        start = int(self.since) if self.since else None
        try:
            while True:
                page = self._fetch(partition, start)
                for kline in page:
                    yield partition.coin, partition.timeframe, [str(x) for x in kline], None
                if len(page) < self.limit:
                    return
                start = int(page[-1][0]) + 1
        except Exception as error:  # one pair's failure must not end the others
            yield partition.coin, partition.timeframe, None, f"{type(error).__name__}: {error}"

    def _fetch(self, pair: Pair, start: int | None) -> list:
        return get_json(self.url, {"symbol": pair.coin, "interval": pair.timeframe, "limit": self.limit, "startTime": start or None})


class KlineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "klines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return KlineReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KlineSource)
