from datetime import datetime

import pytest

from candlewright.logs import get_logger
from candlewright.operators.sinks import read_marks
from candlewright.plans import jobs
from candlewright.plans.jobs import backfill_candles, backfill_messages
from candlewright.schemas import SCRAPE_CHECKPOINTS
from candlewright.sources import http, klines
from tests.helpers import spark_bag

HOUR = 3_600_000
RAW = "coin string, timeframe string, kline array<string>, error string"


def kline(hour, close="1.5", volume="1"):
    return [str(1_700_000_000_000 + hour * HOUR), "1", "2", "0.5", close, volume]


def test_candle_backfill_isolates_pairs_and_is_idempotent(spark, tmp_path):
    rows = [("A", "1h", kline(h), None) for h in (0, 1, 5, 5)] + [("A", "1h", kline(6, "-1"), None), ("A", "1h", ["x"], None)]
    rows += [("B", "1h", None, "URLError: down"), ("C", "1d", kline(0, "abc"), None)]
    for _ in range(2):
        found = backfill_candles(spark.createDataFrame(rows, RAW), f"{tmp_path}/sink", f"{tmp_path}/gaps", f"{tmp_path}/rejects")
        got = {r.coin: (r.n_rows, r.n_valid, r.n_skipped, r.status) for r in found.collect()}
        assert got == {"A": (6, 4, 2, "ok"), "B": (0, 0, 0, "error"), "C": (1, 0, 1, "no data")}
        assert spark.read.parquet(f"{tmp_path}/sink").count() == 3 and spark.read.parquet(f"{tmp_path}/gaps").count() == 1
    assert dict(spark.read.parquet(f"{tmp_path}/sink").dtypes)["close"] == "decimal(20,8)"


def test_candle_job_writes_gaps_and_rejects(spark, tmp_path, monkeypatch):
    pages = {"A": [kline(0), kline(9), kline(10, "-1"), ["x"]], "B": []}
    monkeypatch.setattr(klines.KlineReader, "_fetch", lambda self, pair, start: pages[pair.coin])
    reader = klines.KlineReader({"coins": "A,B", "timeframes": "1h", "base_url": "unused"})
    rows = [row for pair in reader.partitions() for row in reader.read(pair)]
    monkeypatch.setattr(jobs, "_read_klines", lambda spark, options: spark.createDataFrame(rows, RAW))
    monkeypatch.setenv("CANDLEWRIGHT_GAPS", f"{tmp_path}/gaps")
    jobs.main(["candles", "--coins", "A,B", "--url", "unused", "--sink", f"{tmp_path}/sink", "--rejects", f"{tmp_path}/rejects"])
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 2
    gap = spark.read.parquet(f"{tmp_path}/gaps").first()
    assert (gap.gap_to - gap.gap_from).total_seconds() == 9 * 3600
    assert sorted(r.reject_reason for r in spark.read.parquet(f"{tmp_path}/rejects").collect()) == ["negative close", "short kline"]


def test_message_job_writes_rejects_and_languages(spark, data, tmp_path):
    source = f"{data}/telegram_messages.parquet"
    jobs.main(["messages", "--source", source, "--sink", f"{tmp_path}/sink", "--marks", f"{tmp_path}/marks", "--limit", "50", "--rejects", f"{tmp_path}/rejects",
               "--language-samples", f"{data}/language_samples.parquet"])
    rejects = spark.read.parquet(f"{tmp_path}/rejects")
    assert rejects.count() > 0 and rejects.where("reject_reason IS NULL").count() == 0
    told = {r.language for r in spark.read.parquet(f"{tmp_path}/sink").select("language").distinct().collect()}
    assert told == {"vi", "en", None}


def test_message_job_begins_with_marks_from_files(spark, tmp_path):
    schema = "id bigint, channel_name string, message_text string, views int, forwards int, created_at timestamp_ntz"
    spark.createDataFrame([message(i) for i in range(1, 9)], schema).write.parquet(f"{tmp_path}/in")
    (tmp_path / "json").mkdir()
    (tmp_path / "json/c.json").write_text('{"last_message_id": 5, "last_scraped_at": "2024-01-01T00:00:00+00:00"}')
    run = ["messages", "--source", f"{tmp_path}/in", "--sink", f"{tmp_path}/sink", "--marks", f"{tmp_path}/marks", "--json-marks", f"{tmp_path}/json"]
    for _ in range(2):
        jobs.main(run)
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/sink").collect()) == [6, 7, 8]
        assert read_marks(spark, f"{tmp_path}/marks", SCRAPE_CHECKPOINTS).first().last_message_id == 8


def test_listening_once(spark, data, tmp_path):
    folder = f"{tmp_path}/in"
    spark.read.parquet(f"{data}/telegram_messages.parquet").limit(200).write.parquet(folder)
    for _ in range(2):
        jobs.main(["listen", "--once", "--source", folder, "--sink", f"{tmp_path}/sink", "--checkpoint", f"{tmp_path}/c", "--log-file", f"{tmp_path}/log"])
    assert 0 < spark.read.parquet(f"{tmp_path}/sink").count() <= 200


def test_loggers_have_one_handler_of_a_kind(tmp_path, capsys):
    for _ in range(3):
        log = get_logger("cw-test", f"{tmp_path}/log")
    log.info("one line")
    assert capsys.readouterr().out.count("one line") == 1 and (tmp_path / "log").read_text().count("INFO cw-test one line") == 1


def test_a_server_that_asks_for_too_long_a_wait(monkeypatch):
    waits = []
    monkeypatch.setattr(http.time, "sleep", waits.append)

    def answer(told):
        def fail(*_, **__):
            raise http.urllib.error.HTTPError("u", 429, "slow", {"Retry-After": told} if told else {}, None)

        return fail

    for told, expected in (("7", [7.0, 7.0]), (None, [2.0, 4.0]), ("3601", [])):
        waits.clear()
        monkeypatch.setattr(http.urllib.request, "urlopen", answer(told))
        with pytest.raises(OSError):
            http.get_json("http://nowhere", {"a": None})
        assert waits == expected


def message(i, channel="c", text="a text that is long enough"):
    return (i, channel, text, 1, None, datetime(2024, 1, 1, i % 24))


def test_message_backfill_resumes_from_its_marks(spark, tmp_path):
    schema = "id bigint, channel_name string, message_text string, views int, forwards int, created_at timestamp_ntz"
    run = lambda rows, **o: backfill_messages(spark.createDataFrame(rows, schema), f"{tmp_path}/sink", f"{tmp_path}/marks", **o)
    first = run([message(i) for i in range(1, 6)] + [message(6, text="short"), message(9, "d")], limit=3)
    assert {r.channel_name: (r.n_valid, r.n_rejected) for r in first.collect()} == {"c": (2, 1), "d": (1, 0)}
    marks = lambda: {r.channel: r.last_message_id for r in read_marks(spark, f"{tmp_path}/marks", SCRAPE_CHECKPOINTS).collect()}
    assert marks() == {"c": 5, "d": 9}
    again = run([message(i) for i in range(1, 9)])
    assert {r.channel_name: (r.n_valid, r.n_rejected) for r in again.collect()} == {"c": (3, 0)} and marks() == {"c": 8, "d": 9}
    stored = spark_bag(spark.read.parquet(f"{tmp_path}/sink").select("id", "has_media", "reply_count"))
    assert [int(r[1]) for r in stored] == sorted([4, 5, 9, 6, 7, 8], key=lambda i: ("False", i))
    assert run([message(3)]).count() == 0 and marks() == {"c": 8, "d": 9}
