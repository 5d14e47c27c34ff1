import json
import sqlite3
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import functions as F

from candlewright.operators import sinks as S
from candlewright.operators.messages import split_messages
from candlewright.schemas import MESSAGES, SCRAPE_CHECKPOINTS, TABLES
from candlewright.sources import catalog, channels, history, http, klines
from candlewright.streaming import messages as stream
from tests.helpers import spark_bag

KV = "k int, o int, v string"


def test_first_wins_with_ties_nulls_and_repeats(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (1, 1, "c"), (None, 1, "x"), (None, 0, None), (2, None, "n"), (2, 5, "m"), (2, 5, "m")]
    got = S.first_wins(spark.createDataFrame(rows, KV), ["k"], ["o"])
    assert spark_bag(got) == spark_bag(spark.createDataFrame([(1, 1, "a"), (None, 0, None), (2, None, "n")], KV))
    assert S.first_wins(spark.createDataFrame([], KV), ["k"], ["o"]).count() == 0


def test_insert_ignore_keeps_what_is_stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.insert_ignore(spark.createDataFrame([(1, 2, "late"), (1, 1, "early"), (None, 1, "null")], KV), path, ["k"], ["o"])
    S.insert_ignore(spark.createDataFrame([(1, 0, "new"), (2, 0, "two"), (None, 0, "other")], KV), path, ["k"], ["o"])
    once = spark_bag(spark.read.parquet(path))
    assert once == spark_bag(spark.createDataFrame([(1, 1, "early"), (None, 1, "null"), (2, 0, "two")], KV))
    S.insert_ignore(spark.createDataFrame([(1, 0, "new"), (2, 0, "two")], KV), path, ["k"], ["o"])
    assert spark_bag(spark.read.parquet(path)) == once


def test_insert_ignore_reads_what_the_batch_touches(spark, tmp_path):
    path, layout = f"{tmp_path}/t", {"part": "CAST(pmod(k, 4) AS INT)"}
    S.insert_ignore(spark.createDataFrame([(i, 0, "old") for i in range(8)] + [(None, 0, "null")], KV), path, ["k"], ["o"], layout)
    batch = spark.createDataFrame([(1, 0, "new"), (9, 0, "nine"), (None, 1, "again")], KV)
    touched = S._touched(spark.read.parquet(path), batch, layout)
    assert {r.k for r in touched.collect()} == {1, 5, None} and "PartitionFilters: [((part" in touched._jdf.queryExecution().executedPlan().toString()
    S.insert_ignore(batch, path, ["k"], ["o"], layout)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {**{i: "old" for i in range(8)}, 9: "nine", None: "null"} and spark.read.parquet(path).count() == 10


def test_insert_into_database(spark, tmp_path):
    path = f"{tmp_path}/candles.db"
    connect = lambda: sqlite3.connect(path, timeout=60)
    with connect() as db:
        db.execute("CREATE TABLE candles (coin TEXT, timeframe TEXT, open_time TEXT, id INTEGER, UNIQUE (coin, timeframe, open_time))")
    rows = [("A" if i % 3 else "B", "1h", datetime(2024, 1, 1) + timedelta(hours=i), i) for i in range(70)]
    df = spark.createDataFrame(rows + rows[:5], "coin string, timeframe string, open_time timestamp_ntz, id int")
    chunked = S.numbered_chunks(df, size=10).withColumn("open_time", F.col("open_time").cast("string"))
    assert S.insert_chunks(df, size=10).agg(F.sum("n_rows"), F.max("n_rows")).first() == (75, 10)
    kept = ["coin", "timeframe", "open_time", "id"]
    for _ in range(2):
        S.insert_into_database(chunked, connect, "candles", kept, ["coin", "timeframe", "chunk"])
        assert sorted(connect().execute("SELECT id FROM candles")) == [(i,) for i in range(70)]
    S.insert_into_database(df.limit(0).withColumn("open_time", F.lit("x")), connect, "candles", kept)
    other = spark.createDataFrame([("C", "1h", "t", 900), ("A", "1h", str(rows[1][2]), 901)], "coin string, timeframe string, open_time string, id int")
    S.insert_into_database(other, connect, "candles", kept)
    assert [r for r in connect().execute("SELECT id FROM candles WHERE id >= 900")] == [(900,)]


def test_marks_are_versions(spark, tmp_path):
    folder = f"{tmp_path}/marks"
    assert S.read_marks(spark, folder, SCRAPE_CHECKPOINTS).count() == 0
    for mark in (5, 9):
        S.write_marks(spark.createDataFrame([("c", mark)], "channel string, last_message_id bigint"), folder)
    assert S.read_marks(spark, folder, SCRAPE_CHECKPOINTS).first().last_message_id == 9
    S.clear_marks(spark, folder)
    assert S.read_marks(spark, folder, SCRAPE_CHECKPOINTS).count() == 0


def test_stored_projections(spark):
    df = spark.createDataFrame([(1, "c", "a long enough text", 1, 1, datetime(2024, 1, 1))], "id bigint, channel_name string, message_text string, views int, forwards int, created_at timestamp_ntz")
    row = S.stored_messages(split_messages(df)[0], MESSAGES, F.lit("2024-02-01").cast("timestamp_ntz")).first()
    assert (row.has_media, row.reply_count, row.is_processed, row.ingested_at) == (False, 0, False, datetime(2024, 2, 1))
    prices = spark.createDataFrame([(1.5, float("nan"), float("inf"), 1e13, 0.0)], "open double, high double, low double, close double, volume double")
    assert [None if x is None else float(x) for x in S.stored_candles(prices).first()] == [1.5, None, None, None, 0.0]


def test_stream_equals_batch_and_replay_adds_nothing(spark, data, tmp_path):
    source = f"{data}/telegram_messages.parquet"
    valid, rejected = split_messages(spark.read.parquet(source))
    batch = S.first_wins(S.stored_messages(valid, MESSAGES, F.col("ingested_at")), ["id"], ["ingested_at"])
    for checkpoint in ("one", "one", "two"):
        query = stream.start(stream.read_messages(spark, source), f"{tmp_path}/sink", f"{tmp_path}/{checkpoint}", f"{tmp_path}/rejects", once=True)
        query.awaitTermination()
        assert spark_bag(spark.read.parquet(f"{tmp_path}/sink").drop(*S.MESSAGE_LAYOUT)) == spark_bag(batch)
    assert spark.read.parquet(f"{tmp_path}/rejects/batch=0").count() == rejected.count()


def test_stream_filters_channels(spark, data, tmp_path):
    rows = stream.read_messages(spark, f"{data}/telegram_messages.parquet")
    query = stream.start(rows, f"{tmp_path}/sink", f"{tmp_path}/c", channels=["KhoLuaToken"], keys=["channel_name", "id"], once=True)
    query.awaitTermination()
    assert {r[0] for r in spark.read.parquet(f"{tmp_path}/sink").select("channel_name").distinct().collect()} == {"KhoLuaToken"}


def test_channel_lists_and_marks_from_files(spark, tmp_path):
    (tmp_path / "channels.yaml").write_text('# lists\nchannels:\n  english:\n    - "@one"\n    - two # note\n  vietnamese:\n    - ba\n')
    rows = channels.read_channel_lists(spark, f"{tmp_path}/channels.yaml")
    assert [tuple(r) for r in rows.orderBy("position").collect()] == [(1, "english", "@one"), (2, "english", "two"), (3, "vietnamese", "ba")]
    (tmp_path / "marks").mkdir()
    (tmp_path / "marks/a.json").write_text(json.dumps({"last_message_id": 7, "last_scraped_at": "2024-01-01T00:00:00+00:00"}, indent=1))
    row = channels.read_scrape_marks(spark, f"{tmp_path}/marks").first()
    assert tuple(row) == ("a", 7, datetime(2024, 1, 1))


def test_catalog(spark):
    assert catalog.create_databases(spark, " cw_one, ,cw_two") == ["cw_one", "cw_two"]
    catalog.create_tables(spark, "cw_one")
    assert {t.name for t in spark.catalog.listTables("cw_one")} == set(TABLES)
    catalog.drop_tables(spark, "cw_one")
    assert not spark.catalog.listTables("cw_one")
    for name in ("cw_one", "cw_two"):
        spark.sql(f"DROP DATABASE {name}")


def test_kline_source_isolates_failures(spark, tmp_path):
    klines.register(spark)
    page = tmp_path / "page.json"
    page.write_text(json.dumps([[1700000000000, "1", "2", "0.5", "1.5", "10"]]))
    reader = klines.KlineReader({"coins": "A,B", "timeframes": "1h", "base_url": "file:///nowhere"})
    reader._fetch = lambda pair, start: json.loads(page.read_text()) if pair.coin == "A" else (_ for _ in ()).throw(OSError("down"))
    got = [list(reader.read(p)) for p in reader.partitions()]
    assert got[0] == [("A", "1h", ["1700000000000", "1", "2", "0.5", "1.5", "10"], None)] and got[1][0][3] == "OSError: down"
    assert spark.read.format("klines").option("coins", "").load().count() == 0


class Service(BaseHTTPRequestHandler):
    """Channel ``c`` holds messages 1 to 250, one an hour; the first answer says to wait, channel ``gone`` fails."""

    asked: list[dict] = []

    def do_GET(self):
        query = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        self.asked.append(query)
        if query["channel"] == "gone" or len(self.asked) == 1:
            self.send_response(404 if query["channel"] == "gone" else 429)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        ids = [i for i in range(250, 0, -1) if i < int(query.get("offset_id", 999))]
        ids = [i for i in ids if (datetime(2024, 1, 1) + timedelta(hours=i)).isoformat() < query.get("offset_date", "9")]
        at = lambda i: f"{(datetime(2024, 1, 1) + timedelta(hours=i + 7)).isoformat()}+07:00"
        page = [{"id": i, "date": at(i), "text": f"message number {i}", "views": i} for i in ids[: int(query["limit"])]]
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(page).encode())

    def log_message(self, *_):
        pass


def test_history_source_pushes_bounds_and_waits_as_told(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/messages"
    S.write_marks(spark.createDataFrame([("c", 100), ("d", 0)], "channel string, last_message_id bigint"), f"{tmp_path}/marks")
    ids = lambda **o: sorted(r.id for r in history.read(spark, url, "c", f"{tmp_path}/marks", **o).collect())
    assert ids() == list(range(101, 251))
    assert ids(limit=30) == list(range(221, 251))
    assert ids(limit=30, before="2024-01-05T04:00:00") == []
    assert ids(limit=9, before="2024-01-09T08:00:00") == list(range(191, 200))
    assert ids(since="2024-01-11T00:00:00") == list(range(240, 251))
    asked = len(Service.asked)
    rows = history.read(spark, url, "gone,c", f"{tmp_path}/none", limit=5).collect()
    server.shutdown()
    assert len(Service.asked) - asked == http.ATTEMPTS + 1
    assert sorted(r.id for r in rows if r.id) == [246, 247, 248, 249, 250] and [r.channel_name for r in rows if r.error] == ["gone"]
    assert rows[-1].created_at.hour == (rows[-1].id % 24) if rows[-1].id else True
