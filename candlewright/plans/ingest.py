"""Queries of the ingest operators over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.language import Detector, fit_detector
from candlewright.functions.text import ASSETS, channel_or_id, extract_coins, preview, route_language, safe_name
from candlewright.operators import candles as C
from candlewright.operators import messages as M
from candlewright.operators import sinks as S
from candlewright.operators.indicators import COLUMNS, bollinger, indicators
from candlewright.plans import jobs
from candlewright.plans.feeds import named_messages
from candlewright.schemas import SCRAPE_CHECKPOINTS
from candlewright.session import shared_folder, use_utc
from candlewright.sources.channels import concatenated
from candlewright.sources.tables import read_table
from candlewright.streaming import messages as stream

#: What tells a stored row in the results below; rows that are stored more than once come out as often.
ROW = ["id", "channel_name", "created_at"]
CANDLE = ["coin", "timeframe", "open_time", "id"]
#: Rows before this day are the stored table of the insert-or-ignore queries; the whole table is the incoming batch.
STORED_UNTIL = "2024-10-28"
AS_OF = "2024-11-01"
WINDOW = 500


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "telegram_messages")


def _candles(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "ohlcv")


def channel_message_counts(spark: SparkSession, folder: str) -> DataFrame:
    return M.channel_counts(_messages(spark, folder))


def text_coins(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(spark, folder).select(*ROW, F.array_join(extract_coins(F.col("message_text")), ",").alias("coins"))


def coin_mention_counts(spark: SparkSession, folder: str) -> DataFrame:
    return M.coin_counts(_messages(spark, folder))


def message_validity(spark: SparkSession, folder: str) -> DataFrame:
    return M.checked_messages(_messages(spark, folder)).select(*ROW, "reject_reason")


def message_validity_strict(spark: SparkSession, folder: str) -> DataFrame:
    return M.checked_messages(_messages(spark, folder), strict=True).select(*ROW, "reject_reason")


def default_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return M.with_default_metrics(_messages(spark, folder)).select(*ROW, "views", "forwards")


def language_route(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(spark, folder).select(*ROW, route_language(F.col("message_text"), F.col("language")).alias("route"))


def _detector(spark: SparkSession, folder: str) -> Detector:
    return fit_detector(read_table(spark, folder, "language_samples"), "lang", "text")


def detected_language(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(spark, folder).select(*ROW, _detector(spark, folder).language_of(F.col("message_text")).alias("lang"))


def text_preview(spark: SparkSession, folder: str) -> DataFrame:
    text, at = F.col("message_text"), F.col("created_at")
    return _messages(spark, folder).select(*ROW, preview(text).alias("preview"), F.date_format(at, "HH:mm:ss").alias("time_of_day"))


def channel_safe_name(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(spark, folder).select("channel_name", safe_name(F.col("channel_name")).alias("safe_name")).distinct()


def channel_fallback(spark: SparkSession, folder: str) -> DataFrame:
    joined = M.with_channel(_messages(spark, folder), read_table(spark, folder, "telegram_channels"))
    return joined.select(*ROW, channel_or_id(F.col("channel_username"), F.col("channel_id")).alias("channel"))


def channel_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = M.with_channel(_messages(spark, folder), read_table(spark, folder, "telegram_channels"))
    return joined.select(*ROW, "channel_username", "channel_title")


def channel_union(spark: SparkSession, folder: str) -> DataFrame:
    channels = read_table(spark, folder, "telegram_channels")
    lists = [channels.where(F.col("language") == lang).select("username", "language") for lang in ("en", "vi")]
    return concatenated(*lists)


def scrape_window(spark: SparkSession, folder: str) -> DataFrame:
    named = named_messages(spark, folder).withColumn("channel_name", F.col("username"))
    newest = M.scan_window(named, limit=WINDOW)
    return M.resume(newest, read_table(spark, folder, "scrape_checkpoints")).select(*ROW)


def scan_newest(spark: SparkSession, folder: str) -> DataFrame:
    """Each channel's newest messages, as many as a scan takes by default."""
    named = named_messages(spark, folder).withColumn("channel_name", F.col("username"))
    return M.scan_window(named).select(*ROW)


def scan_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return M.scan_window(_messages(spark, folder), limit=None, before=AS_OF, since=STORED_UNTIL).select(*ROW)


def resume_marks(spark: SparkSession, folder: str) -> DataFrame:
    valid = M.checked_messages(_messages(spark, folder)).where("reject_reason IS NULL")
    return M.high_marks(valid)


def parse_klines(spark: SparkSession, folder: str) -> DataFrame:
    return C.parse_klines(C.to_klines(_candles(spark, folder)))


def price_decimal(spark: SparkSession, folder: str) -> DataFrame:
    raw = C.to_klines(_candles(spark, folder))
    return raw.select("coin", "timeframe", C.price_decimal(F.get("kline", F.lit(4))).cast("string").alias("close"))


def candle_validity(spark: SparkSession, folder: str) -> DataFrame:
    return C.checked_candles(_candles(spark, folder)).select(*CANDLE, "reject_reason")


def candle_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return C.candle_gaps(C.split_candles(_candles(spark, folder))[0])


def closed_candles(spark: SparkSession, folder: str) -> DataFrame:
    return C.closed_only(_candles(spark, folder), F.lit("2024-10-31 20:00:00").cast("timestamp_ntz")).select(*CANDLE)


def backfill_plan(spark: SparkSession, folder: str) -> DataFrame:
    return C.backfill_plan(_candles(spark, folder), F.lit(AS_OF).cast("timestamp_ntz"))


def pair_summary(spark: SparkSession, folder: str) -> DataFrame:
    return C.pair_summary(C.checked_candles(_candles(spark, folder)))


def first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return S.first_wins(_candles(spark, folder).select(*CANDLE), ["coin", "timeframe", "open_time"], ["id"])


def insert_ignore_candles(spark: SparkSession, folder: str) -> DataFrame:
    candles = _candles(spark, folder).select(*CANDLE, F.col("close").cast("string").alias("close"))
    stored = candles.where(f"open_time < '{STORED_UNTIL}'")
    return S.after_insert(stored, candles, ["coin", "timeframe", "open_time"], ["id"])


def insert_ignore_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = _messages(spark, folder).select("id", "channel_name", "ingested_at")
    stored = messages.where(f"ingested_at < '{STORED_UNTIL}'")
    return S.after_insert(stored, messages, ["id"], ["ingested_at"])


def insert_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return S.insert_chunks(_candles(spark, folder))


def stream_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    """The messages table as a stream that is run until it is empty, and what its sink then holds."""
    use_utc(spark)
    run = f"{shared_folder(spark)}/stream-{uuid4()}"
    rows = stream.read_messages(spark, f"{folder}/telegram_messages.parquet")
    query = stream.start(rows, f"{run}/sink", f"{run}/checkpoint", keys=["channel_name", "id"], once=True, detector=_detector(spark, folder))
    query.awaitTermination()
    kept = spark.read.parquet(f"{run}/sink")
    return kept.select("channel_name", "id", "ingested_at", F.array_join("coins_mentioned", ",").alias("coins"))


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What the same stream rejects, and why."""
    use_utc(spark)
    run = f"{shared_folder(spark)}/stream-{uuid4()}"
    rows = stream.read_messages(spark, f"{folder}/telegram_messages.parquet")
    stream.start(rows, f"{run}/sink", f"{run}/checkpoint", rejects=f"{run}/rejects", once=True).awaitTermination()
    return spark.read.parquet(f"{run}/rejects").select(*ROW, "reject_reason")


def _candle_job(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    run = f"{shared_folder(spark)}/candles-{uuid4()}"
    found = jobs.backfill_candles(C.to_klines(_candles(spark, folder)), f"{run}/sink", f"{run}/gaps", f"{run}/rejects")
    return found, run


def job_candles_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The outcome of a candle backfill by pair."""
    return _candle_job(spark, folder)[0].select("coin", "timeframe", "n_rows", "n_valid", "n_skipped", "status")


def job_candles_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The table that a candle backfill leaves."""
    stored = spark.read.parquet(f"{_candle_job(spark, folder)[1]}/sink")
    return stored.select("coin", "timeframe", "open_time", F.col("close").cast("string").alias("close"))


def job_candles_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The gaps that a candle backfill reports."""
    return spark.read.parquet(f"{_candle_job(spark, folder)[1]}/gaps")


def job_candles_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected candles by pair and reason."""
    rejects = spark.read.parquet(f"{_candle_job(spark, folder)[1]}/rejects")
    return rejects.groupBy("coin", "timeframe", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def _message_job(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    use_utc(spark)
    run = f"{shared_folder(spark)}/messages-{uuid4()}"
    S.write_marks(read_table(spark, folder, "scrape_checkpoints").select("channel", "last_message_id"), f"{run}/marks")
    named = named_messages(spark, folder).withColumn("channel_name", F.col("username"))
    return jobs.backfill_messages(named, f"{run}/sink", f"{run}/marks", limit=WINDOW, keys=["channel_name", "id"]), run


def job_messages_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Valid and rejected messages of a history backfill by channel."""
    return _message_job(spark, folder)[0]


def job_messages_marks(spark: SparkSession, folder: str) -> DataFrame:
    """The marks that a history backfill leaves."""
    return S.read_marks(spark, f"{_message_job(spark, folder)[1]}/marks", SCRAPE_CHECKPOINTS).select("channel", "last_message_id")


def _series(spark: SparkSession, folder: str) -> DataFrame:
    valid, _ = C.split_candles(_candles(spark, folder))
    return S.first_wins(valid, ["coin", "timeframe", "open_time"], ["id"])


def technical_indicators(spark: SparkSession, folder: str) -> DataFrame:
    found = indicators(_series(spark, folder))
    return found.withColumns({c: F.round(c, 4) for c in COLUMNS})


def bollinger_20(spark: SparkSession, folder: str) -> DataFrame:
    bands = bollinger(_series(spark, folder))
    return bands.withColumns({c: F.round(c, 4) for c in ("bb_upper", "bb_middle", "bb_lower")})


QUERIES = {
    f.__name__: f
    for f in (
        channel_message_counts, text_coins, coin_mention_counts, message_validity, message_validity_strict, default_metrics,
        language_route, detected_language, text_preview, channel_safe_name, channel_fallback, channel_join, channel_union,
        scrape_window, scan_newest, scan_bounds, resume_marks, parse_klines, price_decimal, candle_validity, candle_gaps, closed_candles,
        backfill_plan, pair_summary, first_wins, insert_ignore_candles, insert_ignore_messages, insert_chunks, stream_insert_ignore,
        stream_rejects, job_candles_summary, job_candles_stored, job_candles_gaps, job_candles_rejects, job_messages_summary,
        job_messages_marks, technical_indicators, bollinger_20,
    )
}

_BLANK = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
_STRIPPED = f"length(regexp_replace(message_text, '^{_BLANK}+|{_BLANK}+$', '', 'g'))"
_ASSETS = "[" + ", ".join(f"'{a}'" for a in ASSETS) + "]"
_COINS = f"list_filter({_ASSETS}, lambda a: contains(upper(coalesce(message_text, '')), a))"
_REASON = f"""
  CASE WHEN id IS NULL THEN 'no id' WHEN channel_name IS NULL THEN 'no channel' WHEN created_at IS NULL THEN 'no time'
    <text>
    WHEN message_text IS NOT NULL AND {_STRIPPED} < 10 THEN 'text too short'
    WHEN coalesce(views, 0) < 0 THEN 'negative views' WHEN coalesce(forwards, 0) < 0 THEN 'negative forwards' END
"""
_LENIENT = _REASON.replace("<text>", "WHEN message_text IS NULL OR message_text = '' THEN 'no text'")
_NUMBERS = ["open", "high", "low", "close", "volume"]
_CANDLE_REASON = (
    "CASE "
    + " ".join(f"WHEN {c} IS NULL THEN 'no {c}'" for c in ("coin", "timeframe", "open_time"))
    + " ".join(f" WHEN {c} IS NULL THEN 'no {c}' WHEN {c} < 0 THEN 'negative {c}'" for c in _NUMBERS)
    + " END"
)
_PERIOD = "CAST(CASE timeframe WHEN '15m' THEN 900 WHEN '1h' THEN 3600 WHEN '4h' THEN 14400 WHEN '1d' THEN 86400 END AS BIGINT)"
_FLAT_ROW = ", ".join(ROW)
_SCANNED = f"""
spelled AS (
  SELECT lower(username) AS spelled, username FROM telegram_channels WHERE NOT regexp_full_match(username, '[0-9]+')
  UNION ALL SELECT CAST(id AS VARCHAR), username FROM telegram_channels
),
placed AS (
  SELECT m.* REPLACE (c.username AS channel_name), row_number() OVER (
    PARTITION BY c.username ORDER BY m.id DESC NULLS LAST, m.created_at DESC NULLS LAST, m.message_text DESC NULLS LAST, m.ingested_at DESC NULLS LAST
  ) AS place
  FROM telegram_messages m LEFT JOIN spelled c ON lower(regexp_replace(trim(m.channel_name), '^@+', '')) = c.spelled
),
scanned AS (
  SELECT p.* FROM placed p LEFT JOIN scrape_checkpoints s ON p.channel_name = s.channel
  WHERE place <= {WINDOW} AND (s.last_message_id IS NULL OR s.last_message_id = 0 OR p.id > s.last_message_id)
)
"""
#: Candles as the raw klines give them: whole milliseconds, a missing number is a bad one.
_KLINE_REASON = (
    "CASE WHEN open_time IS NULL THEN 'bad time' "
    + " ".join(f"WHEN {c} IS NULL THEN 'bad {c}'" for c in _NUMBERS)
    + " WHEN coin IS NULL THEN 'no coin' WHEN timeframe IS NULL THEN 'no timeframe' "
    + " ".join(f"WHEN {c} < 0 THEN 'negative {c}'" for c in _NUMBERS)
    + " END"
)
_FETCHED = f"fetched AS (SELECT * REPLACE (make_timestamp((epoch_us(open_time) // 1000) * 1000) AS open_time), {_KLINE_REASON} AS reason FROM ohlcv)"


def _average(before: str, value: str, weight: str) -> str:
    return f"{before} + ({value} - {before}) * {weight}"


#: All indicators of a series, one candle after the other.
_INDICATORS = f"""
WITH RECURSIVE series AS (
  SELECT coin, timeframe, open_time, CAST(arg_min(high, id) AS DOUBLE) AS high, CAST(arg_min(low, id) AS DOUBLE) AS low, CAST(arg_min(close, id) AS DOUBLE) AS x
  FROM ohlcv WHERE ({_CANDLE_REASON}) IS NULL GROUP BY coin, timeframe, open_time
),
steps AS (
  SELECT *, row_number() OVER w AS k, x - coalesce(lag(x) OVER w, x) AS step, coalesce(lag(x) OVER w, x) AS before,
    CASE WHEN count(*) OVER b = 20 THEN avg(x) OVER b END AS middle, stddev_pop(x) OVER b AS deviation
  FROM series WINDOW w AS (PARTITION BY coin, timeframe ORDER BY open_time),
    b AS (PARTITION BY coin, timeframe ORDER BY open_time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
),
ranged AS (SELECT *, greatest(high - low, abs(high - before), abs(low - before)) AS span FROM steps),
carried AS (
  SELECT coin, timeframe, k, open_time, middle, deviation, 0.0::DOUBLE AS gain, 0.0::DOUBLE AS loss, x AS fast, x AS slow, 0.0::DOUBLE AS signal,
    x AS ema_20, x AS ema_50, span AS atr
  FROM ranged WHERE k = 1
  UNION ALL
  SELECT n.coin, n.timeframe, n.k, n.open_time, n.middle, n.deviation, {_average("gain", "greatest(step, 0)", "1.0::DOUBLE / 14")},
    {_average("loss", "greatest(-step, 0)", "1.0::DOUBLE / 14")}, {_average("fast", "x", "2.0::DOUBLE / 13")}, {_average("slow", "x", "2.0::DOUBLE / 27")},
    {_average("signal", f"({_average('fast', 'x', '2.0::DOUBLE / 13')} - ({_average('slow', 'x', '2.0::DOUBLE / 27')}))", "2.0::DOUBLE / 10")},
    {_average("ema_20", "x", "2.0::DOUBLE / 21")}, {_average("ema_50", "x", "2.0::DOUBLE / 51")}, {_average("atr", "span", "1.0::DOUBLE / 14")}
  FROM carried c JOIN ranged n ON n.coin = c.coin AND n.timeframe = c.timeframe AND n.k = c.k + 1
)
SELECT coin, timeframe, open_time AS calculated_at, round(CASE WHEN gain + loss > 0 THEN 100 * gain / (gain + loss) ELSE 50 END, 4) AS rsi_14,
  round(fast - slow, 4) + 0.0 AS macd_line, round(signal, 4) + 0.0 AS macd_signal, round(fast - slow - signal, 4) + 0.0 AS macd_histogram,
  round(middle + 2 * deviation, 4) AS bb_upper, round(middle, 4) AS bb_middle, round(middle - 2 * deviation, 4) AS bb_lower,
  round(ema_20, 4) AS ema_20, round(ema_50, 4) AS ema_50, round(atr, 4) AS atr_14
FROM carried
"""

SQL = {
    "channel_message_counts": "SELECT channel_name, count(*) AS n_messages FROM telegram_messages GROUP BY 1",
    "text_coins": f"SELECT {_FLAT_ROW}, array_to_string({_COINS}, ',') AS coins FROM telegram_messages",
    "coin_mention_counts": f"SELECT coin, count(*) AS n_messages FROM (SELECT unnest({_COINS}) AS coin FROM telegram_messages) GROUP BY coin",
    "message_validity": f"SELECT {_FLAT_ROW}, {_LENIENT} AS reject_reason FROM telegram_messages",
    "message_validity_strict": f"SELECT {_FLAT_ROW}, {_REASON.replace("<text>", "")} AS reject_reason FROM telegram_messages",
    "default_metrics": f"SELECT {_FLAT_ROW}, coalesce(views, 0) AS views, coalesce(forwards, 0) AS forwards FROM telegram_messages",
    "language_route": f"SELECT {_FLAT_ROW}, CASE WHEN {_STRIPPED} >= 20 AND language IN ('vi', 'en') THEN language END AS route FROM telegram_messages",
    "text_preview": f"""
SELECT {_FLAT_ROW}, CASE WHEN message_text <> '' THEN replace(substr(message_text, 1, 60), chr(10), ' ') ELSE '[Media/No Text]' END AS preview,
  strftime(created_at, '%H:%M:%S') AS time_of_day FROM telegram_messages
""",
    "channel_safe_name": "SELECT DISTINCT channel_name, replace(regexp_replace(channel_name, '^@+', ''), '/', '_') AS safe_name FROM telegram_messages",
    "channel_fallback": """
SELECT m.id, m.channel_name, m.created_at, coalesce(nullif(c.username, ''), CAST(m.channel_id AS VARCHAR)) AS channel
FROM telegram_messages m LEFT JOIN telegram_channels c ON m.channel_id = c.id
""",
    "channel_join": """
SELECT m.id, m.channel_name, m.created_at, c.username AS channel_username, c.title AS channel_title
FROM telegram_messages m LEFT JOIN telegram_channels c ON m.channel_id = c.id
""",
    "channel_union": """
SELECT username, language, CAST(1 AS INTEGER) AS list_no FROM telegram_channels WHERE language = 'en'
UNION ALL SELECT username, language, CAST(2 AS INTEGER) FROM telegram_channels WHERE language = 'vi'
""",
    "scrape_window": f"WITH {_SCANNED} SELECT {_FLAT_ROW} FROM scanned",
    "scan_newest": f"WITH {_SCANNED} SELECT {_FLAT_ROW} FROM placed WHERE place <= {M.SCAN_LIMIT}",
    "scan_bounds": f"SELECT {_FLAT_ROW} FROM telegram_messages WHERE created_at < '{AS_OF}' AND created_at >= '{STORED_UNTIL}'",
    "resume_marks": f"SELECT channel_name AS channel, max(id) AS last_message_id FROM telegram_messages WHERE ({_LENIENT}) IS NULL GROUP BY 1",
    "parse_klines": f"""
SELECT coin, timeframe, make_timestamp((epoch_us(open_time) // 1000) * 1000) AS open_time,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS)},
  CASE WHEN open_time IS NULL THEN 'bad time' {" ".join(f"WHEN {c} IS NULL THEN 'bad {c}'" for c in _NUMBERS)} END AS parse_error
FROM ohlcv
""",
    "price_decimal": "SELECT coin, timeframe, CAST(close AS VARCHAR) AS close FROM ohlcv",
    "candle_validity": f"SELECT coin, timeframe, open_time, id, {_CANDLE_REASON} AS reject_reason FROM ohlcv",
    "candle_gaps": f"""
SELECT coin, timeframe, before AS gap_from, open_time AS gap_to FROM (
  SELECT coin, timeframe, open_time, {_PERIOD} AS period, lag(open_time) OVER (PARTITION BY coin, timeframe ORDER BY open_time) AS before
  FROM ohlcv WHERE ({_CANDLE_REASON}) IS NULL
) WHERE epoch_us(open_time) - epoch_us(before) > period * 2500000
""",
    "closed_candles": f"SELECT coin, timeframe, open_time, id FROM ohlcv WHERE epoch_us(open_time) // 1000000 + {_PERIOD} <= epoch_us(TIMESTAMP '2024-10-31 20:00:00') // 1000000",
    "backfill_plan": f"""
SELECT coin, t.timeframe, t.seconds, TIMESTAMP '{AS_OF}' - INTERVAL 90 DAYS AS since, CAST(90 * 86400 // t.seconds AS BIGINT) AS expected
FROM (SELECT DISTINCT coin FROM ohlcv),
  (VALUES ('15m', CAST(900 AS BIGINT)), ('1h', CAST(3600 AS BIGINT)), ('4h', CAST(14400 AS BIGINT)), ('1d', CAST(86400 AS BIGINT))) t(timeframe, seconds)
""",
    "pair_summary": f"""
SELECT coin, timeframe, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_valid, count(*) FILTER (reason IS NOT NULL) AS n_skipped,
  CASE WHEN count(*) FILTER (reason IS NULL) > 0 THEN 'ok' ELSE 'no data' END AS status
FROM (SELECT coin, timeframe, {_CANDLE_REASON} AS reason FROM ohlcv) GROUP BY coin, timeframe
""",
    "first_wins": "SELECT coin, timeframe, open_time, min(id) AS id FROM ohlcv GROUP BY coin, timeframe, open_time",
    "insert_ignore_candles": f"""
WITH stored AS (SELECT * FROM ohlcv WHERE open_time < '{STORED_UNTIL}'),
added AS (
  SELECT coin, timeframe, open_time, min(id) AS id, arg_min(row(close), id) AS kept FROM ohlcv o
  WHERE NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.coin IS NOT DISTINCT FROM o.coin AND s.timeframe IS NOT DISTINCT FROM o.timeframe
      AND s.open_time IS NOT DISTINCT FROM o.open_time
  ) GROUP BY coin, timeframe, open_time
)
SELECT coin, timeframe, open_time, id, CAST(close AS VARCHAR) AS close FROM stored
UNION ALL SELECT coin, timeframe, open_time, id, CAST(kept[1] AS VARCHAR) FROM added
""",
    "insert_ignore_messages": f"""
WITH stored AS (SELECT id, channel_name, ingested_at FROM telegram_messages WHERE ingested_at < '{STORED_UNTIL}'),
placed AS (
  SELECT id, channel_name, ingested_at, row_number() OVER (PARTITION BY id ORDER BY ingested_at NULLS FIRST, channel_name NULLS FIRST) AS place
  FROM telegram_messages WHERE id NOT IN (SELECT id FROM stored)
)
SELECT * FROM stored UNION ALL SELECT id, channel_name, ingested_at FROM placed WHERE place = 1
""",
    "insert_chunks": """
SELECT coin, timeframe, chunk, count(*) AS n_rows FROM (
  SELECT coin, timeframe, CAST((row_number() OVER (PARTITION BY coin, timeframe ORDER BY open_time NULLS FIRST, id) - 1) // 2000 + 1 AS BIGINT) AS chunk FROM ohlcv
) GROUP BY coin, timeframe, chunk
""",
    "bollinger_20": f"""
WITH series AS (
  SELECT coin, timeframe, open_time, arg_min(CAST(close AS DOUBLE), id) AS x FROM ohlcv WHERE ({_CANDLE_REASON}) IS NULL GROUP BY ALL
),
banded AS (
  SELECT coin, timeframe, open_time, count(*) OVER w AS n, avg(x) OVER w AS middle, stddev_pop(x) OVER w AS deviation
  FROM series WINDOW w AS (PARTITION BY coin, timeframe ORDER BY open_time ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
)
SELECT coin, timeframe, open_time AS calculated_at, round(CASE WHEN n = 20 THEN middle + 2 * deviation END, 4) AS bb_upper,
  round(CASE WHEN n = 20 THEN middle END, 4) AS bb_middle, round(CASE WHEN n = 20 THEN middle - 2 * deviation END, 4) AS bb_lower
FROM banded
""",
    "technical_indicators": _INDICATORS,
    "stream_rejects": f"SELECT {_FLAT_ROW}, {_LENIENT} AS reject_reason FROM telegram_messages WHERE ({_LENIENT}) IS NOT NULL",
    "job_candles_summary": f"""
WITH {_FETCHED}
SELECT coin, timeframe, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_valid, count(*) FILTER (reason IS NOT NULL) AS n_skipped,
  CASE WHEN count(*) FILTER (reason IS NULL) > 0 THEN 'ok' ELSE 'no data' END AS status
FROM fetched GROUP BY coin, timeframe
""",
    "job_candles_stored": f"""
WITH {_FETCHED}
SELECT coin, timeframe, open_time, CAST(close AS VARCHAR) AS close FROM (
  SELECT *, row_number() OVER (PARTITION BY coin, timeframe, open_time ORDER BY open, high, low, close, volume) AS place FROM fetched WHERE reason IS NULL
) WHERE place = 1
""",
    "job_candles_gaps": f"""
WITH {_FETCHED}
SELECT coin, timeframe, before AS gap_from, open_time AS gap_to FROM (
  SELECT coin, timeframe, open_time, {_PERIOD} AS period, lag(open_time) OVER (PARTITION BY coin, timeframe ORDER BY open_time) AS before
  FROM fetched WHERE reason IS NULL
) WHERE epoch_us(open_time) - epoch_us(before) > period * 2500000
""",
    "job_candles_rejects": f"""
WITH {_FETCHED}
SELECT coin, timeframe, reason AS reject_reason, count(*) AS n_rows FROM fetched WHERE reason IS NOT NULL GROUP BY coin, timeframe, reason
""",
    "job_messages_summary": f"""
WITH {_SCANNED}
SELECT channel_name, count(*) FILTER (reason IS NULL) AS n_valid, count(*) FILTER (reason IS NOT NULL) AS n_rejected
FROM (SELECT channel_name, {_LENIENT} AS reason FROM scanned) GROUP BY channel_name
""",
    "job_messages_marks": f"""
WITH {_SCANNED},
valid AS (SELECT channel_name AS channel, id AS mark FROM scanned WHERE ({_LENIENT}) IS NULL)
SELECT channel, max(mark) AS last_message_id
FROM (SELECT * FROM valid UNION ALL SELECT channel, last_message_id FROM scrape_checkpoints) GROUP BY channel
""",
    "stream_insert_ignore": f"""
SELECT channel_name, id, ingested_at, array_to_string({_COINS}, ',') AS coins FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_name, id ORDER BY ingested_at) AS place FROM telegram_messages WHERE ({_LENIENT}) IS NULL
) WHERE place = 1
""",
}
