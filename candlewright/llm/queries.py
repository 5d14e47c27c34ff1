"""Queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.text import strip
from candlewright.functions.times import micros
from candlewright.llm.cooccurrence import cooccurrences
from candlewright.llm.language import language_of, sampled_profiles
from candlewright.llm.leakage import leaks
from candlewright.llm.mentions import MENTIONS_SQL, message_coins
from candlewright.llm.mixing import mixture, mixture_report, plan_mixture, sized_documents, source_budgets
from candlewright.llm.nearest_time import nearest_in_time
from candlewright.llm.splitting import split_oversized
from candlewright.operators.channels import with_username
from candlewright.plans.feeds import MESSAGE, NAMED_SQL, named_messages
from candlewright.session import checkpointed
from candlewright.sources.tables import read_table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each coin of each message with the nearest 15m candle, up to 300 seconds away."""
    mentions = message_coins(spark, folder).select(*MESSAGE, F.explode("coins").alias("coin"))
    mentions = mentions.select(*MESSAGE, F.concat("coin", F.lit("USDT")).alias("pair"), (F.col("created_s") * 1_000_000).alias("at_us"))
    candles = read_table(spark, folder, "ohlcv").where("timeframe = '15m' AND close >= 0")
    candles = candles.select(F.col("coin").alias("pair"), micros(F.col("open_time")).alias("open_us"), "id")
    pairs = nearest_in_time(mentions, candles, "pair", "at_us", "open_us", "id", tolerance_us=300_000_000)
    return pairs.where("match_id IS NOT NULL").select(*MESSAGE, F.col("match_id").alias("ohlcv_id"))


def p4_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of coins named in one message, with counts, lift and log-likelihood ratio."""
    pairs = cooccurrences(message_coins(spark, folder), "coins")
    return pairs.withColumnsRenamed({"item_a": "coin_a", "item_b": "coin_b"}).withColumn("llr", F.round("llr", 4))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs in at least 0.4 % of the messages with coins, and at least 3 times as often as chance."""
    often = (F.col("n_ab") * 1000 >= F.col("n") * 4) & (F.col("n_ab") * F.col("n") >= 3 * F.col("n_a") * F.col("n_b"))
    return p4_pairs(spark, folder).where(often).select("coin_a", "coin_b")


#: A measure of texts that SQL has as well.
WORD_OR_MARK = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def _messages_with_language(spark: SparkSession, folder: str, with_segments: bool, least: int = 0) -> DataFrame:
    profiles = sampled_profiles(read_table(spark, folder, "language_samples"), "lang", "text")
    rows = named_messages(spark, folder)
    if least:
        rows = rows.where(F.length(strip(F.col("message_text"))) >= least)
    found = language_of(F.col("message_text"), profiles, with_segments)
    return rows.select(*MESSAGE, "language", found.alias("found"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of the messages that hold several, or whose label is missing or another; shorter texts are no case."""
    found = _messages_with_language(spark, folder, with_segments=False, least=20).where("found IS NOT NULL")
    rows = found.select(*MESSAGE, "language", "found.languages")
    label = F.lower(F.substring(F.coalesce("language", F.lit("")), 1, 2))
    case = (F.size("languages") > 1) | (label != F.element_at("languages", 1))
    return rows.where(case).select(*MESSAGE, F.explode("languages").alias("lang")).distinct()


def p5_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of every stored row, NULL where its text tells none."""
    rows = _messages_with_language(spark, folder, with_segments=False)
    return rows.select(*MESSAGE, "found.lang", "found.confidence", F.array_join("found.languages", ",").alias("languages"))


def p5_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of the messages that hold several languages, each with its language and confidence, at its place in the stored text."""
    rows = _messages_with_language(spark, folder, with_segments=True).where(F.size("found.languages") > 1)
    rows = rows.select(*MESSAGE, F.posexplode("found.segments").alias("segment_no", "s"))
    return rows.select(*MESSAGE, "segment_no", "s.start", "s.length", "s.lang", "s.confidence")


def p7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of test items with up to 2 word edits, and how many."""
    return leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "eval_items"), "doc_id", "text", "item_id", "text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold 12 consecutive words of a test item, word by word."""
    return p7_leaks(spark, folder).where("distance = 0 AND n_words >= 12").select("doc_id", "item_id")


def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Test items that leaked, with the number of documents that hold passages of them."""
    found = p7_leaks(spark, folder).groupBy("item_id")
    return found.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("distance") == 0).alias("n_exact"), F.max("n_passages").alias("most_passages"))


def _sized(spark: SparkSession, folder: str, size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    targets = read_table(spark, folder, "mix_targets")
    documents = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    named = with_username(documents, read_table(spark, folder, "telegram_channels"), "source")
    return sized_documents(named, targets, "doc_id", "username", "text", size=size), targets


def _mixing(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sized, targets = _sized(spark, folder)
    sized = checkpointed(sized)
    return sized, plan_mixture(sized, targets)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that fall short of their share however often they may be used."""
    return source_budgets(*_sized(spark, folder)).where("is_short").select("source")


def p8_budgets_in_words(spark: SparkSession, folder: str) -> DataFrame:
    """What each source has, should give and can give, in words and marks instead of tokens."""
    size = F.regexp_count("text", F.lit(WORD_OR_MARK))
    return source_budgets(*_sized(spark, folder, size)).drop("budget").withColumn("wanted", F.round("wanted", 3))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Shares wanted and reached by source."""
    return mixture_report(*_mixing(spark, folder))


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mixture and how often each is used."""
    return mixture(*_mixing(spark, folder)).withColumnRenamed("id", "doc_id")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", "text")


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in pieces of at most 1,500 tokens, neighbours overlapping by 100."""
    return split_oversized(_documents(spark, folder), "text", limit=1500, overlap=100).drop("text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that had to be cut; sizes of the others aren't wanted."""
    pieces = split_oversized(_documents(spark, folder), "text", limit=1500, overlap=100, sized=False)
    return pieces.where("n_pieces > 1 AND piece_no = 0").select("doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p4_found, p4_pairs, p5_found, p5_languages, p5_segments, p7_found, p7_leaks, p7_items, p8_found, p8_budgets_in_words, p8_report, p8_mixture, p9_found, p9_pieces)}

_PAIRS_SQL = f"""
{NAMED_SQL}, {MENTIONS_SQL},
total AS (SELECT count(*) AS n FROM (SELECT DISTINCT username, id, created_s FROM mentions)),
own AS (SELECT coin, count(*) AS n FROM mentions GROUP BY coin),
pairs AS (
  SELECT a.coin AS coin_a, b.coin AS coin_b, count(*) AS n_ab
  FROM mentions a JOIN mentions b USING (username, id, created_s) WHERE a.coin < b.coin GROUP BY ALL
),
counted AS (
  SELECT coin_a, coin_b, n_ab, a.n AS n_a, b.n AS n_b, t.n AS n
  FROM pairs JOIN own a ON coin_a = a.coin JOIN own b ON coin_b = b.coin, total t
)
"""


def _term(k: str, row: str, column: str) -> str:
    return f"(CASE WHEN {k} > 0 THEN ({k}) * ln(CAST({k} AS DOUBLE) * n / (CAST({row} AS DOUBLE) * ({column}))) ELSE 0 END)"


#: Letters and digits of full width, the compatibility forms that the tables use, and the plain ones.
_PLAIN = string.ascii_letters + string.digits
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _PLAIN)

_SIZED_SQL = f"""
spelled AS (
  SELECT lower(username) AS spelled, username FROM telegram_channels WHERE NOT regexp_full_match(username, '[0-9]+')
  UNION ALL SELECT CAST(id AS VARCHAR), username FROM telegram_channels
),
sized AS (
  SELECT t.source, CAST(sum(len(regexp_extract_all(d.text, '{WORD_OR_MARK}'))) AS BIGINT) AS tokens
  FROM documents d JOIN spelled s ON lower(regexp_replace(trim(d.source), '^@+', '')) = s.spelled JOIN mix_targets t ON t.source = s.username
  GROUP BY t.source
),
goals AS (
  SELECT source, target_share, CAST(max_repeats AS BIGINT) AS max_repeats, coalesce(tokens, 0) AS available,
    target_share * (SELECT sum(tokens) FROM sized) AS wanted
  FROM mix_targets LEFT JOIN sized USING (source)
),
budgets AS (SELECT *, max_repeats * available < wanted AS is_short FROM goals)
"""

SQL = {
    "p2_found": f"""
WITH {NAMED_SQL}, {MENTIONS_SQL},
candles AS (SELECT id, coin, epoch_us(open_time) AS t FROM ohlcv WHERE timeframe = '15m' AND close >= 0)
SELECT username, id, created_s, ohlcv_id FROM (
  SELECT m.username, m.id, m.created_s, c.id AS ohlcv_id,
    row_number() OVER (PARTITION BY m.username, m.id, m.created_s, m.coin ORDER BY abs(c.t - m.created_s * 1000000), c.t, c.id) AS place
  FROM mentions m JOIN candles c ON c.coin = m.coin || 'USDT'
    AND c.t BETWEEN m.created_s * 1000000 - 300000000 AND m.created_s * 1000000 + 300000000
) WHERE place = 1
""",
    "p7_found": rf"""
WITH texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items),
folded AS (SELECT kind, id, lower(regexp_replace(translate(nfc_normalize(text), '{_WIDE}', '{_PLAIN}'), '\p{{Cf}}', '', 'g')) AS t FROM texts),
words AS (SELECT kind, id, regexp_extract_all(replace(strip_accents(t), 'đ', 'd'), '[\p{{L}}\p{{N}}]+') AS w FROM folded),
runs AS (SELECT kind, id, array_to_string(w[k:k + 11], ' ') AS run FROM words, UNNEST(range(1, len(w) - 10)) AS u(k))
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM runs d JOIN runs i USING (run) WHERE d.kind = 'd' AND i.kind = 'i'
""",
    # sizes in words and marks; no case depends on which tokens are counted
    "p8_found": f"WITH {_SIZED_SQL} SELECT source FROM budgets WHERE is_short",
    "p8_budgets_in_words": f"WITH {_SIZED_SQL} SELECT * REPLACE (round(wanted, 3) AS wanted) FROM budgets",
    # the same; no text is near the limit
    "p9_found": f"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '{WORD_OR_MARK}')) > 1500",
    "p4_found": f"WITH {_PAIRS_SQL} SELECT coin_a, coin_b FROM counted WHERE n_ab * 1000 >= n * 4 AND n_ab * n >= 3 * n_a * n_b",
    "p4_pairs": f"""
WITH {_PAIRS_SQL}
SELECT coin_a, coin_b, n_ab, n_a, n_b, n, n_ab * n / (n_a * n_b) AS lift,
  round(greatest(0.0, 2 * ({_term("n_ab", "n_a", "n_b")} + {_term("n_a - n_ab", "n_a", "n - n_b")}
    + {_term("n_b - n_ab", "n - n_a", "n_b")} + {_term("n - n_a - n_b + n_ab", "n - n_a", "n - n_b")})), 4) AS llr
FROM counted
""",
}
