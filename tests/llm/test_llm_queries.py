"""Queries of the subpackage: against their SQL, or against brute force over the smallest tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewright.llm import queries
from candlewright.llm.mentions import clean_coins
from tests.helpers import duck_bag, spark_bag
from tests.llm.test_texts import words


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, data, name):
    assert spark_bag(queries.QUERIES[name](spark, data)) == duck_bag(data, queries.SQL[name])


def test_p7_equals_brute_force(spark, data):
    items = spark.read.parquet(f"{data}/eval_items.parquet").collect()
    runs = {}
    for item in items:
        w = words(item.text)
        for k in range(len(w) - 11):
            runs.setdefault(tuple(w[k : k + 12]), set()).add(item.item_id)
    want = set()
    for doc in spark.read.parquet(f"{data}/documents.parquet").collect():
        w = words(doc.text or "")
        for k in range(len(w) - 11):
            want |= {(doc.doc_id, i) for i in runs.get(tuple(w[k : k + 12]), ())}
    assert {tuple(r) for r in queries.p7_found(spark, data).collect()} == want and want


def least_edits(documents, items, run=12, most=2):
    """The least word edits from any passage of an item to each document, by the whole table of edit distances; for all that are near."""
    numbers: dict[str, int] = {}
    coded = lambda text: [numbers.setdefault(w, len(numbers) + 1) for w in words(text or "")]
    texts, at, owners = [0] * 5, [], []
    for doc_id, text in documents:
        if len(own := coded(text)):
            at.append(len(texts))
            owners.append(doc_id)
            texts += own + [0] * 5  # no passage reaches over the gap
    text, place = np.array(texts), np.arange(len(texts))
    out = {}
    for item_id, item in items:
        own, best = coded(item), np.full(len(at), run)
        for k in range(len(own) - run + 1):
            row = np.zeros(len(text), dtype=np.int64)
            for i, word in enumerate(own[k : k + run], 1):
                step = np.minimum(row + 1, np.append(i - 1, row[:-1]) + (text != word))
                row = np.minimum.accumulate(step - place) + place
            best = np.minimum(best, np.minimum.reduceat(row, at))
        out |= {(owners[d], item_id): int(best[d]) for d in np.flatnonzero(best <= most)}
    return out


def test_p7_leaks_equal_all_edit_distances(spark, data):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/eval_items.parquet").collect()]
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in queries.p7_leaks(spark, data).where("n_words = 12").collect()}
    assert got == least_edits(documents, items) and 0 in got.values()


def test_p8_equals_counts_in_python(spark, data):
    from candlewright.llm.tokens import VOCABULARY, encode

    channels = {}
    for c in spark.read.parquet(f"{data}/telegram_channels.parquet").collect():
        channels[c.username.lower()] = channels[str(c.id)] = c.username
    targets = spark.read.parquet(f"{data}/mix_targets.parquet").collect()
    sums = {t.source: 0 for t in targets}
    for doc in spark.read.parquet(f"{data}/documents.parquet").collect():
        name = channels.get((doc.source or "").strip().lstrip("@").lower())
        if name in sums:
            sums[name] += len(encode(doc.text or "", VOCABULARY))
    total = sum(sums.values())
    want = {t.source for t in targets if t.max_repeats * sums[t.source] < t.target_share * total}
    assert {r.source for r in queries.p8_found(spark, data).collect()} == want


def test_p9_equals_counts_in_python(spark, data):
    from candlewright.llm.tokens import VOCABULARY, encode

    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    want = {d.doc_id for d in docs if d.text and len(encode(d.text, VOCABULARY)) > 1500}
    assert {r.doc_id for r in queries.p9_found(spark, data).collect()} == want and want


def test_clean_coins(spark):
    df = spark.createDataFrame([(1, ["$btc", " #Eth ", "BTC", "", None, "$"]), (2, []), (3, None)], "i int, x array<string>")
    assert [r[0] for r in df.orderBy("i").select(clean_coins(F.col("x"))).collect()] == [["BTC", "ETH"], [], []]


def test_p5_tells_every_row_and_p9_every_size(spark, data):
    languages = queries.p5_languages(spark, data)
    assert languages.count() == spark.read.parquet(f"{data}/telegram_messages.parquet").count()
    assert 0 < languages.where("lang IS NULL").count() < languages.count() / 5
    pieces = queries.p9_pieces(spark, data)
    assert pieces.where("n_tokens IS NULL AND n_pieces > 0").count() == 0 and pieces.where("n_tokens > 1500").count() == 0
    assert {r[0] for r in pieces.where("n_pieces > 1").select("doc_id").collect()} == {r[0] for r in queries.p9_found(spark, data).collect()}


def test_p5_rows_are_cases(spark, data):
    rows = {tuple(r) for r in queries.p5_found(spark, data).collect()}
    by_message = {}
    for *message, lang in rows:
        by_message.setdefault(tuple(message), set()).add(lang)
    segments = {}
    for r in queries.p5_segments(spark, data).collect():
        segments.setdefault((r.username, r.id, r.created_s), set()).add(r.lang)
    mixed = {m for m, langs in by_message.items() if len(langs) > 1}
    assert rows and mixed and all(segments.get(m) for m in mixed)
