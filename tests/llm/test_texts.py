"""Languages, leaks, mixtures and pieces on small awkward tables, against brute force and held-out labels."""

import re
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from candlewright.llm import language, leakage
from candlewright.llm.language import fit_profiles, identify, language_of, sampled_profiles
from candlewright.llm.leakage import leaks
from candlewright.llm.mixing import mixture, mixture_report, plan_mixture, sized_documents
from candlewright.llm.splitting import pieces_of, split_oversized
from candlewright.llm.tokens import VOCABULARY, encode, encoder, token_count

EN = "The market was quiet today and most traders are waiting for the weekly report."
VI = "Thị trường hôm nay khá yên ắng và nhiều người đang chờ báo cáo tuần."
ES = "El mercado estuvo tranquilo hoy y muchos operadores esperan el informe semanal."


@pytest.fixture(scope="module")
def profiles(spark, data):
    return sampled_profiles(spark.read.parquet(f"{data}/language_samples.parquet"), "lang", "text")


def test_held_out_accuracy(spark, data):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{data}/language_samples.parquet").orderBy("sample_id").collect()]
    right = 0
    for part in range(4):
        fitted = fit_profiles(r for i, r in enumerate(rows) if i % 4 != part)
        held = [r for i, r in enumerate(rows) if i % 4 == part]
        found = identify([t for _, t in held], fitted).to_pylist()
        right += sum(f is not None and f["lang"] == lang for f, (lang, _) in zip(found, held))
    assert right / len(rows) >= 0.98


def test_documents_agree_with_their_labels(spark, data, profiles):
    rows = spark.read.parquet(f"{data}/documents.parquet").where("lang IS NOT NULL")
    found = rows.select("lang", language_of(F.col("text"), profiles).alias("f")).collect()
    assert sum(r.f is not None and r.f.lang == r.lang for r in found) / len(found) >= 0.95


def of(profiles, *texts):
    return identify(list(texts), profiles).to_pylist()


def test_texts_without_sentences_have_no_language(profiles):
    texts = [None, "", "   ", "$BTC 1.25 → 3.5 📈", "https://example.org/the-quiet-market-today", "12 34 56", "!!!", "\x00", "BTC ETH SOL"]
    assert of(profiles, *texts) == [None] * len(texts)


def test_capitals_missing_accents_and_decomposed_forms(profiles):
    bare = "".join(c for c in unicodedata.normalize("NFD", VI) if not unicodedata.combining(c)).replace("đ", "d")
    got = of(profiles, EN.upper(), VI.upper(), bare, unicodedata.normalize("NFD", VI), ES.upper())
    assert [g["lang"] for g in got] == ["en", "vi", "vi", "vi", "es"]
    assert all(0 < g["confidence"] <= 1 for g in got)


def test_mixed_texts_and_their_segments(profiles):
    text = f"{EN} {VI} $BTC 5\n\"{ES}\""
    (got,) = of(profiles, text)
    assert got["languages"] == ["en", "es", "vi"]
    assert [s["lang"] for s in got["segments"]] == ["en", "vi", "es"]
    edges = [(s["start"], s["start"] + s["length"]) for s in got["segments"]]
    assert edges[0][0] == 0 and edges[-1][1] == len(text) and all(abs(a[1] - b[0]) <= 1 for a, b in zip(edges, edges[1:]))
    (single,) = of(profiles, "Anh em, quick note: the price is back and the chart still looks heavy.")
    assert single["languages"] == ["en"] and len(single["segments"]) == 1


def test_very_long_text_in_parts(profiles, monkeypatch):
    monkeypatch.setattr(language, "CHUNK", 500)
    (got,) = of(profiles, " ".join([EN] * 60 + [VI] * 60))
    assert got["languages"] == ["en", "vi"] and [s["lang"] for s in got["segments"]] == ["en", "vi"]
    assert of(profiles, "x" * 5000)[0] is None or of(profiles, "x" * 5000)[0]["lang"]


def test_segments_cut_the_stored_text(profiles):
    for written in (f"{EN} {VI} {ES}", f"{VI}\n{EN}\n{VI}", f"각하 Å {VI} {EN}"):
        for text in (written, unicodedata.normalize("NFD", written)):
            (got,) = of(profiles, text)
            cut = [(s["lang"], text[s["start"] : s["start"] + s["length"]]) for s in got["segments"]]
            assert "".join(t for _, t in cut).replace("\n", "") == text.replace("\n", "")
            for lang, t in cut:
                plain = unicodedata.normalize("NFC", t)
                assert {"en": EN, "vi": VI, "es": ES}[lang] in plain
            (bare,) = identify([text], profiles, with_segments=False).to_pylist()
            assert bare == got | {"segments": None}


@pytest.mark.parametrize("gap", ["\n", " ", "\t", "\u00a0"])
def test_parts_of_a_long_text_cut_no_word(profiles, monkeypatch, gap):
    whole = of(profiles, gap.join([EN] * 30))[0]
    monkeypatch.setattr(language, "CHUNK", 333)
    parted = of(profiles, gap.join([EN] * 30))[0]
    assert parted["lang"] == whole["lang"] and parted["segments"][-1]["start"] + parted["segments"][-1]["length"] == len(gap.join([EN] * 30))
    if gap == "\n":
        assert parted == whole


def test_fit_in_groups_equals_fit_at_once(spark, data, monkeypatch):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{data}/language_samples.parquet").collect()]
    once = fit_profiles(rows)
    monkeypatch.setattr(language, "CHUNK", 700)
    grouped = fit_profiles(rows)
    assert (once.gram == grouped.gram).all() and (once.rank == grouped.rank).all()


def test_language_column_over_awkward_tables(spark, profiles):
    df = spark.createDataFrame([(EN, "clash"), (None, None), (EN, "clash")], "t string, lang string")
    assert [r.f and r.f.lang for r in df.select(language_of(F.col("t"), profiles).alias("f")).collect()] == ["en", None, "en"]
    assert df.limit(0).select(language_of(F.col("t"), profiles).alias("f")).count() == 0
    none = fit_profiles([])
    assert df.select(language_of(F.col("t"), none).alias("f")).where("f IS NOT NULL").count() == 0


def words(text):
    kept = (c for c in unicodedata.normalize("NFKD", text).lower() if unicodedata.category(c)[0] != "M" and unicodedata.category(c) != "Cf")
    return re.findall(r"[^\W_]+", "".join(kept).replace("đ", "d"))


def distance(pattern, text):
    """Least edits of pattern to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != t), row[j] + 1, row[j - 1] + 1)
    return min(row)


def brute_leaks(docs, items, run=12, budget=2):
    out = {}
    for d, text in docs:
        for i, item in items:
            w, t = words(item or ""), words(text or "")
            if len(w) >= run:
                best = min(distance(w[k : k + run], t) for k in range(len(w) - run + 1))
                if best <= budget:
                    out[d, i] = min(best, out.get((d, i), 99))
    return out


def searched(spark, docs, items, **options):
    a = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, item_id string")
    b = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, distance string")
    return {(r.doc_id, r.item_id): r.distance for r in leaks(a, b, "doc_id", "text", "item_id", "text", **options).collect()}


def test_leaks_equal_brute_force(spark):
    item = " ".join(f"word{i}" for i in range(30))
    other = "Đường số mười hai chạy dọc theo bờ sông và không ai nhớ vì sao nó được đặt tên như thế"
    w = item.split()
    docs = [
        (1, "intro " + " ".join(w[5:17]) + " outro"),
        (2, " ".join(w[5:16])),
        (3, " ".join([*w[3:9], "changed", *w[10:16]])),
        (4, " ".join([*w[3:7], "one", *w[8:11], "two", *w[12:16]])),
        (5, " ".join([*w[3:6], "one", *w[7:9], "two", *w[10:12], "three", *w[13:15]])),
        (6, "_".join(w[10:25]).upper()),
        (7, unicodedata.normalize("NFD", other).replace("đ", "d").replace("Đ", "D").replace(" ", " ​ ")),
        (8, unicodedata.normalize("NFD", other[:40])), (9, None), (10, ""), (11, "\n".join([*w[:6], *w[7:20]])), (12, " ".join(reversed(w))),
        (1, "repeated id " + " ".join(w[0:12])), (13, "ＷＯＲＤ0 " + " ".join(w[1:14])),
    ]
    items = [(100, item), (101, other), (102, None), (103, ""), (104, "too short"), (100, item), (105, item)]
    got, want = searched(spark, docs, items), brute_leaks(docs, items)
    assert got == want and got[1, 100] == 0 and got[6, 100] == 0 and got[7, 101] == 0 and (12, 100) not in got


def test_leaks_in_passes_parts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(leakage, "ITEMS_A_PASS", 2)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(7)]
    docs = [(i, "filler " * 3 + items[i][1]) for i in range(7)]
    assert searched(spark, docs, items) == {(i, i): 0 for i in range(7)}
    assert searched(spark, [], items) == {} and searched(spark, docs, []) == {}
    long = "other words " * 60_000 + items[3][1] + " more words" * 60_000
    assert searched(spark, [(1, long)], items[3:4]) == {(1, 3): 0}


@pytest.mark.parametrize("gap", ["\n", "\t", "\u00a0", ".", "。", " ", "-"])
def test_no_passage_is_lost_where_long_texts_are_parted(monkeypatch, gap):
    monkeypatch.setattr(leakage, "CHUNK", 300)
    passage = "alpha beta1 gamma délta epsilon ℃zeta eta theta™ iota kappa lambda mu".split()
    index = leakage.PieceIndex([1], [" ".join(passage)], 12, 2)
    for offset in range(0, 140):
        text = gap.join(["xy"] * (offset // 3) + ["z" * (offset % 3 + 1)] + ["fill"] * 40 + passage + ["fill"] * 90)
        found = leakage._search(index, [text])
        assert found["distance"].tolist() == [0], offset
    endless = "w" * 5000 + gap + gap.join(passage) + gap + "v" * 5000
    assert leakage._search(index, [endless])["distance"].tolist() == [0]
    assert len(leakage.words_of([endless])[0]) == 14


def test_pieces_that_many_items_share(monkeypatch):
    monkeypatch.setattr(leakage, "VERIFIED", 36)
    items = [f"of the market and so on item{i} with words of its own that differ{i} from others{i}" for i in range(20)]
    index = leakage.PieceIndex(list(range(20)), items, 12, 2)
    found = leakage._search(index, ["x y of the market and so on " + items[7] + " of the market and so on", items[3]])
    assert {(r.text, r.item) for r in found.itertuples() if r.distance == 0} == {(0, 7), (1, 3)}


def test_passes_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BYTES_A_PASS", 100)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(5)]
    assert searched(spark, [(i, items[i][1]) for i in range(5)], items) == {(i, i): 0 for i in range(5)}


def test_short_items_match_whole(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta")]
    docs = [(1, "x alpha beta gamma delta epsilon zeta y"), (2, "alpha beta gamma delta other zeta"), (3, "alpha beta gamma")]
    assert searched(spark, docs, items) == {(1, 1): 0, (2, 1): 1}


def test_token_counts_and_blocks(spark):
    df = spark.createDataFrame([("hello world",), ("",), (None,), ("<|endoftext|>",)], "t string")
    got = [r[0] for r in df.select(token_count(F.col("t"))).collect()]
    assert got[1:3] == [0, None] and got[0] == len(encode("hello world", VOCABULARY)) and got[3] > 1
    assert len(encode(" " * 900_000 + "y" * 250_000, VOCABULARY)) > 0 and len(encode("\n" * 2_000_000, VOCABULARY)) > 0


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u00a0", "\r\n"])
def test_long_texts_have_the_tokens_of_the_whole(blank):
    whole = encoder(VOCABULARY)[0].encode_ordinary
    long = blank.join(["giá", "BTC", "it's", "12.5%", "—ok"] * 30_000)
    assert encode(long, VOCABULARY) == whole(long)
    for gap in (49_999, 50_000, 60_001):
        for text in ("a" + blank * gap + "b", blank * gap, "it" + blank * gap, blank * gap + "'s 5", "x" + blank * gap + " " + "\n" * gap + "y z"):
            assert encode(text, VOCABULARY) == whole(text)


TARGET = "source string, target_share double, max_repeats int, used string"


def mixed(spark, docs, targets):
    d = spark.createDataFrame([(*x, "clash") for x in docs], "id bigint, source string, text string, n_tokens string")
    t = spark.createDataFrame([(*x, "clash") for x in targets], TARGET)
    sized = sized_documents(d, t, "id", "source", "text").persist()
    plan = plan_mixture(sized, t)
    report = {r.source: r for r in mixture_report(sized, plan).collect()}
    chosen = defaultdict(list)
    for r in mixture(sized, plan).collect():
        chosen[r.source].append(r)
    return report, chosen


def test_mixture_meets_shares_within_half_a_document(spark):
    docs = [(i, s, "word " * (1 + i % 40)) for s, n in (("big", 600), ("mid", 200), ("small", 30)) for i in range(n)]
    docs += [(9, None, "x"), (9, "unwanted", "y " * 500), (10, "big", None), (11, "big", "")]
    targets = [("big", 0.3, 1), ("mid", 0.45, 5), ("small", 0.05, 3), ("tiny", 0.1, 2), ("none", None, None), (None, 0.1, 1)]
    report, chosen = mixed(spark, docs, targets)
    total = sum(r.available for r in report.values())
    assert set(report) == {"big", "mid", "small", "tiny", "none"}
    for name in ("big", "mid"):
        r = report[name]
        assert not r.is_short and abs(r.used - r.target_share * total) <= 42 and r.most_copies <= r.max_repeats
        assert {c.copies for c in chosen[name]} <= {r.most_copies, r.most_copies - 1}
        assert r.used == sum(c.n_tokens * c.copies for c in chosen[name])
    assert report["tiny"].is_short and report["tiny"].available == 0 and report["none"].used == 0
    small = report["small"]
    assert small.is_short == (3 * small.available < 0.05 * total)
    assert sum(r.actual_share for r in report.values()) == pytest.approx(1)


def test_short_source_uses_all_its_repeats(spark):
    report, chosen = mixed(spark, [(1, "a", "one two three"), (2, "b", "w " * 100)], [("a", 0.9, 4), ("b", 0.1, 1)])
    assert report["a"].is_short and [c.copies for c in chosen["a"]] == [4] and not report["b"].is_short


def test_mixture_of_nothing_and_of_copies(spark):
    report, chosen = mixed(spark, [], [("a", 1.0, 2)])
    assert report["a"].used == 0 and report["a"].is_short is False and not chosen
    report, chosen = mixed(spark, [(7, "a", "same text")] * 50, [("a", 0.5, 1)])
    assert report["a"].n_uses in (0, 50)
    assert mixed(spark, [(1, "a", "x")], [])[0] == {}


SPLIT = "id int, text string, piece string, start string"
STRUCTURE = "\r\n".join(["# Title", "", "First block. It has two sentences.", "", "## Part", "", "- item one", "- item two", "* item three", ""])


def test_pieces_cover_the_text_and_overlap(spark):
    long = "\n\n".join(f"## Head {k}\n\n" + " ".join(f"Sentence {k} number {i} ends here." for i in range(40)) for k in range(12))
    texts = {1: long, 2: "", 3: None, 4: "short", 5: STRUCTURE * 40, 6: "x" * 30_000, 7: "日本語の文章です。" * 900, 8: " " * 9000, 9: "😀" * 3000, 10: VI * 200}
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts.items()] + [(4, "short", "clash", "clash")], SPLIT)
    by = defaultdict(list)
    for r in split_oversized(df, "text", limit=300, overlap=40).collect():
        by[r.id].append(r)
    assert [(r.piece_no, r.n_pieces, r.piece) for r in by[3]] == [(0, 0, None)]
    assert [(r.piece_no, r.n_pieces, r.piece) for r in by[2]] == [(0, 1, "")] and len(by[4]) == 2
    for i in (1, 5, 6, 7, 9, 10):
        rows, text = sorted(by[i], key=lambda r: r.piece_no), texts[i]
        assert len(rows) > 1 and [r.piece_no for r in rows] == list(range(rows[0].n_pieces))
        at = 0
        for r in rows:
            assert text[r.start : r.start + len(r.piece)] == r.piece and r.start <= at and r.n_tokens <= 300
            assert len(encode(r.piece, VOCABULARY)) <= 300
            if r.piece_no:
                assert 40 <= len(encode(text[r.start : at], VOCABULARY)) <= 44
                assert text[at - 1].isspace() or text[at].isspace() or i not in (1, 5, 10)
            at = r.start + len(r.piece)
        assert at == len(text)
    for before, r in zip(by[1], by[1][1:]):  # cut before a heading or after a sentence, never inside one
        own = long[before.start + len(before.piece) :].lstrip()
        assert own.startswith(("## Head", "Sentence"))


def cut(text, limit=60, overlap=0):
    at, out = 0, []
    for start, length, _ in pieces_of(text, limit, overlap, VOCABULARY):
        out.append(text[at : start + length])
        at = start + length
    assert "".join(out) == text
    return out


def test_fragments_stay_among_their_siblings_and_headings_with_their_text():
    block = lambda name, n: " ".join(f"{name} line {i} of it." for i in range(n))
    text = f"# A\n\n{block('a', 14)}\n\n# B\n\n{block('b', 2)}\n\n# C\n\n{block('c', 2)}\n\n# D\n\n## E\n\n{block('e', 20)}"
    pieces = cut(text)
    assert len(pieces) > 4 and sum(p.startswith("# B") and "# C" in p and "# D" not in p and "a line" not in p for p in pieces) == 1
    assert not any("a line" in p and "b line" in p for p in pieces)
    assert all(p.strip() not in ("# A", "# D", "## E", "# D\n\n## E") for p in pieces)
    assert [p for p in pieces if p.startswith("# D\n\n## E\n\ne line 0")]
    flat = "\n\n".join(f"## heading number {i}" for i in range(60))
    assert all(p.startswith("## heading") for p in cut(flat))
    assert all(p.startswith("<h2>") for p in cut("\n".join(f"<h2>part {i}</h2>\ntext of part {i} here" for i in range(40))))


def test_sizes_are_counted_unless_left_out(spark):
    df = spark.createDataFrame([(1, "two words", None, None), (2, VI * 40, None, None)], SPLIT)
    sized, bare = (sorted(split_oversized(df, "text", 300, 40, sized=s).collect()) for s in (True, False))
    assert sized[0].n_tokens == len(encode("two words", VOCABULARY)) and bare[0].n_tokens is None
    assert [r.asDict() | {"n_tokens": 0} for r in sized] == [r.asDict() | {"n_tokens": 0} for r in bare]


def test_pieces_of_nothing_and_bad_parameters(spark):
    empty = spark.createDataFrame([], SPLIT)
    assert split_oversized(empty, "text").count() == 0
    with pytest.raises(ValueError):
        split_oversized(empty, "text", limit=100, overlap=100)


def test_exactly_the_limit_is_one_piece(spark):
    text = " ".join(["token"] * 5000)
    n = len(encode(text, VOCABULARY))
    df = spark.createDataFrame([(1, text, None, None)], SPLIT)
    assert split_oversized(df, "text", limit=n).first().n_pieces == 1
    assert split_oversized(df, "text", limit=n - 1).first().n_pieces == 2
