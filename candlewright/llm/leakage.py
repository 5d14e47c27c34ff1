"""Passages of test items inside a corpus, by pigeonhole edit matching.

A passage of ``run`` words with up to ``budget`` word edits still holds one of ``budget + 1`` pieces unchanged. So
each item is cut into pieces, exact hits of pieces are looked up in every document, and around each hit the
item's passages are verified with Myers' bit-parallel edit distance, one word a symbol.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlewright.llm.parts import codes, parts
from candlewright.session import checkpointed

#: Words that a passage has to have in common with an item.
RUN = 12
#: Word edits that a passage may have.
BUDGET = 2
#: Items, and bytes of their texts, looked up in one pass over the corpus; more take more passes. Bounds what is sent to the tasks.
ITEMS_A_PASS, BYTES_A_PASS = 20_000, 16_000_000
#: Characters of text handled at a time, and words of passages verified at a time.
CHUNK, VERIFIED = 400_000, 200_000

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_CHAIN = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each character up to the end of plane 1: what it is (0 gap, 1 of a word, 2 ignored) and its folded form."""
    size = 0x20000
    kind, folded = np.zeros(size, np.uint8), np.arange(size, dtype=np.uint64)
    for code in range(size):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        category = unicodedata.category(ch)
        if category[0] in "LN":
            kind[code] = 1
            small = ch.lower()
            folded[code] = ord(small) if len(small) == 1 else code
        elif category[0] == "M" or category == "Cf":
            kind[code] = 2
    folded[ord("đ")] = folded[ord("Đ")] = ord("d")
    return kind, folded


@lru_cache(maxsize=1)
def _gaps() -> np.ndarray:
    """Whether each character up to the end of plane 1 holds nothing of a word, in any of its forms."""
    kind, _ = _tables()
    gap = kind == 0
    for code in np.flatnonzero(gap):
        if not 0xD800 <= code < 0xE000:
            gap[code] = all(kind[min(ord(c), 0x1FFFF)] == 0 for c in unicodedata.normalize("NFKD", chr(code)))
    return gap


def _between_words(code: np.ndarray) -> np.ndarray:
    return (code < 0x20000) & _gaps()[np.minimum(code, 0x1FFFF)]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts as 64-bit codes, and the number of each word's text.

    Words are the longest runs of letters and digits; letter case, accents, compatibility and composition forms,
    and invisible format characters make no difference.
    """
    words, numbers, group, owner, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], [], 0
    for i, text in enumerate(texts):
        for _, part in parts(text, CHUNK, _between_words):
            if held and held + len(part) > CHUNK:
                code, place = _words(group)
                words.append(code)
                numbers.append(np.array(owner)[place])
                group, owner, held = [], [], 0
            group.append(part)
            owner.append(i)
            held += len(part) + 1
    if group:
        code, place = _words(group)
        words.append(code)
        numbers.append(np.array(owner)[place])
    return np.concatenate(words), np.concatenate(numbers)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    kind_of, folded_of = _tables()
    forms = [t if t.isascii() else unicodedata.normalize("NFKD", t) for t in texts]
    ends = np.cumsum([len(t) + 1 for t in forms])
    code = codes("\n".join(forms) + "\n")
    inside = np.minimum(code, 0x1FFFF)
    kind = np.where(code < 0x20000, kind_of[inside], np.where(code < 0xE0000, 1, 2)).astype(np.uint8)
    symbol = np.where(code < 0x20000, folded_of[inside], code)
    kept = kind != 2
    ends = np.cumsum(kept)[ends - 1]
    symbol, word = symbol[kept], kind[kept] == 1
    opening = word & ~np.append(False, word[:-1])
    begins = np.flatnonzero(opening)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(symbol)) - begins[np.maximum(np.cumsum(opening) - 1, 0)]
    place[~word] = 0
    power = np.cumprod(np.full(int(place.max()) + 1, _CHAIN, dtype=np.uint64))
    scrambled = (symbol + np.uint64(1)) * _MULTIPLY
    scrambled ^= scrambled >> np.uint64(29)
    code = np.add.reduceat(np.where(word, scrambled * power[place], np.uint64(0)), begins)
    return code, np.searchsorted(ends, begins, side="right")


def _chained(words: np.ndarray, length: int) -> np.ndarray:
    """Codes of all ``length`` consecutive words."""
    code = np.zeros(max(len(words) - length + 1, 0), dtype=np.uint64)
    for k in range(length):
        code = code * _CHAIN + (words[k : k + len(code)] ^ (words[k : k + len(code)] >> np.uint64(31))) * _MULTIPLY
    return code


class PieceIndex:
    """The pieces of a bounded set of items, and the items' words for verifying."""

    def __init__(self, ids: list, texts: list[str], run: int, budget: int):
        self.run, self.budget = run, budget
        # any ``run`` words hold budget + 1 whole pieces of this many words, wherever they begin
        self.piece = max((run + 1) // (budget + 2), 1)
        code, owner = words_of(texts)
        self.words, self.ids = code, ids
        self.first = np.searchsorted(owner, np.arange(len(texts)))
        self.n_words = np.diff(np.append(self.first, len(code)))
        starts = [f + np.arange(0, max(n - self.piece + 1, 0), self.piece) for f, n in zip(self.first, self.n_words)]
        #: An item with fewer words than a passage has fewer pieces, and may have fewer edits.
        self.allowed = np.minimum(budget, self.n_words // self.piece - 1)
        at = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64)
        pieces = _chained(code, self.piece)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(pieces, kind="stable")
        self.pieces, self.at = pieces[order], at[order]
        self.owner = owner


def _edit_distance(pattern: np.ndarray, text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Myers: the least distance of each pattern row, of ``length`` words, to any stretch of its text row."""
    one = np.uint64(1)
    masks = np.uint64(1) << np.arange(pattern.shape[1], dtype=np.uint64)
    plus, minus = np.full(len(pattern), ~np.uint64(0)), np.zeros(len(pattern), np.uint64)
    score = length.astype(np.int64)
    best = score.copy()
    top = (length - 1).astype(np.uint64)
    for step in range(text.shape[1]):
        same = pattern == text[:, step, None]
        match = (same * masks).sum(axis=1, dtype=np.uint64)
        vertical = match | minus
        across = (((match & plus) + plus) ^ plus) | match
        up, down = minus | ~(across | plus), plus & across
        score += ((up >> top) & one).astype(np.int64) - ((down >> top) & one).astype(np.int64)
        up, down = up << one, down << one
        plus, minus = down | ~(vertical | up), up & vertical
        np.minimum(best, score, out=best)
    return best


def _verified(index: PieceIndex, words: np.ndarray, text_no: np.ndarray, hit: np.ndarray, item_at: np.ndarray) -> pd.DataFrame:
    """The least distance of each text and item among the passages around exact hits of pieces."""
    run, budget, piece = index.run, index.budget, index.piece
    item = index.owner[item_at]
    start, size = index.first[item], index.n_words[item]
    length = np.minimum(run, size)
    place = item_at - start
    lowest, highest = np.maximum(place + piece - length, 0), np.minimum(place, size - length)
    reps = highest - lowest + 1
    row = np.repeat(np.arange(len(hit)), reps)
    passage = lowest[row] + np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps)
    length = length[row]
    span = np.arange(run)
    pattern_at = (start[row] + passage)[:, None] + span
    pattern = index.words[np.minimum(pattern_at, len(index.words) - 1)]
    begin = hit[row] - (place[row] - passage) - budget
    text_at = begin[:, None] + np.arange(run + 2 * budget)
    clipped = np.clip(text_at, 0, len(words) - 1)
    own = (text_at == clipped) & (text_no[clipped] == text_no[hit[row]][:, None]) & (np.arange(run + 2 * budget) < length[:, None] + 2 * budget)
    # words outside the text, and pattern places beyond a short item's end, match nothing
    text = np.where(own, words[clipped], np.uint64(0))
    pattern = np.where(span < length[:, None], pattern, np.uint64(1))
    distance = _edit_distance(pattern, text, length)
    found = pd.DataFrame({"text": text_no[hit[row]], "item": item[row], "passage": passage, "distance": distance})
    found = found[distance <= index.allowed[item[row]]]
    return found.groupby(["text", "item", "passage"], as_index=False)["distance"].min()


def _search(index: PieceIndex, texts: list[str]) -> pd.DataFrame:
    """``text, item, distance, n_passages`` of the texts that hold passages of items."""
    words, text_no = words_of(texts)
    chained = _chained(words, index.piece)
    low = np.searchsorted(index.pieces, chained)
    at = np.minimum(low, max(len(index.pieces) - 1, 0))
    some = len(index.pieces) and len(chained)
    hits = np.flatnonzero((index.pieces[at] == chained) & (text_no[: len(chained)] == text_no[index.piece - 1 :])) if some else []
    verified = []
    if len(hits):
        low = low[hits]
        many = np.searchsorted(index.pieces, chained[hits], side="right") - low  # items at each hit
        upto = np.cumsum(many)
        step = max(VERIFIED // index.run, 1)
        for k in range(0, int(upto[-1]), step):
            pair = np.arange(k, min(k + step, int(upto[-1])))
            h = np.searchsorted(upto, pair, side="right")
            verified.append(_verified(index, words, text_no, hits[h], index.at[low[h] + pair - (upto[h] - many[h])]))
    found = pd.concat(verified) if verified else pd.DataFrame({"text": [], "item": [], "passage": [], "distance": []}, dtype="int64")
    return found.groupby(["text", "item"], as_index=False).agg(distance=("distance", "min"), n_passages=("passage", "nunique"))


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held > CHUNK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _searcher(index, item_type: pa.DataType, doc_type: pa.DataType):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: PieceIndex = index.value
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for low, high in _chunks(texts):
                found = _search(pieces, texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low).take(pa.array(found["text"].to_numpy(dtype=np.int64))).cast(doc_type),
                        pa.array([pieces.ids[i] for i in found["item"]], item_type),
                        pa.array(found["distance"].to_numpy(dtype=np.int32)),
                        pa.array(np.minimum(pieces.n_words[found["item"].to_numpy(dtype=np.int64)], pieces.run).astype(np.int32)),
                        pa.array(found["n_passages"].to_numpy(dtype=np.int32)),
                    ],
                    names=["doc_id", "item_id", "distance", "n_words", "n_passages"],
                )

    return search


def leaks(documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, run: int = RUN, budget: int = BUDGET) -> DataFrame:
    """``doc_id, item_id, distance, n_words, n_passages``: the documents that hold a passage of an item.

    A passage is ``run`` consecutive words of the item, or all words of a shorter one, ``n_words`` in number; the
    document holds it where it has a stretch at most ``budget`` word edits away. ``distance`` is the least of these over
    the item's passages (0: a passage word by word), ``n_passages`` how many of them the document holds.

    Items are looked up in passes of about ``ITEMS_A_PASS`` items or ``BYTES_A_PASS``, each over the whole corpus; of more
    than one, each is finished and its items are released before the next. No document is moved.

    Defined results: NULL texts, texts without words, and items shorter than a piece hold nothing; rows with a
    NULL id come out with it; of repeated rows or ids, the least distance and the most passages count; empty tables
    give no rows; other columns play no part.
    """
    if not 0 <= budget < run <= 64:
        raise ValueError("a passage has up to 64 words, and fewer edits than words")
    spark = documents.sparkSession
    item_kind, doc_kind = items.schema[item_id].dataType, documents.schema[doc_id].dataType
    wanted = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    size = wanted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(ceil(size.n / ITEMS_A_PASS), ceil(size.bytes / BYTES_A_PASS), 1)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, distance int, n_words int, n_passages int"
    found = []
    for k in range(passes):
        held = wanted.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k).collect()  # about BYTES_A_PASS at most
        index = spark.sparkContext.broadcast(PieceIndex([r.id for r in held], [r.text for r in held], run, budget))
        hits = rows.mapInArrow(_searcher(index, to_arrow_type(item_kind), to_arrow_type(doc_kind)), schema)
        if passes > 1:
            hits = checkpointed(hits)
            index.destroy()
        found.append(hits)
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    best = F.min(F.struct("distance", (-F.col("n_words")).alias("fewer"))).alias("best")
    by_pair = union.groupBy("doc_id", "item_id").agg(best, F.max("n_passages").alias("n_passages"))
    return by_pair.select("doc_id", "item_id", "best.distance", (-F.col("best.fewer")).alias("n_words"), "n_passages")
