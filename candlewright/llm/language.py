"""Languages of texts, and of the segments of mixed ones, by rank-order profiles of n-grams.

A profile is a language's most frequent n-grams in order of frequency. A text's own n-grams are ranked the same
way; the sum of how far each is out of place in a profile, most for one that is missing there, is the distance.
Profiles are fitted on a bounded sample of labelled sentences; every text is scored whole, segment by segment.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.parts import codes, parts

#: Labelled sentences that profiles are fitted on, at most, for each language.
SAMPLES = 5_000
#: N-grams in a profile; also how far out of place a missing one counts.
PROFILE = 1_000
#: Longest n-gram.
LONGEST = 3
#: A segment is told apart only with so many letters in so many words, tickers and the like not counted.
LEAST_LETTERS, LEAST_WORDS = 15, 3
#: Distance to the second language, in parts of the distance to the first, from which a segment makes a text mixed.
CLEAR = 0.04
#: Characters of text that are ranked at a time.
CHUNK = 400_000

#: Segments that are numbered beside their n-grams; ``CHUNK`` characters can't hold as many.
_MOST_SEGMENTS = 1 << 22

_LINKS = re.compile(r"[hH][tT][tT][pP][sS]?://\S+|[wW]{3}\.\S+|[@#$]\w[\w.]*")
#: One of these is in every link, handle and tag.
_LINK_MARKS = ("@", "#", "$", "://", "w.", "W.")
_BREAKS = ".!?…。！？"
_QUOTES = "\"“”„«»\n\r—|•;"

_GAP, _LETTER, _DIGIT, _STOP, _BREAK = 0, 1, 2, 3, 4


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16-bit character: its kind, its lower case, whether it is upper case."""
    kind, lower, upper = np.zeros(65536, np.uint8), np.arange(65536, dtype=np.int64), np.zeros(65536, bool)
    for code in range(65536):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        category = unicodedata.category(ch)
        if category[0] in "LM":
            kind[code] = _LETTER
            small = ch.lower()
            lower[code] = ord(small) if len(small) == 1 else code
            upper[code] = category == "Lu"
        elif category[0] == "N":
            kind[code] = _DIGIT
    for ch in _BREAKS:
        kind[ord(ch)] = _STOP
    for ch in _QUOTES:
        kind[ord(ch)] = _BREAK
    kind[0xFE00:0xFE10] = _GAP  # variation selectors
    return kind, lower, upper


@lru_cache(maxsize=1)
def _joining() -> np.ndarray:
    """Whether each 16-bit character belongs to the one before it: marks, and the later letters of a Hangul syllable."""
    joins = np.array([not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] == "M" for c in range(65536)])
    joins[0x1161:0x1176] = joins[0x11A8:0x11C3] = True
    return joins


def _composed(text: str) -> tuple[str, np.ndarray | None]:
    """``text`` in composed form and, where that differs, the place in ``text`` of each of its characters and of its end."""
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return text, None
    code = codes(text)
    first = np.flatnonzero(~((code < 65536) & _joining()[np.minimum(code, 65535)]))
    first = np.unique(np.append(0, first))
    clusters = [unicodedata.normalize("NFC", text[a:b]) for a, b in pairwise([*first.tolist(), len(text)])]
    return "".join(clusters), np.append(np.repeat(first, [len(c) for c in clusters]), len(text))


def _blanked(text: str) -> str:
    """``text`` with links, handles and tags blanked in place."""
    if not any(mark in text for mark in _LINK_MARKS):
        return text
    return _LINKS.sub(lambda m: " " * len(m[0]), text)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return edge[::2], edge[1::2]


@dataclass
class Segments:
    """Segments of a list of texts: their text, place in it, letters, words, and n-grams by rank."""

    text_no: np.ndarray
    start: np.ndarray
    length: np.ndarray
    letters: np.ndarray
    words: np.ndarray
    gram_segment: np.ndarray
    gram: np.ndarray
    gram_count: np.ndarray
    gram_rank: np.ndarray


def segments_of(texts: list[str]) -> Segments:
    """Cut texts at sentence ends, quotes, bars, dashes and lines, and rank the n-grams of each segment's words.

    Words with digits are left out, and short words in capitals unless the whole segment is in capitals.
    """
    kind_of, lower_of, upper_of = _tables()
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    code = codes("\n".join(texts) + "\n")
    code = np.where(code > 0xFFFF, 0, code).astype(np.int64)
    kind = kind_of[code]
    follows = np.append(kind[1:], _BREAK)
    cut = (kind == _BREAK) | ((kind == _STOP) & (follows != _LETTER) & (follows != _DIGIT))
    segment = np.cumsum(cut) - cut  # the mark belongs to the segment it ends
    n = int(segment[-1]) + 1
    if n > _MOST_SEGMENTS:
        raise ValueError("too many segments at once; texts have to come in parts")
    first = np.searchsorted(segment, np.arange(n))
    last = np.append(first[1:], len(code))
    text_no = np.searchsorted(ends, first, side="right")

    letter = kind == _LETTER
    begin, end = _runs(letter | (kind == _DIGIT))
    total = np.concatenate(([0], np.cumsum(letter)))
    capitals = np.concatenate(([0], np.cumsum(upper_of[code])))
    size = end - begin
    n_upper = capitals[end] - capitals[begin]
    home = segment[begin] if len(begin) else begin
    seg_letters, seg_upper = total[last] - total[first], capitals[last] - capitals[first]
    loud = seg_upper * 2 > seg_letters
    ticker = (n_upper == size) & (size >= 2) & (size <= 6) & ~loud[home]
    good = (total[end] - total[begin] == size) & ~ticker
    begin, end, size, home = begin[good], end[good], size[good], home[good]

    words = np.bincount(home, minlength=n)
    letters = np.bincount(home, weights=size, minlength=n).astype(np.int64)
    padded = size + 2
    stop = np.cumsum(padded)
    seq = np.full(int(stop[-1]) if len(stop) else 0, 95, dtype=np.int64)
    at = np.repeat(begin - (stop - padded) - 1, padded) + np.arange(len(seq))
    inner = np.ones(len(seq), bool)
    inner[stop - padded] = inner[stop - 1] = False
    seq[inner] = lower_of[code[at[inner]]]
    owner = np.repeat(home, padded)
    left = np.repeat(stop, padded) - np.arange(len(seq))  # characters up to the padded word's end

    grams, owners = [seq[inner]], [owner[inner]]
    gram = seq.copy()
    for k in range(1, LONGEST):
        gram = gram[: len(seq) - k] | (seq[k:] << (16 * k))
        whole = left[: len(gram)] > k
        grams.append(gram[whole])
        owners.append(owner[: len(gram)][whole])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    # Both in one number: the mixed n-gram in the low 42 bits, the segment above.
    mixed = (gram * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(22)
    key = np.sort((owner.astype(np.uint64) << np.uint64(42)) | mixed)
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    where = np.flatnonzero(new)
    count = np.diff(np.append(where, len(key)))
    key = key[where]
    gram_segment = (key >> np.uint64(42)).astype(np.int64)
    gram = (key & np.uint64((1 << 42) - 1)).astype(np.int64)
    rank = _ranks(gram_segment, count, n)
    trimmed = np.minimum(last, ends[np.minimum(text_no, len(ends) - 1)] - 1)
    offset = np.concatenate(([0], ends[:-1]))[np.minimum(text_no, len(ends) - 1)]
    return Segments(text_no, first - offset, trimmed - first, letters, words, gram_segment, gram, count, rank)


def _ranks(owner: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The rank of each n-gram by falling count within its owner, from 0; equal counts share their mean rank."""
    if not len(owner):
        return np.zeros(0)
    order = np.lexsort((-count, owner)) if count.max() > 255 else np.argsort((owner << 8) | (255 - count), kind="stable")
    o, c = owner[order], count[order]
    start = np.append(True, (o[1:] != o[:-1]) | (c[1:] != c[:-1]))
    where = np.flatnonzero(start)
    stop = np.append(where[1:], len(o))
    base = np.searchsorted(owner, np.arange(n))
    mean = (where + stop - 1) / 2 - base[o[where]]
    rank = np.empty(len(o))
    rank[order] = np.repeat(mean, stop - where)
    return rank


@dataclass
class Profiles:
    """Ranks of the known n-grams in each profile; a language may have several profiles."""

    languages: list[str]
    owner: np.ndarray
    gram: np.ndarray
    rank: np.ndarray  # by profile and n-gram; 3 * PROFILE for one that a profile lacks

    def distances(self, found: Segments, n: int) -> np.ndarray:
        """Mean out-of-place distance of each segment to each language, from 0 to 1."""
        kept = found.gram_rank < PROFILE
        owner, gram, rank = found.gram_segment[kept], found.gram[kept], found.gram_rank[kept]
        best = np.full((n, len(self.languages)), np.inf)
        if not len(owner) or not len(self.gram):
            return best
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))  # n-grams come in order of their segment
        segment, n_grams = owner[first], np.diff(np.append(first, len(owner)))
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        known = np.flatnonzero(self.gram[at] == gram)  # all others count PROFILE in every profile
        place = np.concatenate(([0], np.cumsum(self.gram[at] == gram)))[np.append(first, len(owner))]
        at, rank = at[known], rank[known].astype(np.float32)
        some = np.flatnonzero(np.diff(place))
        for p, language in enumerate(self.owner):
            saved = self.rank[p][at]
            saved -= rank
            np.abs(saved, out=saved)
            np.minimum(saved, PROFILE, out=saved)
            total = (n_grams - np.diff(place)) * float(PROFILE)
            if len(some):
                total[some] += np.add.reduceat(saved, place[:-1][some])
            best[segment, language] = np.minimum(best[segment, language], total / n_grams / PROFILE)
        return best


def _plain(text: str) -> str:
    """``text`` without accents, as it is often typed."""
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return bare.replace("đ", "d").replace("Đ", "D")


def _counts(texts: list[str]) -> pd.Series:
    found = segments_of(texts)
    return pd.Series(found.gram_count).groupby(found.gram).sum()


def fit_profiles(samples: Iterable[tuple[str, str]]) -> Profiles:
    """Profiles of labelled texts: one as written for each language, one without accents where that differs."""
    frame = pd.DataFrame(samples, columns=["lang", "text"]).dropna()
    languages, owner, ranked = sorted(frame["lang"].unique()), [], []
    for no, language in enumerate(languages):
        written = [_blanked(_composed(t)[0]) for t in frame.loc[frame["lang"] == language, "text"]]
        bare = [_plain(t) for t in written]
        for texts in [written] + ([bare] if bare != written and any(c.isascii() for c in "".join(bare) if c.isalpha()) else []):
            counts = [_counts([part for _, _, part in group]) for group in _chunks(texts)]
            counts = pd.concat(counts).groupby(level=0).sum().sort_values(ascending=False, kind="stable")[:PROFILE]
            owner.append(no)
            ranked.append(pd.Series(counts.rank(ascending=False).to_numpy() - 1, index=counts.index))
    table = pd.concat(ranked, axis=1) if ranked else pd.DataFrame()
    table = table.sort_index()
    rank = np.ascontiguousarray(table.fillna(3 * PROFILE).to_numpy(dtype=np.float32).reshape(len(table), len(owner)).T)
    return Profiles(languages, np.array(owner, dtype=int), table.index.to_numpy(dtype=np.int64), rank)


def sampled_profiles(samples: DataFrame, lang: str, text: str, per_language: int = SAMPLES) -> Profiles:
    """Profiles of at most ``per_language`` labelled texts a language, the first by hash of their text."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    rows = samples.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna().withColumn("place", place)
    return fit_profiles((r.lang, r.text) for r in rows.where(F.col("place") <= per_language).select("lang", "text").toLocalIterator())


def _confidence(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest language, and how much nearer it is than the second, from 0 to 1."""
    best = distance.argmin(axis=1)
    ordered = np.sort(distance, axis=1)
    second = ordered[:, 1] if distance.shape[1] > 1 else np.ones(len(distance))
    with np.errstate(invalid="ignore", divide="ignore"):
        return best, np.where((second > 0) & np.isfinite(second), 1 - ordered[:, 0] / second, 0.0)


_RESULT = pa.struct(
    [
        ("lang", pa.string()),
        ("confidence", pa.float64()),
        ("languages", pa.list_(pa.string())),
        (
            "segments",
            pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])),
        ),
    ]
)
RESULT = "struct<lang: string, confidence: double, languages: array<string>, segments: array<struct<start: int, length: int, lang: string, confidence: double>>>"


def _between_words(code: np.ndarray) -> np.ndarray:
    kind = _tables()[0][np.minimum(code, 65535)]
    return (code > 65535) | ((kind != _LETTER) & (kind != _DIGIT))


def _between_segments(code: np.ndarray) -> np.ndarray:
    return (code < 65536) & (_tables()[0][np.minimum(code, 65535)] == _BREAK)


def _chunks(texts: list[str]) -> Iterable[list[tuple[int, int, str]]]:
    """``(text, place, part)`` of all parts, in groups of about ``CHUNK`` characters."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for place, part in parts(text, CHUNK, _between_words, better=_between_segments):
            group.append((i, place, part))
            held += len(part) + 1
            if held > CHUNK:
                yield group
                group, held = [], 0
    if group:
        yield group


@dataclass
class Scores:
    """What a batch of texts shows: summed distances and telling segments by text, which languages are clear, and the segments."""

    weight: np.ndarray
    telling: np.ndarray
    clear: np.ndarray
    segments: list[list[tuple]]  # ``start, length, letters, language or -1, confidence`` by text


def _score(texts: list[str], profiles: Profiles, with_segments: bool) -> Scores:
    shape = (len(texts), len(profiles.languages))
    out = Scores(np.zeros(shape), np.zeros(len(texts), np.int64), np.zeros(shape, bool), [[] for _ in texts] if with_segments else [])
    for group in _chunks(texts):
        found = segments_of([part for _, _, part in group])
        n = len(found.start)
        distance = profiles.distances(found, n)
        telling = (found.letters >= LEAST_LETTERS) & (found.words >= LEAST_WORDS) & (found.text_no < len(group))
        best, sure = _confidence(distance)
        owner = np.array([i for i, _, _ in group] + [-1])[np.minimum(found.text_no, len(group))]
        rows = np.flatnonzero(telling)
        np.add.at(out.weight, owner[rows], distance[rows] * found.letters[rows, None])
        np.add.at(out.telling, owner[rows], 1)
        clear = np.flatnonzero(telling & (sure >= CLEAR))
        out.clear[owner[clear], best[clear]] = True
        if with_segments:
            start = found.start + np.array([p for _, p, _ in group] + [0])[np.minimum(found.text_no, len(group))]
            told = np.where(telling, best, -1)
            for i, *segment in zip(*(x.tolist() for x in (owner, start, found.length, found.letters, told, sure))):
                if i >= 0:
                    out.segments[i].append(tuple(segment))
    return out


def _joined(segments: list[tuple], main: int, kinds: set[int]) -> list[list]:
    """Neighbouring segments of one language as one: ``start, end, language, confidence``."""
    out: list[list] = []
    for start, length, letters, told, sure in segments:
        mine = None if told < 0 else told if told in kinds else main
        if out and (not letters or mine is None or out[-1][2] in (mine, None)):
            out[-1][1] = start + length
            out[-1][2] = mine if out[-1][2] is None else out[-1][2]
            out[-1][3] = max(out[-1][3], sure if told >= 0 else 0.0)
        else:
            out.append([start, start + length, mine, sure if told >= 0 else 0.0])
    return out


def identify(texts: list[str | None], profiles: Profiles, with_segments: bool = True) -> pa.Array:
    """The language of each text and, ``with_segments``, of each of its segments.

    Neighbouring segments of one language are joined; one too short to tell goes with the segment before it, or
    with the first that can be told. A text's languages are those of its segments that are clearly told apart,
    else the one nearest to all its telling segments together. A text with no telling segment has none.
    """
    if not profiles.languages:
        return pa.nulls(len(texts), _RESULT)
    composed = [_composed(t or "") for t in texts]
    scores = _score([_blanked(t) for t, _ in composed], profiles, with_segments)
    whole, whole_sure = _confidence(scores.weight)
    names = profiles.languages
    several = scores.clear.sum(axis=1) > 1
    out: list[dict | None] = []
    for i, (main, sure, told, mixed) in enumerate(zip(whole.tolist(), whole_sure.tolist(), scores.telling.tolist(), several.tolist())):
        if not told:
            out.append(None)
            continue
        kinds = np.flatnonzero(scores.clear[i]).tolist() if mixed else [main]
        found = {"lang": names[main], "confidence": sure, "languages": [names[k] for k in kinds]}
        if with_segments:
            places = composed[i][1]
            joined = _joined(scores.segments[i], main, set(kinds))
            if places is not None:
                joined = [(int(places[a]), int(places[b]), k, c) for a, b, k, c in joined]
            found["segments"] = [{"start": a, "length": b - a, "lang": names[k], "confidence": c} for a, b, k, c in joined]
        out.append(found)
    return pa.array(out, _RESULT)


def language_of(text: Column, profiles: Profiles, with_segments: bool = True) -> Column:
    """``lang``, ``confidence``, ``languages`` and ``segments`` of a text; NULL where nothing in it tells a language.

    ``segments`` cover the text, as it is stored, in order; without ``with_segments`` they are NULL. NULL, empty and
    wordless texts give NULL.
    """

    def detect(texts: pa.Array) -> pa.Array:
        return identify(texts.to_pylist(), profiles, with_segments)

    detect.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # marked so that a filter on the result doesn't have it found a second time
    return F.arrow_udf(detect, RESULT).asNondeterministic()(text)
