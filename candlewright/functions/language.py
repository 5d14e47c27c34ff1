"""The language of a text by naive Bayes over letter n-grams, fitted on a bounded sample of labelled texts.

N-grams are hashed into a fixed number of cells; a language is one row of log probabilities. Texts are scored whole,
a batch of them at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.text import LEAST_DETECTABLE, strip

#: Labelled texts a language, at most, that a detector is fitted on.
SAMPLES = 5_000
#: Longest n-gram, cells that n-grams are hashed into, and what each cell counts before any text is seen.
LONGEST, CELLS, PRIOR = 3, 1 << 16, 0.05
#: Letters that a text needs, and characters that are scored at a time.
LEAST_LETTERS, CHUNK = 3, 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower case of each 16-bit letter or mark, 0 for all other characters."""
    table = np.zeros(65536, dtype=np.uint64)
    for code in range(65536):
        ch = chr(code)
        if unicodedata.category(ch)[0] in "LM":
            small = ch.lower()
            table[code] = ord(small) if len(small) == 1 else code
    return table


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams of texts, words set off by gaps, and the number of each one's text."""
    texts = [t if t.isascii() else unicodedata.normalize("NFC", t) for t in texts]
    code = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "replace"), dtype="<u4")
    letter = np.where(code < 65536, _letters()[np.minimum(code, 65535)], 0)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    cells, owners = [], []
    mixed = np.zeros(len(letter), dtype=np.uint64)
    for k in range(LONGEST):
        n = len(letter) - k
        mixed = (mixed[:n] + letter[k:]) * _MIX + np.uint64(k)
        whole = (letter[:n] > 0) | (letter[k:] > 0)  # not a gap to a gap
        whole &= owner[:n] == owner[k:]
        cells.append((mixed[whole] >> np.uint64(48)).astype(np.int64) % CELLS)
        owners.append(owner[:n][whole])
    return np.concatenate(cells), np.concatenate(owners)


def _groups(texts: list[str]) -> Iterator[list[int]]:
    """The numbers of texts, in groups of about ``CHUNK`` characters."""
    group, held = [], 0
    for i, text in enumerate(texts):
        group.append(i)
        held += len(text) + 1
        if held > CHUNK:
            yield group
            group, held = [], 0
    if group:
        yield group


@dataclass
class Detector:
    """Languages, and the log probability of each cell in each of them."""

    languages: list[str]
    weights: np.ndarray

    def languages_of(self, texts: list[str | None]) -> list[str | None]:
        """The likeliest language of each text; None for one with hardly a letter."""
        out: list[str | None] = [None] * len(texts)
        if not self.languages:
            return out
        filled = [t or "" for t in texts]
        for group in _groups(filled):
            cell, owner = _grams([filled[i] for i in group])
            n = np.bincount(owner, minlength=len(group))
            scores = np.stack([np.bincount(owner, weights=row[cell], minlength=len(group)) for row in self.weights])
            for i, best, some in zip(group, scores.argmax(axis=0).tolist(), (n >= LEAST_LETTERS * LONGEST).tolist()):
                out[i] = self.languages[best] if some else None
        return out

    def language_of(self, text: Column) -> Column:
        """The language of a text; NULL for NULL, for texts shorter than 20 after trimming, and for ones without words."""

        def detect(texts: pa.Array) -> pa.Array:
            return pa.array(self.languages_of(texts.to_pylist()), pa.string())

        detect.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        return F.when(F.length(strip(text)) >= LEAST_DETECTABLE, F.arrow_udf(detect, "string")(text))


def fit(samples: Iterable[tuple[str, str]]) -> Detector:
    """A detector of the languages of ``(language, text)`` pairs; pairs that lack one are left out."""
    by_language: dict[str, list[str]] = {}
    for language, text in samples:
        if language is not None and text is not None:
            by_language.setdefault(language, []).append(text)
    languages = sorted(by_language)
    counts = np.full((len(languages), CELLS), PRIOR)
    for row, language in zip(counts, languages):
        for group in _groups(by_language[language]):
            row += np.bincount(_grams([by_language[language][i] for i in group])[0], minlength=CELLS)
    return Detector(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))


def fit_detector(samples: DataFrame, language: str, text: str, per_language: int = SAMPLES) -> Detector:
    """A detector fitted on at most ``per_language`` labelled texts a language, the first by hash of their text."""
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.xxhash64("text"), "text"))
    rows = samples.select(F.col(language).alias("language"), F.col(text).alias("text")).dropna().withColumn("place", place)
    kept = rows.where(F.col("place") <= per_language).select("language", "text")
    return fit((r.language, r.text) for r in kept.toLocalIterator())
