"""Cutting oversized texts at natural boundaries.

A text is read as a tree: sections under headings, blocks between blank lines, lines and list items, sentences,
words. Sibling nodes that fit are merged up to the limit; only nodes that don't fit are opened, and what comes out of
one is merged with its own siblings only. A heading stays with what follows it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.tokens import VOCABULARY, encode, encoder

#: Where a node of each depth is cut into its children: the child begins where a match ends.
CUTS = [
    *(re.compile(rf"\n(?=[ \t]*#{{1,{depth}}}[ \t])|\n(?=<h[1-{depth}][ >])", re.IGNORECASE) for depth in range(1, 7)),
    re.compile(r"(?:\r?\n[ \t]*){2,}"),
    re.compile(r"\r?\n(?=\S)"),
    re.compile(r"\r?\n\s*|<br ?/?>|</(?:p|li|tr|div)>", re.IGNORECASE),
    re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+"),
    re.compile(r"(?<=[,;:|–—])\s+"),
    re.compile(r"\s+"),
]

_HEADING = re.compile(r"^[ \t]*(?:(#{1,6})[ \t]|<h([1-6])[ >]).*", re.IGNORECASE | re.MULTILINE)
_BLANKS = re.compile(r"\s*")
#: A heading is kept whole, and with what follows, if it has at most so many characters.
_HEADING_CHARS = 400

#: A token may end inside a character; a cut then moves by up to this many tokens.
SLACK = 4


class _Sizes:
    """Token counts of the parts of one text, from the tokens of the whole."""

    def __init__(self, text: str, tokens: list[int], lengths: np.ndarray):
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        starts_char = np.append((raw & 0xC0) != 0x80, True)
        edges = np.concatenate(([0], np.cumsum(lengths[tokens])))
        whole = starts_char[edges]
        chars = np.cumsum(starts_char) - 1
        self.token_at = np.flatnonzero(whole)
        self.char_at = chars[edges[whole]]
        self.n_chars, self.n_tokens = int(chars[-1]), len(tokens)
        self._chars = self.char_at.tolist()

    def snap(self, char: int) -> int:
        """The last place up to ``char`` where a token and a character begin."""
        return bisect_right(self._chars, char) - 1

    def tokens_to(self, place: int) -> int:
        return int(self.token_at[place])


class _Headings:
    """Where the headings of a text begin, their lines end, and what follows them begins; their levels from 1, the greatest."""

    def __init__(self, text: str):
        found = [(m.start() + len(m[0]) - len(m[0].lstrip()), m.end(), len(m[1] or "") or int(m[2])) for m in _HEADING.finditer(text)]
        self.starts = [start for start, _, _ in found]
        self.lines = [end for _, end, _ in found]
        self.levels = [level for _, _, level in found]
        self.ends = [_BLANKS.match(text, end).end() for end in self.lines]

    def parted_at(self, at: int) -> bool:
        """Whether a cut would part a heading, or a heading from what belongs under it."""
        k = bisect_left(self.starts, at) - 1
        if k < 0 or at > self.ends[k] or at - self.starts[k] > _HEADING_CHARS:
            return False
        alone = k + 1 < len(self.starts) and self.starts[k + 1] == self.ends[k] and self.levels[k + 1] <= self.levels[k]
        return at <= self.lines[k] or not alone


def _children(text: str, sizes: _Sizes, headings: _Headings, start: int, end: int, depth: int) -> list[tuple[int, int]]:
    """The children of a node (places) at ``depth``, each from where a cut ends to the next; a heading alone is none."""
    low, high = int(sizes.char_at[start]), int(sizes.char_at[end])
    edges = [start]
    for cut in CUTS[depth].finditer(text, low, high):
        edge = sizes.snap(cut.end())
        if edges[-1] < edge < end and not headings.parted_at(cut.end()):
            edges.append(edge)
    return list(zip(edges, [*edges[1:], end]))


def _pieces(text: str, sizes: _Sizes, headings: _Headings, start: int, end: int, depth: int, limit: int) -> list[tuple[int, int]]:
    """The pieces of a node that is over the limit: its children merged with their siblings, or their own pieces."""
    tokens = sizes.tokens_to
    if depth == len(CUTS):  # one endless word
        cuts, at = [start], start
        while tokens(end) - tokens(at) > limit:
            at = max(int(np.searchsorted(sizes.token_at, tokens(at) + limit, side="right")) - 1, at + 1)
            cuts.append(at)
        return list(zip(cuts, [*cuts[1:], end]))
    out: list[tuple[int, int]] = []
    open_run = False  # whether the last piece is a run of siblings that the next one may join
    for low, high in _children(text, sizes, headings, start, end, depth):
        if tokens(high) - tokens(low) > limit:
            out += _pieces(text, sizes, headings, low, high, depth + 1, limit)
            open_run = False
        elif open_run and tokens(high) - tokens(out[-1][0]) <= limit:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
            open_run = True
    return out


def pieces_of(text: str, limit: int, overlap: int, path: str) -> list[tuple[int, int, int]]:
    """``(first character, characters, tokens)`` of the pieces of one text; one piece where it is within the limit."""
    tokens = encode(text, path)
    if len(tokens) <= limit:
        return [(0, len(text), len(tokens))]
    sizes, headings = _Sizes(text, tokens, encoder(path)[1]), _Headings(text)
    out = []
    for start, end in _pieces(text, sizes, headings, 0, len(sizes.token_at) - 1, 0, limit - overlap - SLACK):
        if start:
            start = int(np.searchsorted(sizes.token_at, max(sizes.tokens_to(start) - overlap, 0), side="right")) - 1
        first, last = int(sizes.char_at[start]), int(sizes.char_at[end])
        out.append((first, last - first, sizes.tokens_to(end) - sizes.tokens_to(start)))
    return out


def pieces(text: Column, limit: int, overlap: int, path: str = VOCABULARY, sized: bool = True) -> Column:
    """The pieces of a text as an array of ``start, length`` (characters) and ``n_tokens``; NULL for NULL.

    Unless ``sized``, a text of at most ``limit`` bytes, which can't have more tokens than that, is not encoded.
    """

    def split(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is None:
                out.append(None)
            elif not sized and len(t.encode("utf-8", "replace")) <= limit:
                out.append([{"start": 0, "length": len(t), "n_tokens": None}])
            else:
                out.append([dict(zip(("start", "length", "n_tokens"), p)) for p in pieces_of(t, limit, overlap, path)])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("n_tokens", pa.int32())])))

    split.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # marked so that a filter on the pieces doesn't have them made a second time
    return F.arrow_udf(split, "array<struct<start: int, length: int, n_tokens: int>>").asNondeterministic()(text)


def split_oversized(items: DataFrame, text: str, limit: int = 1500, overlap: int = 100, path: str = VOCABULARY, sized: bool = True) -> DataFrame:
    """``items`` with one row per piece: ``piece_no`` from 0, ``n_pieces, start, n_tokens, piece``.

    Pieces have at most ``limit`` tokens, each but the first repeating the last ``overlap`` tokens before it (up
    to 3 more where a token ends inside a character). Texts within the limit are one piece. ``n_tokens`` counts
    the text's own tokens. Who wants the cuts alone can leave sizes out (``sized=False``): texts that their bytes show
    to be within the limit then have no ``n_tokens``; all else stays the same.

    Defined results: a NULL text gives one row with a NULL piece and 0 pieces; an empty text one empty piece;
    repeated rows are split each; an empty table gives no rows; a column that has one of the new names is replaced.
    """
    if not 0 <= overlap < limit - SLACK:
        raise ValueError("the overlap has to leave room for a piece's own tokens")
    new = ["piece_no", "n_pieces", "start", "n_tokens", "piece"]
    cut = items.withColumn("__pieces", pieces(F.col(text), limit, overlap, path, sized))
    rows = cut.select(
        *(F.col(c) for c in items.columns if c == text or c not in new),
        F.when(F.col("__pieces").isNull(), 0).otherwise(F.size("__pieces")).alias("__n"),
        F.posexplode_outer("__pieces").alias("__no", "__piece"),
    )
    piece = F.substring(F.col(text), F.col("__piece.start") + 1, F.col("__piece.length"))
    kept = [c for c in items.columns if c not in new]
    return rows.select(
        *kept,
        F.coalesce("__no", F.lit(0)).alias("piece_no"),
        F.col("__n").alias("n_pieces"),
        F.col("__piece.start").alias("start"),
        F.col("__piece.n_tokens").alias("n_tokens"),
        piece.alias("piece"),
    )
