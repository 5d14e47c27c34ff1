"""Very long texts in parts, none of which cuts a word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Takes code points and says where a part may end before one.
Edge = Callable[[np.ndarray], np.ndarray]


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


def _first(text: str, start: int, end: int, edge: Edge) -> int | None:
    for at in range(start, end, 4096):
        found = np.flatnonzero(edge(codes(text[at : min(at + 4096, end)])))
        if len(found):
            return at + int(found[0])
    return None


def parts(text: str, size: int, edge: Edge, better: Edge | None = None) -> Iterator[tuple[int, str]]:
    """``text`` in parts with their place, each of ``size`` characters and on to the next edge, or to the end.

    A ``better`` edge is taken where one comes within another ``size`` characters, or the end does.
    """
    start = 0
    while len(text) - start > size:
        soon = start + 2 * size
        cut = _first(text, start + size, min(soon, len(text)), better) if better else None
        if cut is None and not (better and soon >= len(text)):
            cut = _first(text, start + size, len(text), edge)
        if cut is None:
            break
        yield start, text[start:cut]
        start = cut
    yield start, text[start:]
