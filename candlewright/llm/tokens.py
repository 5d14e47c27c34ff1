"""Token counts with a public byte-pair vocabulary, as Column expressions."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vocabulary file (ranks of byte pairs) that sizes are counted with; it has to lie on every worker.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# Fixed value: the pattern that cuts a text before its parts are encoded, as published with this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of blanks from this length on, which the encoder's pattern can't take, are encoded beside the rest of their text.
LONG_BLANKS = 50_000
_LONG_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_BLANKS)


@lru_cache(maxsize=4)
def encoder(path: str):
    """The encoder of a vocabulary file and the length in bytes of each of its tokens; kept per Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def encode(text: str, path: str) -> list[int]:
    """The tokens of a whole text, whatever its length.

    The pattern takes a run of blanks without its last, or a run at the end whole, as one part; nothing else that it
    matches spans a place where blanks begin. So what is encoded piece by piece here has the tokens of the whole.
    """
    encoding, _ = encoder(path)
    if len(text) < LONG_BLANKS:
        return encoding.encode_ordinary(text)
    tokens, at = [], 0
    for run in _LONG_BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        tokens += encoding.encode_ordinary(text[at : run.start()])
        tokens += encoding._encode_single_piece(text[run.start() : end])
        at = end
    return tokens + encoding.encode_ordinary(text[at:])


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of ``text``; 0 for the empty text, NULL for NULL."""

    def count(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else len(encode(t, path)) for t in texts.to_pylist()], pa.int64())

    count.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, "bigint").asNondeterministic()(text)  # never counted twice
