"""Byte-level BPE: text to token ids by a local rank file, and ids back to bytes.

``encode`` gives the ids as the bytes of little-endian unsigned 32-bit integers, which is four bytes a token on disk and
in shuffles. Both directions are per row: no shuffle, no state.

* null text: no ids, and the empty byte string; null ids decode to the empty byte string
* long texts are cut only between a letter or digit and a following space. No match of the split pattern holds such
  a pair, so a match ends there anyway and the ids are those of the whole text. A text without such a place stays whole.
* repeated rows, ties and extra columns do not matter: rows are independent and only the named column is read
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters after which a long text is cut at the next safe place.
PIECE_CHARS = 65_536
_SAFE = re.compile(r"(?<=[^\W_])(?= )")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file, without special tokens; read once in each Python process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters whose ids, in order, are the ids of the text."""
    start = 0
    while len(text) - start > size and (place := _SAFE.search(text, start + size)):
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def encode_text(bpe: tiktoken.Encoding, text: str | None, size: int = PIECE_CHARS) -> bytes:
    return b"".join(np.array(bpe.encode_ordinary(x), "<u4").tobytes() for x in pieces(text or "", size))


def encode(text: Column, path: str, size: int = PIECE_CHARS) -> Column:
    """Binary column: the ids of ``text`` by the rank file at ``path``, which every executor has."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for batch in batches:
            yield pa.array((encode_text(bpe, x.as_py(), size) for x in batch), pa.binary())

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Binary column: the bytes that the ids stand for."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for batch in batches:
            yield pa.array((bpe.decode_bytes(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in batch), pa.binary())

    return raw(ids)


def n_tokens(ids: Column) -> Column:
    return (F.length(ids) / 4).cast("long")
