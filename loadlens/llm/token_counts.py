"""Token counts under a unigram model, with the pre-tokens of a text in a trie.

Each pre-token (a match of the split pattern, as UTF-8 bytes) is cut into vocabulary tokens so that the sum of their
scores is greatest. The best score of every prefix is the forward pass of a dynamic program, and pre-tokens with a
common prefix share that part: they are inserted into a trie, the pass is made once per trie node, and the node where a
pre-token ends holds its number of tokens. The model is the rank file itself: a token's score is ``-log(rank + 2)``,
Zipf's law for tokens in the order of their frequency. Nothing is trained.

A text is counted in its task; only the number leaves it. The trie is kept between texts and started anew when it has
``NODES`` nodes, which bounds memory and changes no count.

* null or empty text: 0 tokens and 0 pre-tokens
* ties between cuts of equal score: the cut with fewer tokens
* a byte that the vocabulary does not hold is one token of score ``UNKNOWN``
* long texts are read whole; repeated rows get equal counts; only the named column is read
"""

from __future__ import annotations

import base64
import functools
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

NODES = 400_000
UNKNOWN = -30.0
_SPLIT = regex.compile(public_tokenizers.PATTERN)


@functools.lru_cache(maxsize=4)
def scores(path: str) -> dict[bytes, float]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): -math.log(int(rank) + 2) for token, rank in map(bytes.split, lines)}


def endings(vocabulary: dict[bytes, float]) -> dict[bytes, float | None]:
    """Everything that a token of the vocabulary ends with, and the score of what is a token itself."""
    found: dict[bytes, float | None] = {token[i:]: None for token in vocabulary for i in range(len(token))}
    return found | vocabulary


@functools.lru_cache(maxsize=4)
def endings_of(path: str) -> dict[bytes, float | None]:
    return endings(scores(path))


class Trie:
    """Counts of pre-tokens; ``best[n]`` is (score, -tokens) of the prefix that node n stands for."""

    def __init__(self, vocabulary: dict[bytes, float], nodes: int = NODES, ends: dict[bytes, float | None] | None = None):
        self.vocabulary, self.nodes = vocabulary, nodes
        self.ends = endings(vocabulary) if ends is None else ends
        self.clear()

    def clear(self) -> None:
        #: The child of a node by ``node << 8 | byte``.
        self.children: dict[int, int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]
        self.terminal: dict[str | bytes, int] = {}

    def count(self, token: str | bytes) -> int:
        """Tokens of the best cut of ``token``."""
        if (known := self.terminal.get(token)) is not None:
            return known
        if len(self.best) >= self.nodes:
            self.clear()
        whole = token if isinstance(token, bytes) else token.encode("utf-8", "surrogatepass")
        children, best, node, way = self.children, self.best, 0, [0]
        for byte in whole:
            child = children.get(node << 8 | byte)
            if child is None:
                child = children[node << 8 | byte] = len(best)
                best.append(self._forward(whole, len(way), way))
            node = child
            way.append(node)
        self.terminal[token] = -best[node][1]
        return self.terminal[token]

    def _forward(self, token: bytes, end: int, way: list[int]) -> tuple[float, int]:
        """The best (score, -tokens) of ``token[:end]`` from those of its prefixes, which lie on ``way``.

        A last token is lengthened to the left only as long as some token of the vocabulary ends with it.
        """
        best, ends, last = self.best, self.ends, token[end - 1 : end]
        score, tokens = best[way[end - 1]]
        found = (score + self.vocabulary.get(last, UNKNOWN), tokens - 1)
        if last in ends:
            for start in range(end - 2, -1, -1):
                own = ends.get(token[start:end], math.inf)
                if own is None:
                    continue
                if own == math.inf:
                    break
                score, tokens = best[way[start]]
                cut = (score + own, tokens - 1)
                if cut > found:
                    found = cut
        return found


def count(text: Column, path: str) -> Column:
    """Struct column: n_tokens and n_pretokens of ``text`` by the rank file at ``path``."""

    @F.arrow_udf("struct<n_tokens:long,n_pretokens:long>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = Trie(scores(path), ends=endings_of(path))
        for batch in batches:
            tokens, parts = [], []
            for x in batch:
                found = Counter(_SPLIT.findall(x.as_py() or ""))
                tokens.append(sum(n * trie.count(k) for k, n in found.items()))
                parts.append(sum(found.values()))
            yield pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(parts, pa.int64())], names=["n_tokens", "n_pretokens"])

    return counted(text)
