"""Best-fit packing of documents into training sequences of equal room, by bin completion.

Each text becomes the ids of a ``tokenizers`` file and an end id. A document longer than a sequence is cut into whole
sequences and, where something is left over, a shorter first piece; no other document is cut. Whole pieces are sequences
of their own. The others are packed by their lengths: tasks count the pieces of each length, the counts (at most ``room``
rows, whatever the table) go to the search of ``bin_completion``, and each piece finds its place from its length and its
rank among the pieces of that length. A frequent length is ranked in hash buckets, by counts of the buckets before, so its
pieces are spread over many tasks. Token ids are made once and written; they are shuffled once, to be ranked.

* null or empty text: the end id alone, a piece of length 1
* the tokenizer splits a text into pre-tokens, whose ids do not depend on each other, so each different one is encoded once
  in a process. Texts of Latin letters and common signs are split here; others are given to the tokenizer as they are
* long texts are cut only where no match of the split can lie, which changes no id
* strings of special tokens in a text are ordinary text
* repeated rows are documents of their own; ties of equal length are settled by the row's place in the written table
* extra columns do not matter: those in ``keep`` come back inside the struct ``row``; an empty table gives no rows
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadlens.llm import bin_completion
from loadlens.llm.bpe import pieces
from loadlens.llm.shared import stored

ROOM, END = 2_048, 0
#: Characters that are split or given to the tokenizer at a time; its results take some hundred bytes a token.
CHUNK_CHARS = 32_768
#: Characters of the pre-tokens that a process keeps; then it forgets them all.
KNOWN_CHARS = 8_000_000
#: Pieces of one length that are ranked together, roughly.
BUCKET_ROWS = 500

_PIECES = "array<struct<piece:int,start:long,length:long,ids:binary>>"


#: Letters, numbers and all characters of texts that are split here; what they are has not changed between Unicode versions.
_LETTER, _NUMBER, _PLAIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r -~¡-ɏ"
_SPLIT = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)
_OTHER = re.compile(rf"[^{_PLAIN}]")


class Encoder(dict):
    """Ids of texts as bytes; the ids of pre-tokens met before are kept, up to ``KNOWN_CHARS`` characters of them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.made = Tokenizer.from_file(path)
        self.made.encode_special_tokens = True
        self.model, self.chars = self.made.model, 0
        shown = self.made.pre_tokenizer.pre_tokenize_str
        #: how the tokenizer writes the bytes of a character for its model
        self.written = {i: shown(chr(i))[0][0] for i in range(0x250) if not _OTHER.match(chr(i))}

    def __missing__(self, word: str) -> bytes:
        ids = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(word.translate(self.written))])
        self.chars += len(word)
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        found = []
        for x in pieces(text or "", CHUNK_CHARS):
            if self.chars > KNOWN_CHARS:
                self.clear()
                self.chars = 0
            if _OTHER.search(x):
                found.append(np.array(self.made.encode(x, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                found.extend(map(self.__getitem__, _SPLIT.findall(x)))
        return b"".join(found)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, once in each Python process."""
    return Encoder(path)


def cut(ids: np.ndarray, room: int) -> list[dict]:
    """Pieces of ``room`` ids after a first one of what is left over."""
    first = len(ids) % room or min(room, len(ids))
    ends = range(first, len(ids) + 1, room)
    starts = [0, *ends][:-1]
    return [{"piece": i, "start": a, "length": b - a, "ids": ids[a:b].tobytes()} for i, (a, b) in enumerate(zip(starts, ends, strict=True))]


def tokenized(text: Column, path: str, room: int = ROOM, end: int = END) -> Column:
    """Array column: the pieces of ``text`` with their ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf(_PIECES)
    def cut_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made, last = encoder(path), np.array([end], "<u4").tobytes()
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]))
        for batch in batches:
            yield pa.array((cut(np.frombuffer(made.encode(x.as_py()) + last, "<u4"), room) for x in batch), kind)

    return cut_up(text)


def _placer(plan: list[tuple[bin_completion.Filling, int]]):
    """Column function (length, rank) -> (sequence_id, offset) of a plan of at most ``room`` lengths."""
    segments: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = {}
    sequence = 0
    for filling, times in plan:
        offset = 0
        for length, k in filling:
            segments.append((length, used.get(length, 0), k, sequence, offset))
            used[length] = used.get(length, 0) + k * times
            offset += length * k
        sequence += times
    length, since, copies, base, offset = np.array(sorted(segments), np.int64).reshape(-1, 5).T.copy()

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        own, rank = lengths.to_numpy(), ranks.to_numpy()
        at = np.empty(len(own), np.int64)
        for x in np.unique(own):
            low, high = np.searchsorted(length, [x, x + 1])
            here = own == x
            at[here] = low + np.searchsorted(since[low:high], rank[here], "right") - 1
        nth = rank - since[at]
        return pd.DataFrame({"sequence_id": base[at] + nth // copies[at], "offset": offset[at] + nth % copies[at] * own})

    return place


def place(items: DataFrame, room: int = ROOM, steps: int = bin_completion.STEPS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds sequence_id and offset to a written table of items with (item long, unique; length long, 1 to ``room``)."""
    whole = items.where(F.col("length") == room)
    parts = items.where(F.col("length") < room)
    # at most one row for each length below room
    found = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = _placer(bin_completion.pack(found, room, steps))
    buckets = items.sparkSession.createDataFrame([(x, -(-n // bucket_rows)) for x, n in found.items()], "length long, _buckets long")
    bucket = F.pmod(F.xxhash64("item"), F.col("_buckets")).alias("_bucket")
    parts = parts.join(F.broadcast(buckets), "length").select(*items.columns, bucket)
    counts = parts.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("item")) - 1
    ranked = parts.withColumn("_nth", nth).join(counts, ["length", "_bucket"])
    ranked = ranked.withColumn("_place", placed(F.col("length"), F.col("_before") + F.col("_nth")))
    parts = ranked.select(*items.columns, "_place.sequence_id", "_place.offset")
    return parts.unionByName(whole.select("*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def pack(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), room: int = ROOM, end: int = END) -> DataFrame:
    """One row per piece: row (struct of ``keep``), piece, start, length, ids, sequence_id, offset."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.explode(tokenized(F.col(f"`{text}`"), path, room, end)).alias("p"))
    items = stored(rows.select("row", "p.*").withColumn("item", F.monotonically_increasing_id()), "pieces")
    return place(items, room).drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, in the order of the offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
