"""Removal of long repeated byte strings by run-compressed Burrows-Wheeler transforms.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else, in any document. Candidates meet
through *anchors*: every window of ``length`` bytes has an anchor, its 64-byte string of smallest hash, so two equal
windows hold the same anchor at the same place. All windows of an anchor lie in its *context*, the bytes up to
``length - 64`` before and after it.

1. A scan gives (anchor, context hash, text, place). Equal texts of a task are read once.
2. Anchors that occur once are dropped by a combined aggregate. Where all contexts of an anchor are equal, every window
   in them is repeated, and no byte needs to be looked at.
3. Of the other anchors, one occurrence of each distinct context is cut out of its text and sent to the anchor's task.
   There the contexts, aligned at the anchor, form an index: the Burrows-Wheeler transform of the collection is built
   column by column from the right, compressed to its runs. Inside a run the match of a suffix with its predecessor
   just goes on; only at the sampled run ends is it looked up anew. So the matching statistics of all contexts are
   streamed along with the transform, and starts that match a neighbour for ``length`` bytes are marked.
4. Marked stretches go back to the texts with that context, and each text joins its stretches.

Anchors with more than ``CONTEXTS`` distinct contexts (a passage in a great many documents) are not sent to one task:
hashes of their windows are counted instead, combined before the shuffle.

Equal keys count as equal bytes: 96 bits for a text, 128 for an anchor with its context, and for a window.

* null text: empty; texts shorter than ``length`` keep everything; matches never cross documents
* a text that occurs twice (repeated rows included) goes whole when it has ``length`` bytes or more
* overlapping occurrences count, as in a long run of one character
* the columns of the input are kept, whatever their names; an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.shared import stored

LENGTH = 200
#: Bytes of an anchor.
GRAM = 64
#: Distinct contexts of an anchor that one task indexes; anchors with more are settled by counting window hashes.
CONTEXTS = 50_000
FOUND = "anchor long, ctx long, k1 long, at long, more array<int>"
#: Bytes of text that are hashed at once, and contexts that are indexed at once (an anchor's stay together).
BATCH_BYTES = 1 << 18
BATCH_CONTEXTS = 8_000

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _doubled(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of twice the stretch, from hashes of stretches of ``step`` bytes."""
    out = h[:-step] * _C1
    out += h[step:]
    out ^= out >> np.uint64(29)
    out *= _C2
    out ^= out >> np.uint64(32)
    return out


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two, 8 at least) from each place of ``data``."""
    h = data.astype(np.uint64)
    for step in (1, 2, 4):
        h = h[:-step] | (h[step:] << np.uint64(8 * step))
    step = 8
    while step < gram:
        h = _doubled(h, step)
        step *= 2
    return h


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over ``values[i : i + width]`` for each i that has them all."""
    have, out = 1, values
    while 2 * have <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    return out if have == width else best(out[: len(values) - width + 1], out[width - have : width - have + len(values) - width + 1])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of documents that lie one after another in ``data``, up to ``ends``."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data, gram) | np.uint64(1)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)
    for end in ends:  # no window goes over the end of a document
        least[max(0, end - length + 1) : end] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(_sliding(padded, width, np.maximum)[: len(h)] == h)
    return places, h[places]


def _find(length: int):
    """(k1, k2, raw) to rows (anchor, ctx, k1, at, more), one for each text, anchor and context.

    ``at`` holds k2 and, in its lower half, the first place in the text; ``more`` the others, null if there are none: a line
    that a text repeats very often is one row.
    """
    reach = length - GRAM

    def of(docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        raw = b"".join(x for _, _, x in docs)
        ends = np.cumsum([len(x) for _, _, x in docs])
        places, hashes = anchors(np.frombuffer(raw, np.uint8), ends, length)
        doc = np.searchsorted(ends, places, side="right")
        begin = ends[doc] - np.array([len(x) for _, _, x in docs])[doc]
        low, high = np.maximum(begin, places - reach), np.minimum(ends[doc], places + length)
        ctx = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], c) for a, b, c in zip(low.tolist(), high.tolist(), (places - low).tolist(), strict=True)), np.uint64, len(places))
        order = np.lexsort((places, ctx, hashes, doc))
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (doc, hashes, ctx)], axis=0)
        first, rest = order[new], order[~new]
        others = np.diff(np.r_[np.flatnonzero(new), len(order)]) - 1
        offsets = pa.array(np.r_[0, np.cumsum(others)].astype(np.int32))
        more = pa.ListArray.from_arrays(offsets, pa.array((places - begin)[rest].astype(np.int32)), mask=pa.array(others == 0))
        keys = np.array([(a, b) for a, b, _ in docs], np.int64)[doc]
        columns = (hashes.view(np.int64), ctx.view(np.int64), keys[:, 0], (keys[:, 1] << 32) + places - begin)
        return pa.RecordBatch.from_arrays([*(pa.array(x[first]) for x in columns), more], names=["anchor", "ctx", "k1", "at", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        docs: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for k1, k2, raw in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), batch["raw"], strict=True):
                if (k1, k2) not in seen:
                    seen.add((k1, k2))
                    docs.append((k1, k2, raw.as_py()))
                    size += len(docs[-1][2])
                    if size >= BATCH_BYTES:
                        yield of(docs)
                        docs, size = [], 0
        if docs:
            yield of(docs)

    return run


def matches(rows: np.ndarray, low: np.ndarray, high: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For aligned contexts: whether the ``length`` bytes from each column equal those of another row of the group.

    Row i holds bytes in the columns ``low[i]`` to ``high[i]``; ``group`` does not decrease. The transform of a column is
    its bytes in the order of what follows them; ``end`` is how far a row matches its predecessor in that order.
    """
    count, width = rows.shape
    starts = width - length + 1
    marked = np.zeros((count, starts), bool)
    order = np.arange(count)
    end = np.full(count + 1, width, np.int32)  # one more, so that the last row has a follower
    for column in range(width - 1, -1, -1):
        there = (low[order] <= column) & (column < high[order])
        symbol = group[order].astype(np.int64) * 512 + np.where(there, rows[order, column], 256)
        moved = np.argsort(symbol, kind="stable")
        before, after = moved[:-1], moved[1:]
        same = (symbol[before] == symbol[after]) & there[after]
        new = np.full(count + 1, column, np.int32)
        inside = same & (after == before + 1)  # within a run the match goes on
        new[1:count][inside] = end[after[inside]]
        head = np.flatnonzero(same & (after != before + 1))  # at a run's end it is the least match between the two
        if len(head):
            edges = np.column_stack([before[head] + 1, after[head] + 1]).ravel()
            new[1 + head] = np.minimum.reduceat(end, edges)[::2]
        order, end = order[moved], new
        if column < starts:
            marked[order, column] = np.maximum(end[:-1], end[1:]) - column >= length
    return marked


def _stretches(marked: np.ndarray, length: int) -> list[list[int]]:
    """For each row: begin, end, begin, end ... of the bytes covered by its marked starts, from the anchor."""
    reach = marked.shape[1] - 1
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    on, off = np.nonzero(edge == 1), np.nonzero(edge == -1)
    out: list[list[int]] = [[] for _ in range(len(marked))]
    for row, a, b in zip(on[0].tolist(), on[1].tolist(), off[1].tolist(), strict=True):
        out[row] += [a - reach, b - 1 - reach + length]
    return out


def _index(length: int):
    """Contexts (anchor, ctx, copies, before, raw), sorted by anchor, to (anchor, ctx, cover)."""
    reach = length - GRAM
    width = 2 * reach + GRAM

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        # a text that Spark's skew handling read in two tasks gave its contexts twice
        frame = frame.drop_duplicates(["anchor", "ctx"], ignore_index=True)
        sizes = frame["raw"].map(len).to_numpy()
        data = np.frombuffer(bytes(width) + b"".join(frame["raw"]) + bytes(width), np.uint8)
        low = reach - frame["before"].to_numpy()
        rows = np.lib.stride_tricks.sliding_window_view(data, width)[width + np.cumsum(sizes) - sizes - low]
        marked = matches(rows, low, low + sizes, pd.factorize(frame["anchor"])[0], length)
        starts = np.arange(marked.shape[1])
        whole = (starts >= low[:, None]) & (starts + length <= (low + sizes)[:, None])
        marked |= whole & (frame["copies"].to_numpy() > 1)[:, None]
        cover = _stretches(marked, length)
        out = pd.DataFrame({"anchor": frame["anchor"], "ctx": frame["ctx"], "cover": cover})
        return out[[len(x) > 0 for x in cover]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= BATCH_CONTEXTS:
                frame = pd.concat(held, ignore_index=True)
                last = frame["anchor"] == frame["anchor"].iloc[-1]  # this anchor may go on in the next batch
                held, count = [frame[last]], int(last.sum())
                if not last.all():
                    yield of(frame[~last].reset_index(drop=True))
        if count:
            yield of(pd.concat(held, ignore_index=True))

    return run


def _cut_out(length: int):
    """Texts with the places of contexts (k1, k2, raw, wanted) to (anchor, ctx, copies, crowded, before, raw).

    Rows come from a join by (k1, k2), so that copies of a text follow each other, and all but the first are passed over.
    """
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for k1, k2, raw, wanted in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), batch["raw"], batch["wanted"], strict=True):
                if (k1, k2) == last:
                    continue
                last = (k1, k2)
                text = raw.as_py()
                for x in wanted.as_py():
                    low = max(0, x["pos"] - reach)
                    for column, value in zip(out, (x["anchor"], x["ctx"], x["copies"], x["crowded"], x["pos"] - low, text[low : x["pos"] + length]), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["anchor", "ctx", "copies", "crowded", "before", "raw"])

    return run


def _windows(length: int):
    """Contexts to hashes of their windows: (anchor, ctx, copies, at, w1, w2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x["raw"][i : i + length]) for i in range(len(x["raw"]) - length + 1)), "<i8").reshape(-1, 2)
                at = np.arange(len(digests), dtype=np.int32) - x["before"]
                same = [np.full(len(at), x[c], np.int64) for c in ("anchor", "ctx", "copies")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*same, at, digests[:, 0].copy(), digests[:, 1].copy())], names=["anchor", "ctx", "copies", "at", "w1", "w2"])

    return run


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, cover) of contexts by the counts of their windows, for anchors with very many contexts."""
    window = ["anchor", "at", "w1", "w2"]
    each = stored(contexts.mapInArrow(_windows(length), "anchor long, ctx long, copies long, at int, w1 long, w2 long"), "windows")
    twice = each.groupBy(*window).agg(F.sum("copies").alias("n")).where("n > 1").drop("n")
    starts = each.join(twice, window).groupBy("anchor", "ctx").agg(F.collect_list("at").alias("at"))
    return starts.select("anchor", "ctx", F.flatten(F.transform("at", lambda x: F.array(x, x + length))).alias("cover"))


def _at(at: str) -> list[Column]:
    return [F.shiftright(at, 32).alias("k2"), F.col(at).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pos")]


def covers(texts: DataFrame, length: int = LENGTH, contexts: int = CONTEXTS) -> DataFrame:
    """From (k1, k2, raw): k1, k2, marks; a mark is the places of an anchor and its covered stretches (null: all)."""
    long_texts = texts.where(F.length("raw") >= length)
    # made twice, which costs less than keeping all anchors
    found = long_texts.mapInArrow(_find(length), FOUND)
    count = F.sum(F.lit(1) + F.coalesce(F.size("more"), F.lit(0)))
    repeated = found.groupBy("anchor").agg(count.alias("n"), (F.min("ctx") != F.max("ctx")).alias("mixed")).where("n > 1").drop("n")
    # stored, so that the join has both sides from a shuffle and can split the places of a hot anchor
    places = stored(found.join(stored(repeated, "repeated"), "anchor"), "places")
    distinct = places.where("mixed").groupBy("anchor", "ctx").agg(count.alias("copies"), F.min(F.struct("k1", "at")).alias("one"))
    distinct = stored(distinct, "contexts")
    crowds = distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > contexts)
    crowds = stored(crowds.select("anchor", F.lit(True).alias("crowded")), "crowds")
    wanted = (
        distinct.join(crowds, "anchor", "left")
        .select("one.k1", *_at("one.at"), "anchor", "ctx", "copies", F.coalesce("crowded", F.lit(False)).alias("crowded"))
        .select("k1", "k2", F.struct("anchor", "ctx", "copies", "crowded", "pos").alias("x"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("x").alias("wanted"))
    )
    cut = long_texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "raw", "wanted")
    cut = cut.mapInArrow(_cut_out(length), "anchor long, ctx long, copies long, crowded boolean, before int, raw binary")
    plain = cut.where("not crowded").repartition("anchor").sortWithinPartitions("anchor", "ctx")
    settled = plain.mapInPandas(_index(length), "anchor long, ctx long, cover array<int>")
    if not crowds.isEmpty():
        settled = settled.unionByName(_counted(cut.where("crowded").dropDuplicates(["anchor", "ctx"]), length))
    settled = stored(settled, "covers")
    whole = places.where("not mixed").select("k1", *_at("at"), "more", F.lit(None).cast("array<int>").alias("cover"))
    part = places.where("mixed").join(settled, ["anchor", "ctx"]).select("k1", *_at("at"), "more", "cover")
    return whole.unionByName(part).groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "more", "cover")).alias("marks"))


def _merged(length: int, size: int, marks: list[dict] | None, copied: bool) -> list[int]:
    """begin, end, begin, end ... of the removed bytes, in order and apart."""
    if size < length:
        return []
    if copied:
        return [0, size]
    reach = length - GRAM
    pairs = []
    for mark in marks or ():
        c = mark["cover"]
        for p in (mark["pos"], *(mark["more"] or ())):
            pairs += [(max(0, p - reach), min(size, p + length))] if c is None else [(p + a, p + b) for a, b in zip(c[::2], c[1::2], strict=True)]
    out: list[int] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def mark(documents: DataFrame, text: str = "text", into: str = "spans", length: int = LENGTH, contexts: int = CONTEXTS) -> DataFrame:
    """``documents`` with ``into``: array<int> of begin, end, begin, end ... (bytes of ``text``) that are to go."""
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    keys = [F.xxhash64(raw).alias("k1"), F.shiftright(F.xxhash64(F.lit(7), raw), 32).alias("k2")]
    keyed = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), *keys)
    copied = keyed.groupBy("k1", "k2").agg((F.count("*") > 1).alias("copied"))
    found = covers(documents.select(*keys, raw.alias("raw")), length, contexts)
    known = copied.where("copied").join(found, ["k1", "k2"], "full")

    @F.arrow_udf("array<int>")
    def merged(sizes: pa.Array, marks: pa.Array, twice: pa.Array) -> pa.Array:
        rows = zip(sizes.to_pylist(), marks, twice.to_pylist(), strict=True)
        return pa.array((_merged(length, n, None if c else m.as_py(), bool(c)) for n, m, c in rows), pa.list_(pa.int32()))

    spans = merged(F.coalesce(F.octet_length(F.col("row")[text]), F.lit(0)), "marks", "copied")
    return keyed.join(known, ["k1", "k2"], "left").select("row.*", spans.alias(into))


def kept(raw: bytes, spans: list[int]) -> bytes:
    edges = [0, *spans, len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


@F.arrow_udf(T.BinaryType())
def kept_bytes(text: pa.Array, spans: pa.Array) -> pa.Array:
    """What is left of ``text`` (null: empty) without the spans."""
    return pa.array((kept((x.as_py() or "").encode(), y) for x, y in zip(text, spans.to_pylist(), strict=True)), pa.binary())


@F.arrow_udf(T.StringType())
def kept_text(text: pa.Array, spans: pa.Array) -> pa.Array:
    """As :func:`kept_bytes`, as text: a character of which only some bytes would go stays whole."""

    def whole(raw: bytes, spans: list[int]) -> list[int]:
        out = []
        for a, b in zip(spans[::2], spans[1::2], strict=True):
            while a < b and raw[a] & 0xC0 == 0x80:
                a += 1
            while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            out += [a, b] if a < b else []
        return out

    def left(text: str, spans: list[int]) -> str:
        raw = text.encode()
        return kept(raw, whole(raw, spans)).decode()

    return pa.array((None if x.as_py() is None else left(x.as_py(), y) for x, y in zip(text, spans.to_pylist(), strict=True)), pa.string())
