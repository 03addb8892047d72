"""SimHash near duplicates by a self-join of a binary trie of fingerprints.

``fingerprint`` is a per-row column. ``links`` joins the distinct fingerprints with themselves: the bits are cut into
``errors + 1`` bands, and two fingerprints within the error budget agree in one band at least. The fingerprints of a
band value, band first, are the leaves below one node of a binary trie. That node is joined with itself: node pairs go
down together bit by bit, add up the bits in which they differ, and are dropped once that is over the budget. All node
pairs of a depth are one array operation. A pair that agrees in several bands is given by the first of them.

With a budget that leaves bands of few bits, a band value holds a share of all fingerprints that does not shrink as they grow.
There the bits are cut into ``errors + 2`` bands, of which near fingerprints agree in two at least: rows go by the first of the two,
and a task joins only those rows of a node that agree in a second band as well.

Scale: texts never leave the scan; only distinct fingerprints are joined, ``errors + 1`` rows each. A band value with
more than ``NODE_ROWS`` fingerprints (``PAIRED_ROWS`` where a task looks for the second band) is split further before it reaches a
task: by the second band, or the remaining bits are cut into bands again, which is exact for the same reason. Components are
found by :func:`graphs.components` on fingerprints.

* null text, empty text or no word: the fingerprint is zero, and it links like any other
* fewer words than a shingle: the whole sequence is the only shingle; repeated shingles count each time
* ties: a bit set in exactly half the hashes is 0
* repeated rows share their fingerprint and component; rows without an id are kept, ids of null never name a component
  unless it has no other
* only id and text are read, so other columns cannot clash; an empty table gives an empty result
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.graphs import components, forest
from loadlens.llm.shared import stored

BITS = 64
#: Fingerprints below one trie node that a task joins at once; larger nodes are split into bands again.
NODE_ROWS = 20_000
#: Fingerprints of a band value that a task joins at once by their second common band.
PAIRED_ROWS = 200_000
#: Bits of a band below which near fingerprints are those that agree in two bands.
BAND_BITS = 12
#: Rows that a task takes up before it joins their complete nodes.
BATCH_ROWS = 50_000
#: Node pairs that are expanded together, and row pairs of two leaves from which they are compared as a block.
FRONTIER = 100_000
BLOCK_PAIRS = 2_048
#: Pairs that a task holds before it takes those that span the same groups.
HELD_PAIRS = 2_000_000
#: Texts, and shingles of them, of a block of a component whose texts are compared.
GROUP_ROWS, GROUP_SHINGLES = 8_000, 2_000_000


def hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of each word shingle of the text with A-Z lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in shingles), np.uint64)


def majority(values: np.ndarray) -> int:
    """The number whose bits are those set in over half of the values."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(values), 1 << 16):
        part = values[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def fingerprint(text: Column, words: int = 3, seed: int = 42) -> Column:
    """Long column: the 64 bits of the SimHash of ``text``."""

    @F.arrow_udf("long")
    def bits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [majority(hashes(x.as_py(), words, seed)) for x in batch]
            yield pa.array(np.array(values, np.uint64).view(np.int64))

    return bits(text)


def trie_pairs(
    group: np.ndarray, bits: np.ndarray, depth: int, errors: int, only: Callable | None = None, where: Callable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of rows of one group whose lowest ``depth`` bits differ in at most ``errors``.

    ``group`` and ``bits`` are sorted together and (group, bits) is unique; the rows of a group are the leaves of a trie.
    A node is a range of rows; a pair is a row range, another one that is the same or follows, and the differing bits.
    Leaves hold few rows, more of them the larger the budget, as nothing is pruned near the root. Rows of two leaves are
    compared by all bits. ``where`` tells from the bits of both rows which pairs count. With ``only=spanning`` those are
    thinned out whenever many are held; what is left connects the same rows, but need not be pairs of near rows.
    """
    rows = min(2048, 8 << errors)
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    ends = np.r_[begins[1:], len(group)]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def take(i: np.ndarray, j: np.ndarray) -> None:
        i, j = i[i < j], j[i < j]
        if where is not None:
            keep = where(bits[i], bits[j])
            i, j = i[keep], j[keep]
        found.append((i, j))
        if only is spanning and sum(len(x) for x, _ in found) > HELD_PAIRS:
            found[:] = [only(bits, *(np.concatenate(x) for x in zip(*found, strict=True)))]

    roots = np.flatnonzero(ends - begins > 1)
    todo = [(depth, *(x[roots] for x in (begins, ends, begins, ends)), np.zeros(len(roots), np.int8))]
    while todo:
        level, a0, a1, b0, b1, differ = todo.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            todo += [(level, *(x[:half] for x in (a0, a1, b0, b1, differ))), (level, *(x[half:] for x in (a0, a1, b0, b1, differ)))]
            continue
        leaf = (a1 - a0 <= rows) & (b1 - b0 <= rows) | (level == 0)
        _leaf_pairs(bits, a0[leaf], a1[leaf], b0[leaf], b1[leaf], errors, take)
        a0, a1, b0, b1, differ = (x[~leaf] for x in (a0, a1, b0, b1, differ))
        if not len(a0):
            continue
        mask = np.uint64(1 << (level - 1))
        ma, mb = _split(bits, a0, a1, mask), _split(bits, b0, b1, mask)
        below = []
        for (x0, x1), xs in (((a0, ma), 0), ((ma, a1), 1)):
            for (y0, y1), ys in (((b0, mb), 0), ((mb, b1), 1)):
                count = differ + (xs != ys)
                keep = (x0 < x1) & (y0 < y1) & (count <= errors)
                if xs > ys:  # a node joined with itself meets its two halves once
                    keep &= a0 != b0
                below.append([v[keep] for v in (x0, x1, y0, y1, count)])
        todo.append((level - 1, *(np.concatenate(v) for v in zip(*below, strict=True))))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate([empty, *x]) for x in zip(*found, strict=True)) if found else (empty, empty)


def _leaf_pairs(bits: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, errors: int, take: Callable) -> None:
    """Gives ``take`` the pairs of rows of small node pairs, by all their bits at once."""
    large = (a1 - a0) * (b1 - b0) > BLOCK_PAIRS
    for x0, x1, y0, y1 in zip(*(x[large].tolist() for x in (a0, a1, b0, b1)), strict=True):
        for x in range(x0, x1, 256):
            near = np.bitwise_count(bits[x : min(x + 256, x1), None] ^ bits[None, y0:y1]) <= errors
            i, j = np.nonzero(near)
            take(i + x, j + y0)
    a0, a1, b0, b1 = (x[~large] for x in (a0, a1, b0, b1))
    width = b1 - b0
    counts = (a1 - a0) * width
    pair = np.repeat(np.arange(len(a0)), counts)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts)
    i, j = a0[pair] + place // width[pair], b0[pair] + place % width[pair]
    near = np.bitwise_count(bits[i] ^ bits[j]) <= errors
    take(i[near], j[near])


def spanning(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what the given pairs connect: fewer than rows, however large a group of copies is."""
    return forest(i, j, len(bits))


def towards_hubs(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its pair with the neighbour of most pairs, and with the nearest one: at most two a row.

    Copies of one text lie closer to it than to each other, so it has the most pairs, and the pairs with it are those
    that a later check confirms.
    """
    own, other = np.r_[i, j], np.r_[j, i]
    degree = np.bincount(own, minlength=len(bits))
    apart = np.bitwise_count(bits[own] ^ bits[other])
    chosen = []
    for order in (np.lexsort((other, apart, -degree[other], own)), np.lexsort((other, -degree[other], apart, own))):
        first = np.r_[True, own[order][1:] != own[order][:-1]] if len(order) else np.empty(0, bool)
        best = order[first]
        chosen.append(np.column_stack([np.minimum(own[best], other[best]), np.maximum(own[best], other[best])]))
    kept = np.unique(np.concatenate(chosen), axis=0)
    return kept[:, 0], kept[:, 1]


def _split(bits: np.ndarray, begin: np.ndarray, end: np.ndarray, mask: np.uint64) -> np.ndarray:
    """For each range of rows with equal higher bits: where the rows with the masked bit begin (a binary search)."""
    low, high = begin.copy(), end.copy()
    while (active := low < high).any():
        middle = (low + high) // 2
        one = (bits[np.minimum(middle, len(bits) - 1)] & mask) != 0
        high = np.where(active & one, middle, high)
        low = np.where(active & ~one, middle + 1, low)
    return low


def _bands(parts: list[tuple[int, int]], count: int) -> list[tuple[int, int]]:
    """The longest stretch (low bit, width) of ``parts`` cut into ``count`` bands, as (low bit, width)."""
    low, width = max(parts, key=lambda x: x[1])
    edges = [low + width * i // count for i in range(count + 1)]
    return [(x, y - x) for x, y in zip(edges, edges[1:], strict=False)]


def _value(low: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))


#: Names of bands of which near fingerprints agree in two begin with it.
PAIR = "p"


def _bands_of(errors: int) -> dict[str, tuple[int, int]]:
    """The bands that rows go by, by name. Short ones are the first of two; the last of that cut is never the first."""
    if BITS // (errors + 1) < BAND_BITS:
        return {f"{PAIR}{i}": x for i, x in enumerate(_pair_cut(errors)[:-1])}
    return {str(i): x for i, x in enumerate(_bands([(0, BITS)], errors + 1))}


def _pair_cut(errors: int) -> list[tuple[int, int]]:
    return _bands([(0, BITS)], errors + 2)


def _numbers(band: str) -> list[int]:
    return [int(i) for i in band.removeprefix(PAIR).split(".")]


def _first_of_two(band: str) -> bool:
    """Whether rows of this name are to agree in one more band of the same cut."""
    return band.startswith(PAIR) and len(_numbers(band)) == 1


def links(prints: DataFrame, errors: int = 2, node_rows: int = NODE_ROWS, max_splits: int = 3, only: Callable | None = None) -> DataFrame:
    """From distinct fingerprints (fp long): pairs (a long, b long) that differ in at most ``errors`` bits.

    ``only`` (``spanning`` or ``towards_hubs``) thins out the pairs that a task has found, before they leave it.
    Where ``prints`` has a column ``kind`` (int), only fingerprints of one kind are compared, and the pairs have it too.
    """
    kind = F.col("kind") if "kind" in prints.columns else F.lit(0).alias("kind")
    bands = _bands_of(errors)
    rows = prints.select(kind, "fp", F.explode(F.array(*(F.struct(F.lit(name).alias("band"), _value(*b).alias("value")) for name, b in bands.items()))).alias("k"))
    rows = stored(rows.select("kind", "fp", F.col("k.band").alias("band"), F.array("k.value").alias("value")), "bands")
    node = ["kind", "band", "value"]
    ready = []
    for split in range(max_splits):
        most = node_rows * (PAIRED_ROWS // NODE_ROWS) if not split and all(map(_first_of_two, bands)) else node_rows
        crowded = stored(rows.groupBy(*node).agg(F.count("*").alias("n")).where(F.col("n") > most).drop("n"), "crowded")
        if crowded.isEmpty():
            break
        ready.append(rows.join(crowded, node, "left_anti"))
        rows = stored(_deeper(rows.join(crowded, node, "left_semi"), errors), "bands")
    ready.append(rows)
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    dealt = every.withColumn("key", F.xxhash64(*node)).repartition("key").sortWithinPartitions("key", *node)
    return dealt.mapInPandas(_joined(errors, only), "kind int, a long, b long")


def _cuts(band: str, errors: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """For the bands that ``band`` names ('i', 'i.j' or with ``PAIR``): the stretches of bits outside them, and the bands before them that
    pairs of this name do not agree in.

    Where pairs agree in two bands of one cut, the first two numbers are these; every other number is a band of the longest
    stretch that is left.
    """
    parts, before, names = [(0, BITS)], [], _numbers(band)
    if band.startswith(PAIR):
        cut, pair = _pair_cut(errors), names[:2]
        before += [x for i, x in enumerate(cut[: pair[-1]]) if i not in pair]
        parts, names = _outside([cut[i] for i in pair]), names[2:]
    for i in names:
        whole = max(parts, key=lambda x: x[1])
        cut = _bands(parts, errors + 1)
        before += cut[:i]
        parts = [x for x in parts if x != whole] + cut[:i] + cut[i + 1 :]
    return parts, before


def _outside(taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches of bits between those in ``taken``, which are in order."""
    begins = [0, *(low + width for low, width in taken)]
    ends = [*(low for low, _ in taken), BITS]
    return [(low, high - low) for low, high in zip(begins, ends, strict=True) if low < high]


def _next(band: str, errors: int) -> dict[int, tuple[int, int]]:
    """The bands by which rows of a name are told further apart, by number."""
    if _first_of_two(band):
        return {i: x for i, x in enumerate(_pair_cut(errors)) if i > _numbers(band)[0]}
    return dict(enumerate(_bands(_cuts(band, errors)[0], errors + 1)))


def _deeper(rows: DataFrame, errors: int) -> DataFrame:
    """Rows of crowded band values, once for each band that tells them further apart."""
    names = [r["band"] for r in rows.select("band").distinct().collect()]  # at most (errors + 1) ** splits names
    cuts = [(name, f"{name}.{i}", low, (1 << width) - 1) for name in names for i, (low, width) in _next(name, errors).items()]
    listed = rows.sparkSession.createDataFrame(cuts, "band string, deeper string, low int, mask long")
    more = F.expr("shiftrightunsigned(fp, low) & mask")
    return rows.join(F.broadcast(listed), "band").select("kind", "fp", F.col("deeper").alias("band"), F.concat("value", F.array(more)).alias("value"))


def _first(band: str, a: np.ndarray, b: np.ndarray, errors: int) -> np.ndarray:
    """Whether the bands that ``band`` names are the first ones in which the pair agrees, at each cut."""
    keep = np.ones(len(a), bool)
    for low, width in _cuts(band, errors)[1]:
        keep &= ((a ^ b) >> np.uint64(low)) & np.uint64((1 << width) - 1) != 0
    return keep


def _joined(errors: int, only: Callable | None):
    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"kind": np.empty(0, np.int32), "a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})]
        for (kind, band), own in frame.groupby(["kind", "band"], sort=False):
            node = pd.factorize(own["value"].map(tuple))[0]
            prints = own["fp"].to_numpy(np.int64).view(np.uint64)
            seconds = _next(band, errors) if _first_of_two(band) else {None: (0, 0)}
            for second, (low, width) in seconds.items():
                group = node.astype(np.int64) << width | ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
                order = np.lexsort((prints, group))
                group, bits = group[order], prints[order]
                # before pairs are thinned out: those of other bands are left to these bands
                first = functools.partial(_first, band if second is None else f"{band}.{second}", errors=errors)
                i, j = trie_pairs(group, bits, BITS, errors, only, first)
                if only is not None:
                    i, j = only(bits, i, j)
                out.append(pd.DataFrame({"kind": np.full(len(i), kind, np.int32), "a": bits[i].view(np.int64), "b": bits[j].view(np.int64)}))
        return pd.concat(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= BATCH_ROWS:
                frame = pd.concat(held)
                open_key = frame["key"] == frame["key"].iloc[-1]  # the last key may go on in the next batch
                held, count = [frame[open_key]], int(open_key.sum())
                if not open_key.all():
                    yield pairs(frame[~open_key])
        if count:
            yield pairs(pd.concat(held))

    return run


def near_duplicates(documents: DataFrame, errors: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """From documents (doc_id, text): doc_id, fp long, component_id (the smallest doc_id reachable by links)."""
    printed = stored(documents.select("doc_id", fingerprint(F.col("text"), words, seed).alias("fp")), "fingerprints")
    named = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classes = _classes(named, links(named.select("fp"), errors, only=spanning))
    return printed.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(named: DataFrame, linked: DataFrame) -> DataFrame:
    """From (fp, first) and links of fingerprints: fp, component, component_id (the smallest first)."""
    joined = components(linked)
    own = named.join(joined, named["fp"] == joined["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    own = stored(own, "components")
    smallest = own.groupBy("component").agg(F.min("first").alias("component_id"))
    return own.join(smallest, "component").select("fp", "component", "component_id")


def _remixed(values: np.ndarray, i: int) -> np.ndarray:
    """Other hashes of the same shingles; the first are the hashes themselves."""
    if i == 0:
        return values
    out = values + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def _fingerprints(words: int, seed: int, count: int):
    @F.arrow_udf("array<long>")
    def several(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for x in batch:
                own = np.unique(hashes(x.as_py(), words, seed))
                out.append(np.array([majority(_remixed(own, i)) for i in range(count)], np.uint64).view(np.int64))
            yield pa.array(out, pa.list_(pa.int64()))

    return several


def _shingles(words: int, seed: int):
    @F.arrow_udf("array<long>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.unique(hashes(x.as_py(), words, seed)).view(np.int64) for x in batch], pa.list_(pa.int64()))

    return sets


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all pairs of a row of ``left`` and one of ``right`` of that Jaccard similarity or more.

    ``sets`` are distinct hashes. Rows that are connected already are not compared again, so a group of copies takes a
    pass or two over it.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    _, codes, times = np.unique(np.concatenate([np.empty(0, np.int64), *sets]), return_inverse=True, return_counts=True)
    common = times[codes] > 1  # a shingle of one row is in no intersection
    ends = np.r_[0, np.cumsum(common)][np.cumsum(sizes)]
    begins, codes = np.r_[0, ends[:-1]], codes[common]
    has, group = np.zeros(len(times), bool), np.arange(len(sets))
    found: list[tuple[int, int]] = []

    def compare(row: int, others: np.ndarray) -> None:
        others = others[group[others] != group[row]]
        low, high = np.minimum(sizes[row], sizes[others]), np.maximum(sizes[row], sizes[others])
        others = others[low >= similarity * high]
        if not len(others):
            return
        own = codes[begins[row] : ends[row]]
        has[own] = True
        if 4 * len(others) > len(sets):
            both = np.r_[0, np.cumsum(has[codes])]
            both = both[ends[others]] - both[begins[others]]
        else:
            both = np.array([np.count_nonzero(has[codes[begins[x] : ends[x]]]) for x in others])
        has[own] = False
        whole = sizes[row] + sizes[others] - both
        for x in others[np.where(whole > 0, both / np.maximum(whole, 1), 1.0) >= similarity].tolist():
            if group[x] != group[row]:
                group[group == group[x]] = group[row]
                found.append((row, x))

    left, right = np.flatnonzero(left), np.flatnonzero(right)
    one = np.array_equal(left, right)
    for row in [] if one else left[:3]:  # connects most rows of a group of copies at once
        compare(row, np.union1d(left, right))
    for row in left:
        compare(row, right[right > row] if one else right)
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _verified(similarity: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        frame = frame.sort_values(["block", "node"], kind="stable")
        node, block = frame["node"].to_numpy(), frame["block"].to_numpy()
        a, b = similar([np.asarray(x, np.int64) for x in frame["shingles"]], block == left, block == right, similarity)
        return pd.DataFrame({"a": node[a], "b": node[b]})

    return run


def verified(sets: DataFrame, similarity: float, rows: int = GROUP_ROWS, shingles: int = GROUP_SHINGLES) -> DataFrame:
    """From (component, node, shingles): pairs (a, b) that connect all similar texts of each component.

    All texts of a component are compared with each other. One of more texts or shingles than the bounds is cut into hash
    blocks, and each pair of blocks is a group of its own.
    """
    sizes = sets.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / rows), F.ceil(F.sum(F.size("shingles")) / shingles)).cast("int").alias("blocks"))
    cut = sets.join(sizes, "component").withColumn("blocks", F.greatest("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int"))
    paired = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = paired.select("component", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "node", "shingles")
    return keyed.groupBy("component", "left", "right").applyInPandas(_verified(similarity), "a long, b long")


def one_of_each(
    documents: DataFrame, similarity: float = 0.8, words: int = 5, errors: int = 8, prints: int = 4, seed: int = 42
) -> DataFrame:
    """``documents`` (doc_id, text and any others): one row of each group of near duplicates, that of smallest doc_id.

    Near duplicates have a Jaccard similarity of ``similarity`` or more by their sets of word shingles; a text without a
    word is like any other such text. Candidates differ in at most ``errors`` bits of one of ``prints`` fingerprints. All
    texts that candidates connect are compared with each other, and only links that hold are thinned out, so a template
    or passage that many texts share hides no pair. Texts in one group may be linked through others. Of rows that agree
    in id the first by all columns stays.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns))
    text = F.coalesce(F.col("text"), F.lit(""))
    made = _fingerprints(words, seed, prints)("text")
    printed = stored(documents.select(row.alias("row"), F.xxhash64(text).alias("node"), made.alias("prints")), "fingerprints")
    texts = printed.select("node", "prints").distinct()
    own = texts.select("node", F.posexplode("prints").alias("kind", "fp"))
    least = stored(own.groupBy("kind", "fp").agg(F.min("node").alias("least")), "least")
    far = links(least.select("kind", "fp"), errors, only=spanning)
    for end, name in (("a", "x"), ("b", "y")):
        far = far.join(least.select("kind", F.col("fp").alias(end), F.col("least").alias(name)), ["kind", end])
    same = own.join(least, ["kind", "fp"]).where("node <> least").select(F.col("least").alias("x"), F.col("node").alias("y"))
    pairs = stored(far.select("x", "y").unionByName(same), "pairs")
    met = components(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")))
    read = printed.join(met, "node").groupBy("component", "node").agg(F.min(F.coalesce("row.text", F.lit(""))).alias("text"))
    read = stored(read.select("component", "node", _shingles(words, seed)("text").alias("shingles")), "candidates")
    linked = stored(verified(read, similarity), "similar")
    grouped = components(linked)
    keyed = printed.select("node", "row").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keyed = keyed.select("component", "node", "row", F.col("row.doc_id").alias("id"))
    # the smallest row of a group, found without moving texts: ids first, then the texts of that id
    smallest = keyed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("s"))
    smallest = smallest.select("component", F.col("s.id").alias("least_id"), F.col("s.node").alias("least_node"))
    kept = keyed.join(
        smallest.select("least_id", "least_node"), (F.col("node") == F.col("least_node")) & F.col("id").eqNullSafe(F.col("least_id"))
    )
    return kept.groupBy("component").agg(F.min("row").alias("row")).select("row.*")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
