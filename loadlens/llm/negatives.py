"""Hard negatives: for each anchor and each of its positives, the best rows of another label within a window of scores.

Scores are integer inner products, computed tile by tile: a tile is the product of a block of anchors and a block of
candidates as matrices of 64-bit integers, by Strassen's recursion with zero padding. Its sums and differences stay exact,
as whole numbers modulo 2^64 form a ring. Each (anchor block, candidate block) is a group of its own. The first pass keeps
a heap of the best positives of each anchor in each tile, the second one, which knows the positives, a heap for each
window; heaps of the same anchor merge by keeping their best, so any number of tiles may meet in any order.

* a row without id or label, or whose vector is null, empty or holds a null or non-finite component, takes no part
* vectors of different lengths are not compared
* rows are rows: a repeated row is another row, may be positive or negative, and as an anchor has rows of its own
* ties of score: the smaller id, then the row's place in the written table, which only tells repeated rows apart
* fewer positives or negatives than asked: all; an anchor without either has no rows; an empty table gives no rows
* components are whole numbers of 64 bits, larger ones the largest such. Tiles whose scores might not fit 64 bits are
  multiplied in Python integers, and a score beyond them counts as the largest or smallest long
* extra columns do not matter
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadlens.llm.shared import stored
from loadlens.llm.vectors import finite

ANCHOR_ROWS, CANDIDATE_ROWS = 4_096, 32_768
#: Rows of the matrices multiplied at a time, and the side at which Strassen's recursion ends.
TILE_ROWS, LEAF = 1_024, 16
MOST = 2**63 - 1
#: A score no row has; scores are cut off one above it.
NONE = -(2**63)


def _even(a: np.ndarray) -> np.ndarray:
    """``a`` with a row and a column of zeros where their number is odd."""
    if not any(n % 2 for n in a.shape):
        return a
    out = np.zeros([n + n % 2 for n in a.shape], a.dtype)
    out[: a.shape[0], : a.shape[1]] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b``, exact for 64-bit integers wherever the result fits and for Python integers always."""
    n, m = len(a), b.shape[1]
    if min(n, a.shape[1], m) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), a.dtype)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and of ``b``, cut off at the range of a long above ``NONE``."""
    bound = int(a.shape[1]) * max(map(abs, (int(a.min()), int(a.max())))) * max(map(abs, (int(b.min()), int(b.max()))))
    if bound <= MOST:
        return strassen(a, b.T)
    wide = strassen(a.astype(object), b.T.astype(object))
    return np.clip(wide, -MOST, MOST).astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best scores of each row, best first; columns come in the order that settles ties."""
    if scores.shape[1] > k:
        worst = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    else:
        worst = np.full(len(scores), NONE)
    row, column = np.nonzero((scores >= worst[:, None]) & (scores > NONE))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], column[keep]


def _tiles(anchors: pd.DataFrame, others: pd.DataFrame):
    """Both blocks in the order of their rows' ids, and the scores of each tile with the places of its rows."""
    others.sort_values(["vec_id", "row"], inplace=True)
    a, b = np.stack(anchors["v"].to_numpy()), np.stack(others["v"].to_numpy())
    for i in range(0, len(a), TILE_ROWS):
        for j in range(0, len(b), TILE_ROWS):
            yield anchors.iloc[i : i + TILE_ROWS], others.iloc[j : j + TILE_ROWS], products(a[i : i + TILE_ROWS], b[j : j + TILE_ROWS])


def _positives(k: int):
    def run(key: tuple, anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        heaps = []
        for a, b, scores in _tiles(anchors, others) if len(anchors) and len(others) else ():
            fits = a["label"].to_numpy()[:, None] == b["label"].to_numpy()[None, :]
            fits &= a["row"].to_numpy()[:, None] != b["row"].to_numpy()[None, :]
            row, column = best(np.where(fits, scores, NONE), k)
            heaps.append((a["row"].to_numpy()[row], b["row"].to_numpy()[column], b["vec_id"].to_numpy()[column], scores[row, column]))
        columns = zip(*heaps) if heaps else [[np.empty(0, np.int64)]] * 4
        return pd.DataFrame(dict(zip(("anchor", "row", "vec_id", "score"), map(np.concatenate, columns), strict=True)))

    return run


def _window(k: int, low: int, high: int):
    def run(key: tuple, anchors: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        heaps = []
        for a, b, scores in _tiles(anchors, others) if len(anchors) and len(others) else ():
            other = a["label"].to_numpy()[:, None] != b["label"].to_numpy()[None, :]
            listed = a["positives"].to_numpy()
            for nth in range(max(map(len, listed))):
                there = np.flatnonzero([len(x) > nth for x in listed])
                # least <= score <= most is low * positive <= 100 * score <= high * positive, in whole numbers
                ends = [(-(-low * int(listed[r][nth]) // 100), high * int(listed[r][nth]) // 100) for r in there]
                least, most = (np.array([min(max(e[i], NONE + 1), MOST) for e in ends])[:, None] for i in (0, 1))
                part = scores[there]
                fits = other[there] & (part >= least) & (part <= most)
                row, column = best(np.where(fits, part, NONE), k)
                own = there[row]
                heaps.append((a["row"].to_numpy()[own], np.full(len(own), nth), b["row"].to_numpy()[column], b["vec_id"].to_numpy()[column], scores[own, column]))
        columns = zip(*heaps) if heaps else [[np.empty(0, np.int64)]] * 5
        return pd.DataFrame(dict(zip(("anchor", "nth", "row", "vec_id", "score"), map(np.concatenate, columns), strict=True)))

    return run


def usable(embeddings: DataFrame, is_anchor: Column, label: Column, scale: int = 256) -> DataFrame:
    """row, vec_id, label, asked, v, width of the rows that take part; ``v`` are whole numbers."""
    v = F.transform(finite(F.col("embedding")), lambda x: F.floor(x * scale).cast("long"))
    rows = embeddings.select("vec_id", label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asked"), v.alias("v"))
    rows = rows.where("vec_id is not null and label is not null and v is not null")
    return rows.select(F.monotonically_increasing_id().alias("row"), "*", F.size("v").alias("width"))


def mine(
    embeddings: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = 256, anchor_rows: int = ANCHOR_ROWS, candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A window holds the scores from ``low`` to ``high`` percent of the positive's.
    """
    rows = stored(usable(embeddings, is_anchor, label, scale), "vectors")
    total, asked = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    blocks, anchor_blocks = max(1, -(-total // candidate_rows)), max(1, -(-asked // anchor_rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(n)).cast("int")
    key = ["width", "anchor_block", "block"]
    others = rows.select("row", "vec_id", "label", "v", "width", place(1, blocks).alias("block"), each(anchor_blocks).alias("anchor_block")).groupBy(*key)
    blocked = lambda df, *more: df.select("row", "label", "v", "width", *more, place(2, anchor_blocks).alias("anchor_block"), each(blocks).alias("block"))

    tiled = blocked(rows.where("asked")).groupBy(*key)
    heaps = tiled.cogroup(others).applyInPandas(_positives(positives), "anchor long, row long, vec_id long, score long")
    order = W.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    found = heaps.withColumn("nth", F.row_number().over(order) - 1).where(F.col("nth") < positives)
    # at most ``positives`` of an anchor
    listed = F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score")))
    known = found.groupBy("anchor").agg(listed.alias("found")).withColumnRenamed("anchor", "row")
    scored = stored(rows.where("asked").join(known, "row"), "positives")

    tiled = blocked(scored, F.col("found.score").alias("positives")).groupBy(*key)
    heaps = tiled.cogroup(others).applyInPandas(_window(negatives, low, high), "anchor long, nth long, row long, vec_id long, score long")
    order = W.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id", "row")
    mined = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = scored.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "found")
    positive = F.get(F.col("found"), F.col("nth").cast("int"))
    return mined.join(names, "anchor").select(
        "anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
