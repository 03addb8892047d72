"""Exact top-k inner products by a dual-tree search of cover trees.

Queries and candidates are integer vectors. Both sides are cut into hash blocks, and each (query block, candidate block)
is a group of its own, so neither side is held whole. In a group both blocks get a cover tree: a node's points lie within
its covering radius of its centre, and the centres of its children lie apart by the radius of their level. Node pairs go
down together, best bound first. For centres q, x and covering radii s, r no inner product of the pair exceeds

    q·x + s·|x| + r·|q| + s·r

and the pair is dropped where that is below the worst k-th score of the query node's group. Leaves are compared exactly.
The best k of each group meet in a window over ``k * blocks`` rows a query. Scores and ties (smaller id) are exact.

* a vector that is null, empty, or holds a null or non-finite component takes no part, nor does a row without an id
* vectors of different lengths are not compared
* a query is compared with every row but those of its own id; fully repeated rows count once
* fewer than k other rows: all of them; an empty table gives an empty result
* components are whole numbers of 64 bits, larger ones the largest such; beyond ``EXACT`` the products are added as Python
  integers, and a score beyond 64 bits ranks by its value but is returned as the largest or smallest long
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadlens.llm.shared import stored
from loadlens.llm.vectors import finite, matrix

QUERY_ROWS = 2_048
BLOCK_ROWS = 8_192
#: Rows of a leaf, for candidates and for queries: as many as are compared in one product.
LEAF, QUERY_LEAF = 256, 64
#: Ratio of the radii of successive levels.
BASE = 1.3
#: Sums below this are exact in double precision.
EXACT = 2.0**53


class Node:
    """A centre, its covering radius, and the rows below: as children, or as a leaf's row numbers."""

    __slots__ = ("centre", "radius", "norm", "rows", "children", "group")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: int):
        self.centre = points[centre]
        apart = np.sqrt(((points[rows] - self.centre) ** 2).sum(axis=1))
        self.radius = float(apart.max()) * (1 + 1e-9) + 1e-9
        self.norm = float(np.sqrt((self.centre**2).sum()))
        self.rows, self.children, self.group = rows, [], None


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node:
    """The tree of the rows of ``points``. A node is split at the first smaller radius that gives it two children."""
    root = Node(points, np.arange(len(points)), 0)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.rows) <= leaf:
            continue
        radius, rows = node.radius / BASE, node.rows
        apart = np.sqrt(((points[rows] - node.centre) ** 2).sum(axis=1))
        inner = np.unique(apart)
        if len(inner) == 1:  # equal points
            continue
        while radius >= apart.max():
            radius /= BASE
        owner, least, centre, n = np.zeros(len(rows), np.int64), apart, int(np.argmin(apart)), 0
        centres = [rows[centre]]
        most = max(2, 2 * len(rows) // leaf)  # more centres would make leaves of a point or two
        while least.max() > radius and n + 1 < most:  # the farthest point becomes the next centre
            n += 1
            far = int(np.argmax(least))
            centres.append(rows[far])
            new = np.sqrt(((points[rows] - points[rows[far]]) ** 2).sum(axis=1))
            closer = new < least
            owner[closer], least = n, np.minimum(least, new)
        node.children = [Node(points, rows[owner == i], c) for i, c in enumerate(centres) if (owner == i).any()]
        todo += node.children
    return root


class _Best:
    """The k best (score, id) of each query so far, and the worst k-th score of a node's queries."""

    def __init__(self, count: int, k: int):
        self.scores = np.full((count, k), -np.inf)
        self.ids = np.full((count, k), np.iinfo(np.int64).max)

    def worst(self, node: Node) -> float:
        return float(self.scores[node.rows, -1].min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        better = scores >= self.scores[rows, -1][:, None]
        row, column = better.any(axis=1), better.any(axis=0)
        if not row.any():
            return
        rows, scores, ids = rows[row], scores[row][:, column], ids[column]
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best points of each query, best first; -inf where there are fewer."""
    best = _Best(len(queries), k)
    left, right = cover_tree(queries, QUERY_LEAF), cover_tree(points)

    def bound(a: Node, b: Node) -> float:
        value = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return value + 1e-9 * (abs(value) + 1)

    count = 0
    heap = [(-bound(left, right), count, left, right)]
    while heap:
        limit, _, a, b = heapq.heappop(heap)
        if -limit < best.worst(a):
            continue
        if not a.children and not b.children:
            scores = queries[a.rows] @ points[b.rows].T
            scores[query_ids[a.rows][:, None] == ids[b.rows][None, :]] = -np.inf
            best.add(a.rows, scores, ids[b.rows])
            continue
        # the wider node goes down first
        down = a.children and (not b.children or a.radius > b.radius)
        for x, y in ((c, b) for c in a.children) if down else ((a, c) for c in b.children):
            if (top := bound(x, y)) >= best.worst(x):
                count += 1
                heapq.heappush(heap, (-top, count, x, y))
    return best.scores, best.ids


def _plain(queries: list[list[int]], query_ids: np.ndarray, points: list[list[int]], ids: np.ndarray, k: int) -> list[tuple]:
    """The same for numbers that doubles do not hold."""
    out = []
    for q, own in zip(queries, query_ids.tolist(), strict=True):
        scored = [(-sum(x * y for x, y in zip(q, p, strict=True)), i) for p, i in zip(points, ids.tolist(), strict=True) if i != own]
        out += [(own, i, -s) for s, i in heapq.nsmallest(k, scored)]
    return out


def _grouped(k: int):
    def run(key: tuple, asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(offered):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in columns})
        queries, points = matrix(asked["v"]), matrix(offered["v"])
        query_ids, ids = asked["vec_id"].to_numpy(), offered["vec_id"].to_numpy()
        size = max(1.0, np.abs(queries).max()) * max(1.0, np.abs(points).max()) * queries.shape[1]
        if size >= EXACT:
            whole = [[[int(x) for x in row] for row in frame["v"]] for frame in (asked, offered)]
            found = _plain(whole[0], query_ids, whole[1], ids, k)
            return pd.DataFrame([(q, i, min(max(x, -(2**63)), 2**63 - 1)) for q, i, x in found], columns=columns, dtype=np.int64)
        scores, best = search(queries, query_ids, points, ids, k)
        there = scores > -np.inf
        return pd.DataFrame({"query_id": np.repeat(query_ids, k)[there.ravel()], "vec_id": best[there], "score": scores[there].astype(np.int64)})

    return run


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * scale).cast("long"))


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = 256, query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """From (vec_id, embedding): query_id, rank, vec_id, score for the rows where ``is_query`` holds."""
    rows = embeddings.select("vec_id", is_query.alias("asked"), whole_numbers(finite(F.col("embedding")), scale).alias("v"))
    rows = stored(rows.where("vec_id is not null and v is not null").withColumn("width", F.size("v")).distinct(), "points")
    total, asked = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    blocks, query_blocks = max(1, -(-total // block_rows)), max(1, -(-asked // query_rows))
    block = F.pmod(F.xxhash64(F.lit(5), "vec_id", "v"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(6), "vec_id", "v"), F.lit(query_blocks)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    offered = rows.select("vec_id", "v", "width", block.alias("block"), each(query_blocks).alias("query_block"))
    wanted = rows.where("asked").select("vec_id", "v", "width", query_block.alias("query_block"), each(blocks).alias("block"))
    key = ["width", "query_block", "block"]
    found = wanted.groupBy(*key).cogroup(offered.groupBy(*key)).applyInPandas(_grouped(k), "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
