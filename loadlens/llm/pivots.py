"""Near duplicates of embeddings through a pivot-permutation index.

Pivots are vectors of the table itself, drawn by a hash of their content, no two of them within the cosine bound of each
other: a bounded sample (``PIVOTS`` rows at most), while every vector is indexed.

* A vector within the bound of a pivot is at home at the nearest such pivot. All links of such vectors are found exactly:
  by the triangle inequality the other vector of a link lies within twice the angle of that pivot, so all vectors there
  are compared with those at home. A dense group, which holds few pivots, is found this way.
* A pair of two other vectors is described by the ``NEAREST`` pivots closest to each, in order. An inverted list holds the
  vectors that name the same two pivots, one of them among the vector's first ``FIRST``; so a pair meets where it shares
  two pivots or more, of which near ones count most. All pairs of a list are compared. This part is approximate: pairs
  that share no list are not found. The rule is the same at every number of rows.

A pair is a link by its cosine in double precision.

Scale: equal vectors are one row with a count. The number of pivots grows with the table up to its bound, which keeps
lists short. Short lists are dealt out to tasks by a hash, as many to a task as its size allows. A long list of either kind
is cut into hash blocks and each pair of blocks is a group of its own. So no task holds a whole long list and no pair is
left out; the work on a dense group grows with its square, as its numbers of links
do. A vector visits a home pivot only if the vectors at home there reach so far that one may be linked. A task gives each
vector the number of its links and a spanning forest of them, never the pairs themselves. A pair that meets in several
lists counts in one. The pivots and a number for each are all that the driver holds and tasks get from it.

* a vector that is null, empty, zero, or holds a null or non-finite component links with nothing and is its own component
* vectors of different lengths are not compared
* repeated rows and rows of equal vectors link with each other (each has cosine 1); a repeated id counts as another row
* a null id is kept in its row; it names a component only if all ids of the component are null
* only id and vector are read; an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.graphs import components, forest
from loadlens.llm.shared import stored
from loadlens.llm.vectors import finite, matrix

PIVOTS = 2_048
#: Vectors per pivot that the number of pivots aims at.
ROWS_PER_PIVOT = 100
#: Vectors that are drawn for each pivot, as those of a dense group are mostly left out.
DRAWN = 4
NEAREST = 12
FIRST = 4
#: Rows of a block of a list.
LIST_ROWS = 2_000
#: Components of vectors that a task of short lists holds, about.
TASK_VALUES = 2_000_000
#: In place of a second pivot: the list of a home pivot.
HOME = -1
#: Linked pairs whose lists are compared at a time.
PAIRS = 8_192


def choose(vectors: DataFrame, count: int, cosine: float) -> np.ndarray:
    """At most ``count`` pivots as unit rows: the vectors of smallest hash, without those within the bound of one before."""
    drawn = vectors.orderBy(F.xxhash64(F.lit(9), "unit"), "node").limit(DRAWN * count).select("unit").collect()
    return apart(np.array([r["unit"] for r in drawn], np.float64), count, cosine)


def apart(drawn: np.ndarray, count: int, cosine: float) -> np.ndarray:
    """The first ``count`` rows that are not within the bound of an earlier one."""
    kept = np.empty((min(count, len(drawn)), drawn.shape[1]))
    n = 0
    for row in drawn:
        if n == len(kept):
            break
        if not n or (kept[:n] @ row).max() < cosine:
            kept[n], n = row, n + 1
    return kept[:n]


def nearest(units: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` pivots nearest to each row, nearest first."""
    score = units @ pivots.T
    count = min(count, len(pivots))
    some = np.argpartition(-score, count - 1, axis=1)[:, :count]
    order = np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def _described(pivots: np.ndarray, count: int, cosine: float):
    """Rows with the nearest pivots, the home pivot or -1, and the cosine with the nearest one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                units = matrix(batch["unit"])
                near = nearest(units, pivots, count).astype(np.int32)
                reach = np.einsum("ij,ij->i", units, pivots[near[:, 0]])
                home = np.where(reach >= cosine, near[:, 0], -1).astype(np.int32)
                yield pd.DataFrame({**{c: batch[c] for c in ("node", "copies", "unit")}, "near": list(near), "home": home, "reach": reach})

    return run


def _visiting(pivots: np.ndarray, around: np.ndarray):
    """Rows with the other home pivots whose vectors may be linked: those with a cosine of ``around`` or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                home = batch["home"].to_numpy()[:, None]
                # a pair of two homes counts at the smaller one, so a vector visits those before its own
                visits = (matrix(batch["unit"]) @ pivots.T >= around) & ((np.arange(len(pivots)) < home) | (home < 0))
                yield batch.assign(visits=[np.flatnonzero(v).astype(np.int32) for v in visits])

    return run


def around(reach: np.ndarray, cosine: float) -> np.ndarray:
    """By the least cosine of a vector at home with its pivot (above 1: none is): the least cosine of one linked with such a vector."""
    angle = np.arccos(np.clip(reach, -1, 1)) + np.arccos(np.clip(cosine, -1, 1))
    return np.where(reach > 1.5, 2.0, np.where(angle >= np.pi, -2.0, np.cos(np.minimum(angle, np.pi)) - 1e-7))


def lists_of(near: np.ndarray, first: int, total: int) -> np.ndarray:
    """Numbers of the lists of each row: two of its pivots, one among the ``first`` nearest, as smaller * total + larger."""
    if near.shape[1] == 1:  # one pivot, one list
        return near.astype(np.int64)
    i, j = np.triu_indices(near.shape[1], 1)
    i, j = i[i < first], j[i < first]
    a, b = near[:, i].astype(np.int64), near[:, j].astype(np.int64)
    return np.minimum(a, b) * total + np.maximum(a, b)


def _counts_here(own: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a pair, by the lists of its vectors, meets in no list of a smaller number than this one."""
    here = np.empty(len(left), bool)
    for at in range(0, len(left), PAIRS):
        a, b = left[at : at + PAIRS], right[at : at + PAIRS]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        here[at : at + PAIRS] = np.where(both, a, np.iinfo(np.int64).max).min(axis=1) == own
    return here


def _within(units: np.ndarray, named: np.ndarray, home: np.ndarray, block: np.ndarray, copies: np.ndarray, cosine: float, own: int | None):
    """Of one list, or of a pair of its blocks: links of each row (counted with copies), and (root, member) that span them.

    ``own`` is the number of the list among ``named``; None: the list of a home pivot, where pairs need a row at home.
    """
    one = block[0] == block[-1]  # rows are sorted by block
    rows = np.flatnonzero(block == block[0])
    others = rows if one else np.flatnonzero(block == block[-1])
    degree, pairs = np.zeros(len(units), np.int64), []
    for start in range(0, len(rows), 512):
        part = rows[start : start + 512]
        score = units[part] @ units[others].T
        close = score >= cosine - 1e-9
        if one:
            close &= part[:, None] < others[None, :]
        if own is None:
            close &= home[part][:, None] | home[others][None, :]
        i, j = np.nonzero(close)
        edge = np.flatnonzero(score[i, j] < cosine + 1e-9)  # sums of another order may differ there
        sure = np.ones(len(i), bool)
        sure[edge] = np.einsum("ij,ij->i", units[part[i[edge]]], units[others[j[edge]]]) >= cosine
        a, b = part[i[sure]], others[j[sure]]
        if own is not None and len(a):
            here = _counts_here(own, named[a], named[b])
            a, b = a[here], b[here]
        if len(a):
            np.add.at(degree, a, copies[b])
            np.add.at(degree, b, copies[a])
            pairs.append(forest(a, b, len(units)))
    if not pairs:
        return degree, np.empty(0, int), np.empty(0, int)
    return degree, *forest(*(np.concatenate(x) for x in zip(*pairs, strict=True)), len(units))


def _links(cosine: float, first: int, total: int):
    """Rows of some whole lists, or of one pair of blocks of a list, to rows (node, links, to)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pivot", "second", "block", "node"], kind="stable")
        units, near = matrix(frame["unit"]), np.stack(frame["near"].to_numpy())
        pivot, second, block, node, copies, home = (frame[c].to_numpy() for c in ("pivot", "second", "block", "node", "copies", "home"))
        named = lists_of(near, first, total)
        new = np.flatnonzero((np.diff(pivot) != 0) | (np.diff(second) != 0)) + 1
        found = [(np.empty(0, np.int64),) * 3]
        for start, end in zip(np.r_[0, new], np.r_[new, len(frame)], strict=True):
            at = slice(start, end)
            own = None if second[start] == HOME else int(pivot[start]) * total + int(second[start])
            degree, root, member = _within(units[at], named[at], home[at] == pivot[start], block[at], copies[at], cosine, own)
            linked = np.flatnonzero(degree)
            if len(linked):
                ids = node[at]
                found.append((ids[linked], degree[linked], ids[linked]))
                found.append((ids[member], np.zeros(len(member), np.int64), ids[root]))
        return pd.DataFrame(dict(zip(("node", "links", "other"), (np.concatenate(x) for x in zip(*found, strict=True)), strict=True)))

    return run


def near_duplicates(
    embeddings: DataFrame,
    cosine: float = 0.9,
    pivots: int = PIVOTS,
    count: int = NEAREST,
    first: int = FIRST,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """From (vec_id, embedding): vec_id, n_links, component_id, kept; one row per row."""
    rows = embeddings.select("vec_id", finite(F.col("embedding")).alias("v"))
    largest = F.array_max(F.transform("v", F.abs))  # taken out first, so that no square overflows
    rows = rows.withColumn("largest", largest).withColumn("v", F.when(F.col("largest") > 0, F.col("v")))
    rows = stored(rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors")
    distinct = rows.where("v is not null").groupBy("v", "largest", "node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    distinct = distinct.withColumn("v", F.transform("v", lambda x: x / F.col("largest")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    distinct = distinct.withColumn("norm", norm).select(
        "node", "copies", "first", F.transform("v", lambda x: x / F.col("norm")).alias("unit"), F.size("v").alias("width")
    )
    distinct = stored(distinct, "distinct")
    linked = None
    for width, n in [(r["width"], r["n"]) for r in distinct.groupBy("width").agg(F.count("*").alias("n")).collect()]:
        own = distinct.where(F.col("width") == width)
        table = choose(own, min(pivots, max(4 * count, n // ROWS_PER_PIVOT)), cosine)
        more = _linked(own, table, cosine, count, first, list_rows)
        linked = more if linked is None else linked.unionByName(more)
    if linked is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    linked = stored(linked, "links")
    degree = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(linked.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    own = distinct.select("node", "copies", "first").join(degree, "node", "left").join(joined, "node", "left")
    own = stored(own.withColumn("component", F.coalesce("component", "node")), "components")
    smallest = own.groupBy("component").agg(F.min("first").alias("least"))
    known = own.join(smallest, "component").select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "least")
    component = F.coalesce("least", "vec_id")
    return rows.join(known, "node", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def _linked(vectors: DataFrame, table: np.ndarray, cosine: float, count: int, first: int, list_rows: int) -> DataFrame:
    """(node, links, other): parts of the link counts, and links that span each component."""
    total = len(table)
    described = "node long, copies long, unit array<double>, near array<int>, home int, reach double"
    near = stored(vectors.select("node", "copies", "unit").mapInPandas(_described(table, count, cosine), described), "permutations")
    reach = np.full(total, 2.0)
    for r in near.where("home >= 0").groupBy("home").agg(F.min("reach").alias("least")).collect():  # a row per pivot at most
        reach[r["home"]] = r["least"]
    near = near.drop("reach")
    if total > 1:
        # two of the nearest pivots, the smaller number first; a pivot is named once, so the pairs of a row are distinct
        places = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(min(first, total)) for j in range(i + 1, min(count, total))))
        at = lambda p: F.get("near", p)
        pair = lambda p: F.struct(F.least(at(p["i"]), at(p["j"])).alias("pivot"), F.greatest(at(p["i"]), at(p["j"])).alias("second"))
        lists = near.where("home < 0").select("*", F.explode(F.transform(places, pair)).alias("l")).select("*", "l.*").drop("l")
    else:
        lists = near.where("home < 0").select("*", F.lit(0).alias("pivot"), F.lit(0).alias("second"))
    homes = near.where("home >= 0").select("*", F.col("home").alias("pivot"))
    visits = f"{described.removesuffix(', reach double')}, visits array<int>"
    guests = near.mapInPandas(_visiting(table, around(reach, cosine)), visits)
    guests = guests.select("*", F.explode("visits").alias("pivot")).select(*homes.columns)
    lists = stored(lists.unionByName(homes.unionByName(guests).withColumn("second", F.lit(HOME))).select("pivot", "second", "node"), "lists")
    key = ["pivot", "second"]
    sizes = lists.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")  # a list of one vector has no pair
    sizes = stored(sizes.select(*key, "n", F.ceil(F.col("n") / list_rows).cast("int").alias("blocks")), "sizes")
    short = sizes.where("blocks = 1").agg(F.sum("n")).first()[0] or 0
    tasks = -(-short // max(list_rows, TASK_VALUES // table.shape[1])) or 1
    lists = lists.join(sizes.drop("n"), key).join(near, "node")
    lists = lists.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    # short lists are dealt out to tasks whole; a long one has numbers of its own
    together = F.pmod(F.xxhash64(F.lit(5), *key), F.lit(tasks))
    alone = F.lit(tasks) + F.col("pivot").cast("long") * (total + 1) + F.col("second") - HOME
    lists = lists.withColumn("task", F.when(F.col("blocks") == 1, together).otherwise(alone))
    paired = lists.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = paired.select(
        "task", *key, F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "node", "copies", "unit", "near", "home"
    )
    return keyed.groupBy("task", "left", "right").applyInPandas(_links(cosine, first, total), "node long, links long, other long")
