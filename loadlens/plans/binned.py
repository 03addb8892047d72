"""Boosted trees of tables whose rows do not fit in memory as Spark's learner keeps them (M8-M11 at full size).

Spark's learner caches four bytes for each feature of each row and more beside, and reads them again for every level of every tree. Here a
row is stored once, in the shared folder: the bin of each numeric column and the number of the level of each text column, a byte or four
each. A stored record is a block of rows, column by column, so that a pass costs Spark a record for thousands of rows. A level of a tree is
one job: tasks place their rows in the tree and sum labels by node, column and bin or level; others add the sums of a node and choose its
split, which is all that the driver gets. A one-hot column is a
split of one level against the others, so its sums are those of the level. The result is a model of the learner's own class over the same
features. ``fitted`` grows the trees of a small table in one task instead, without a job for each level.

As in Spark's own boosting the first tree counts in full and the others by the learning rate; rows are drawn anew for each tree, by a hash
of their content (equal rows are drawn together), and features for each node. Sums are whole numbers, so they do not depend on the order of
the rows, and reruns agree.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.sources.shared import ensure_importable, written_once

#: Rows that the thresholds are made from, at most about; Spark's learner draws as many at 256 bins.
SAMPLE = 65_536
#: Trees after which the margins are stored, so that a pass does not place its rows in all trees before.
KEEP_TREES = 10
#: Sums of a job: nodes of a level times bins and levels. Further nodes are jobs of their own.
SUMS = 1 << 21
CELLS, ROW, MARGIN, LABEL = "_cells", "_row", "_margin", "_label"
#: Rows of a stored block; rows of a task that are summed together at least and at most.
BLOCK, SUMMED, HELD = 1 << 12, 1 << 14, 1 << 18
#: Rows of a table whose trees are grown in one task.
TASK_ROWS = 1_000_000
#: Cells, row hashes, labels and margins of some rows; cells have a line for each column.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def thresholds(sample: np.ndarray, times: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 thresholds between the different values of a sample, with about as many rows from one to the next."""
    values, where = np.unique(sample, return_inverse=True)
    between = (values[:-1] + values[1:]) / 2
    if len(between) >= bins:
        upto = np.cumsum(np.bincount(where, times))[:-1]
        wanted = np.arange(1, bins) * (times.sum() / bins)
        between = between[np.unique(np.minimum(np.searchsorted(upto, wanted), len(between) - 1))]
    return between


def _drawn(row: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree draws; 64 bits mixed as in splitmix."""
    z = row.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (1_000_003 * seed + tree + 1)) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 < share


class Tree:
    """Nodes in arrays: column and cut (a bin, or a level; -1: a leaf), children, rows, mean, spread and gain."""

    def __init__(self) -> None:
        self.column, self.cut, self.left, self.right = [], [], [], []
        self.stats: list[tuple[float, float, float]] = []  # rows, sum, sum of squares
        self.gain: list[float] = []

    def add(self, stats: Sequence[float]) -> int:
        for values, v in ((self.column, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.stats, tuple(stats)), (self.gain, 0.0)):
            values.append(v)
        return len(self.column) - 1

    def mean(self) -> np.ndarray:
        return np.array([s / n if n else 0.0 for n, s, _ in self.stats])

    def place(self, cells: np.ndarray, numeric: int) -> np.ndarray:
        """The node of each row; numeric columns go left up to the cut, a level goes right."""
        column, cut = np.asarray(self.column), np.asarray(self.cut)
        leaf = column < 0
        own = np.arange(len(column))
        # children left and right; a leaf is its own
        child = np.stack([np.where(leaf, own, self.left), np.where(leaf, own, self.right)], axis=1).ravel()
        column, level = np.maximum(column, 0), column >= numeric
        node, every = np.zeros(cells.shape[1], np.int64), np.arange(cells.shape[1])
        for _ in range(self.depth()):
            value, at = cells[column[node], every], cut[node]
            right = np.where(level[node], value == at, value > at) if level.any() else value > at
            node = child[2 * node + right]
        return node

    def depth(self) -> int:
        deep = [0] * len(self.column)
        for i, (left, right) in enumerate(zip(self.left, self.right, strict=True)):
            if left >= 0:
                deep[left] = deep[right] = deep[i] + 1
        return max(deep)


def _blocks(batches: Iterable[pa.RecordBatch], numeric: int, columns: int) -> Iterator[Rows]:
    """The rows of stored blocks."""
    for batch in batches:
        for cells, row, label, margin in zip(*batch.columns, strict=True):
            row = np.frombuffer(row.as_buffer(), np.int64)
            whole, n = np.frombuffer(cells.as_buffer(), np.uint8), len(row)
            found = whole[: numeric * n].reshape(numeric, n)
            if columns > numeric:
                found = np.concatenate([found.astype(np.int32), whole[numeric * n :].view("<i4").reshape(columns - numeric, n)])
            yield found, row, np.frombuffer(label.as_buffer()), np.frombuffer(margin.as_buffer())


def _stored(cells: np.ndarray, numeric: int, row: np.ndarray, label: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """A block of rows as a record."""
    whole = cells[:numeric].astype(np.uint8).tobytes() + cells[numeric:].astype("<i4").tobytes()
    parts = [whole, *(np.ascontiguousarray(x).tobytes() for x in (row, label, margin))]
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], [CELLS, ROW, LABEL, MARGIN])


BLOCKS = f"{CELLS} binary, {ROW} binary, {LABEL} binary, {MARGIN} binary"


def _in_cells(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins and numbers of levels, a line for each column, of rows of values."""
    lines = [np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)]
    return np.stack([*lines, *values[:, len(cuts) :].T.astype(np.int64)])


def binned(rows: DataFrame, numeric: Sequence[str], levels: Sequence[str], cuts: Sequence[np.ndarray]) -> DataFrame:
    """Rows as blocks of bins and numbers of levels, stored once, with the rows' hashes, labels and margins."""
    columns = len(numeric) + len(levels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            cells, row, label = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            held.clear()
            return _stored(cells, len(cuts), row, label, np.zeros(len(row)))

        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)
            held.append((_in_cells(values, cuts), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))))
            if sum(len(x[1]) for x in held) >= BLOCK:
                yield block()
        if held:
            yield block()

    given = rows.select(F.array(*[F.col(c).cast("double") for c in (*numeric, *levels)]), ROW, LABEL)
    return written_once(given.mapInArrow(cut, BLOCKS), "binned")


def _summed(
    blocks: Iterable[Rows], job: _Boosting, number: int, tree: Tree, open_nodes: Sequence[int], before: Sequence[tuple[float, Tree]], scale: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, labels in whole numbers and their squares by open node, column and bin or level, of the rows given."""
    size = len(open_nodes)
    slot = np.full(len(tree.column), -1)
    slot[list(open_nodes)] = range(size)
    out = [[np.zeros(size * w, t) for w in job.widths] for t in (np.int64, np.int64, float)]
    held: list[tuple[np.ndarray, ...]] = []
    # each sum goes over all nodes and bins, so the more of these there are, the more rows are summed together
    enough = min(HELD, max(SUMMED, 2 * size * max(job.widths)))

    def add() -> None:
        cells, at, label = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
        held.clear()
        for i in range(0, len(at), HELD):
            part, label_part = slice(i, i + HELD), label[i : i + HELD]
            square = label_part * label_part
            for c, w in enumerate(job.widths):
                found = at[part] * w + cells[c, part]
                out[0][c] += np.bincount(found, minlength=size * w)
                out[1][c] += np.bincount(found, label_part, size * w).astype(np.int64)
                out[2][c] += np.bincount(found, square, size * w)

    for cells, row, label, margin in blocks:
        if number:
            margin = _moved(margin, cells, before, job.numeric)
            label = np.where(label < margin, -1.0, 1.0) if job.absolute else 2 * (label - margin)
        at = slot[tree.place(cells, job.numeric)]
        used = at >= 0
        if job.share < 1:
            used &= _drawn(row, job.seed, number, job.share)
        used = np.flatnonzero(used)
        held.append((cells[:, used], at[used], np.round(label[used] * scale)))
        if sum(len(x[1]) for x in held) >= enough:
            add()
    if held:
        add()
    return tuple(np.concatenate([x.reshape(size, -1) for x in each], axis=1).ravel() for each in out)


def _moved(margin: np.ndarray, cells: np.ndarray, trees: Sequence[tuple[float, Tree]], numeric: int) -> np.ndarray:
    """Margins after trees, added one by one: the same whether they are stored between or not."""
    for weight, tree in trees:
        margin = margin + (weight * tree.mean())[tree.place(cells, numeric)]
    return margin


class _Boosting:
    """What all passes of a fit know."""

    def __init__(self, learner: GBTRegressor, numeric: int, widths: Sequence[int], rows: int, ends: tuple[float, float]):
        self.numeric, self.widths, self.rows, self.ends = numeric, list(widths), rows, ends
        self.offsets = [0, *np.cumsum(widths).tolist()]
        self.absolute, self.trees = learner.getLossType() == "absolute", learner.getMaxIter()
        self.depth, self.rate, self.seed = learner.getMaxDepth(), learner.getStepSize(), learner.getSeed()
        self.least, self.least_gain, self.share = learner.getMinInstancesPerNode(), learner.getMinInfoGain(), learner.getSubsamplingRate()
        # a numeric column is a feature, and so is each level of a text column
        self.features = numeric + sum(self.widths[numeric:])
        asked = learner.getFeatureSubsetStrategy()
        self.per_node = self.features if asked in ("all", "auto") else max(1, math.ceil(float(asked) * self.features))

    def scale(self, first: bool, margins: tuple[float, float]) -> float:
        """A power of two by which labels become whole numbers whose sums stay exact."""
        low, high = self.ends
        most = max(abs(low), abs(high)) if first else 1.0 if self.absolute else 2 * max(high - margins[0], margins[1] - low)
        bits = min(61 - math.log2(max(1, self.rows)), 52 - math.log2(HELD)) - math.log2(max(most, 1e-300))
        return 2.0 ** math.floor(min(bits, 400))

    def best_in_jobs(self, stored: DataFrame, number: int, tree: Tree, open_nodes: Sequence[int], before: Sequence[tuple[float, Tree]], scale: float) -> list:
        """``best`` of each open node: one job. A task sends a record of sums for each node, tasks that get those of a node add
        them up and choose its split, and the driver gets the splits."""
        job = self

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _summed(_blocks(batches, job.numeric, len(job.widths)), job, number, tree, open_nodes, before, scale)
            for at, parts in enumerate(zip(*(x.reshape(len(open_nodes), -1) for x in found), strict=True)):
                if parts[0].any() or not at:
                    yield pa.RecordBatch.from_arrays([pa.array([at]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], ["at", "n", "s", "q"])

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            added: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                for at, *parts in zip(*batch.columns, strict=True):
                    own = [np.frombuffer(x.as_buffer(), t) for x, t in zip(parts, (np.int64, np.int64, float), strict=True)]
                    if (at := at.as_py()) in added:
                        for x, y in zip(added[at], own, strict=True):
                            x += y
                    else:
                        added[at] = [x.copy() for x in own]
            if added:
                sums = np.stack([[n, s / scale, q / scale**2] for n, s, q in added.values()], axis=1)
                best = job.best([open_nodes[at] for at in added], sums, number)
                yield pa.RecordBatch.from_arrays([pa.array([*added]), pa.array([pickle.dumps(x) for x in best], pa.binary())], ["at", "best"])

        parts = stored.mapInArrow(summed, "at long, n binary, s binary, q binary")
        places = max(1, min(len(open_nodes), 2 * stored.sparkSession.sparkContext.defaultParallelism))
        found = {r["at"]: pickle.loads(r["best"]) for r in parts.repartition(places, "at").mapInArrow(chosen, "at long, best binary").collect()}
        # a node of which no row was drawn is a leaf
        return [found.get(at, (None, None)) for at in range(len(open_nodes))]

    def best(self, nodes: Sequence[int], sums: np.ndarray, number: int) -> list[tuple]:
        """What all rows of each node add up to, and its best split, the first feature on ties: column, cut, gain and the sums of both
        children; none if it stays a leaf."""
        count = len(nodes)
        chosen = np.ones((count, self.features), bool)
        if self.per_node < self.features:
            chosen[:] = False
            for i, node in enumerate(nodes):
                chosen[i, np.random.default_rng([self.seed, number, node]).choice(self.features, self.per_node, replace=False)] = True
        total = sums[:, :, : self.widths[0]].sum(axis=2)[:, :, None]
        every, best, feature = np.arange(count), np.zeros(count), 0
        found: list[tuple | None] = [None] * count
        for i, size in enumerate(self.widths):
            own = sums[:, :, self.offsets[i] : self.offsets[i + 1]]
            if i < self.numeric:
                left, asked = np.cumsum(own, axis=2)[:, :, :-1], chosen[:, feature, None]
                feature += 1
            else:
                left, asked = total - own, chosen[:, feature : feature + size]
                feature += size
            if not left.shape[2] or not asked.any():
                continue
            right = total - left
            fits = asked & (left[0] >= self.least) & (right[0] >= self.least)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total[1] ** 2 / total[0]) / total[0]
            gain = np.where(fits, gain, -1.0)
            cut = np.argmax(gain, axis=1)
            most = gain[every, cut]
            # features made of one input have the same splits, whose gains differ by rounding only
            for k in np.flatnonzero(most > np.maximum(best * (1 + 1e-9), self.least_gain)).tolist():
                best[k], found[k] = most[k], (i, int(cut[k]), float(most[k]), left[:, k, cut[k]].tolist(), right[:, k, cut[k]].tolist())
        # less than rounding explains is no gain
        small = [not n or b <= 1e-12 * q / n for (n, _, q), b in zip(total[:, :, 0].T.tolist(), best.tolist(), strict=True)]
        return [(total[:, k, 0].tolist(), None if small[k] else found[k]) for k in range(count)]

    def grow(self, number: int, best: Callable[[Tree, Sequence[int]], list[tuple]]) -> Tree:
        """A tree; ``best`` gives sums and split of nodes of a tree."""
        tree = Tree()
        open_nodes = [tree.add((0.0, 0.0, 0.0))]
        some = max(1, SUMS // self.offsets[-1])
        for depth in range(self.depth):
            found = [x for i in range(0, len(open_nodes), some) for x in best(tree, open_nodes[i : i + some])]
            if not depth:
                tree.stats[0] = tuple(found[0][0])
            below = []
            for node, (_, split) in zip(open_nodes, found, strict=True):
                if split is not None:
                    tree.column[node], tree.cut[node], tree.gain[node], left, right = split
                    tree.left[node], tree.right[node] = tree.add(left), tree.add(right)
                    below += [tree.left[node], tree.right[node]]
            # a node of fewer rows than two children need is a leaf
            open_nodes = [c for c in below if tree.stats[c][0] >= 2 * self.least]
            if not open_nodes:
                break
        return tree

    def weight(self, number: int) -> float:
        return self.rate if number else 1.0

    def boosted(self, best: Callable, ended: Callable[[list], None]) -> list[tuple[float, Tree]]:
        """All trees; ``best`` takes the number, tree, nodes and scale, ``ended`` the trees so far."""
        trees: list[tuple[float, Tree]] = []
        margins = (0.0, 0.0)
        for number in range(self.trees):
            scale = self.scale(number == 0, margins)
            tree = self.grow(number, lambda tree, nodes: best(number, tree, nodes, scale))  # noqa: B023
            trees.append((self.weight(number), tree))
            ends = self.weight(number) * tree.mean()
            margins = (margins[0] + float(ends.min()), margins[1] + float(ends.max()))
            ended(trees)
        return trees

    def in_jobs(self, stored: DataFrame) -> list[tuple[float, Tree]]:
        """A job for each level; margins are stored every ``KEEP_TREES`` trees."""
        rows, since = stored, []

        def best(number: int, tree: Tree, nodes: Sequence[int], scale: float) -> list:
            return self.best_in_jobs(rows, number, tree, nodes, since, scale)

        def ended(trees: list[tuple[float, Tree]]) -> None:
            nonlocal rows
            since.append(trees[-1])
            if len(since) == KEEP_TREES and len(trees) < self.trees:
                rows = _with_margins(rows, since, len(self.widths), self.numeric)
                since.clear()

        return self.boosted(best, ended)

    def in_task(self, stored: DataFrame) -> list[tuple[float, Tree]]:
        """All levels of all trees in one task, over all rows."""
        job = self

        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [list(x) for x in _blocks(batches, job.numeric, len(job.widths))]

            def best(number: int, tree: Tree, nodes: Sequence[int], scale: float) -> list:
                counts, totals, squares = (x.reshape(len(nodes), -1) for x in _summed(rows, job, number, tree, nodes, (), scale))
                return job.best(nodes, np.stack([counts, totals / scale, squares / scale**2]), number)

            def ended(trees: list[tuple[float, Tree]]) -> None:
                for block in rows:
                    block[3] = _moved(block[3], block[0], trees[-1:], job.numeric)

            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(job.boosted(best, ended))], pa.binary())], ["trees"])

        return pickle.loads(stored.coalesce(1).mapInArrow(grown, "trees binary").first()["trees"])


@dataclass(frozen=True)
class Cells:
    """Training rows as blocks, what they are cut by, and how many levels each text column has."""

    stored: DataFrame
    numeric: list[str]
    cuts: list[np.ndarray]
    levels: dict[str, int]
    total: int
    ends: tuple[float, float]

    def job(self, learner: GBTRegressor) -> _Boosting:
        return _Boosting(learner, len(self.numeric), [*(len(c) + 1 for c in self.cuts), *self.levels.values()], self.total, self.ends)


def cells(rows: DataFrame, numeric: Sequence[str], levels: Mapping[str, int], known: tuple[int, float, float], bins: int = 256) -> Cells:
    """Rows with ``numeric`` columns, ``levels`` (number of a level by column, and how many there are), label and ``_row``, stored once.

    ``known``: the number of rows, the least and the greatest label.
    """
    total, low, high = known
    ensure_importable(rows.sparkSession)
    # at most about SAMPLE different rows, by hash
    part = rows if total <= SAMPLE else rows.where(F.pmod(F.xxhash64(F.lit(5), ROW), F.lit(total)) < SAMPLE)
    sample = part.groupBy(*numeric).agg(F.count(F.lit(1)).alias("_n")).toArrow()
    times = sample["_n"].to_numpy()
    cuts = [thresholds(sample[c].to_numpy(), times, bins) for c in numeric]
    stored = binned(rows.select(*numeric, *levels, ROW, LABEL), numeric, list(levels), cuts)
    return Cells(stored, list(numeric), cuts, dict(levels), total, (low, high))


def boost(
    rows: DataFrame, learner: GBTRegressor, numeric: Sequence[str], levels: Mapping[str, int], known: tuple[int, float, float], bins: int = 256
) -> GBTRegressionModel:
    """Boosted trees of rows as ``cells`` takes them. The features of the model are the numeric columns and then a one-hot column
    for each level."""
    made = cells(rows, numeric, levels, known, bins)
    job = made.job(learner)
    return _model(rows, learner, job.in_jobs(made.stored), made.cuts, job)


def fitted(made: Cells, learner: GBTRegressor) -> list[tuple[float, Tree]]:
    """Boosted trees with their weights; those of a small table are grown in one task. Both ways grow the same trees."""
    job = made.job(learner)
    return job.in_task(made.stored) if made.total <= TASK_ROWS else job.in_jobs(made.stored)


def predicted(rows: DataFrame, made: Cells, trees: Sequence[tuple[float, Tree]], keep: str) -> DataFrame:
    """``keep`` and ``prediction`` of rows that have the numeric columns and levels of ``made``."""
    numeric, columns, cuts = len(made.numeric), len(made.numeric) + len(made.levels), made.cuts

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)
            found = _moved(np.zeros(len(values)), _in_cells(values, cuts), trees, numeric)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found)], [keep, "prediction"])

    given = rows.select(F.array(*[F.col(c).cast("double") for c in (*made.numeric, *made.levels)]), F.col(keep).cast("double").alias(keep))
    return given.mapInArrow(scored, f"{keep} double, prediction double")


def _with_margins(stored: DataFrame, trees: Sequence[tuple[float, Tree]], columns: int, numeric: int) -> DataFrame:
    """The rows with their margin moved on by trees, stored once more."""

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, row, label, margin in _blocks(batches, numeric, columns):
            yield _stored(cells, numeric, row, label, _moved(margin, cells, trees, numeric))

    return written_once(stored.mapInArrow(moved, BLOCKS), "binned")


def _model(rows: DataFrame, learner: GBTRegressor, trees: Sequence[tuple[float, Tree]], cuts: Sequence[np.ndarray], job: _Boosting) -> GBTRegressionModel:
    """The trees as a model of Spark's own class, which scores, stores and ranks features."""
    spark = rows.sparkSession
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    start = [*range(job.numeric), *(job.numeric + job.offsets[i] - job.offsets[job.numeric] for i in range(job.numeric, len(job.widths)))]

    def doubles(values: Sequence[float]) -> object:
        out = gateway.new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def node(tree: Tree, at: int) -> object:
        n, s, q = tree.stats[at]
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles(tree.stats[at]), int(n))
        mean = s / n if n else 0.0
        spread = max(q / n - mean**2, 0.0) if n else 0.0
        column, cut = tree.column[at], tree.cut[at]
        if column < 0:
            return ml.tree.LeafNode(mean, spread, stats)
        # a level's one-hot column is 0 or 1
        place = (column, float(cuts[column][cut])) if column < job.numeric else (start[column] + cut, 0.5)
        return ml.tree.InternalNode(
            mean, spread, tree.gain[at], node(tree, tree.left[at]), node(tree, tree.right[at]), ml.tree.ContinuousSplit(*place), stats
        )

    listed = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for i, (_, tree) in enumerate(trees):
        listed[i] = ml.regression.DecisionTreeRegressionModel(f"{learner.uid}-{i}", node(tree, 0), job.features)
    made = GBTRegressionModel(ml.regression.GBTRegressionModel(learner.uid, listed, doubles([w for w, _ in trees]), job.features))
    made.setFeaturesCol(learner.getFeaturesCol())
    return made
