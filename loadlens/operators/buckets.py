"""Buckets whose edges come from the data, and the data behind charts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators.quantiles import exact_quantiles
from loadlens.operators.rows import sample_n


class Buckets(NamedTuple):
    index: Column
    labels: list[str]
    edges: list[float]


def quantile_buckets(df: DataFrame, column: str, q: int = 10) -> Buckets:
    """Right-closed buckets between exact quantiles; equal edges merge, the minimum is included (K4)."""
    found = exact_quantiles(df, column, [i / q for i in range(q + 1)])
    edges = sorted({e for e in found if e is not None})
    if len(edges) < 2:
        raise ValueError(f"{column} has fewer than two distinct quantile edges")
    return Buckets(C.cut(column, edges, include_lowest=True), C.quantile_interval_labels(edges), edges)


def bucket_counts(
    df: DataFrame,
    column: str = K.PREDICTION,
    edges: Sequence[float] = K.PREDICTION_EDGES,
    labels: Sequence[str] = K.PREDICTION_LABELS,
    include_lowest: bool = True,
) -> DataFrame:
    """Rows per fixed bucket as a share of all rows, empty buckets kept, in bucket order."""
    spine = df.sparkSession.createDataFrame(list(enumerate(labels)), "_idx int, rate_bucket string")
    index = F.coalesce(C.cut(column, edges, include_lowest), F.lit(-1)).alias("_idx")
    counts = df.select(index).groupBy("_idx").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket at most, so the total over all of them is a sum of a few rows
    counts = counts.withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    joined = spine.join(counts, "_idx", "full_outer")
    total = F.max("_all").over(Window.partitionBy())
    return (
        joined.withColumn("count", F.coalesce("_n", F.lit(0)))
        .withColumn("percentage", F.coalesce(C.safe_div(F.col("count") * 100.0, total), F.lit(0.0)))
        .where(F.col("_idx") >= 0)
        .orderBy("_idx")
        .select("rate_bucket", "count", "percentage")
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty bins kept (K7)."""
    values = df.select(C.null_if_nan(F.col(column).cast("double")).alias("v")).where(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    # all values equal: one unit around them, as plotting libraries do
    left = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins
    index = F.least(F.floor((F.col("v") - left) / width), F.lit(bins - 1))
    counts = values.select(index.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    edges = span.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("_left"),
        (F.when(F.col("lo") == F.col("hi"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / bins).alias("_width"),
    )
    return (
        edges.join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("_left") + F.col("bin") * F.col("_width")).alias("lower"),
            (F.col("_left") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and the number of fliers (K8)."""
    q1, med, q3 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    quartiles = [F.lit(v).cast("double").alias(n) for n, v in (("q1", q1), ("median", med), ("q3", q3))]
    if q1 is None or q3 is None:
        low = high = F.lit(None).cast("double")
    else:
        low, high = F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1))
    c = C.null_if_nan(column)
    return df.agg(
        F.min(F.when(c >= low, c)).alias("whisker_low"),
        F.max(F.when(c <= high, c)).alias("whisker_high"),
        F.count(F.when((c < low) | (c > high), 1)).alias("fliers"),
    ).select(*quartiles, "whisker_low", "whisker_high", "fliers")


def scatter_points(
    df: DataFrame, x: str, y: str, max_points: int | None = None, key: Sequence[str] = (K.KEY,)
) -> DataFrame:
    """Point set of two columns; a hash sample when the chart can only show so many (K9)."""
    part = df if max_points is None else sample_n(df, max_points, key)
    return part.select(x, y)


def scatter_grid(
    df: DataFrame, x: str, y: str, cells: int = 32, per_cell: int = 5, key: Sequence[str] = (K.KEY,), seed: int = 42
) -> DataFrame:
    """A bounded point set that keeps rare regions visible (K9): cell_x, cell_y, cell_rows, x, y.

    The range of both columns is cut into ``cells`` by ``cells`` cells. Each cell keeps all its points, or the ``per_cell`` of
    smallest hash of seed and key, and the number of its rows. Tasks drop what is beyond before the shuffle, so a cell with a
    third of all rows costs ``per_cell`` rows a task. Rows without a finite x and y are left out.
    """
    points = df.select(C.null_if_nan(F.col(x).cast("double")).alias(x), C.null_if_nan(F.col(y).cast("double")).alias(y), *[k for k in key if k not in (x, y)])
    points = points.where(C.is_finite(x) & C.is_finite(y))
    ends = points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    end = lambda name: ends.select(name).scalar()
    cell = lambda c, a, b: F.when(b > a, F.least(F.floor((F.col(c) - a) / (b - a) * cells), F.lit(cells - 1))).otherwise(0).cast("int")
    placed = points.withColumns({"cell_x": cell(x, end("x0"), end("x1")), "cell_y": cell(y, end("y0"), end("y1"))})
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    first = Window.partitionBy("cell_x", "cell_y").orderBy(draw, *key)
    kept = placed.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= per_cell)
    counts = placed.groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("cell_rows"))
    return kept.join(counts, ["cell_x", "cell_y"]).select("cell_x", "cell_y", "cell_rows", x, y)


def diagonal(df: DataFrame, actual: str = K.TARGET, predicted: str = K.PREDICTION) -> DataFrame:
    """Ends of the perfect-prediction line of an actual-vs-predicted chart."""
    return df.agg(
        F.least(F.min(actual), F.min(predicted)).alias("low"),
        F.greatest(F.max(actual), F.max(predicted)).alias("high"),
    )


def scenario_series(df: DataFrame, column: str = K.PREDICTION) -> DataFrame:
    """A scenario by date with the floor of its shaded area, min - max(10, 2 % of min)."""
    low = df.agg(F.min(column).alias("m")).select(F.col("m") - F.greatest(F.lit(10.0), F.col("m") * 0.02)).scalar()
    return df.select("date", column, low.alias("floor")).orderBy("date")
