"""High-rate strategies, threshold tables and time windows.

Nothing here multiplies the rows by the grid: rows are first reduced to one row per threshold level (or
per day), and only those few rows are spread over the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators.rows import adjust_where

Window4 = tuple[str, str, str, str]


def two_stage(
    df: DataFrame,
    p: str = K.PREDICTION,
    probability: str = "high_probability",
    factor: float = K.TWO_STAGE_FACTOR,
    name: str = "two_stage_prediction",
) -> DataFrame:
    """``prediction * (1 + factor * probability)`` with the probability held in [0, 1]."""
    return df.withColumn(name, F.col(p) * (F.lit(1.0) + F.lit(factor) * C.clip01(probability)))


def boosted(
    p: str, probability: str, threshold: float, boost: float
) -> Column:
    """The prediction raised by ``boost`` where the probability reaches the threshold."""
    return adjust_where(F.col(probability) >= threshold, p, F.col(p) * (1 + boost))


def _reached(value: Column, thresholds: Sequence[float]) -> Column:
    """How many of the ascending thresholds the value reaches."""
    out = F.when(value < F.lit(float(thresholds[0])), 0)
    for i, t in enumerate(thresholds[1:], start=1):
        out = out.when(value < F.lit(float(t)), i)
    return F.when(value.isNull() | F.isnan(value), 0).otherwise(out.otherwise(len(thresholds)))


def _with_scatter(parts: DataFrame, whole: WindowSpec) -> DataFrame:
    """Parts (n, mean, var; a few rows) with their share of the squared deviations from the mean of the whole.

    Central moments are merged, as sums of squares lose all digits where the mean is large against the spread.
    """
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    return parts.withColumn("scatter", F.col("n") * (F.col("var") + F.pow(F.col("mean") - mean, F.lit(2.0))))


def strategy_grid(
    df: DataFrame,
    thresholds: Sequence[float] = K.STRATEGY_THRESHOLDS,
    boosts: Sequence[float] = K.STRATEGY_BOOSTS,
    y: str = K.TARGET,
    p: str = K.PREDICTION,
    probability: str = "high_probability",
    high: float = K.HIGH_RATE,
) -> DataFrame:
    """MAE, RMSE, R², high-rate MAE and triggered rows of every threshold and boost.

    One pass over the rows groups them by the number of thresholds their probability reaches and sums the
    errors with and without each boost; the grid is then assembled from those few rows.
    """
    thresholds = sorted(thresholds)
    actual = F.col(y)
    is_high = actual >= high

    def sums(prediction: Column, name: str) -> list[Column]:
        e = prediction - actual
        return [
            F.sum(F.abs(e)).alias(f"abs_{name}"),
            F.sum(e * e).alias(f"sq_{name}"),
            F.coalesce(F.sum(F.when(is_high, F.abs(e))), F.lit(0.0)).alias(f"high_{name}"),
        ]

    level = _reached(F.col(probability).cast("double"), thresholds)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(is_high, 1)).alias("n_high"),
        F.avg(actual).alias("mean"),
        F.var_pop(actual).alias("var"),
        *sums(F.col(p), "base"),
    ]
    for j, b in enumerate(boosts):
        aggs += sums(F.col(p) * (1 + b), f"b{j}")
    levels = df.where(actual.isNotNull() & F.col(p).isNotNull()).groupBy(level.alias("level")).agg(*aggs)

    cells = []
    for i, t in enumerate(thresholds, start=1):
        on = F.col("level") >= i
        for j, b in enumerate(boosts):
            cells.append(
                F.struct(
                    F.lit(float(t)).alias("threshold"),
                    F.lit(float(b)).alias("boost"),
                    *[F.when(on, F.col(f"{m}_b{j}")).otherwise(F.col(f"{m}_base")).alias(m) for m in ("abs", "sq", "high")],
                    F.when(on, F.col("n")).otherwise(0).alias("hit"),
                )
            )
    spread = _with_scatter(levels, Window.partitionBy()).select("n", "n_high", "scatter", F.inline(F.array(*cells)))
    n = F.sum("n")
    total_spread = F.sum("scatter")
    return (
        spread.groupBy("threshold", "boost")
        .agg(
            (F.sum("abs") / n).alias("MAE"),
            F.sqrt(F.sum("sq") / n).alias("RMSE"),
            (F.lit(1.0) - F.try_divide(F.sum("sq"), total_spread)).alias("R2"),
            F.try_divide(F.sum("high"), F.sum("n_high")).alias("high_rate_MAE"),
            F.sum("hit").alias("triggered"),
        )
        .orderBy("MAE", "threshold", "boost")
    )


def extreme_metrics(
    df: DataFrame,
    thresholds: Sequence[float] = K.EXTREME_RATES,
    y: str = K.TARGET,
    p: str = K.PREDICTION,
    keep_empty: bool = False,
) -> DataFrame:
    """Count, MAE and mean rates of the rows at or above each threshold.

    Rows are summed per highest threshold they reach; those few sums are added up for the lower ones.
    Thresholds that no row reaches are left out, or kept with empty metrics.
    """
    thresholds = sorted(thresholds)
    spine = [F.lit(float(t)) for t in thresholds]
    reached = _reached(F.col(y).cast("double"), thresholds)
    levels = (
        df.select(reached.alias("level"), F.col(y).alias("_y"), F.col(p).alias("_p"))
        .groupBy("level")
        .agg(
            F.count("_y").alias("n"),
            F.sum(F.abs(F.col("_p") - F.col("_y"))).alias("abs"),
            F.sum("_y").alias("y"),
            F.sum("_p").alias("p"),
        )
    )
    steps = levels.select(F.explode(F.slice(F.array(*spine), F.lit(1), F.col("level"))).alias("threshold"), "n", "abs", "y", "p")
    if keep_empty:
        empty = df.sparkSession.createDataFrame(
            [(float(t), 0, None, None, None) for t in thresholds],
            "threshold double, n long, abs double, y double, p double",
        )
        steps = steps.unionByName(empty)
    n = F.sum("n")
    return (
        steps.groupBy("threshold")
        .agg(
            n.alias("count"),
            F.try_divide(F.sum("abs"), n).alias("MAE"),
            F.try_divide(F.sum("y"), n).alias("mean_actual"),
            F.try_divide(F.sum("p"), n).alias("mean_predicted"),
        )
        .orderBy("threshold")
    )


# ---------------------------------------------------------------- time windows


def _windows(windows: Sequence[Window4]) -> Column:
    day = lambda text: F.lit(text).cast("date")
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("window"),
                day(train_end).alias("train_end"),
                day(start).alias("valid_start"),
                day(end).alias("valid_end"),
            )
            for name, train_end, start, end in windows
        ]
    )


def in_windows(df: DataFrame, windows: Sequence[Window4] = K.ROLLING_WINDOWS, date: str = "date") -> DataFrame:
    """Rows of each validation window, tagged; a row is repeated only for windows it lies in."""
    d = F.col(date)
    inside = F.filter(_windows(windows), lambda w: d.between(w["valid_start"], w["valid_end"]))
    return df.withColumn("_w", F.explode(inside)).withColumn("window", F.col("_w.window")).drop("_w")


def window_counts(df: DataFrame, windows: Sequence[Window4] = K.ROLLING_WINDOWS, date: str = "date") -> DataFrame:
    """Training and validation rows of every window, from one count per day."""
    daily = df.where(F.col(date).isNotNull()).groupBy(F.col(date).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    spread = daily.select("_d", "_n", F.inline(_windows(windows)))
    train = F.sum(F.when(F.col("_d") <= F.col("train_end"), F.col("_n")).otherwise(0))
    valid = F.sum(F.when(F.col("_d").between(F.col("valid_start"), F.col("valid_end")), F.col("_n")).otherwise(0))
    return (
        spread.groupBy("window", "train_end", "valid_start", "valid_end")
        .agg(train.alias("train_rows"), valid.alias("valid_rows"))
        .orderBy("valid_start")
    )


def window_metrics(
    df: DataFrame,
    windows: Sequence[Window4] = K.ROLLING_WINDOWS,
    y: str = K.TARGET,
    p: str = K.PREDICTION,
    date: str = "date",
) -> DataFrame:
    """MAE, RMSE and R² per validation window, from sums per day."""
    e = F.col(p) - F.col(y)
    daily = (
        df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & F.col(date).isNotNull())
        .groupBy(F.col(date).alias("_d"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.abs(e)).alias("abs"),
            F.sum(e * e).alias("sq"),
            F.avg(y).alias("mean"),
            F.var_pop(y).alias("var"),
        )
    )
    n = F.sum("n")
    return (
        _with_scatter(in_windows(daily, windows, "_d"), Window.partitionBy("window"))
        .groupBy("window")
        .agg(
            n.alias("valid_rows"),
            (F.sum("abs") / n).alias("MAE"),
            F.sqrt(F.sum("sq") / n).alias("RMSE"),
            (F.lit(1.0) - F.try_divide(F.sum("sq"), F.sum("scatter"))).alias("R2"),
        )
        .orderBy("window")
    )
