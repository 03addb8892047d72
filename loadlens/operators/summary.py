"""Grouped summaries of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators.audit import describe_numeric
from loadlens.operators.buckets import quantile_buckets
from loadlens.operators.quantiles import group_stats
from loadlens.operators.rows import numeric_cols

_STATS = {
    "count": F.count,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
}


def group_summary(
    df: DataFrame,
    keys: Sequence[str],
    target: str = K.TARGET,
    stats: Sequence[str] = ("count", "mean", "median"),
    order_by: str | None = "count",
    min_count: int | None = None,
) -> DataFrame:
    """Target statistics per group, largest ``order_by`` first."""
    df = C.without_nan(df, target)
    aggs = [_STATS[s](target).alias(s) for s in stats if s != "median"]
    median = {"median": 0.5} if "median" in stats else None
    out = group_stats(df, keys, aggs, of=target, quantiles=median).select(*keys, *stats)
    if min_count is not None:
        out = out.where(F.col("count") >= min_count)
    return out.orderBy(F.desc_nulls_last(order_by), *keys) if order_by else out


def trend(df: DataFrame, date: str = "date", grain: str = "day", target: str = K.TARGET) -> DataFrame:
    """Mean, median and count per day, or per year-month, in time order."""
    name = "date" if grain == "day" else "month"
    key = F.col(date) if grain == "day" else C.month_period(date)
    part = df.select(key.alias(name), F.col(target))
    return group_summary(part, [name], target, ("mean", "median", "count"), order_by=None).orderBy(name)


def weekday_summary(df: DataFrame, date: str = "date", target: str = K.TARGET) -> DataFrame:
    """Monday to Sunday; a weekday without loads stays as an empty row."""
    spine = df.sparkSession.createDataFrame(list(enumerate(K.WEEKDAYS)), "_day int, weekday string")
    part = df.select(C.weekday(date).alias("_day"), F.col(target))
    found = group_summary(part, ["_day"], target, order_by=None)
    return F.broadcast(spine).join(found, "_day", "left").orderBy("_day").drop("_day")


def rate_per_mile_summary(df: DataFrame) -> DataFrame:
    """Distribution of the rate per mile."""
    return describe_numeric(df.select(C.rate_per_mile().alias("rate_per_mile"))).drop("column")


def segment_summary(
    df: DataFrame,
    edges: Sequence[float] = K.RATE_EDGES,
    labels: Sequence[str] = K.RATE_LABELS,
    target: str = K.TARGET,
    covariates: Sequence[str] = ("distance", "weight", "market_index", "quote_signal"),
) -> DataFrame:
    """Rate segments with counts, rates, covariate means and their share of all rows."""
    part = df.select(C.cut(target, edges).alias("segment_idx"), target, *covariates)
    # rows without a target are in no segment but count in the share, hence their own group
    part = part.withColumn("segment_idx", F.coalesce("segment_idx", F.lit(-1)))
    found = group_stats(
        part,
        ["segment_idx"],
        [
            F.count(F.lit(1)).alias("_rows"),
            F.count(target).alias("count"),
            F.avg(target).alias("mean_rate"),
            *[F.avg(c).alias(f"mean_{c}") for c in covariates],
        ],
        of=target,
        quantiles={"median_rate": 0.5},
    )
    everything = Window.partitionBy()  # at most one row per segment
    share = F.col("count") / F.sum("_rows").over(everything) * 100
    return (
        found.withColumn("percentage", share)
        .where(F.col("segment_idx") >= 0)
        .orderBy("segment_idx")
        .select(
            C.label_of("segment_idx", labels).alias("rate_segment"),
            "count",
            "mean_rate",
            "median_rate",
            *[f"mean_{c}" for c in covariates],
            "percentage",
        )
    )


def compare_segments(
    df: DataFrame,
    condition: Column,
    features: Sequence[str] = ("distance", "weight", "market_index", "quote_signal", "rate_per_mile"),
    names: tuple[str, str] = ("normal", "high_rate"),
) -> DataFrame:
    """Feature means on both sides of a condition and their difference in percent (G10), in one pass."""
    off, on = names
    df = C.without_nan(df, *features)
    wide = df.agg(
        *[F.avg(F.when(~condition, F.col(f))).alias(f"{f}_off") for f in features],
        *[F.avg(F.when(condition, F.col(f))).alias(f"{f}_on") for f in features],
    )
    rows = [
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}_off").alias(off), F.col(f"{f}_on").alias(on)) for f in features
    ]
    return wide.select(F.inline(F.array(*rows))).withColumn(
        "difference_pct", C.safe_div((F.col(on) - F.col(off)) * 100, off)
    )


def high_rate_by(
    df: DataFrame,
    keys: Sequence[str],
    threshold: float = K.HIGH_RATE,
    target: str = K.TARGET,
    stats: Sequence[str] = ("mean", "max"),
    having: int = 0,
) -> DataFrame:
    """Loads, high-rate loads and their share per group."""
    df = C.without_nan(df, target)
    high = F.count(F.when(F.col(target) >= threshold, 1))
    aggs = [F.count(target).alias("total_loads"), high.alias("high_rate_loads")]
    aggs += [_STATS[s](target).alias(f"{s}_rate") for s in stats if s != "median"]
    median = {"median_rate": 0.5} if "median" in stats else None
    out = group_stats(df, keys, aggs, of=target, quantiles=median)
    share = C.safe_div(F.col("high_rate_loads") * 100.0, "total_loads")
    out = out.where(F.col("high_rate_loads") >= having).withColumn("high_rate_percentage", share)
    return out.select(
        *keys, "total_loads", "high_rate_loads", *[f"{s}_rate" for s in stats], "high_rate_percentage"
    ).orderBy(*([F.desc("high_rate_loads")] if having else []), *keys)


def high_rate_by_distance(df: DataFrame, threshold: float = K.HIGH_RATE) -> DataFrame:
    part = df.select(C.cut("distance", K.DISTANCE_EDGES_7).alias("_idx"), K.TARGET)
    found = high_rate_by(part, ["_idx"], threshold, stats=("mean", "median"))
    label = C.label_of("_idx", K.DISTANCE_LABELS_7).alias("distance_bucket")
    return found.orderBy("_idx").select(label, *[c for c in found.columns if c != "_idx"])


def high_rate_only_by(df: DataFrame, key: str, threshold: float = K.HIGH_RATE, target: str = K.TARGET) -> DataFrame:
    """Count, mean and maximum of the high-rate loads alone."""
    high = C.without_nan(df, target).where(F.col(target) >= threshold)
    return group_summary(high, [key], target, ("count", "mean", "max")).withColumnsRenamed(
        {"count": "high_rate_loads", "mean": "mean_rate", "max": "max_rate"}
    )


def quantile_summary(df: DataFrame, column: str, q: int = 10, target: str = K.TARGET) -> DataFrame:
    """Target statistics per quantile bucket of a column; rows without a value are left out."""
    part = df.select(column, target)
    buckets = quantile_buckets(part, column, q)
    part = part.select(buckets.index.alias("_idx"), target)
    found = group_stats(
        part,
        ["_idx"],
        [F.count(target).alias("count"), F.avg(target).alias("mean_rate"), F.max(target).alias("max_rate")],
        of=target,
        quantiles={"median_rate": 0.5},
    )
    label = C.label_of("_idx", buckets.labels).alias(f"{column}_bucket")
    return found.orderBy("_idx").select(label, "count", "mean_rate", "median_rate", "max_rate")


def _correlation(x: Column, y: Column) -> Column:
    """Correlation over the pairs that have both values; NULL when one side does not vary."""
    pair_x, pair_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(pair_x) * F.stddev_pop(pair_y))


def correlations(df: DataFrame, target: str = K.TARGET, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete correlation of every numeric column with the target, largest first."""
    cols = list(cols or numeric_cols(df))
    y = C.null_if_nan(target)
    wide = df.agg(
        *[_correlation(C.null_if_nan(F.col(c).cast("double")), y).alias(f"c{i}") for i, c in enumerate(cols)]
    )
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("correlation")) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows))).orderBy(F.desc_nulls_last("correlation"), "feature")


def high_rate_correlations(df: DataFrame, threshold: float = K.HIGH_RATE) -> DataFrame:
    high = C.without_nan(df, K.TARGET).where(F.col(K.TARGET) >= threshold).withColumn("rate_per_mile", C.rate_per_mile())
    return correlations(high, cols=K.HIGH_RATE_FEATURES)
