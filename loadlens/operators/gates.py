"""Quality gates for prediction files and scenario frames (V1-V9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators.quantiles import group_stats
from loadlens.operators.rows import key_diff_counts
from loadlens.sources.domains import date_spine
from loadlens.sources.tables import InputError

PREDICTION_COLUMNS = [K.KEY, K.PREDICTION]


def check_columns(df: DataFrame, cols: Sequence[str], label: str = "table") -> None:
    """Exact column list in order (V1)."""
    if df.columns != list(cols):
        raise InputError(f"{label} must have the columns {', '.join(cols)} in this order, found {', '.join(df.columns)}")


def check_contract(train: DataFrame, to_score: DataFrame, target: str = K.TARGET) -> None:
    """The target exists for training and is absent from the table to score (V9)."""
    if target not in train.columns:
        raise InputError(f"training table has no {target}")
    if target in to_score.columns:
        raise InputError(f"table to score must not contain {target}")


def _tall(wide: DataFrame, cast: str, name: str, value: str) -> DataFrame:
    rows = [F.struct(F.lit(c).alias(name), F.col(c).cast(cast).alias(value)) for c in wide.columns]
    return wide.select(F.inline(F.array(*rows)))


def check_predictions(
    df: DataFrame, expected_rows: int | None = None, strict: bool = True, key: str = K.KEY, p: str = K.PREDICTION
) -> DataFrame:
    """Violations per rule: row count, missing and repeated keys, missing, infinite, negative predictions (V2, V5).

    ``strict`` also rejects zero predictions. Rows are first reduced to one row per key, which also
    serves the duplicate check, so a key with very many copies is combined before the shuffle.
    """
    v = C.null_if_nan(F.col(p).cast("double"))
    bad_sign = v <= 0 if strict else v < 0
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(v.isNull(), 1)).alias("no_value"),
        F.count(F.when(C.is_infinite(v), 1)).alias("infinite"),
        F.count(F.when(bad_sign, 1)).alias("sign"),
    )
    zero = F.lit(0)
    rows = F.coalesce(F.sum("n"), zero)
    wide = per_key.agg(
        (F.abs(rows - F.lit(expected_rows)) if expected_rows is not None else F.lit(0)).alias("row_count_difference"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), zero).alias("missing_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)), zero).alias("duplicate_keys"),
        F.coalesce(F.sum("no_value"), zero).alias("missing_predictions"),
        F.coalesce(F.sum("infinite"), zero).alias("infinite_predictions"),
        F.coalesce(F.sum("sign"), zero).alias("non_positive_predictions" if strict else "negative_predictions"),
    )
    return _with_verdict(_tall(wide, "long", "check", "violations"))


def _with_verdict(checks: DataFrame) -> DataFrame:
    return checks.withColumn("passed", F.col("violations") == 0)


def check_key_set(df: DataFrame, expected: DataFrame, key: str = K.KEY) -> DataFrame:
    """Missing and extra keys against the expected domain (V4)."""
    wide = key_diff_counts(df, expected, key).withColumnsRenamed({"missing": "missing_ids", "extra": "extra_ids"})
    return _with_verdict(_tall(wide, "long", "check", "violations"))


def check_key_order(df: DataFrame, template: DataFrame, pos: str = "row_pos", key: str = K.KEY) -> DataFrame:
    """Same key at every position of an explicit position column (V3)."""
    a = df.select(pos, F.col(key).alias("_a"))
    b = template.select(pos, F.col(key).alias("_b"))
    return a.join(b, pos, "full_outer").agg(
        F.count(F.lit(1)).alias("positions"),
        F.count(F.when(~F.col("_a").eqNullSafe(F.col("_b")), 1)).alias("mismatches"),
    )


def require(checks: DataFrame, label: str) -> None:
    """Raise with the failed rules; the frame has one row per rule."""
    failed = [f"{r['check']}={r['violations']}" for r in checks.where(~F.col("passed")).toLocalIterator()]
    if failed:
        raise InputError(f"{label}: {', '.join(sorted(failed))}")


def validate_predictions(df: DataFrame, expected: DataFrame, expected_rows: int, strict: bool = True) -> None:
    """All gates of a prediction file; raises on the first kind of failure."""
    check_columns(df, PREDICTION_COLUMNS, "predictions")
    require(check_predictions(df, expected_rows, strict), "predictions")
    require(check_key_set(df, expected), "predictions")


# ---------------------------------------------------------------- scenario frames (V6)


def scenario_checks(
    df: DataFrame,
    start: str = K.LANE_START,
    end: str = K.LANE_END,
    lane: Mapping[str, Any] = K.LANE,
) -> DataFrame:
    """Violations per rule of a fixed-lane frame: one row a day, constant lane, positive finite rates."""
    num = {c: F.col(c).try_cast("double") for c in ("distance", "weight", K.PREDICTION)}

    def bad(ok: Column) -> Column:
        return F.count(F.when(~F.coalesce(ok, F.lit(False)), 1))

    day = F.to_date(F.col("date").try_cast("timestamp"))
    wide = df.agg(
        F.count(F.when(day.isNull(), 1)).alias("invalid_dates"),
        (F.count(day) - F.count_distinct(day)).alias("duplicate_dates"),
        *[bad(F.col(c) == F.lit(lane[c])).alias(f"wrong_{c}") for c in ("pickup", "delivery", "equipment")],
        *[bad(C.is_finite(num[c]) & C.is_close(num[c], lane[c])).alias(f"wrong_{c}") for c in ("distance", "weight")],
        bad(C.is_finite(num[K.PREDICTION]) & (num[K.PREDICTION] > 0)).alias("bad_predictions"),
    )
    checks = _tall(wide, "long", "check", "violations")
    days = key_diff_counts(df.select(day.alias("date")), date_spine(df.sparkSession, start, end), "date")
    days = days.withColumnsRenamed({"missing": "missing_dates", "extra": "extra_dates"})
    return _with_verdict(checks.unionByName(_tall(days, "long", "check", "violations")))


def validate_scenario(df: DataFrame, start: str = K.LANE_START, end: str = K.LANE_END) -> DataFrame:
    """The frame in date order when it passes all rules, else an error."""
    check_columns(df, K.SCENARIO_COLUMNS, "scenario")
    require(scenario_checks(df, start, end), "scenario")
    return df.orderBy("date")


# ---------------------------------------------------------------- summaries of predictions (V7, V8)


def submission_audit(df: DataFrame, key: str = K.KEY, p: str = K.PREDICTION) -> DataFrame:
    """The audit table of a prediction file: 12 metrics with their values."""
    v = F.col(p)
    counts = check_predictions(df, strict=False, key=key, p=p)
    n = lambda check: F.max(F.when(F.col("check") == check, F.col("violations"))).cast("double")
    faults = counts.agg(
        n("missing_predictions").alias("missing_predictions"),
        n("infinite_predictions").alias("infinite_predictions"),
        n("negative_predictions").alias("negative_predictions"),
        (n("duplicate_keys") + F.greatest(n("missing_keys") - 1, F.lit(0.0))).alias("duplicate_load_ids"),
    )
    values = group_stats(
        df,
        [],
        [
            F.count(F.lit(1)).cast("double").alias("rows"),
            F.lit(float(len(df.columns))).alias("columns"),
            F.min(v).alias("minimum_prediction"),
            F.max(v).alias("maximum_prediction"),
            F.avg(v).alias("mean_prediction"),
        ],
        of=v,
        quantiles={"median_prediction": 0.5, "p95_prediction": 0.95, "p99_prediction": 0.99},
    )
    order = [
        "rows", "columns",
        "missing_predictions", "infinite_predictions", "negative_predictions", "duplicate_load_ids",
        "minimum_prediction", "maximum_prediction", "mean_prediction",
        "median_prediction", "p95_prediction", "p99_prediction",
    ]
    tall = _tall(values, "double", "metric", "value").unionByName(_tall(faults, "double", "metric", "value"))
    return tall.orderBy(F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric")))


def prediction_summary(df: DataFrame, p: str = K.PREDICTION) -> DataFrame:
    """Count, range, centre, population spread and quantiles of the predictions, one row each."""
    v = F.col(p)
    wide = group_stats(
        df,
        [],
        [
            F.count(v).cast("double").alias("prediction_count"),
            F.min(v).alias("minimum"),
            F.max(v).alias("maximum"),
            F.avg(v).alias("mean"),
            F.stddev_pop(v).alias("std"),
        ],
        of=v,
        quantiles={"median": 0.5, "p25": 0.25, "p75": 0.75, "p95": 0.95, "p99": 0.99},
    )
    order = ["prediction_count", "minimum", "maximum", "mean", "median", "std", "p25", "p75", "p95", "p99"]
    return _tall(wide.select(*order), "double", "metric", "value")
