"""Report sets: the tables an analysis writes, by name, and their sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators import audit, buckets, evaluate, gates, rows, strategy, summary
from loadlens.sources.tables import write_table


def write_reports(reports: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    for name, df in reports.items():
        write_table(df, f"{folder}/{name}", fmt)


def audit_reports(df: DataFrame, key: str = K.KEY, target: str = K.TARGET) -> dict[str, DataFrame]:
    out = audit.one_scan(df) | {
        "duplicate_rows": audit.duplicate_rows(df),
        "duplicate_keys": audit.duplicate_keys(df, key),
        "distinct": audit.distinct_report(df),
        "describe": audit.describe_numeric(df),
    }
    out |= {f"values_{c}": v for c, v in audit.value_counts_all(df).items() if c != key}
    if target in df.columns:
        out |= {
            "target": audit.target_summary(df, target),
            "target_percentiles": audit.percentiles(df, target),
            "target_outliers": audit.iqr_outliers(df, target),
        }
    return out


def exploration_reports(df: DataFrame) -> dict[str, DataFrame]:
    with_route = df.withColumn("route", C.route())
    return {
        "equipment_summary": summary.group_summary(
            df, ["equipment"], stats=("count", "mean", "median", "min", "max"), order_by="mean"
        ),
        "pickup_summary": summary.group_summary(df, ["pickup"]),
        "delivery_summary": summary.group_summary(df, ["delivery"]),
        "route_summary": summary.group_summary(with_route, ["route"]),
        "daily_rate_summary": summary.trend(df),
        "monthly_rate_summary": summary.trend(df, grain="month"),
        "weekday_summary": summary.weekday_summary(df),
        "rate_per_mile": summary.rate_per_mile_summary(df),
        "correlations": summary.correlations(df),
        "rate_histogram": buckets.histogram(df, K.TARGET, 50),
        "rate_boxplot": buckets.boxplot_stats(df, K.TARGET),
    }


def high_rate_reports(df: DataFrame, threshold: float = K.HIGH_RATE) -> dict[str, DataFrame]:
    d = df.withColumns({"route": C.route(), "rate_per_mile": C.rate_per_mile(), "month": F.month("date")})
    return {
        "rate_segments": summary.segment_summary(d),
        "high_vs_normal": summary.compare_segments(d, F.col(K.TARGET) >= threshold),
        "high_rate_equipment": summary.high_rate_by(d, ["equipment"], threshold),
        "high_rate_monthly": summary.high_rate_by(d, ["month"], threshold, stats=("mean",)),
        "high_rate_distance": summary.high_rate_by_distance(d, threshold),
        "high_rate_routes": summary.high_rate_by(d, ["route"], threshold, having=1),
        "high_rate_pickups": summary.high_rate_only_by(d, "pickup", threshold),
        "high_rate_deliveries": summary.high_rate_only_by(d, "delivery", threshold),
        "high_rate_correlations": summary.high_rate_correlations(d, threshold),
        "quote_signal_analysis": summary.quantile_summary(d, "quote_signal"),
        "market_index_analysis": summary.quantile_summary(d, "market_index"),
    }


def error_reports(scored: DataFrame) -> dict[str, DataFrame]:
    """Reports on rows that carry a target and a prediction."""
    cols = [c for c in (K.KEY, "date", "pickup", "delivery", "equipment", "distance", K.TARGET, K.PREDICTION)]
    errors = evaluate.add_errors(scored.select(*cols))
    return {
        "row_errors": errors,
        "top_errors": rows.top_k(errors, "absolute_error", 20, ties=[K.KEY]),
        "overall": evaluate.regression_metrics(scored),
        "bias": evaluate.bias(scored),
        "equipment_error": evaluate.error_by(
            scored, ["equipment"], ("MAE", "median_error", "mean_actual", "mean_predicted")
        ),
        "distance_error": evaluate.error_by_distance(scored),
        "monthly_error": evaluate.error_by_month(scored, ("MAE", "RMSE", "mean_actual", "mean_predicted")),
        "route_error": evaluate.error_by_route(scored),
        "extreme_rates": strategy.extreme_metrics(scored),
    }


def submission_reports(predictions: DataFrame) -> dict[str, DataFrame]:
    return {
        "submission_audit": gates.submission_audit(predictions),
        "prediction_summary": gates.prediction_summary(predictions),
        "prediction_buckets": buckets.bucket_counts(predictions),
        "highest_predictions": rows.top_k(predictions, K.PREDICTION, 30, ties=[K.KEY]),
        "lowest_predictions": rows.top_k(predictions, K.PREDICTION, 20, ascending=True, ties=[K.KEY]),
    }
