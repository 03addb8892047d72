"""The history of model metrics as a table, and the final comparison that reads it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.operators import rows
from loadlens.sources.tables import METRICS

SETTING_NAMES = ("n_estimators", "learning_rate", "max_depth", "min_child_weight", "subsample", "colsample_bytree")


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add rows (model, MAE, RMSE, R2) to the metric history."""
    metrics.select(*[F.col(f.name).cast(f.dataType) for f in METRICS.fields]).write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)


def final_comparison(history: DataFrame) -> DataFrame:
    """One row per model, its best run by MAE, the best model first."""
    best = history.groupBy("model").agg(F.min(F.struct("MAE", "RMSE", "R2")).alias("m"))
    return best.select("model", "m.*").orderBy("MAE", "model")


def final_config(spark: SparkSession, comparison: DataFrame, config: Sequence[float] = K.CHAMPION) -> DataFrame:
    """The settings of the final model and the metrics of the best one, as (parameter, value) rows."""
    settings = [F.struct(F.lit(n).alias("parameter"), F.lit(f"{v:g}").alias("value")) for n, v in zip(SETTING_NAMES, config, strict=True)]
    best = rows.best_by(comparison, "MAE", ties=["model"]).select(
        F.inline(F.array(*settings, *[F.struct(F.lit(c).alias("parameter"), F.col(c).cast("string").alias("value")) for c in ("model", "MAE", "RMSE", "R2")]))
    )
    return best


def top_by_each(results: DataFrame, metrics: Sequence[str], k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows of smallest value by each metric, tagged with the metric."""
    return rows.union_tagged({m: rows.top_k(results, m, k, ascending=True, ties=ties) for m in metrics}, "metric")


def top_configs(results: DataFrame, k: int = 10) -> DataFrame:
    """The tuning configurations with the smallest MAE and RMSE and the largest R²."""
    found = results.withColumn("unexplained", 1 - F.col("R2"))
    top = top_by_each(found, ("MAE", "RMSE", "unexplained"), k, ["config"]).drop("unexplained")
    return top.withColumn("metric", F.when(F.col("metric") == "unexplained", "R2").otherwise(F.col("metric")))
