"""Generated domains: expected keys, date spines, the fixed-lane scenario."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import constants as K


def expected_ids(spark: SparkSession, n: int, prefix: str = "TE-", start: int = 1) -> DataFrame:
    """Keys ``TE-000001 ...``, generated in parallel."""
    return spark.range(start, start + n).select(
        F.format_string(prefix + "%06d", F.col("id")).alias("load_id")
    )


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from ``start`` to ``end``."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def scenario_frame(
    spark: SparkSession,
    start: str = K.LANE_START,
    end: str = K.LANE_END,
    lane: Mapping[str, Any] = K.LANE,
) -> DataFrame:
    """One lane on every day of a period, rate still empty."""
    return date_spine(spark, start, end).select(
        *[F.lit(lane[c]).alias(c) for c in ("pickup", "delivery", "distance", "equipment", "weight")],
        "date",
        F.lit(None).cast("double").alias("predicted_rate"),
    )
