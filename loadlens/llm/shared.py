"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from loadlens.sources.shared import written_once


#: Rows of an Arrow batch at most: texts can be long, and a task holds a batch of them at a time.
ARROW_ROWS = 1_000


def ready(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import it, and keep their batches small.

    Elsewhere the package is installed or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, ARROW_ROWS)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: what follows neither repeats its work nor loses it with an executor."""
    table = written_once(df, f"lens-{name}")
    # Spark frees the shuffle files of a finished job when the driver collects garbage, which may be much later
    df.sparkSession._jvm.System.gc()
    return table
