"""A local session for the tests, the benchmark and trials on one machine."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from loadlens.sources.shared import ensure_checkpoints


def local_session(cpus: str = "8", app: str = "loadlens") -> SparkSession:
    """``hugeMethodLimit`` makes Spark split the long methods that the feature projections generate; fits that run at a time
    share the cores by the FAIR scheduler."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOADLENS_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoints(spark)
    return spark
