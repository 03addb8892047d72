"""The shared folder for checkpoints and tables that outlive a task."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=1)
def _own_folder() -> str:
    """A temporary folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="loadlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _own_folder()


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back; the files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    removed_at_end(spark, path)
    return spark.read.parquet(path)


def bucketed_once(df: DataFrame, name: str, buckets: int, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` written once as a table in buckets of ``key``, sorted by ``order``; the files go when the application ends.

    Read back, a partition is a bucket whatever the number of cores, without a shuffle. Spark would read the files of several
    buckets together where no join or grouping asks for buckets; the session is told not to. ``df`` is best dealt out by
    ``repartition(buckets, key)``, so that each bucket is one file; its ``key`` is never missing. The catalog forgets the table at once, the frame keeps it.
    """
    spark = df.sparkSession
    ensure_settings(spark)
    table, path = f"lens_{name}_{uuid.uuid4().hex}", f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("path", path).bucketBy(buckets, key).sortBy(*order).saveAsTable(table)
    removed_at_end(spark, path)
    # a scan goes by buckets only where it reads their key; no key is missing
    stored = spark.table(table).where(F.col(key).isNotNull())
    spark.sql(f"DROP TABLE {table}")
    return stored


def removed_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def ensure_settings(spark: SparkSession) -> None:
    """Have a partition of a bucketed table be a bucket, and the long methods of feature projections split, as the JVM
    interprets methods over 8,000 bytes."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import it. Elsewhere the package is installed or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give the session a checkpoint folder, so that boosting can cut its lineage."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
