"""Several Spark jobs of one driver at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
POOL = "spark.scheduler.pool"


def in_parallel(spark: SparkSession, tasks: Sequence[Callable[[], T]], width: int = 4, pool: str = "fit") -> list[T]:
    """Results of all tasks, in their order; ``width`` of them run at a time.

    Each task's jobs go to a scheduler pool of its own, so with ``spark.scheduler.mode=FAIR`` they share the cores evenly.
    Small jobs, as those of a tree's levels, leave most cores idle when they run one after another. The first error is
    raised when the tasks already begun have ended; those not begun are dropped.
    """
    sc = spark.sparkContext

    def own(number: int, task: Callable[[], T]) -> T:
        before = sc.getLocalProperty(POOL)
        sc.setLocalProperty(POOL, f"{pool}-{number}")
        try:
            return task()
        finally:
            sc.setLocalProperty(POOL, before)

    with ThreadPoolExecutor(max(1, width)) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(own), i, task) for i, task in enumerate(tasks)]
        try:
            return [f.result() for f in started]
        except BaseException:
            for f in started:
                f.cancel()
            raise


#: What a tree learner keeps of a row besides a number for each feature: label, weight, margins; 304 bytes in all
#: at 36 features, where about 300 were measured.
ROW_BYTES, FEATURE_BYTES = 160, 4


def storage_bytes(spark: SparkSession) -> int:
    """Memory that all executors have for cached rows."""
    found, total = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), 0
    while found.hasNext():
        total += found.next()._1()
    return total


def fits_at_once(spark: SparkSession, rows: int, features: int, asked: int) -> int:
    """How many of the fits that are ``asked`` for at a time keep their rows in the storage memory; at least one.

    Spark's tree learners cache the binned rows of each fit, and what does not fit in memory goes to disk, to be read again for
    every level of every tree. Fits give the same models whether they run at a time or one after another.
    """
    each = max(1, rows) * (ROW_BYTES + FEATURE_BYTES * features)
    return max(1, min(asked, storage_bytes(spark) // each))
