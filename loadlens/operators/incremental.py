"""An audit that reads new months only (A1, A4-A5, A8-A11, A15-A16 over a growing table).

For each partition of a stored table a small mergeable state is kept: per column the rows, missing, infinite, negative and
zero values, mean and sum of squares about it, least and greatest value, a distinct sketch, and the counts of the values of
text columns. An update compares the files of each partition with those its state was made from and reads only partitions
that are new or changed. Reports merge the states and never read the table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.columns import is_infinite, null_if_nan
from loadlens.operators.rows import categorical_cols, numeric_cols

PARTS = ("load_year", "load_month")
PART, FILES = "_part", "_files"


def _fingerprints(table: DataFrame, parts: Sequence[str]) -> dict[str, str]:
    """A digest of the file names of each partition, by the partition's text ``a=1/b=2``."""
    names: dict[str, list[str]] = {}
    pattern = re.compile("/" + "/".join(f"{p}=[^/]*" for p in parts) + "/")
    for file in table.inputFiles():
        found = pattern.search(file)
        if found:
            names.setdefault(found.group().strip("/"), []).append(file)
    return {part: hashlib.md5("\n".join(sorted(files)).encode()).hexdigest() for part, files in names.items()}


def _part_text(parts: Sequence[str]):
    return F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for p in parts])


def column_state(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and value of ``by``) with what reports need; one aggregate over the rows."""
    cols = [c for c in df.columns if c not in by]
    numbers = set(numeric_cols(df))
    structs = []
    for i, c in enumerate(cols):
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        value = null_if_nan(c) if floating else F.col(c)
        number = value.cast("double") if c in numbers else F.lit(None).cast("double")
        finite = F.when(~is_infinite(number), number) if c in numbers else number
        structs.append(
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("rows"), F.count(value).alias("present"),
                F.count(F.when(is_infinite(number), 1)).alias("infinite") if c in numbers else F.lit(0).cast("long").alias("infinite"),
                F.count(F.when(number < 0, 1)).alias("negative"), F.count(F.when(number == 0, 1)).alias("zero"),
                F.count(finite).alias("n"), F.avg(finite).alias("mean"), (F.var_pop(finite) * F.count(finite)).alias("m2"),
                F.min(finite).alias("least"), F.max(finite).alias("greatest"),
                # ends of dates and texts, whose order is that of their text
                *[(F.lit(None) if c in numbers else end(value)).cast("string").alias(n) for n, end in (("first", F.min), ("last", F.max))],
                F.hll_sketch_agg(F.coalesce(value.cast("string"), F.lit("\0")), 12).alias("sketch"),
            )
        )
    wide = df.groupBy(*by).agg(F.array(*structs).alias("_s"))
    return wide.select(*by, F.inline("_s"))


def value_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per text column and value (and value of ``by``); missing values count as one."""
    tall = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])))
    return tall.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def update(spark: SparkSession, path: str, state: str, parts: Sequence[str] = PARTS) -> list[str]:
    """Bring the states of the table at ``path`` up to date; returns the partitions that were read.

    The states of the partitions read are replaced, and those of partitions that are gone are left out of reports. Partitions,
    one a month, and their digests are listed on the driver, as Spark does for the table itself.
    """
    table = spark.read.parquet(path)
    now = _fingerprints(table, parts)
    done = _read(spark, f"{state}/columns")
    before = {r[PART]: r[FILES] for r in done.groupBy(PART).agg(F.first(FILES).alias(FILES)).collect()} if done is not None else {}
    new = sorted(p for p, files in now.items() if before.get(p) != files)
    if new:
        filters = None
        for part in new:
            own = F.lit(True)
            for item in part.split("/"):
                name, _, value = item.partition("=")
                own = own & (F.col(name).isNull() if value == "__HIVE_DEFAULT_PARTITION__" else F.col(name) == F.lit(value).cast(table.schema[name].dataType))
            filters = own if filters is None else filters | own
        rows = table.where(filters).withColumn(PART, _part_text(parts)).drop(*parts)
        files = spark.createDataFrame([(p, now[p]) for p in new], f"{PART} string, {FILES} string")
        texts = [c for c in categorical_cols(rows) if c != PART]
        for name, found in (("values", value_state(rows, texts, [PART])), ("columns", column_state(rows, [PART]))):
            # a row for each new partition; the columns, which hold the digests, are written last
            out = found.join(F.broadcast(files), PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            out.partitionBy(PART).parquet(f"{state}/{name}")
    spark.createDataFrame([(p,) for p in sorted(now)], f"{PART} string").coalesce(1).write.mode("overwrite").parquet(f"{state}/live")
    return new


def _live(spark: SparkSession, state: str, name: str) -> DataFrame:
    kept = spark.read.parquet(f"{state}/{name}").withColumn(PART, F.col(PART).cast("string"))
    return kept.join(spark.read.parquet(f"{state}/live"), PART, "left_semi")


def merged_columns(states: DataFrame) -> DataFrame:
    """States of any number of partitions as one report per column.

    Spread: the sums of squares about each mean, and those of the means about the mean of all.
    """
    means = states.groupBy("column").agg((F.sum(F.col("mean") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0))).alias("overall"))
    apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col("overall")) ** 2
    merged = states.join(means, "column").groupBy("column").agg(
        F.min("position").alias("position"),
        *[F.sum(c).alias(c) for c in ("rows", "present", "infinite", "negative", "zero", "n")],
        F.first("overall").alias("mean"),
        F.sum(apart).alias("m2"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
    return merged.select(
        "position", "column", "rows", (F.col("rows") - F.col("present")).alias("missing"), "infinite", "negative", "zero", "mean",
        F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))).alias("std"), "least", "greatest", "first", "last", "distinct_estimate",
    )


def audit(spark: SparkSession, state: str) -> DataFrame:
    """The report of all columns, from the states alone. ``first`` and ``last`` are the ends of dates and texts."""
    return merged_columns(_live(spark, state, "columns")).orderBy("position")


def value_counts(spark: SparkSession, state: str) -> DataFrame:
    """Column, value, n of the text columns, from the states alone."""
    return _live(spark, state, "values").groupBy("column", "value").agg(F.sum("n").alias("n"))
