"""Table audit (A1-A17): every report is one aggregate over all columns, not one job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions import constants as K
from loadlens.functions.columns import is_infinite, null_if_nan, without_nan
from loadlens.operators.quantiles import exact_quantiles, group_stats
from loadlens.operators.rows import categorical_cols, leakage_columns, numeric_cols
from loadlens.sources.shared import written_once

_FLOATING = (T.DoubleType, T.FloatType)


def _missing(df: DataFrame, c: str) -> Column:
    test = F.col(c).isNull()
    return test | F.isnan(c) if isinstance(df.schema[c].dataType, _FLOATING) else test


def per_column(df: DataFrame, cols: Sequence[str], measures: dict[str, list[Column]]) -> DataFrame:
    """One aggregate over the table, laid out as one row per column.

    ``measures`` holds, per output name, one aggregate for each of ``cols``.
    """
    names = list(measures)
    wide = df.agg(*[measures[m][i].alias(f"{m}_{i}") for m in names for i in range(len(cols))])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column"),
            *[F.col(f"{m}_{i}").alias(m) for m in names],
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*rows)))


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def profile_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and number of values of every column."""
    kinds = dict(df.dtypes)
    present = per_column(df, df.columns, {"non_null": [F.count(F.when(~_missing(df, c), 1)) for c in df.columns]})
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return present.select("position", "column", kind[F.col("column")].alias("type"), "non_null").orderBy("position")


def missing_report(df: DataFrame, only_nonzero: bool = False) -> DataFrame:
    missing = [F.count(F.when(_missing(df, c), 1)) for c in df.columns]
    share = [F.avg(F.when(_missing(df, c), 100.0).otherwise(0.0)) for c in df.columns]
    out = per_column(df, df.columns, {"missing_count": missing, "missing_percentage": share})
    if only_nonzero:
        out = out.where(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"), "position").drop("position")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Extra copies of full rows; equal rows are counted down before they are shuffled."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def duplicate_keys(df: DataFrame, key: str = K.KEY) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(key).alias("unique_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def distinct_report(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct values per column, a missing value counting as one more."""
    cleaned = {c: null_if_nan(c) if isinstance(df.schema[c].dataType, _FLOATING) else F.col(c) for c in df.columns}
    if approx:
        distinct = [
            F.approx_count_distinct(v) + F.coalesce(F.max(_missing(df, c).cast("int")), F.lit(0)) for c, v in cleaned.items()
        ]
        return per_column(df, df.columns, {"unique_values": distinct}).orderBy("position").drop("position")
    # 128 bits of each value instead of the rows: equal ones are combined before the shuffle; a missing value has its own mark
    hashed = [
        F.struct(
            F.lit(i).alias("position"),
            v.isNull().alias("missing"),
            F.xxhash64(v).alias("h1"),
            F.xxhash64(F.lit(1), v).alias("h2"),
        )
        for i, v in enumerate(cleaned.values())
    ]
    if not hashed:
        return per_column(df, df.columns, {"unique_values": []}).drop("position")
    each = df.select(F.inline(F.array(*hashed))).distinct().groupBy("position").agg(F.count("*").alias("n"))
    names = [F.struct(F.lit(i).alias("p"), F.lit(c).alias("column")) for i, c in enumerate(df.columns)]
    listed = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    found = listed.join(F.broadcast(each), F.col("p") == F.col("position"), "left")  # a row per column
    return found.orderBy("p").select("column", F.coalesce("n", F.lit(0)).alias("unique_values"))


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns as (column, value) rows, missing values included."""
    wide = df.select(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "value")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum per numeric column."""
    v = F.col("value")
    return group_stats(
        long_values(df, cols or numeric_cols(df)),
        ["column"],
        [
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        ],
        of=v,
        quantiles={"p25": 0.25, "p50": 0.5, "p75": 0.75},
    ).select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, column: str, k: int | None = 20, dropna: bool = False) -> DataFrame:
    if dropna:
        df = df.where(F.col(column).isNotNull())
    out = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return out if k is None else out.limit(k)


def value_counts_all(df: DataFrame, k: int = 20, cols: Sequence[str] | None = None) -> dict[str, DataFrame]:
    return {c: value_counts(df, c, k) for c in cols or categorical_cols(df)}


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(
        F.min(column).alias("first_date"),
        F.max(column).alias("last_date"),
        F.count(F.when(F.col(column).isNull(), 1)).alias("invalid_dates"),
    )


def target_summary(df: DataFrame, column: str = K.TARGET) -> DataFrame:
    c = null_if_nan(column)
    return group_stats(
        df,
        [],
        [
            F.count(F.when(c.isNull(), 1)).alias("missing"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
        ],
        of=column,
        quantiles={"median": 0.5},
    ).select("missing", "min", "max", "mean", "median", "std")


def percentiles(df: DataFrame, column: str = K.TARGET, ps: Sequence[float] = K.AUDIT_PERCENTILES) -> DataFrame:
    names = {f"p{i}": p for i, p in enumerate(ps)}
    wide = group_stats(df, [], [], of=column, quantiles=names)
    rows = [F.struct(F.lit(p).alias("p"), F.col(n).alias("value")) for n, p in names.items()]
    return wide.select(F.inline(F.array(*rows)))


def iqr_outliers(df: DataFrame, column: str = K.TARGET, k: float = 1.5) -> DataFrame:
    """Quartile fences and how many rows lie outside them, as a share of all rows."""
    q1, q3 = exact_quantiles(df, column, [0.25, 0.75])
    iqr = None if q1 is None or q3 is None else q3 - q1
    lower = None if iqr is None else q1 - k * iqr
    upper = None if iqr is None else q3 + k * iqr
    values = {"q1": q1, "q3": q3, "iqr": iqr, "lower_bound": lower, "upper_bound": upper}
    fences = {n: F.lit(v).cast("double") for n, v in values.items()}
    df = without_nan(df, column)
    c = F.col(column)
    outside = (c < fences["lower_bound"]) | (c > fences["upper_bound"])
    counted = df.agg(F.count(F.when(outside, 1)).alias("outlier_count"), F.count(F.lit(1)).alias("_rows"))
    return counted.select(
        *[v.alias(n) for n, v in fences.items()],
        "outlier_count",
        F.try_divide(F.col("outlier_count") * 100.0, F.col("_rows")).alias("outlier_percentage"),
    )


def infinite_report(df: DataFrame, only_nonzero: bool = False) -> DataFrame:
    cols = numeric_cols(df)
    counts = [F.count(F.when(is_infinite(F.col(c).cast("double")), 1)) for c in cols]
    out = per_column(df, cols, {"infinite_count": counts})
    if only_nonzero:
        out = out.where(F.col("infinite_count") > 0)
    return out.orderBy("position").drop("position")


def sign_report(df: DataFrame, only_negative: bool = False) -> DataFrame:
    cols = numeric_cols(df)
    out = per_column(
        df,
        cols,
        {
            "negative_count": [F.count(F.when(F.col(c).cast("double") < 0, 1)) for c in cols],
            "zero_count": [F.count(F.when(F.col(c).cast("double") == 0, 1)) for c in cols],
        },
    )
    if only_negative:
        out = out.where(F.col("negative_count") > 0)
    return out.orderBy("position").drop("position")


def one_scan(df: DataFrame, date: str = "date") -> dict[str, DataFrame]:
    """Shape, columns, missing, infinite, signs and dates of a table from a single pass over it.

    The pass is one aggregate; its result, a row per column, is stored in the shared folder and read by each report.
    """
    numbers = set(numeric_cols(df))
    number = lambda c: F.col(c).cast("double")
    counted = lambda test: [F.count(F.when(test(c), 1)) if c in numbers else F.max(F.lit(None).cast("long")) for c in df.columns]
    day = lambda best: [best(c) if c == date else F.max(F.lit(None).cast("date")) for c in df.columns]
    facts = per_column(
        df,
        df.columns,
        {
            "rows": [F.count(F.lit(1))] * len(df.columns),
            "missing_count": [F.count(F.when(_missing(df, c), 1)) for c in df.columns],
            "missing_percentage": [F.avg(F.when(_missing(df, c), 100.0).otherwise(0.0)) for c in df.columns],
            "infinite_count": counted(lambda c: is_infinite(number(c))),
            "negative_count": counted(lambda c: number(c) < 0),
            "zero_count": counted(lambda c: number(c) == 0),
            "first_date": day(F.min),
            "last_date": day(F.max),
        },
    )
    facts = written_once(facts, "profile")
    kind = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    numeric = facts.where(F.col("column").isin(sorted(numbers)))
    out = {
        "shape": facts.agg(F.max("rows").alias("rows"), F.count(F.lit(1)).cast("int").alias("columns")),
        "columns": facts.select(
            "position", "column", kind[F.col("column")].alias("type"), (F.col("rows") - F.col("missing_count")).alias("non_null")
        ).orderBy("position"),
        "missing": facts.orderBy(F.desc("missing_count"), "position").select("column", "missing_count", "missing_percentage"),
        "infinite": numeric.orderBy("position").select("column", "infinite_count"),
        "signs": numeric.orderBy("position").select("column", "negative_count", "zero_count"),
    }
    if date in df.columns:
        out["dates"] = facts.where(F.col("column") == date).select(
            "first_date", "last_date", F.col("missing_count").alias("invalid_dates")
        )
    return out


def feature_quality(df: DataFrame) -> DataFrame:
    """Missing and infinite values per column after feature engineering (X4), in one scan."""
    numbers = set(numeric_cols(df))
    out = per_column(
        df,
        df.columns,
        {
            "missing_count": [F.count(F.when(_missing(df, c), 1)) for c in df.columns],
            "infinite_count": [
                F.count(F.when(is_infinite(F.col(c).cast("double")), 1) if c in numbers else F.lit(None))
                for c in df.columns
            ],
        },
    )
    return out.orderBy("position").drop("position")


def leakage_report(df: DataFrame, patterns: Sequence[str] = K.LEAKAGE_PATTERNS) -> DataFrame:
    """Columns whose names give the target away, and how many rows carry a value there."""
    cols = leakage_columns(df, patterns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, pattern string, non_null long")
    found = per_column(df, cols, {"non_null": [F.count(F.when(~_missing(df, c), 1)) for c in cols]})
    pattern = F.create_map(*[F.lit(x) for c in cols for x in (c, next(p for p in patterns if p in c.lower()))])
    return found.select("column", pattern[F.col("column")].alias("pattern"), "non_null")
