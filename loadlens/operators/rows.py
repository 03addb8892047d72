"""Row and column level operators: projections, filters, splits, samples, top-k, key joins, unions."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions import constants as K
from loadlens.functions.columns import col
from loadlens.sources.shared import written_once

# ---------------------------------------------------------------- columns


def leakage_columns(df: DataFrame, patterns: Sequence[str] = K.LEAKAGE_PATTERNS) -> list[str]:
    return [c for c in df.columns if any(p in c.lower() for p in patterns)]


def drop_leakage(df: DataFrame, patterns: Sequence[str] = K.LEAKAGE_PATTERNS, keep: Sequence[str] = ()) -> DataFrame:
    """Drop every column whose name gives the target away, except those in ``keep``."""
    return df.drop(*[c for c in leakage_columns(df, patterns) if c not in keep])


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def categorical_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# ---------------------------------------------------------------- filters


def time_split(df: DataFrame, split_date: str = K.SPLIT_DATE, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows before the date, and rows from the date on. Rows without a date are in neither."""
    at = F.lit(split_date).cast("date")
    return df.where(F.col(date) < at), df.where(F.col(date) >= at)


def between_dates(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def split_by_threshold(df: DataFrame, column: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Rows at or above the threshold, and rows below it."""
    known = ~F.isnan(F.col(column).cast("double"))  # Spark orders NaN above every number
    return df.where(known & (F.col(column) >= threshold)), df.where(F.col(column) < threshold)


def drop_missing(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def adjust_where(condition: Column, value: Column | str, adjusted: Column) -> Column:
    """The adjusted value where the condition holds, else the value itself."""
    return F.when(condition, adjusted).otherwise(col(value))


# ---------------------------------------------------------------- order and top-k


def _order(cols: Sequence[str], ascending: bool) -> list[Column]:
    return [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in cols]


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First rows in an explicit order; a table on many machines has no order of its own."""
    return df.orderBy(*_order(order, True)).limit(n)


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*_order(order, False)).limit(n)


def sort_by_date(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy("date", *ties)


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """The k largest (or smallest) rows; every task keeps k rows at most."""
    return df.orderBy(*_order([by], ascending), *_order(ties, True)).limit(k)


def best_by(df: DataFrame, metric: str, ascending: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    return top_k(df.where(F.col(metric).isNotNull()), metric, 1, ascending, ties)


# ---------------------------------------------------------------- keys and unions


def attach_predictions(df: DataFrame, predictions: DataFrame, key: str = K.KEY, how: str = "inner") -> DataFrame:
    """Rows with their predictions from another table, matched by key; ``how="left"`` keeps rows without one.

    ``key_diff_counts(df, predictions)`` tells how many keys have no partner on either side.
    """
    return df.join(predictions, key, how)


def key_diff(df: DataFrame, expected: DataFrame, key: str = K.KEY) -> DataFrame:
    """Keys that are expected but absent (``missing``) and present but not expected (``extra``).

    Each side is reduced to one row per key before the single join.
    """
    have = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("_have"))
    want = expected.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(True).alias("_want"))
    side = F.when(F.col("_have").isNull(), "missing").when(F.col("_want").isNull(), "extra")
    return have.join(want, key, "full_outer").select(key, side.alias("side")).where(F.col("side").isNotNull())


def key_diff_counts(df: DataFrame, expected: DataFrame, key: str = K.KEY) -> DataFrame:
    side = F.col("side")
    return key_diff(df, expected, key).agg(
        F.count(F.when(side == "missing", 1)).alias("missing"),
        F.count(F.when(side == "extra", 1)).alias("extra"),
    )


def union_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames of equal columns with a column that names their origin."""
    out: DataFrame | None = None
    for name, df in frames.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("nothing to union")
    return out


# ---------------------------------------------------------------- splits and samples (M1, M2)


def hash_bucket(seed: int, *key: Column | str) -> Column:
    """0-99, a function of the seed and the key alone: replays whatever the partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100


def random_split(
    df: DataFrame, key: Sequence[str] = (K.KEY,), test_percent: int = 20, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash."""
    bucket = hash_bucket(seed, *key)
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


#: Digits of a draw that one step of the search for a cut looks at: at most 16 ** 3 counts.
CUT_DIGITS = 3


def _cut(draws: DataFrame, n: int) -> tuple[str, int | None]:
    """Where the ``n`` smallest of the texts in column ``d`` end: a prefix, and how many of the texts with it belong to them.

    All texts of a smaller prefix belong to them; None: all texts with the prefix do too. Texts are hexadecimal digits of one
    length and more than ``n``. Each step counts the next digits of the texts with the prefix so far.
    """
    prefix, left = "", n
    while True:
        part = draws.where(F.col("d").startswith(prefix)).groupBy(F.substring("d", len(prefix) + 1, CUT_DIGITS).alias("next"))
        # at most 16 ** CUT_DIGITS rows
        for r in sorted(part.count().collect(), key=lambda r: r["next"]):
            if r["count"] >= left:
                break
            left -= r["count"]
        if not r["next"]:  # the whole text is in the prefix
            return prefix, left
        prefix += r["next"]
        if r["count"] == left:
            return prefix, None


def sample_n(df: DataFrame, n: int, key: Sequence[str] = (K.KEY,), seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer) without replacement: those of smallest hash of seed and key.

    A histogram of the hashes' first digits, then of the next ones where the n-th falls, gives the cut; the sample is a filter,
    and no task sorts or merges n rows. Building the frame writes the hashes once and counts them. Rows of one key are told
    apart by a hash of all columns, and of rows that are equal in all columns as many copies as belong to the sample are made.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    draws = written_once(df.select(draw.alias("d")), "draws")
    if n >= draws.count():
        return df
    if n <= 0:
        return df.limit(0)
    prefix, left = _cut(draws, n)
    found = F.substring(draw, 1, len(prefix))
    if left is None:
        return df.where(found <= prefix)
    same, tie = df.where(draw == prefix), F.md5(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    second, copies = _cut(written_once(same.select(tie.alias("d")), "ties"), left)
    cut = F.substring(tie, 1, len(second))
    out = df.where(draw < prefix).unionByName(same.where(cut <= second if copies is None else cut < second))
    if copies is None:
        return out
    one = same.where(tie == second).limit(1)
    return out.unionByName(one.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy")).drop("_copy"))


def numbered(df: DataFrame, *order: str, name: str = "row_pos", parts: int | None = None) -> DataFrame:
    """Consecutive numbers from 0 in the order of columns, given by many tasks (V3).

    Rows are dealt out by ranges of the order and of a hash of all columns, so that equal values of a frequent key are not
    left to one task, then sorted and written once. The sizes of the ranges, one for each task, give the first number of each.
    Rows equal in ``order`` follow each other by their hash. ``parts`` is the number of ranges; left out, Spark chooses it by
    the size of the rows. Building the frame writes them.
    """
    by = [*_order(order, True), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(*by) if parts is None else df.repartitionByRange(parts, *by)
    placed = ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    written = written_once(placed, "numbered")
    part = F.shiftright("_at", 33)
    # one row for each task that wrote
    sizes = sorted((r["part"], r["n"]) for r in written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = [0, *itertools.accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame([(p, first) for (p, _), first in zip(sizes, firsts)], "_part long, _first long")
    own = written.withColumns({"_part": part, "_in": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    return own.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_first") + F.col("_in")).alias(name))


def permuted(number: Column | str, n: int, *salt: Column | str) -> Column:
    """A keyed permutation of the numbers 0 to n - 1: where each one goes.

    A Feistel network on number pairs (a, b) with a * b just above n; a number that falls outside goes round again until it
    is inside, which keeps it a permutation. ``salt`` is a text that chooses the permutation.
    """
    if n < 2:
        return F.lit(0).cast("long")
    high = math.isqrt(n - 1) + 1
    low = -(-n // high)

    def mixed(x: Column) -> Column:
        a, b = F.floor(x / low), x % low
        for i in range(2):
            a = (a + F.pmod(F.xxhash64(F.lit(2 * i), *map(col, salt), b), F.lit(high))) % high
            b = (b + F.pmod(F.xxhash64(F.lit(2 * i + 1), *map(col, salt), a), F.lit(low))) % low
        return (a * low + b).cast("long")

    first, outside = mixed(col(number).cast("long")), high * low - n
    if not outside:
        return first
    # each time round leaves at most a share outside / n of the numbers; 64 rounds leave none, and few numbers need fewer
    rounds = F.sequence(F.lit(1), F.lit(min(64, outside)))
    return F.aggregate(rounds, first, lambda x, _: F.when(x < n, x).otherwise(mixed(x)))
