"""Exact quantiles that never gather a group in one place, and grouped statistics built on them.

Spark's own exact ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the values are
counted once, combined on the map side, under an order-preserving path: a bucket (a few thousand per group), 2^14 parts
of a bucket, 2^14 parts of a part, and the value. Going down the path, the counts of a level tell which child holds the
wanted rank, and only its children are looked at next. Windows run over the children of one node, at most 2^14 below
the first level, so a group whose values all lie close together is not gathered either. The result is the same number
as the exact percentile with linear interpolation, and building the frame runs nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.columns import col, null_if_nan

BUCKETS_PER_DOUBLING = 1024
# covers the exponents of all doubles, so that bucket numbers of positive values are positive
_SHIFT = 1100 * BUCKETS_PER_DOUBLING
PARTS = 1 << 14

#: Columns of a value's path, from the bucket down; the value itself is the last step.
PATH = ["_b1", "_b2", "_b3"]


def order_bucket(v: Column) -> Column:
    """A bucket number that never decreases with the value; about 0.07 % wide relative to it. NULL is in 0."""
    size = _exponent(v) + _SHIFT
    # the logarithm of zero is NULL
    return F.coalesce((F.signum(v) * size).cast("long"), F.lit(0).cast("long"))


def _exponent(v: Column) -> Column:
    return F.floor(F.least(F.log2(F.abs(v)), F.lit(1025.0)) * BUCKETS_PER_DOUBLING)


def order_path(v: Column) -> dict[str, Column]:
    """Bucket, part and part of the part of a value: in this order they never decrease with the value."""
    low = F.pow(F.lit(2.0), _exponent(v) / BUCKETS_PER_DOUBLING)
    width = 2.0 ** (1 / BUCKETS_PER_DOUBLING) - 1
    place = (F.try_divide(F.abs(v), low) - 1) / width * PARTS  # where in its bucket, 0 to PARTS
    place = F.when(F.abs(v) < float("inf"), F.least(F.greatest(place, F.lit(0.0)), F.lit(PARTS - 1e-6)))
    sign = F.signum(v)
    second = F.floor(place)
    third = F.floor((place - second) * PARTS)
    whole = lambda c: F.coalesce((sign * c).cast("long"), F.lit(0).cast("long"))
    return {"_b1": order_bucket(v), "_b2": whole(second), "_b3": whole(third)}


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    of: Column | str | None = None,
    quantiles: Mapping[str, float] | None = None,
    times: str | None = None,
) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` plus exact quantiles of the column ``of`` under the given names.

    Rows with a missing key are left out. For quantiles a row counts as often as its column ``times`` says, else once. With keys, one scan computes the plain aggregates and the counts per value
    (grouping sets); without keys the plain aggregates are a scan of their own, so that an empty table gives a row.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    if not quantiles:
        return df.groupBy(*keys).agg(*aggs)

    keys = list(keys)
    df = df.withColumn("_v", null_if_nan(col(of).cast("double")))
    df = df.withColumns(order_path(F.col("_v")))
    steps = [*PATH, "_v"]
    counted_n = (F.sum(F.when(F.col("_v").isNotNull(), F.col(times)).otherwise(0)) if times else F.count("_v")).alias("_n")
    if keys and aggs:
        both = df.groupingSets([[*keys, *steps], keys], *keys, *steps).agg(*aggs, counted_n, F.grouping("_b1").alias("_all"))
        values = both.where("_all = 0").select(*keys, *steps, "_n")
        stats = both.where("_all = 1").drop(*steps, "_n", "_all")
    else:
        values = df.groupBy(*keys, *steps).agg(counted_n)
        stats = df.agg(*aggs) if aggs else values.select(*keys).distinct()
    found = _at_ranks(values.where("_v IS NOT NULL"), keys, quantiles)
    if keys:
        return stats.join(found, keys, "left")
    if not aggs:
        return found
    # one row each, with different columns: fold them into one
    both = stats.unionByName(found, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def _at_ranks(values: DataFrame, keys: list[str], quantiles: Mapping[str, float]) -> DataFrame:
    """The quantiles of each group from the counts of its values along their paths."""
    steps = [*PATH, "_v"]
    chosen = None
    for depth, step in enumerate(steps, start=1):
        node = [*keys, *steps[: depth - 1]]
        level = values if step == "_v" else values.groupBy(*node, step).agg(F.sum("_n").alias("_n"))
        children = Window.partitionBy(*node)
        upto = F.sum("_n").over(children.orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        if chosen is None:
            level = level.withColumns({"_total": F.sum("_n").over(children), "_start": F.lit(0).cast("long")})
        else:
            level = level.join(chosen, node)
        placed = level.withColumn("_last", F.col("_start") + upto - 1).withColumn("_first", F.col("_last") - F.col("_n") + 1)
        held = placed.where(_holds_rank(quantiles.values()))
        chosen = held.select(*node, step, "_total", F.col("_first").alias("_start"))
    ends = []
    for i, p in enumerate(quantiles.values()):
        for end, rank in (("lo", F.floor(_rank(p))), ("hi", F.ceil(_rank(p)))):
            hit = rank.between(F.col("_first"), F.col("_last"))
            ends.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{end}{i}"))
    found = held.groupBy(*keys).agg(*ends, F.max("_total").alias("_total"))
    result = []
    for i, (name, p) in enumerate(quantiles.items()):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = lo + (hi - lo) * (_rank(p) - F.floor(_rank(p)))
        result.append(F.when(lo == hi, lo).otherwise(between).alias(name))
    return found.select(*keys, *result)


def _rank(p: float) -> Column:
    """0-based position of a quantile among the values of its group."""
    return F.lit(float(p)) * (F.col("_total") - 1)


def _holds_rank(probs: Iterable[float]) -> Column:
    """Whether the ranks ``_first`` to ``_last`` include one that a quantile needs."""
    holds = F.lit(False)
    for p in sorted(set(probs)):
        for rank in (F.floor(_rank(p)), F.ceil(_rank(p))):
            holds = holds | rank.between(F.col("_first"), F.col("_last"))
    return holds


def pairs_below(counts: DataFrame, value: str, high: str, low: str) -> DataFrame:
    """One row: how many (high, low) pairs have the smaller value on the low side, those of equal value counted half.

    ``counts`` has one row per value with the counts ``high`` and ``low``. Along the paths of the values, the low
    counts of earlier children of the same node are cumulated at each level.
    """
    steps = [*PATH, "_v"]
    values = counts.withColumn("_v", F.col(value)).withColumns(order_path(F.col(value)))
    parts = None
    for depth, step in enumerate(steps, start=1):
        node = steps[: depth - 1]
        level = values.groupBy(*node, step).agg(F.sum(high).alias("_high"), F.sum(low).alias("_low"))
        earlier = Window.partitionBy(*node).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("_low").over(earlier), F.lit(0)).cast("double")
        if step == "_v":
            below = below + F.col("_low") / 2
        part = level.select((F.col("_high") * below).alias("_pairs"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.agg(F.sum("_pairs").alias("pairs"))


def exact_quantiles(df: DataFrame, column: Column | str, probs: Sequence[float]) -> list[float | None]:
    """Quantiles of one column as plain numbers (a handful of values, for bucket edges and fences)."""
    names = {f"q{i}": float(p) for i, p in enumerate(probs)}
    row = group_stats(df, [], [], column, names).first()  # the only job here: a few plain numbers are asked for
    return [None if row is None else row[n] for n in names]


def approx_quantiles(
    df: DataFrame, column: Column | str, probs: Sequence[float], accuracy: int = 10_000
) -> list[float | None]:
    """One-pass sketch for exploration; the reports use the exact version."""
    row = df.agg(F.percentile_approx(col(column), list(probs), accuracy).alias("q")).first()
    return list(row["q"]) if row and row["q"] is not None else [None] * len(probs)
