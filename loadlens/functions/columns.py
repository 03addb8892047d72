"""Null-safe column helpers shared by every report.

All of them return plain ``Column`` expressions, so they stay inside whole-stage code
generation and work the same on batch and streaming frames.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Number = int | float


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: Column | str) -> Column:
    """NaN counts as missing everywhere in this library."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def without_nan(df: DataFrame, *cols: str) -> DataFrame:
    """The frame with NaN turned into NULL in the given columns, or in all floating-point columns.

    Spark orders NaN above every number, so a comparison would count it as a high value.
    """
    kinds = dict(df.dtypes)
    wanted = [c for c in cols or df.columns if kinds.get(c) in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in wanted}) if wanted else df


def flag(condition: Column) -> Column:
    """0/1 indicator; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def safe_div(a: Column | str, b: Column | str) -> Column:
    """``a / b`` with NULL instead of an error or an infinity when ``b`` is zero."""
    return F.try_divide(col(a), col(b))


def clip0(c: Column | str) -> Column:
    """Floor at zero; missing stays missing (``greatest`` would turn NULL into 0)."""
    c = col(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def clip01(c: Column | str) -> Column:
    c = col(c)
    return F.when(c < 0, F.lit(0.0)).when(c > 1, F.lit(1.0)).otherwise(c)


def log1p0(c: Column | str) -> Column:
    return F.log1p(clip0(c))


def to_log_target(c: Column | str) -> Column:
    return F.log1p(col(c))


def from_log_target(c: Column | str) -> Column:
    """Back-transform of a log-scale prediction, floored at zero."""
    return clip0(F.expm1(col(c)))


def is_infinite(c: Column | str) -> Column:
    return F.abs(col(c)) == F.lit(float("inf"))


def is_finite(c: Column | str) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & ~is_infinite(c)


def is_close(a: Column | str, b: Column | Number) -> Column:
    """|a - b| <= 1e-8 + 1e-5 |b|."""
    b = b if isinstance(b, Column) else F.lit(float(b))
    return F.abs(col(a) - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def cents(c: Column | str) -> Column:
    """Two decimals, half to even."""
    return F.bround(col(c), 2)


def text_or_nan(c: Column | str) -> Column:
    """Missing text is spelled ``nan`` so that lanes with an unknown end stay one visible group."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def route(pickup: Column | str = "pickup", delivery: Column | str = "delivery") -> Column:
    return F.concat(text_or_nan(pickup), F.lit(" → "), text_or_nan(delivery))


def route_equipment(lane: Column | str = "route", equipment: Column | str = "equipment") -> Column:
    return F.concat(text_or_nan(lane), F.lit(" | "), text_or_nan(equipment))


def same_city(pickup: Column | str = "pickup", delivery: Column | str = "delivery") -> Column:
    return flag(col(pickup) == col(delivery))


def rate_per_mile(rate: Column | str = "posted_rate", distance: Column | str = "distance") -> Column:
    return safe_div(rate, distance)


def snake(name: str) -> str:
    """A model name as a column-name stem: lower case, blanks to underscores, dashes removed."""
    return name.lower().replace(" ", "_").replace("-", "")


# ---------------------------------------------------------------- dates


def weekday(d: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(d))


def is_weekend(d: Column | str) -> Column:
    return flag(weekday(d) >= 5)


def month_period(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def weekday_name(d: Column | str) -> Column:
    return F.date_format(col(d), "EEEE")


def cyclic(c: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * c / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


# ---------------------------------------------------------------- fixed-edge buckets


def cut(
    x: Column | str,
    edges: Sequence[Number],
    include_lowest: bool = False,
    labels: Sequence[str] | None = None,
) -> Column:
    """The right-closed bucket ``(edges[i], edges[i+1]]`` that holds ``x``: its 0-based number or its label.

    Values outside all buckets, NaN and NULL give NULL (NaN compares above every edge, so it passes them
    all). ``include_lowest`` closes the first bucket on the left as well.
    """
    x = col(x).cast("double")
    first = F.lit(float(edges[0]))
    out = F.when(x < first if include_lowest else x <= first, F.lit(None))
    for i, edge in enumerate(edges[1:]):
        out = out.when(x <= F.lit(float(edge)), F.lit(i if labels is None else labels[i]))
    return out


def label_of(index: Column | str, labels: Sequence[str]) -> Column:
    """Text label of a bucket number."""
    index = col(index)
    out = F.when(index == 0, F.lit(labels[0]))
    for i, label in enumerate(labels[1:], start=1):
        out = out.when(index == i, F.lit(label))
    return out


def interval_labels(edges: Sequence[Number]) -> list[str]:
    """``(a, b]`` names of fixed-edge buckets."""
    e = [float(v) for v in edges]
    return [f"({lo}, {hi}]" for lo, hi in zip(e, e[1:])]


def quantile_interval_labels(edges: Sequence[Number], precision: int = 3) -> list[str]:
    """``(a, b]`` names of quantile buckets: rounded ends, the first one widened to include the minimum."""

    def shorten(v: float, digits: int) -> float:
        if v == 0 or not math.isfinite(v):
            return v
        if abs(v) < 1:
            digits += -math.floor(math.log10(abs(v))) - 1
        return round(v, digits)

    for digits in range(precision, 20):
        names = [shorten(float(v), digits) for v in edges]
        if len(set(names)) == len(names):
            break
    names[0] = names[0] - 10 ** (-digits)
    return [f"({lo}, {hi}]" for lo, hi in zip(names, names[1:])]
