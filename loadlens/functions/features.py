"""Feature engineering as one projection per feature set.

No shuffle, no UDF, no job: the same code runs on a batch table and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K

DATE_FEATURES = [
    "year", "month", "day", "day_of_week", "day_of_year", "week_of_year", "is_weekend",
    "month_sin", "month_cos", "weekday_sin", "weekday_cos",
]

# model inputs of the base feature set: 32 numeric and 4 categorical
BASE_NUMERIC = [
    "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
    "distance", "weight", "market_index", "quote_signal",
    *DATE_FEATURES,
    "distance_log", "distance_squared", "weight_log", "weight_squared",
    "weight_per_mile", "distance_weight_interaction",
    "market_index_squared", "market_index_log",
    "quote_signal_squared", "quote_signal_abs",
    "lat_difference", "lon_difference", "geo_distance",
]
#: Columns that the feature sets are derived from.
FEATURE_INPUTS = [
    "pickup", "delivery", "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
    "distance", "equipment", "weight", "date", "market_index", "quote_signal",
]

BASE_CATEGORICAL = ["pickup", "delivery", "equipment", "route"]

REFINED_NUMERIC = [
    "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
    "distance", "weight", "market_index", "quote_signal",
    *DATE_FEATURES,
    "distance_log", "distance_squared", "distance_cubed",
    *[f"long_haul_{m}" for m in K.LONG_HAUL_MILES],
    "weight_log", "weight_squared", "heavy_load", "very_heavy_load",
    "distance_weight", "weight_per_mile",
    "market_index_squared", "market_index_centered", "market_index_high", "market_index_very_high",
    "quote_signal_squared", "quote_signal_cubed", "distance_quote_signal", "distance_quote_signal_squared",
    "quote_signal_low", "quote_signal_high", "quote_signal_mid",
    "distance_market", "distance_market_squared", "distance_market_quote",
    "lat_difference", "lon_difference", "geo_distance", "geo_distance_per_mile",
]
REFINED_CATEGORICAL = [*BASE_CATEGORICAL, "route_equipment", "distance_bucket"]


def _num(name: str) -> Column:
    return C.null_if_nan(F.col(name).try_cast("double"))


def _date_features() -> dict[str, Column]:
    d = F.col("date")
    month_sin, month_cos = C.cyclic(F.month(d), 12)
    weekday_sin, weekday_cos = C.cyclic(C.weekday(d), 7)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": C.weekday(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": C.is_weekend(d),
        "month_sin": month_sin,
        "month_cos": month_cos,
        "weekday_sin": weekday_sin,
        "weekday_cos": weekday_cos,
    }


def _geo_features() -> dict[str, Column]:
    dlat = F.col("delivery_lat") - F.col("pickup_lat")
    dlon = F.col("delivery_lon") - F.col("pickup_lon")
    return {
        "lat_difference": F.abs(dlat),
        "lon_difference": F.abs(dlon),
        "geo_distance": F.sqrt(dlat * dlat + dlon * dlon),
    }


def if_columns(df: DataFrame, needed: list[str], features: dict[str, Column]) -> dict[str, Column]:
    """The features when all needed columns exist, else none; decided while building the plan."""
    return features if set(needed) <= set(df.columns) else {}


def create_features(df: DataFrame, same_city: bool = False, buckets: bool = False) -> DataFrame:
    """Base feature set (X1). ``same_city`` and ``buckets`` add the two columns of X2.

    Feature groups whose input columns are absent are left out.
    """
    x, w = _num("distance"), _num("weight")
    m, s = _num("market_index"), _num("quote_signal")
    lane = {"route": C.route()}
    if same_city:
        lane["same_city"] = C.same_city()
    miles = {"distance_log": C.log1p0(x), "distance_squared": x * x}
    if buckets:
        miles["distance_bucket"] = C.cut(x, K.DISTANCE_EDGES_8, labels=K.DISTANCE_LABELS_8)
    groups = [
        (["date"], _date_features()),
        (["pickup", "delivery"], lane),
        (["distance"], miles),
        (["weight"], {"weight_log": C.log1p0(w), "weight_squared": w * w}),
        (
            ["weight", "distance"],
            {"weight_per_mile": C.safe_div(w, x), "distance_weight_interaction": x * w},
        ),
        (["market_index"], {"market_index_squared": m * m, "market_index_log": C.log1p0(m)}),
        (["quote_signal"], {"quote_signal_squared": s * s, "quote_signal_abs": F.abs(s)}),
        (["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon"], _geo_features()),
    ]
    new: dict[str, Column] = {}
    for needed, features in groups:
        new.update(if_columns(df, needed, features))
    return df.withColumns(new)


def refined_features(df: DataFrame) -> DataFrame:
    """Refined feature set (X3): 46 derived columns, all input columns required."""
    x, w = _num("distance"), _num("weight")
    m, s = _num("market_index"), _num("quote_signal")
    new: dict[str, Column] = dict(_date_features())
    new["route"] = C.route()
    new["route_equipment"] = C.route_equipment(C.route())
    new["distance_log"] = C.log1p0(x)
    new["distance_squared"] = x * x
    new["distance_cubed"] = x * x * x
    for miles in K.LONG_HAUL_MILES:
        new[f"long_haul_{miles}"] = C.flag(x >= miles)
    new["distance_bucket"] = C.cut(x, K.DISTANCE_EDGES_10, labels=K.DISTANCE_LABELS_10)
    new["weight_log"] = C.log1p0(w)
    new["weight_squared"] = w * w
    new["heavy_load"] = C.flag(w >= K.HEAVY_LB)
    new["very_heavy_load"] = C.flag(w >= K.VERY_HEAVY_LB)
    new["distance_weight"] = x * w
    new["weight_per_mile"] = C.safe_div(w, x)
    new["market_index_squared"] = m * m
    new["market_index_centered"] = m - F.lit(1.0)
    new["market_index_high"] = C.flag(m >= K.INDEX_HIGH)
    new["market_index_very_high"] = C.flag(m >= K.INDEX_VERY_HIGH)
    new["quote_signal_squared"] = s * s
    new["quote_signal_cubed"] = s * s * s
    new["distance_quote_signal"] = x * s
    new["distance_quote_signal_squared"] = x * (s * s)
    new["quote_signal_low"] = C.flag(s < K.SIGNAL_LOW)
    new["quote_signal_high"] = C.flag(s > K.SIGNAL_HIGH)
    new["quote_signal_mid"] = C.flag(s.between(K.SIGNAL_LOW, K.SIGNAL_HIGH))
    new["distance_market"] = x * m
    new["distance_market_squared"] = x * (m * m)
    new["distance_market_quote"] = x * m * s
    geo = _geo_features()
    new.update(geo)
    new["geo_distance_per_mile"] = C.safe_div(geo["geo_distance"], x)
    return df.withColumns(new)


_PLACES = ("pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon")
#: Input columns that a feature is made of, for those made of several or of one by another name.
_SOURCES = {
    **{c: ("date",) for c in DATE_FEATURES},
    **{f"distance_{p}": ("distance",) for p in ("log", "squared", "cubed", "bucket")},
    **{f"long_haul_{m}": ("distance",) for m in K.LONG_HAUL_MILES},
    **{c: ("weight",) for c in ("weight_log", "weight_squared", "heavy_load", "very_heavy_load")},
    **{c: ("weight", "distance") for c in ("weight_per_mile", "distance_weight_interaction", "distance_weight")},
    **{f"market_index_{p}": ("market_index",) for p in ("squared", "log", "centered", "high", "very_high")},
    **{f"quote_signal_{p}": ("quote_signal",) for p in ("squared", "cubed", "abs", "low", "high", "mid")},
    **{f"distance_quote_signal{p}": ("distance", "quote_signal") for p in ("", "_squared")},
    **{f"distance_market{p}": ("distance", "market_index") for p in ("", "_squared")},
    "distance_market_quote": ("distance", "market_index", "quote_signal"),
    "lat_difference": ("pickup_lat", "delivery_lat"),
    "lon_difference": ("pickup_lon", "delivery_lon"),
    "geo_distance": _PLACES,
    "geo_distance_per_mile": (*_PLACES, "distance"),
    "route": ("pickup", "delivery"),
    "route_equipment": ("pickup", "delivery", "equipment"),
}
#: What the columns of the feature sets are made of; counts of values need no more than the different inputs.
SOURCES = {c: _SOURCES.get(c, (c,)) for c in dict.fromkeys([*BASE_NUMERIC, *BASE_CATEGORICAL, *REFINED_NUMERIC, *REFINED_CATEGORICAL])}


def sources(derive: object) -> dict[str, tuple[str, ...]]:
    """``SOURCES`` for the feature sets of this module, nothing for other functions."""
    return SOURCES if derive in (create_features, refined_features) else {}
