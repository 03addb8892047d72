"""Exact quantiles against NumPy, with hot values, all signs, extremes and values that lie close together."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlens.operators.quantiles import PARTS, approx_quantiles, exact_quantiles, group_stats, order_bucket, order_path

PROBS = {"q0": 0.0, "q1": 0.01, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}


def frame(spark, groups):
    data = [(k, None if v is None else float(v)) for k, values in groups.items() for v in values]
    return spark.createDataFrame(data, "k string, v double")


def check(df, groups, **options):
    got = group_stats(df, ["k"], [F.count("v").alias("n")], "v", PROBS, **options).collect()
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        values = [v for v in groups[r["k"]] if v is not None and not math.isnan(v)]
        assert r["n"] == sum(v is not None for v in groups[r["k"]])
        for name, p in PROBS.items():
            if not values:
                assert r[name] is None
            else:
                assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


def groups_of(rng):
    return {
        "lognormal": list(np.exp(rng.normal(7, 1, 2000))),
        "hot": [1234.5] * 3000 + list(rng.uniform(1, 5000, 500)),
        "signs": list(rng.normal(0, 1e-3, 501)) + [0.0] * 20,
        "wide": [1e-300, -1e300, 1e300, 5e-324, 0.0, -1.0],
        "one": [7.0],
        "none": [None, None],
        "dense": list(1000 + np.arange(1000) * 1e-4),
    }


def test_groups(spark):
    groups = groups_of(np.random.default_rng(1))
    check(frame(spark, groups), groups)


def test_a_million_values_of_one_bucket_are_spread(spark):
    """All values share the first step of their path; no window runs over more than the parts of one node."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("a").alias("k"), (F.lit(1.7e9) + F.col("id") / 10).alias("v"))
    paths = df.select(*[c.alias(name) for name, c in order_path(F.col("v")).items()])
    first = paths.groupBy("_b1").count().agg(F.max("count")).first()[0]
    second = paths.distinct().groupBy("_b1").agg(F.countDistinct("_b2").alias("n")).agg(F.max("n")).first()[0]
    third = paths.groupBy("_b1", "_b2", "_b3").count().agg(F.max("count")).first()[0]
    assert first > n / 2 and second <= PARTS and third < 100
    (row,) = group_stats(df, ["k"], [], "v", {"m": 0.5}).collect()
    assert row["m"] == pytest.approx(1.7e9 + (n - 1) / 20, rel=1e-15)


def test_building_the_frame_runs_nothing(spark):
    @F.udf("double")
    def fails(v):
        raise AssertionError("the frame was executed")

    group_stats(spark.range(3).select(fails("id").alias("v")), [], [], "v", {"m": 0.5})


def test_without_plain_aggregates(spark):
    groups = groups_of(np.random.default_rng(2))
    got = group_stats(frame(spark, groups), ["k"], [], "v", {"m": 0.5}).collect()
    assert {r["k"] for r in got} == set(groups)
    m = {r["k"]: r["m"] for r in got}
    assert m["none"] is None and m["one"] == 7.0
    assert m["lognormal"] == pytest.approx(np.median(groups["lognormal"]))


def test_missing_keys_are_left_out_and_nan_is_missing(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", float("nan")), ("a", 2.0), ("a", 4.0)], "k string, v double")
    (row,) = group_stats(df, ["k"], [F.count(F.lit(1)).alias("n")], "v", {"m": 0.5}).collect()
    assert (row["k"], row["n"], row["m"]) == ("a", 3, 3.0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(df, "v", [0.5]) == [None]
    assert group_stats(df, ["k"], [F.count("v").alias("n")], "v", {"m": 0.5}).collect() == []
    (row,) = group_stats(df, [], [F.count("v").alias("n")], "v", {"m": 0.5}).collect()
    assert (row["n"], row["m"]) == (0, None)


def test_infinite_values(spark):
    df = frame(spark, {"a": [float("-inf"), 1.0, float("inf")]})
    assert exact_quantiles(df, "v", [0.5]) == [1.0]


def test_approximate_version_is_close(spark):
    values = list(np.random.default_rng(3).uniform(0, 1000, 5000))
    (m,) = approx_quantiles(frame(spark, {"a": values}), "v", [0.5])
    assert m == pytest.approx(np.median(values), rel=0.01)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=200))
def test_bucket_keeps_order(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted((r["v"], r["b"]) for r in df.select("v", order_bucket(F.col("v")).alias("b")).collect())
    numbers = [b for _, b in got]
    assert numbers == sorted(numbers)
    path = [c.alias(name) for name, c in order_path(F.col("v")).items()]
    steps = sorted((r["v"], r["_b1"], r["_b2"], r["_b3"]) for r in df.select("v", *path).collect())
    assert [x[1:] for x in steps] == sorted(x[1:] for x in steps)
