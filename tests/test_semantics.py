"""The rules that decide correctness: missing values, bucket edges, rounding, ties, names."""

import datetime

import pytest
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.functions.features import (
    BASE_CATEGORICAL,
    BASE_NUMERIC,
    REFINED_CATEGORICAL,
    REFINED_NUMERIC,
    create_features,
    refined_features,
)
from loadlens.operators import audit, buckets, evaluate, rows, strategy, summary
from loadlens.plans import models
from loadlens.sources import domains, tables

DAY = datetime.date(2025, 3, 2)  # a Sunday


def load(**changes):
    row = dict(
        load_id="TE-000001", pickup="Lexington", delivery="Fort Wayne", pickup_lat=38.0, pickup_lon=-84.0,
        delivery_lat=41.0, delivery_lon=-80.0, distance=360.0, equipment="Dry Van", weight=32000.0, date=DAY,
        market_index=1.0, quote_signal=2.0, posted_rate=900.0,
    )
    return tuple((row | changes).values())


def loads(spark, *changes):
    return spark.createDataFrame([load(**c) for c in changes], tables.LOADS)


def one(df):
    (row,) = df.collect()
    return row.asDict()


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_buckets_are_right_closed(spark):
    got = column(spark, [100.0, 100.1, 1000.0, 0.0, None, 9e9], lambda x: C.cut(x, K.DISTANCE_EDGES_8))
    assert got == [0, 1, 4, 0, None, 7]
    label = lambda x: C.label_of(C.cut(x, K.RATE_EDGES), K.RATE_LABELS)
    assert column(spark, [1000.0, 7500.0, 7500.01, float("nan")], label) == ["<1000", "5000-7500", "7500-10000", None]


def test_first_edge_can_be_included(spark):
    cut = lambda x: C.cut(x, K.PREDICTION_EDGES, include_lowest=True)
    assert column(spark, [0.0, -0.01, 500.0, 10000.1], cut) == [0, None, 0, 7]
    assert column(spark, [0.0, 0.01], lambda x: C.cut(x, K.PREDICTION_EDGES)) == [None, 0]


def test_interval_names():
    assert C.interval_labels(K.DISTANCE_EDGES_8)[0] == "(-inf, 100.0]"
    assert C.interval_labels(K.DISTANCE_EDGES_8)[-1] == "(2500.0, inf]"
    assert C.quantile_interval_labels([0.67612, 0.87111, 1.4]) == ["(0.675, 0.871]", "(0.871, 1.4]"]


def test_unknown_conditions_are_zero(spark):
    assert column(spark, [None, 35000.0, 34999.0], lambda x: C.flag(x >= K.HEAVY_LB)) == [0, 1, 0]


def test_clip_keeps_missing(spark):
    assert column(spark, [None, -1.0, 2.0], C.clip0) == [None, 0.0, 2.0]
    assert column(spark, [None, -1.0, 0.5, 2.0], C.clip01) == [None, 0.0, 0.5, 1.0]


def test_zero_divisor_is_missing(spark):
    assert column(spark, [0.0, 2.0, None], lambda x: C.safe_div(F.lit(1.0), x)) == [None, 0.5, None]


def test_cents_round_half_to_even(spark):
    assert column(spark, [0.125, 0.375, 2.0], C.cents) == [0.12, 0.38, 2.0]


def test_log_round_trip_has_a_floor(spark):
    got = column(spark, [0.0, 99.0, -3.0], lambda x: C.from_log_target(C.to_log_target(F.greatest(x, F.lit(0.0)))))
    assert got == pytest.approx([0.0, 99.0, 0.0])
    assert column(spark, [-2.0], C.from_log_target) == [0.0]


def test_close_and_finite(spark):
    assert column(spark, [360.0, 360.003, 360.1], lambda x: C.is_close(x, 360.0)) == [True, True, False]
    assert column(spark, [1.0, None, float("nan"), float("inf")], C.is_finite) == [True, False, False, False]


def test_model_name_stem():
    assert C.snake("Raw Trees - Squared Error") == "raw_trees__squared_error"


def test_missing_city_in_route(spark):
    row = one(create_features(loads(spark, {"pickup": None}), same_city=True))
    assert row["route"] == "nan → Fort Wayne"
    assert row["same_city"] == 0
    assert one(create_features(loads(spark, {"pickup": None, "delivery": None}), same_city=True))["same_city"] == 0


def test_calendar_parts(spark):
    row = one(create_features(loads(spark, {})))
    assert (row["day_of_week"], row["is_weekend"], row["week_of_year"], row["day_of_year"]) == (6, 1, 9, 61)
    new_year = one(create_features(loads(spark, {"date": datetime.date(2024, 12, 30)})))
    assert (new_year["week_of_year"], new_year["day_of_week"]) == (1, 0)


def test_bad_date_costs_only_its_features(spark):
    row = one(create_features(loads(spark, {"date": None})))
    assert row["week_of_year"] is None and row["is_weekend"] == 0 and row["distance_log"] is not None


def test_zero_distance_and_missing_weight(spark):
    row = one(refined_features(loads(spark, {"distance": 0.0, "weight": None})))
    assert row["weight_per_mile"] is None and row["geo_distance_per_mile"] is None
    assert row["heavy_load"] == 0 and row["distance_log"] == 0.0 and row["weight_log"] is None


def test_three_signal_zones(spark):
    df = loads(spark, {"quote_signal": 1.734}, {"quote_signal": 1.735}, {"quote_signal": 2.403}, {"quote_signal": 2.404}, {"quote_signal": None})
    got = refined_features(df).select("quote_signal_low", "quote_signal_mid", "quote_signal_high").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (0, 1, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]


def test_feature_counts(spark):
    df = loads(spark, {})
    assert len(create_features(df).columns) == 14 + 25
    assert len(refined_features(df).columns) == 14 + 46
    assert len(BASE_NUMERIC) + len(BASE_CATEGORICAL) == 36
    assert set(BASE_NUMERIC + BASE_CATEGORICAL) <= set(create_features(df).columns)
    assert set(REFINED_NUMERIC + REFINED_CATEGORICAL) <= set(refined_features(df).columns)


def test_absent_columns_skip_their_features(spark):
    df = loads(spark, {}).drop("weight", "pickup_lat", "date")
    got = set(create_features(df).columns)
    assert "distance_log" in got and not got & {"weight_log", "weight_per_mile", "geo_distance", "month_sin"}


def test_groups_without_key_or_target(spark):
    df = loads(spark, {"equipment": None}, {"posted_rate": None}, {"posted_rate": 100.0})
    got = one(summary.group_summary(df, ["equipment"]))
    assert got == {"equipment": "Dry Van", "count": 1, "mean": 100.0, "median": 100.0}
    segments = summary.segment_summary(df).collect()
    assert [(r["rate_segment"], r["count"]) for r in segments] == [("<1000", 2)]
    assert segments[0]["percentage"] == pytest.approx(200 / 3)


def test_high_rate_threshold_is_inclusive_while_its_segment_is_below(spark):
    df = loads(spark, {"posted_rate": 7500.0}, {"posted_rate": 7499.0})
    assert one(summary.high_rate_by(df, ["equipment"]))["high_rate_loads"] == 1
    assert one(summary.segment_summary(df))["rate_segment"] == "5000-7500"


def test_absent_weekdays_stay(spark):
    got = summary.weekday_summary(loads(spark, {})).collect()
    assert [r["weekday"] for r in got] == K.WEEKDAYS
    assert [r["count"] for r in got] == [None] * 6 + [1]


def test_month_keys(spark):
    df = loads(spark, {}, {"date": datetime.date(2024, 3, 5)})
    assert [r["month"] for r in summary.trend(df, grain="month").collect()] == ["2024-03", "2025-03"]
    assert len(summary.high_rate_by(df.withColumn("month", F.month("date")), ["month"]).collect()) == 1


def test_correlation_skips_missing_pairs_and_constant_columns(spark):
    df = loads(
        spark,
        {"weight": None, "posted_rate": 5.0},
        {"weight": 1.0, "posted_rate": 1.0},
        {"weight": 2.0, "posted_rate": 2.0},
        {"weight": 3.0, "posted_rate": 3.0},
    )
    got = {r["feature"]: r["correlation"] for r in summary.correlations(df).collect()}
    assert got["weight"] == pytest.approx(1.0) and got["posted_rate"] == pytest.approx(1.0)
    assert got["distance"] is None


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert one(models.modes(df, ["c"])) == {"column": "c", "fill": "a"}


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "c double")
    assert one(models.medians(df, ["c"])) == {"column": "c", "fill": 2.5}


def test_audit_counts(spark):
    inf = float("inf")
    df = loads(spark, {}, {}, {"weight": float("nan"), "distance": -1.0}, {"load_id": None, "distance": inf, "weight": 0.0})
    missing = {r["column"]: r["missing_count"] for r in audit.missing_report(df, only_nonzero=True).collect()}
    assert missing == {"load_id": 1, "weight": 1}
    assert one(audit.duplicate_rows(df)) == {"duplicate_rows": 1}
    assert one(audit.duplicate_keys(df)) == {"rows": 4, "unique_keys": 1, "duplicate_keys": 2}
    distinct = {r["column"]: r["unique_values"] for r in audit.distinct_report(df).collect()}
    assert (distinct["load_id"], distinct["weight"], distinct["distance"]) == (2, 3, 3)
    assert one(audit.infinite_report(df, only_nonzero=True)) == {"column": "distance", "infinite_count": 1}
    signs = {r["column"]: (r["negative_count"], r["zero_count"]) for r in audit.sign_report(df).collect()}
    assert signs["distance"] == (1, 0) and signs["weight"] == (0, 1)
    counts = audit.value_counts(df, "load_id").collect()
    assert [tuple(r) for r in counts] == [("TE-000001", 3), (None, 1)]


def test_leakage(spark):
    df = loads(spark, {}).withColumn("rate_per_mile", C.rate_per_mile())
    got = {r["column"]: r["pattern"] for r in audit.leakage_report(df).collect()}
    assert got == {"posted_rate": "posted_rate", "rate_per_mile": "rate_per_mile"}
    assert audit.leakage_report(df.select("weight")).collect() == []
    assert not set(got) & set(rows.drop_leakage(df).columns)
    assert "posted_rate" in rows.drop_leakage(df, keep=["posted_rate"]).columns


def test_histogram_of_one_value(spark):
    got = buckets.histogram(loads(spark, {}, {}), "posted_rate", 10).collect()
    assert sum(r["count"] for r in got) == 2 and len(got) == 10
    assert (got[0]["lower"], got[-1]["upper"]) == (899.5, 900.5)


def test_quantile_buckets_merge_equal_edges(spark):
    df = loads(spark, *[{"quote_signal": 1.0}] * 9, {"quote_signal": 2.0}, {"quote_signal": None})
    got = summary.quantile_summary(df, "quote_signal").collect()
    assert sum(r["count"] for r in got) == 10


def test_percentage_error_of_zero_target(spark):
    df = loads(spark, {"posted_rate": 0.0}).withColumn("predicted_rate", F.lit(5.0))
    row = one(evaluate.add_errors(df))
    assert row["percentage_error"] is None and row["error"] == 5.0 and row["underpredicted"] is False


def test_classification_with_an_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, predicted int")
    got = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert got["1"]["precision"] == 0.0 and got["1"]["support"] == 0 and got["accuracy"]["f1"] == 1.0


def test_auc_counts_ties_half_and_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert one(evaluate.roc_auc(df))["roc_auc"] == pytest.approx(0.875)
    assert one(evaluate.roc_auc(df.where("label = 1")))["roc_auc"] is None


def test_thresholds_without_rows(spark):
    df = loads(spark, {"posted_rate": 6000.0}).withColumn("predicted_rate", F.lit(5000.0))
    assert [r["threshold"] for r in strategy.extreme_metrics(df).collect()] == [5000.0]
    kept = strategy.extreme_metrics(df, keep_empty=True).collect()
    assert [(r["count"], r["MAE"]) for r in kept] == [(1, 1000.0)] + [(0, None)] * 4


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("2025-01-02", "1.5"), ("bad", "x"), (None, "NaN"), ("2025-01-03 10:00:00", "2")], "date string, n string")
    got = tables.parse_numeric(tables.parse_dates(df, "date"), "n").collect()
    assert [r["date"] for r in got] == [datetime.date(2025, 1, 2), None, None, datetime.date(2025, 1, 3)]
    assert [r["n"] for r in got] == [1.5, None, None, 2.0]


def test_csv_round_trip(spark, tmp_path):
    df = loads(spark, {}, {"weight": None, "load_id": "TE-000002"})
    tables.write_table(df, str(tmp_path / "loads.csv"), "csv")
    back = tables.read_loads(spark, str(tmp_path / "loads.csv"))
    assert sorted(back.collect(), key=lambda r: r["load_id"]) == sorted(df.collect(), key=lambda r: r["load_id"])
    assert dict(tables.read_loads(spark, str(tmp_path / "loads.csv"), infer=True).dtypes)["distance"] == "double"


def test_partitioned_sink_prunes(spark, tmp_path):
    df = loads(spark, {}, {"date": datetime.date(2025, 7, 1)})
    tables.write_loads(df, str(tmp_path / "loads"))
    back = tables.read_loads(spark, str(tmp_path / "loads"))
    assert back.where("load_month = 7").count() == 1


def test_checked_scan_names_its_table(spark, tmp_path):
    with pytest.raises(tables.InputError, match="predictions file not found"):
        tables.read_checked(spark, str(tmp_path / "nothing.csv"), "predictions")
    bad = tmp_path / "bad.csv"
    bad.write_text("load_id,predicted_rate\nTE-000001,abc\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        tables.read_checked(spark, str(bad), "predictions", tables.PREDICTIONS).collect()


def test_generated_domains(spark):
    assert [r[0] for r in domains.expected_ids(spark, 2).orderBy("load_id").collect()] == ["TE-000001", "TE-000002"]
    lane = domains.scenario_frame(spark)
    assert lane.columns == K.SCENARIO_COLUMNS and lane.count() == 31


def test_splits_replay(spark, sf_dir):
    df = spark.range(5000).select(F.format_string("TE-%06d", "id").alias("load_id"))
    train, test = rows.random_split(df)
    again = rows.random_split(df.repartition(7))[1]
    assert train.count() + test.count() == 5000
    assert 0.17 < test.count() / 5000 < 0.23
    assert sorted(test.collect()) == sorted(again.collect())
    assert rows.sample_n(df, 100).count() == 100
    assert sorted(rows.sample_n(df, 100).collect()) == sorted(rows.sample_n(df.repartition(5), 100).collect())


def test_union_needs_frames():
    with pytest.raises(ValueError):
        rows.union_tagged({}, "tag")


def test_nan_is_missing_in_every_comparison(spark):
    nan = float("nan")
    d = loads(spark, dict(posted_rate=8000.0), dict(posted_rate=500.0), dict(posted_rate=nan, weight=nan, market_index=nan, quote_signal=nan))
    assert one(evaluate.class_balance(d))["positives"] == 1
    (high,) = summary.high_rate_by(d, ["equipment"]).collect()
    assert (high["total_loads"], high["high_rate_loads"], high["mean_rate"]) == (2, 1, 4250.0)
    (group,) = summary.group_summary(d, ["equipment"]).collect()
    assert (group["count"], group["mean"], group["median"]) == (2, 4250.0, 4250.0)
    assert one(audit.iqr_outliers(d))["outlier_count"] == 0
    assert one(summary.high_rate_only_by(d, "equipment"))["high_rate_loads"] == 1
    above, below = rows.split_by_threshold(d, K.TARGET, 7500)
    assert (above.count(), below.count()) == (1, 1)
    flags = one(refined_features(d).agg(*[F.sum(c).alias(c) for c in ("heavy_load", "market_index_high", "quote_signal_high")]))
    assert flags == {"heavy_load": 0, "market_index_high": 0, "quote_signal_high": 0}
    assert models.labeled(d).count() == 2
    table = {r["feature"]: r["high_rate"] for r in summary.compare_segments(C.without_nan(d, K.TARGET), F.col(K.TARGET) >= 7500, ["weight"]).collect()}
    assert table == {"weight": 32000.0}


def test_central_moments_keep_their_digits(spark):
    """The mean is large against the spread, so sums of squares would lose it."""
    d = spark.range(100).select(
        (F.lit(1e9) + F.col("id") % 2).alias(K.TARGET), (F.lit(1e9) + F.col("id") % 2 + 0.1).alias(K.PREDICTION),
        F.when(F.col("id") < 50, 0.2).otherwise(0.9).alias("high_probability"), F.lit(DAY).alias("date"),
    )
    cells = strategy.strategy_grid(d, [0.95], [0.5]).collect()
    assert cells[0]["R2"] == pytest.approx(1 - 0.01 / 0.25, rel=1e-6)
    window = [("w", "2025-01-01", "2025-03-01", "2025-03-31")]
    assert one(strategy.window_metrics(d, window))["R2"] == pytest.approx(1 - 0.01 / 0.25, rel=1e-6)


def test_requests_are_cleaned(spark):
    from loadlens.streaming.requests import clean_requests

    (r,) = clean_requests(loads(spark, dict(equipment=" Reefer\u00a0", pickup="  ", delivery="\tFort Wayne\n", weight=float("nan")))).collect()
    assert (r["equipment"], r["pickup"], r["delivery"], r["weight"]) == ("Reefer", None, "Fort Wayne", None)


def test_fixed_values():
    """Edges, labels and settings as published; written out here, so that a slip in the constants shows."""
    assert K.CHAMPION == (700, 0.05, 6, 5, 0.85, 0.85) and len(K.TUNING_CONFIGS) == 15
    assert K.TUNING_CONFIGS[0] == (700, 0.05, 8, 5, 0.85, 0.85) and K.TUNING_CONFIGS[-1] == (700, 0.05, 8, 5, 0.85, 1.0)
    assert (K.HIGH_RATE, K.TWO_STAGE_FACTOR, K.SPLIT_DATE) == (7500, 1.5, "2025-09-01")
    assert (K.HEAVY_LB, K.VERY_HEAVY_LB, K.INDEX_HIGH, K.INDEX_VERY_HIGH) == (35000, 40000, 1.2, 1.3)
    assert (K.SIGNAL_LOW, K.SIGNAL_HIGH, K.LONG_HAUL_MILES) == (1.735, 2.403, [500, 1000, 1500, 2000, 2500])
    assert K.RATE_LABELS[-3:] == ["7500-10000", "10000-15000", "15000+"]
    assert K.LANE == {"pickup": "Lexington", "delivery": "Fort Wayne", "distance": 360.0, "equipment": "Dry Van", "weight": 32000.0}
