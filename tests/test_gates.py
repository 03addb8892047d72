"""A clean prediction file passes every gate, and each seeded fault is caught."""

import pytest
from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.operators import buckets, gates, rows
from loadlens.sources import domains
from loadlens.sources.tables import InputError

N = 50


@pytest.fixture(scope="module")
def clean(spark):
    return domains.expected_ids(spark, N).withColumn("predicted_rate", F.substring("load_id", 4, 6).cast("double") * 10)


def at(n):
    return F.col("load_id") == f"TE-{n:06d}"


def rate(df, value):
    return df.withColumn("predicted_rate", F.when(at(7), F.lit(value)).otherwise(F.col("predicted_rate")))


FAULTS = {
    "missing_keys": lambda d: d.withColumn("load_id", F.when(~at(7), F.col("load_id"))),
    "duplicate_keys": lambda d: d.withColumn("load_id", F.when(at(7), "TE-000008").otherwise(F.col("load_id"))),
    "missing_predictions": lambda d: rate(d, None),
    "infinite_predictions": lambda d: rate(d, float("inf")),
    "non_positive_predictions": lambda d: rate(d, -1.0),
    "row_count_difference": lambda d: d.where(~at(7)),
    "extra_ids": lambda d: d.withColumn("load_id", F.when(at(7), "XX-000007").otherwise(F.col("load_id"))),
}


def test_clean_file_passes(spark, clean):
    gates.validate_predictions(clean, domains.expected_ids(spark, N), N)


@pytest.mark.parametrize("rule", FAULTS)
def test_fault_is_caught(spark, clean, rule):
    with pytest.raises(InputError, match=f"{rule}=1"):
        gates.validate_predictions(FAULTS[rule](clean), domains.expected_ids(spark, N), N)


def test_nan_prediction_is_missing(spark, clean):
    with pytest.raises(InputError, match="missing_predictions=1"):
        gates.validate_predictions(rate(clean, float("nan")), domains.expected_ids(spark, N), N)


def test_zero_prediction_depends_on_strictness(spark, clean):
    zero = rate(clean, 0.0)
    gates.validate_predictions(zero, domains.expected_ids(spark, N), N, strict=False)
    with pytest.raises(InputError, match="non_positive_predictions=1"):
        gates.validate_predictions(zero, domains.expected_ids(spark, N), N, strict=True)


def test_column_order_and_contract(spark, clean):
    with pytest.raises(InputError, match="columns"):
        gates.check_columns(clean.select("predicted_rate", "load_id"), gates.PREDICTION_COLUMNS)
    train = spark.createDataFrame([], "load_id string, posted_rate double")
    gates.check_contract(train, train.drop("posted_rate"))
    with pytest.raises(InputError):
        gates.check_contract(train, train)
    with pytest.raises(InputError):
        gates.check_contract(train.drop("posted_rate"), train.drop("posted_rate"))


def test_key_order(spark, clean):
    file = clean.withColumn("row_pos", F.substring("load_id", 4, 6).cast("int"))
    swapped = file.withColumn(
        "row_pos", F.when(at(3), 4).when(at(4), 3).otherwise(F.col("row_pos"))
    )
    assert gates.check_key_order(file, file).first()["mismatches"] == 0
    assert gates.check_key_order(file, swapped).first()["mismatches"] == 2
    assert gates.check_key_order(file, file.where(~at(9))).first()["mismatches"] == 1


def test_audit_counts_repeated_missing_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 0.0), ("a", -3.0), ("a", None)], "load_id string, predicted_rate double")
    audit = {r["metric"]: r["value"] for r in gates.submission_audit(df).collect()}
    assert list(audit) == [
        "rows", "columns", "missing_predictions", "infinite_predictions", "negative_predictions", "duplicate_load_ids",
        "minimum_prediction", "maximum_prediction", "mean_prediction", "median_prediction", "p95_prediction", "p99_prediction",
    ]
    assert audit["rows"] == 5 and audit["duplicate_load_ids"] == 3 and audit["negative_predictions"] == 1
    assert audit["missing_predictions"] == 1 and audit["median_prediction"] == 0.5


def test_empty_prediction_buckets_stay(spark, clean):
    got = buckets.bucket_counts(clean).collect()
    assert [r["rate_bucket"] for r in got] == K.PREDICTION_LABELS
    assert [r["count"] for r in got] == [50] + [0] * 7
    assert got[0]["percentage"] == 100.0
    (empty, *_) = buckets.bucket_counts(clean.limit(0)).collect()
    assert (empty["count"], empty["percentage"]) == (0, 0.0)


def test_values_outside_buckets_count_in_the_share(spark, clean):
    got = buckets.bucket_counts(rate(clean, -5.0)).collect()
    assert got[0]["count"] == 49 and got[0]["percentage"] == pytest.approx(98.0)


# ---------------------------------------------------------------- scenario


def scenario(spark):
    return domains.scenario_frame(spark).withColumn("predicted_rate", F.dayofmonth("date") * 1.0 + 800)


def on_day(df, day, **changes):
    hit = F.dayofmonth("date") == day
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in changes.items()})


SCENARIO_FAULTS = {
    "invalid_dates": dict(date=None),
    "duplicate_dates": dict(date="2025-12-02"),
    "missing_dates": dict(date="2026-01-01"),
    "extra_dates": dict(date="2026-01-01"),
    "wrong_pickup": dict(pickup="Boston"),
    "wrong_delivery": dict(delivery=None),
    "wrong_equipment": dict(equipment="Reefer"),
    "wrong_distance": dict(distance=361.0),
    "wrong_weight": dict(weight=float("nan")),
    "bad_predictions": dict(predicted_rate=0.0),
}


def test_good_scenario_comes_back_by_date(spark):
    days = [r["date"].day for r in gates.validate_scenario(scenario(spark)).collect()]
    assert days == list(range(1, 32))


@pytest.mark.parametrize("rule", SCENARIO_FAULTS)
def test_scenario_fault_is_caught(spark, rule):
    text = scenario(spark).withColumn("date", F.col("date").cast("string"))
    with pytest.raises(InputError, match=rule):
        gates.validate_scenario(on_day(text, 5, **SCENARIO_FAULTS[rule]))


def test_scenario_floor(spark):
    got = buckets.scenario_series(scenario(spark)).collect()
    assert {r["floor"] for r in got} == {801 - 801 * 0.02}
    low = buckets.scenario_series(scenario(spark).withColumn("predicted_rate", F.lit(100.0))).first()
    assert low["floor"] == 90.0


def test_keys_beyond_the_padding_stay_apart(spark, tmp_path):
    """Order keys of more digits than the padding keep all of them, on both sides of the key check."""
    from loadlens.sources import star

    rows_ = [(k, 50.0) for k in (999_998, 999_999, 1_000_000, 9_999_999, 10_000_000)]
    spark.createDataFrame(rows_, "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    made = star.submission(spark, str(tmp_path))
    assert {r["load_id"] for r in made.collect()} == {f"TE-{k + 1:06d}" for k, _ in rows_}
    want = spark.createDataFrame([(f"TE-{k + 1:06d}",) for k, _ in rows_], "load_id string")
    assert rows.key_diff(made, want).collect() == []
