"""Models: closed form, learning, importance, replay, storage, unseen categories, time windows."""

import datetime

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.functions.features import (
    BASE_CATEGORICAL, BASE_NUMERIC, FEATURE_INPUTS, REFINED_CATEGORICAL, REFINED_NUMERIC, create_features, refined_features, sources,
)
from loadlens.operators import evaluate, rows, strategy
from loadlens.operators.quantiles import group_stats
from loadlens.plans import models, scoring, validation
from loadlens.plans.catalog import SPLIT, WINDOWS
from loadlens.sources import domains, star

FAST = dict(trees=4, rate=0.4, depth=4)


@pytest.fixture(scope="module")
def loads(spark, sf_dir):
    return star.loads(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def parts(loads):
    return rows.time_split(create_features(loads), SPLIT)


@pytest.fixture(scope="module")
def model(parts):
    return models.fit_rate_model(parts[0], models.gbt(**FAST), log_target=True)


@pytest.mark.parametrize("solver", ["normal", "l-bfgs"])
def test_ridge_is_the_closed_form(spark, solver):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3)) * [1, 10, 100]
    y = x @ [3.0, -2.0, 0.5] + 7 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, posted_rate double")
    fitted = models.fit_rate_model(df, numeric=["a", "b", "c"], categorical=[], alpha=10.0, solver=solver).stages[-2]
    centred = x - x.mean(0)
    want = np.linalg.solve(centred.T @ centred + 10.0 * np.eye(3), centred.T @ (y - y.mean()))
    assert fitted.coefficients.toArray() == pytest.approx(want, rel=1e-6)
    assert fitted.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-6)


def test_boosting_beats_the_mean(parts, model):
    train, valid = parts
    mean = train.agg(F.avg(K.TARGET)).first()[0]
    both = evaluate.metrics_of(
        model.transform(valid).withColumn("mean", F.lit(mean)), {"model": K.PREDICTION, "mean": "mean"}
    )
    mae = {r["model"]: r["MAE"] for r in both.collect()}
    assert mae["model"] < 0.5 * mae["mean"]
    assert model.transform(valid).where(F.col(K.PREDICTION) < 0).count() == 0


def test_same_seed_same_model(parts, model):
    train, valid = parts
    again = models.fit_rate_model(train, models.gbt(**FAST), log_target=True)
    a, b = ([r[0] for r in m.transform(valid).orderBy("load_id", "date").select(K.PREDICTION).collect()] for m in (model, again))
    assert a == pytest.approx(b, rel=1e-9)


def test_training_rows_do_not_depend_on_the_machine(parts):
    """The same rows in another order and partitioning are dealt out in the same way."""
    rows_ = parts[0].select(*BASE_NUMERIC, "route")
    dealt = [
        models.settled_rows(r).select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), F.xxhash64("*").alias("h"))
        for r in (rows_, rows_.repartition(3, "distance"))
    ]
    a, b = (sorted(map(tuple, d.collect())) for d in dealt)
    assert a == b and len({x[0] for x in a}) == 8


def _shuffles(df):
    """Exchanges that run when the frame is read."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.mark.parametrize("onehot", [False, True])
def test_training_rows_are_shuffled_once(parts, onehot):
    """Passes of a learner read the rows as they were dealt out, a bucket in each partition, without another shuffle."""
    seen = []

    def fit(prepared):
        seen.append(prepared)
        return models.fit_learner(prepared, models.gbt(trees=1, depth=1))

    models.fit_rate_model(parts[0], onehot=onehot, fit=fit, derive=create_features)
    (prepared,) = seen
    assert prepared.rdd.getNumPartitions() == 8
    text = prepared.select(models.FEATURES, models.LABEL)
    assert _shuffles(text.where(F.col(models.LABEL) < 0)) == 0


@pytest.mark.parametrize("onehot", [False, True])
def test_features_derived_anew_are_those_that_were_stored(parts, onehot):
    """Only inputs are stored where the features can be derived; the prepared rows are the same, gaps included."""
    train = parts[0].withColumn("weight", F.when(F.col("distance") > 1500, None).otherwise(F.col("weight")))
    seen = []
    for derive in (None, create_features):
        fit = lambda p: seen.append(p) or models.fit_learner(p, models.gbt(trees=1, depth=1))
        numeric, categorical = ["weight", "distance", "weight_log", "month"], ["route", "equipment"]
        models.fit_rate_model(create_features(train), None, numeric, categorical, onehot=onehot, fit=fit, derive=derive)
    a, b = (sorted(map(tuple, p.select(F.spark_partition_id(), F.xxhash64(vector_to_array(models.FEATURES), models.LABEL)).collect())) for p in seen)
    assert a == b


def test_levels_are_coded_by_their_mean_label(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("a", 10.0)] * 10 + [("b", 0.0)] * 10, f"c string, {models.LABEL} double")
    stages, (coded,) = models.category_stages(["c"], onehot=False)
    got = Pipeline(stages=stages).fit(train).transform(spark.createDataFrame([("a",), ("b",), ("z",)], "c string"))
    assert [r[coded] for r in got.orderBy("c").collect()] == [7.5, 2.5, 5.0]


def test_importance(parts, model):
    native = models.feature_importance(model, parts[0])
    total = native.agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)
    grouped = models.aggregate_importance(native)
    assert {r["feature_group"] for r in grouped.collect()} == {*BASE_NUMERIC, *BASE_CATEGORICAL}
    folded = models.aggregate_importance(native, [*BASE_CATEGORICAL, *BASE_NUMERIC])
    assert folded.where("feature_group = 'distance'").first()["importance"] >= grouped.where(
        "feature_group = 'distance'"
    ).first()["importance"]
    assert not folded.where("feature_group = 'pickup_lat'").count()


def test_onehot_importance_names_levels(parts):
    one_hot = models.fit_rate_model(parts[0], models.gbt(trees=1, depth=2), onehot=True)
    native = models.feature_importance(one_hot, parts[0]).collect()
    names = {r["feature"]: r["source"] for r in native}
    assert names["equipment__level_Reefer"] == "equipment"
    assert set(names.values()) == {*BASE_NUMERIC, *BASE_CATEGORICAL}


def test_permutation_importance_finds_distance(parts, model):
    got = models.permutation_importance(model, parts[1], n=100, repeats=2).collect()
    assert len(got) == 36 and got[0]["feature"] == "distance" and got[0]["importance_mean"] > 0
    native = models.aggregate_importance(models.feature_importance(model, parts[0])).collect()
    unused = {r["feature_group"] for r in native if r["importance"] == 0}
    assert unused and all(abs(r["importance_mean"]) < 1e-6 for r in got if r["feature"] in unused)


def test_unseen_category_is_the_zero_vector(spark):
    from pyspark.ml import Pipeline

    stages, (coded,) = models.category_stages(["c"], onehot=True)
    coder = Pipeline(stages=stages).fit(spark.createDataFrame([("a",), ("b",)], "c string"))
    got = coder.transform(spark.createDataFrame([("a",), ("z",)], "c string")).select(vector_to_array(coded)).collect()
    assert [sum(r[0]) for r in got] == [1.0, 0.0] and len(got[0][0]) == 2


def test_unseen_category_and_missing_values_are_scored(parts, model):
    odd = parts[1].limit(5).withColumns({"pickup": F.lit("Nowhere"), "route": F.lit("x"), "weight": F.lit(None).cast("double")})
    assert model.transform(odd).where(F.col(K.PREDICTION).isNotNull()).count() == 5


def test_fill_values_come_from_training_rows_only(spark):
    filler = models.MissingFiller(["v"], ["c"]).fit(spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, None)], "v double, c string"))
    got = filler.transform(spark.createDataFrame([(None, None), (100.0, "z")], "v double, c string")).collect()
    assert [tuple(r) for r in got] == [(2.0, "a"), (100.0, "z")]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], f"{models.LABEL} double")
    sums = models.with_balanced_weights(df).groupBy(models.LABEL).agg(F.sum(models.WEIGHT).alias("w")).collect()
    assert [r["w"] for r in sums] == pytest.approx([2.0, 2.0])


def test_classifier_gives_probabilities(parts):
    high = models.fit_high_rate_classifier(parts[0], models.rf_classifier(trees=5, depth=4))
    got = high.transform(parts[0]).select("high_probability", C_high().alias("label"))
    span = got.agg(F.min("high_probability"), F.max("high_probability")).first()
    assert 0 <= span[0] < span[1] <= 1
    auc = evaluate.roc_auc(got.withColumnRenamed("high_probability", "score")).first()["roc_auc"]
    assert auc > 0.7


def C_high():
    return F.when(F.col(K.TARGET) >= K.HIGH_RATE, 1).otherwise(0)


def test_stored_model_scores_the_same(spark, loads, tmp_path):
    train, valid = rows.time_split(loads, SPLIT)
    fitted = scoring.train_final(train, valid.drop(K.TARGET), models.gbt(**FAST))
    scoring.save_model(fitted, str(tmp_path / "model"))
    loaded = scoring.load_model(str(tmp_path / "model"))
    a, b = (sorted(scoring.score(valid.drop(K.TARGET), m).collect()) for m in (fitted, loaded))
    assert a == b and len(a) == valid.count()
    lane = scoring.score_scenario(domains.scenario_frame(spark), loaded)
    assert lane.columns == K.SCENARIO_COLUMNS and lane.where("predicted_rate > 0").count() == 31


def test_rolling_windows_fit_on_the_past(parts, loads):
    seen = []

    def fit(train):
        seen.append(train.agg(F.max("date")).first()[0].isoformat())
        return models.fit_rate_model(train, models.gbt(trees=1, depth=2))

    windows = [*WINDOWS[:2], ("Empty", "1980-01-01", "1980-01-02", "1980-01-31")]
    predictions, metrics = validation.rolling_validate(create_features(loads), fit, windows)
    got = metrics.collect()
    assert [r["window"] for r in got] == ["July", "August"]
    assert seen[0] <= "2001-06-30" and seen[1] <= "2001-07-31"
    counts = {r["window"]: r["valid_rows"] for r in strategy.window_counts(loads, windows).collect()}
    assert predictions.count() == counts["July"] + counts["August"]
    # each window trains on the rows before it: the next one adds exactly this window's rows
    assert got[1]["train_rows"] == got[0]["train_rows"] + got[0]["valid_rows"]


def test_tuning_ranks_configurations(parts):
    configs = [(100, 0.1, 2, 5, 1.0, 1.0), (100, 0.9, 4, 5, 1.0, 1.0)]
    got = validation.tune(*parts, configs=configs, tree_share=0.02).collect()
    assert [r["MAE"] for r in got] == sorted(r["MAE"] for r in got)
    assert {r["n_estimators"] for r in got} == {2} and {r["config"] for r in got} == {1, 2}


ODD_INPUTS = (
    "pickup string, delivery string, pickup_lat double, pickup_lon double, delivery_lat double, delivery_lon double, "
    "distance double, equipment string, weight double, date date, market_index double, quote_signal double"
)
SETS = [(create_features, BASE_NUMERIC, BASE_CATEGORICAL), (refined_features, REFINED_NUMERIC, REFINED_CATEGORICAL)]


@pytest.fixture(scope="module")
def odd_inputs(spark):
    """Inputs with repeats, gaps, NaN, zeros and negative values."""
    rng = np.random.default_rng(11)
    numbers = [None, float("nan"), 0.0, -3.0, 0.5, 1.25, 2.0, 45000.0, 700.0]
    some = lambda values: values[rng.integers(len(values))]
    days = [None, *(datetime.date(2001, m, 3 * m) for m in range(1, 10))]
    made = []
    for _ in range(120):
        places = [some(numbers) for _ in range(4)]
        made.append((some([None, "a", "b"]), some([None, "a", "c"]), *places, some(numbers), some(["x", "y", None]), some(numbers), some(days), some(numbers), some(numbers)))
    return spark.createDataFrame(made * 2, ODD_INPUTS)


@pytest.mark.parametrize("derive, numeric, categorical", SETS)
def test_fills_from_counts_of_inputs_are_those_of_all_rows(odd_inputs, derive, numeric, categorical):
    fills = lambda df: {r["column"]: r["fill"] for r in df.collect()}
    features = derive(odd_inputs)
    assert fills(models.medians(odd_inputs, numeric, derive)) == fills(models.medians(features, numeric))
    assert fills(models.modes(odd_inputs, categorical, derive)) == fills(models.modes(features, categorical))


@pytest.mark.parametrize("derive, numeric, categorical", SETS)
def test_features_are_derived_once_for_equal_inputs(odd_inputs, derive, numeric, categorical):
    """Fills look at the different inputs of a group of features, once for each feature, not at every row."""
    found = models.derived_counts(odd_inputs, [*numeric, *categorical], derive)
    assert sorted(c for _, own in found for c in own) == sorted([*numeric, *categorical])
    for counted, own in found:
        assert counted.agg(F.sum("_n")).first()[0] == odd_inputs.count()
        assert counted.count() <= odd_inputs.distinct().count()
    dates = next(counted for counted, own in found if "month_sin" in own)
    assert dates.count() == odd_inputs.select("date").distinct().count()


@pytest.mark.parametrize("derive, numeric, categorical", SETS)
def test_features_are_made_of_the_named_inputs_alone(odd_inputs, derive, numeric, categorical):
    alone = sources(derive)
    whole = derive(odd_inputs)
    for inputs in {alone[c] for c in [*numeric, *categorical]}:
        own = [c for c in [*numeric, *categorical] if alone[c] == inputs]
        part = derive(models.with_missing(odd_inputs.select(*inputs), odd_inputs, FEATURE_INPUTS))
        values = lambda df: sorted(map(str, df.select(*own).collect()))  # noqa: B023, E731
        assert values(part) == values(whole)


def test_quantiles_of_counted_rows(spark):
    counted = spark.createDataFrame([("a", 1.0, 3), ("a", 5.0, 2), ("a", None, 9), ("b", None, 4)], "k string, v double, n long")
    found = group_stats(counted, ["k"], [], of="v", quantiles={"q": 0.5, "r": 0.75}, times="n")
    assert sorted(map(tuple, found.collect())) == [("a", 1.0, 5.0), ("b", None, None)]


def test_parts_of_training_rows_grow_slower_than_the_rows(spark):
    """Each part sends the statistics of all nodes, so parts of a fixed size would send bytes in proportion to the rows."""
    few = models.settled_rows(spark.range(50).select("id"), total=600_000)
    many = models.settled_rows(spark.range(50).select("id"), total=60_000_000)
    assert few.rdd.getNumPartitions() == 8 and 8 < many.rdd.getNumPartitions() <= 100
    assert many.count() == few.count() == 50
