"""Boosted trees of binned rows: exact splits by brute force, one-hot columns as levels, reruns, margins stored on the way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.operators import evaluate
from loadlens.plans import binned, models


def _table(spark, n=3000):
    rng = np.random.default_rng(3)
    names = [f"l{i}" for i in range(12)]
    data = [(f"k{i}", float(rng.integers(0, 40)), float(rng.integers(-50, 50)) / 25, names[int(rng.integers(0, 12))]) for i in range(n)]
    df = spark.createDataFrame(data, "load_id string, a double, b double, place string")
    rate = 100 + 5 * F.col("a") + 80 * (F.col("place") == "l3").cast("double") + 20 * (F.col("b") > 0.4).cast("double")
    return df.withColumn("posted_rate", rate)


def _fit(df, onehot=True, log_target=False, **settings):
    return models.fit_rate_model(df, models.gbt(**({"trees": 3, "rate": 0.5, "depth": 3, "rows": 1.0, "cols": 1.0} | settings)), ["a", "b"], ["place"], log_target, onehot)


def _text(model):
    return model.stages[-2].toDebugString.split("\n", 1)[1]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(models, "CELLS", 0)


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_the_trees_are_those_of_sparks_learner(spark, monkeypatch, loss):
    """Without draws both learners choose the same splits; the one-hot columns are never made."""
    df = _table(spark)
    learners = _fit(df, loss=loss)
    monkeypatch.setattr(models, "CELLS", 0)
    own = _fit(df, loss=loss)
    a, b = (m.transform(df).agg(F.sum("predicted_rate"), F.sum(F.col("predicted_rate") * F.col("a"))).first() for m in (learners, own))
    assert list(a) == pytest.approx(list(b), rel=1e-6)
    assert learners.stages[-2].featureImportances.toArray() == pytest.approx(own.stages[-2].featureImportances.toArray(), abs=1e-6)
    mae = [evaluate.regression_metrics(m.transform(df)).first()["MAE"] for m in (learners, own)]
    assert mae[0] == pytest.approx(mae[1], rel=1e-6)


def test_wide_rows_are_not_handed_to_sparks_learner(spark, monkeypatch, small):
    """The learner caches a number for each one-hot column of each row, so beyond CELLS it must not be asked."""

    def refuse(*_, **__):
        raise AssertionError("rows as vectors")

    monkeypatch.setattr(models, "fit_learner", refuse)
    df = _table(spark, 400)
    model = _fit(df)
    assert model.transform(df).where("predicted_rate > 0").count() == 400 and model.stages[-2].numFeatures == 14


def test_reruns_agree_however_rows_are_dealt(spark, small):
    df = _table(spark)
    fits = [_fit(rows, rows=0.7, cols=0.6, trees=4) for rows in (df, df.repartition(7), df.orderBy("b"))]
    assert _text(fits[0]) == _text(fits[1]) == _text(fits[2])


def test_margins_stored_on_the_way_change_nothing(spark, small, monkeypatch):
    df = _table(spark, 600)
    whole = _fit(df, trees=5)
    monkeypatch.setattr(binned, "KEEP_TREES", 2)
    assert _text(_fit(df, trees=5)) == _text(whole)
    monkeypatch.setattr(binned, "SUMS", 1)
    assert _text(_fit(df, trees=5)) == _text(whole)


def test_stored_model_and_odd_rows(spark, small, tmp_path):
    """Missing values, unknown levels and a single label; a stored model scores the same."""
    df = _table(spark, 300)
    gaps = df.withColumns({"a": F.when(F.col("a") > 5, F.col("a")), "place": F.when(F.col("place") != "l1", F.col("place"))})
    model = _fit(gaps)
    model.write().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    new = gaps.withColumn("place", F.lit("elsewhere"))
    assert model.transform(new).select("predicted_rate").collect() == again.transform(new).select("predicted_rate").collect()
    same = _fit(df.withColumn("posted_rate", F.lit(250.0)))
    assert {r[0] for r in same.transform(df).select("predicted_rate").collect()} == {250.0}
    assert all(t.depth == 0 for t in same.stages[-2].trees)


def test_thresholds_lie_between_values():
    few = binned.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 256)
    assert few.tolist() == [1.5, 2.5]
    many = binned.thresholds(np.arange(10_000.0), np.ones(10_000), 256)
    assert len(many) == 255 and np.diff(many).max() <= 80
    # a value with most rows does not use up the thresholds of the others
    hot = binned.thresholds(np.arange(1000.0), np.where(np.arange(1000) == 0, 1e6, 1.0), 16)
    assert 1 <= len(hot) < 16


def _numeric(spark, n=2000):
    rows = _table(spark, n).select("a", "b", F.length("place").cast("double").alias("c"), F.log("posted_rate").alias("_label"))
    return rows.withColumn(binned.ROW, F.xxhash64("a", "b", "c"))


def test_trees_of_one_task_are_those_of_jobs(spark, monkeypatch):
    """Draws, losses and margins included; a deep tree is more than one job for a level."""
    rows = _numeric(spark).repartition(3)
    ends = rows.agg(F.min("_label"), F.max("_label")).first()
    made = binned.cells(rows, ["a", "b", "c"], {}, (2000, *ends))
    monkeypatch.setattr(binned, "KEEP_TREES", 2)
    monkeypatch.setattr(binned, "SUMS", 400)
    for loss in ("squared", "absolute"):
        learner = models.gbt(trees=5, rate=0.3, depth=5, rows=0.8, cols=0.7, loss=loss)
        both = [binned.fitted(made, learner)]
        monkeypatch.setattr(binned, "TASK_ROWS", 0)
        both.append(binned.fitted(made, learner))
        monkeypatch.undo()
        text = [[(w, t.column, t.cut, t.left, t.right, t.mean().tolist()) for w, t in trees] for trees in both]
        assert text[0] == text[1] and max(t.depth() for _, t in both[0]) == 5
    scored = binned.predicted(rows, made, both[0], "_label").agg(F.avg(F.abs(F.col("prediction") - F.col("_label"))), F.count("_label")).first()
    assert scored[1] == 2000 and scored[0] < 0.5


def test_level_means_of_large_tables_are_those_of_small(spark, monkeypatch):
    """Means from sums of whole numbers, without dealing rows out; missing texts and labels of both signs."""
    df = _table(spark, 900).withColumn("place", F.when(F.col("place") != "l1", F.col("place")))
    df = df.withColumn("posted_rate", F.col("posted_rate") - 150)
    found = []
    for cells in (10**9, 0):
        monkeypatch.setattr(models, "CELLS", cells)
        model = _fit(df, onehot=False)
        assert model.stages[-2].numFeatures == 3
        found.append({r["level"]: (r["mean"], len(r["without"])) for r in model.stages[1].levels.collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) == 11
    assert all(found[0][k] == pytest.approx(found[1][k], rel=1e-9) for k in found[0])


def test_tuning_query_fits_all_trees(monkeypatch):
    """The query gives no share of trees, so every configuration has those that it names."""
    from loadlens.plans import catalog, validation

    asked = {}
    monkeypatch.setattr(catalog, "_split", lambda *_: ("train", "valid"))
    monkeypatch.setattr(validation, "tune", lambda *a, **k: asked.update(k))
    catalog.QUERIES["tuning"](None, None)
    assert "tree_share" not in asked and "configs" not in asked
