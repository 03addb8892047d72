"""Exact samples and numbers without one task, permutations, rescued cells, dead letters, rounds, levels as a table."""

import math
import threading
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.functions.features import create_features
from loadlens.operators import audit, buckets, gates, incremental, rows
from loadlens.plans import models, parallel, rounds, validation
from loadlens.plans.catalog import SPLIT, WINDOWS
from loadlens.plans.parallel import in_parallel
from loadlens.sources import star, tables
from loadlens.streaming import requests
from tests.test_plans import plan

# ---------------------------------------------------------------- samples, numbers, permutations


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 2000])
def test_sample_is_the_first_n_of_the_draws(spark, n):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("load_id"), F.col("id").alias("v"))
    draw = F.md5(F.concat_ws("|", F.lit("42"), "load_id"))
    expected = [r["v"] for r in df.withColumn("d", draw).orderBy("d").limit(n).collect()]
    sample = rows.sample_n(df, n)
    assert sorted(r["v"] for r in sample.collect()) == sorted(expected)
    text = plan(rows.sample_n(df, 500))
    assert "TakeOrdered" not in text and "SinglePartition" not in text and "Sort" not in text


def test_sample_of_repeated_keys_and_rows(spark):
    """A key with most rows, and rows that are equal in all columns."""
    data = [("hot", i % 4, None) for i in range(300)] + [(f"k{i}", i, "x") for i in range(100)]
    df = spark.createDataFrame(data, "load_id string, v int, w string")
    have = Counter(data)
    for n in range(0, 401, 23):
        got = [tuple(r) for r in rows.sample_n(df, n).collect()]
        assert len(got) == n and not Counter(got) - have
        assert sorted(got, key=str) == sorted(map(tuple, rows.sample_n(df.repartition(5), n).collect()), key=str)
    assert rows.sample_n(df.limit(0), 3).collect() == []


def test_numbers_in_many_tasks(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("hot"))
    got = rows.numbered(df, "v").orderBy("row_pos").collect()
    assert [r["row_pos"] for r in got] == list(range(20_000)) and [r["v"] for r in got] == sorted(r["v"] for r in got)
    hot = rows.numbered(df, "hot", parts=8)
    found = hot.orderBy("row_pos").collect()
    assert [r["hot"] for r in found] == sorted(r["hot"] for r in found)
    spread = hot.where("hot = 0").groupBy(F.input_file_name()).count().collect()
    assert len(spread) > 1  # the frequent key is in many tasks
    assert "Window" not in plan(hot)
    template = rows.numbered(df, "v").withColumnRenamed("v", "load_id")
    assert tuple(gates.check_key_order(template, template.repartition(3)).first()) == (20_000, 0)
    assert rows.numbered(df.limit(0), "v").collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 90, 1000, 4099])
def test_permutations(spark, n):
    ids = spark.range(n)
    both = ids.select(*[rows.permuted("id", n, F.lit(s)).alias(s) for s in ("a", "b")]).collect()
    assert sorted(r["a"] for r in both) == sorted(r["b"] for r in both) == list(range(n))
    if n > 50:
        assert [r["a"] for r in both] != [r["b"] for r in both]
        moved = np.array([r["a"] for r in both])
        assert abs(np.corrcoef(moved, np.arange(n))[0, 1]) < 4 / math.sqrt(n)


# ---------------------------------------------------------------- importance


def test_permutation_importance_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    data = [(f"k{i:03d}", float(rng.normal()), float(rng.normal()), float(rng.normal() + 100)) for i in range(137)]
    df = spark.createDataFrame(data, "load_id string, a double, b double, posted_rate double")
    model = PipelineModel([SQLTransformer(statement="SELECT *, 100 + 3 * a + b AS predicted_rate FROM __THIS__")])
    got = {r["feature"]: r for r in models.permutation_importance(model, df, ["a", "b"], repeats=3).collect()}
    a, b, y = (np.array([r[i] for r in data]) for i in (1, 2, 3))
    base = np.abs(100 + 3 * a + b - y).mean()
    for name in ("a", "b"):
        rises = []
        for r in (1, 2, 3):
            to = [x[0] for x in spark.range(137).select("id", rows.permuted("id", 137, F.lit(f"42|{name}|{r}")).alias("to")).orderBy("id").select("to").collect()]
            mixed = {"a": a.copy(), "b": b.copy()}
            mixed[name][to] = {"a": a, "b": b}[name]
            rises.append(np.abs(100 + 3 * mixed["a"] + mixed["b"] - y).mean() - base)
        assert got[name]["importance_mean"] == pytest.approx(np.mean(rises))
        assert got[name]["importance_std"] == pytest.approx(np.std(rises))


def test_a_trial_shuffles_a_number_and_a_value(spark):
    wide = spark.range(3000).select(F.col("id").cast("string").alias("load_id"), *[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(12)])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored, total, name = models._by_number(wide, ["load_id"])
        text = plan(models.trials(stored, total, "c3", 2, 1))
        assert text.count("\n(") and sum(line.strip().startswith("+- Exchange") or " Exchange (" in line for line in text.split("\n\n")[0].splitlines()) == 1
        spark.sql(f"DROP TABLE {name}")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_trial_gathers_nothing_on_the_driver(spark):
    """At any size: the values sent are the rows of the table, five times over, and are not broadcast."""
    wide = spark.range(300).select(F.col("id").cast("string").alias("load_id"), F.col("id").cast("double").alias("c"))
    stored, total, name = models._by_number(wide, ["load_id"])
    text = plan(models.trials(stored, total, "c", 5, 1))
    spark.sql(f"DROP TABLE {name}")
    assert "Broadcast" not in text and "SortMergeJoin" in text


# ---------------------------------------------------------------- rounds and parallel fits


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = 3 * x[:, 0] - np.abs(x[:, 1]) * 2 + rng.normal(size=600) * 0.1
    from pyspark.ml.linalg import Vectors

    frame = spark.createDataFrame([(Vectors.dense(r), float(t), float(t > 0)) for r, t in zip(x.tolist(), y)], [models.FEATURES, models.LABEL, "up"])
    return frame.repartition(2).cache()


def predictions(model, frame):
    return [r["prediction"] for r in model.transform(frame).select("prediction").collect()]


def test_boosting_goes_on_after_the_last_whole_round(spark, prepared, tmp_path):
    whole = rounds.boost(prepared, str(tmp_path / "a"), trees=10, per_round=4, depth=3, rate=0.3)
    with pytest.raises(rounds.Stopped):
        rounds.boost(prepared, str(tmp_path / "b"), trees=10, per_round=4, depth=3, rate=0.3, rounds=1)
    assert rounds.rounds_done(spark, str(tmp_path / "b")) == 1
    # a round that was cut off: its model is there, its mark is not
    (tmp_path / "b" / "round-0002" / "model").mkdir(parents=True)
    kept = (tmp_path / "b" / "round-0001" / "model" / "metadata" / "_SUCCESS").stat().st_mtime_ns
    again = rounds.boost(prepared, str(tmp_path / "b"), trees=10, per_round=4, depth=3, rate=0.3)
    assert (tmp_path / "b" / "round-0001" / "model" / "metadata" / "_SUCCESS").stat().st_mtime_ns == kept
    assert whole.getNumTrees == again.getNumTrees == 10
    assert predictions(whole, prepared) == predictions(again, prepared)
    assert sum(whole.featureImportances.toArray()) == pytest.approx(1)
    y = np.array([r[0] for r in prepared.select(models.LABEL).collect()])
    error = np.abs(np.array(predictions(again, prepared)) - y).mean()
    at_once = models.fit_learner(prepared, models.gbt(trees=10, depth=3, rate=0.3))
    assert error < 1.2 * np.abs(np.array(predictions(at_once, prepared)) - y).mean()
    again.write().save(str(tmp_path / "model"))
    assert predictions(type(again).load(str(tmp_path / "model")), prepared) == predictions(again, prepared)


@pytest.mark.parametrize("kind", ["regressor", "classifier"])
def test_forests_grow_in_rounds(prepared, tmp_path, kind):
    frame = prepared if kind == "regressor" else prepared.withColumn(models.LABEL, F.col("up")).withColumn(models.WEIGHT, F.lit(1.0))
    learner = models.rf_regressor(trees=7, depth=4) if kind == "regressor" else models.rf_classifier(trees=7, depth=4)
    whole = rounds.grow(frame, str(tmp_path / "a"), learner, per_round=3)
    with pytest.raises(rounds.Stopped):
        rounds.grow(frame, str(tmp_path / "b"), learner, per_round=3, rounds=2)
    again = rounds.grow(frame, str(tmp_path / "b"), learner, per_round=3)
    assert whole.getNumTrees == again.getNumTrees == 7
    assert predictions(whole, frame) == predictions(again, frame)


def test_tasks_run_at_a_time_in_pools_of_their_own(spark):
    import threading

    meet = threading.Barrier(3, timeout=20)

    def task(i):
        meet.wait()
        return i, spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.range(10).count()

    got = in_parallel(spark, [lambda i=i: task(i) for i in range(3)], width=3, pool="p")
    assert got == [(i, f"p-{i}", 10) for i in range(3)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(ZeroDivisionError):
        in_parallel(spark, [lambda: 1 // 0, lambda: 1])


def test_tuning_at_a_time_equals_one_after_another(spark, sf_dir, tmp_path):
    train, valid = rows.time_split(create_features(star.loads(spark, sf_dir)), SPLIT)
    configs = [(100, 0.1, 2, 5, 0.8, 0.85), (100, 0.9, 4, 5, 0.8, 1.0), (150, 0.3, 3, 5, 1.0, 0.7)]
    one, many = (validation.tune(train, valid, configs, 0.03, parallel=p).collect() for p in (1, 3))
    assert [tuple(r)[:7] for r in one] == [tuple(r)[:7] for r in many]
    assert [tuple(r)[7:] for r in one] == [pytest.approx(tuple(r)[7:], rel=1e-12) for r in many]
    kept = validation.tune(train, valid, configs, 0.03, folder=str(tmp_path), per_round=2).collect()
    again = validation.tune(train, valid, configs, 0.03, folder=str(tmp_path), per_round=2).collect()
    assert [r["config"] for r in kept] == [r["config"] for r in again]
    assert [r["MAE"] for r in kept] == pytest.approx([r["MAE"] for r in again], rel=1e-12)


def test_windows_are_fitted_as_memory_allows(spark, sf_dir, monkeypatch):
    """Fits keep their rows in memory; where it holds those of one fit, one runs at a time."""
    loads = star.loads(spark, sf_dir)
    lock, running, most = threading.Lock(), [0], []

    def fit(train):
        with lock:
            running[0] += 1
            most.append(running[0])
        time.sleep(0.5)
        with lock:
            running[0] -= 1
        return PipelineModel([SQLTransformer(statement="SELECT *, 1.8D * distance AS predicted_rate FROM __THIS__")])

    for memory, together in ((1 << 40, True), (1, False)):
        monkeypatch.setattr(parallel, "storage_bytes", lambda _, m=memory: m)
        most.clear()
        validation.rolling_validate(loads, fit, WINDOWS, parallel=4)
        assert len(most) == 4 and (max(most) > 1) == together
    monkeypatch.undo()
    assert parallel.fits_at_once(spark, 10, 36, 8) == 8
    assert parallel.fits_at_once(spark, 10**13, 36, 8) == 1


def test_windows_read_their_months(spark, sf_dir, tmp_path):
    loads = star.loads(spark, sf_dir)
    stored = validation.store_by_month(loads, str(tmp_path / "m"))
    part = validation.in_months(stored, "2001-07-01", "2001-07-31")
    text = plan(part.select("load_id"))
    assert "PartitionFilters: [isnotnull(_month" in text and "(_month" in text
    assert part.count() == rows.between_dates(loads, "2001-07-01", "2001-07-31").count()
    assert part.columns == loads.columns
    assert validation.in_months(stored, None, "2001-06-30").count() == loads.where("date <= '2001-06-30'").count()


# ---------------------------------------------------------------- levels


def test_a_row_does_not_see_its_own_label(spark):
    """Random labels and many levels of few rows: nothing can be learned, and nothing is."""
    rng = np.random.default_rng(2)
    data = [(f"l{rng.integers(0, 1500)}", float(i), float(rng.normal())) for i in range(3000)]
    df = spark.createDataFrame(data, "c string, v double, posted_rate double")
    train, test = df.where("v < 2000"), df.where("v >= 2000")
    model = models.fit_rate_model(train.drop("v"), models.gbt(trees=10, depth=3, rate=0.3, rows=1.0, cols=1.0), [], ["c"])
    # rates are floored at zero, so compare the raw prediction
    raw = PipelineModel(model.stages[:-1])
    for part in (test,):
        r2 = part.transform(raw.transform).agg((1 - F.sum((F.col("posted_rate") - F.col("prediction")) ** 2) / F.sum(F.col("posted_rate") ** 2)).alias("r2")).first()[0]
        assert abs(r2) < 0.15
    rows_ = models.with_folds(models.labeled(train).select("c", models.LABEL).withColumn("v", F.monotonically_increasing_id()), ["v"])
    coder = models.LevelMeans(["c"], ["m"]).fit(rows_)
    seen = coder.transform(rows_.drop(models.FOLD)).corr("m", models.LABEL)
    unseen = coder.transform(rows_).corr("m", models.LABEL)
    assert seen > 0.5 and abs(unseen) < 0.15


def test_out_of_fold_means_equal_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = [(str(rng.choice(["a", "b", "c"])), i, float(rng.normal() + 5)) for i in range(60)] + [("once", 99, 9.0), (None, 100, 1.0)]
    df = models.with_folds(spark.createDataFrame(data, f"c string, i long, {models.LABEL} double"), ["i"])
    coder = models.LevelMeans(["c"], ["m"]).fit(df)
    table = df.collect()
    for r in coder.transform(df).collect():
        others = [x[models.LABEL] for x in table if x["_fold"] != r["_fold"]]
        own = [x[models.LABEL] for x in table if x["_fold"] != r["_fold"] and x["c"] == r["c"] and r["c"] is not None]
        prior = sum(others) / len(others)
        assert r["m"] == pytest.approx((sum(own) + 10 * prior) / (len(own) + 10))
    pipeline = Pipeline(stages=[models.LevelMeans(["c"], ["m"])]).fit(df)
    pipeline.write().save(str(tmp_path / "p"))
    fresh, loaded = (sorted(m.transform(df.drop("_fold")).select("i", "m").collect()) for m in (pipeline, PipelineModel.load(str(tmp_path / "p"))))
    assert fresh == loaded


# ---------------------------------------------------------------- rescued cells and dead letters


def test_rescued_cells(spark, tmp_path):
    (tmp_path / "in").mkdir()
    head = "load_id,weight,date,equipment\n"
    (tmp_path / "in" / "a.csv").write_text(head + "1,5,2024-01-01,x\n2,heavy,2024-13-01,x\n3,heavy,,\n4,NaN,2024-01-02,y\n")
    (tmp_path / "in" / "b.csv").write_text(head + "5,heavy,2024-01-01,x\n6,7\n7,8,2024-01-01,x,more\n")
    loads, rescued = tables.read_with_rescue(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, rescued.collect())) == [
        ("a.csv", "date", "2024-13-01", 1), ("a.csv", "weight", "NaN", 1), ("a.csv", "weight", "heavy", 2),
        ("b.csv", "(row)", "6,7", 1), ("b.csv", "(row)", "7,8,2024-01-01,x,more", 1), ("b.csv", "weight", "heavy", 1),
    ]
    assert loads.count() == 7 and loads.where("weight is not null").count() == 3
    assert sorted(map(str, loads.collect())) == sorted(map(str, tables.read_loads(spark, str(tmp_path / "in"), fmt="csv").collect()))


def test_dead_letters_after_restarts(spark, sf_dir, tmp_path):
    loads = star.loads(spark, sf_dir).limit(400).withColumn("load_id", F.when(F.rand(1) < 0.1, None).otherwise(F.col("load_id")))
    inbox, out, bad, checkpoint = (str(tmp_path / x) for x in ("in", "out", "bad", "checkpoint"))
    loads.repartition(3).write.parquet(inbox)
    model = PipelineModel([SQLTransformer(statement="SELECT *, if(distance > 2500, NULL, 1.5D * distance - 500) AS predicted_rate FROM __THIS__")])
    live = lambda: requests.request_stream(spark, inbox, spark.read.parquet(inbox).schema, files_per_trigger=1)
    failed = []

    def lost(number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("driver lost between the two writes")

    with pytest.raises(Exception):  # noqa: B017
        requests.run_with_dead_letters(live(), model, out, bad, checkpoint, lost)
    for _ in range(2):
        requests.run_with_dead_letters(live(), model, out, bad, checkpoint, lost)
    loads.repartition(1).write.mode("append").parquet(inbox)
    requests.run_with_dead_letters(live(), model, out, bad, checkpoint)
    good, wrong = spark.read.parquet(out), spark.read.parquet(bad)
    total = spark.read.parquet(inbox)
    assert failed and good.count() + wrong.count() == total.count() == 800
    reasons = {tuple(r["reasons"]): r["count"] for r in wrong.groupBy("reasons").count().collect()}
    gone = total.where("load_id is null").count()
    assert sum(n for r, n in reasons.items() if "missing key" in r) == gone
    assert sum(n for r, n in reasons.items() if "no finite prediction" in r) == total.where("distance > 2500").count()
    assert sum(n for r, n in reasons.items() if "prediction not positive" in r) == total.where("1.5D * distance - 500 <= 0").count()
    assert wrong.where("request.distance is null").count() == 0
    assert requests.accepted(good).count() == good.count()


# ---------------------------------------------------------------- incremental audit and point grids


def test_an_audit_reads_new_and_changed_months_only(spark, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")
    data = [(f"k{i}", i % 5, float(i) if i % 7 else None, "ab"[i % 2] if i % 3 else None, 2020 + i // 40, i % 4 + 1) for i in range(120)]
    data += [("x", 1, float("inf"), "a", 2020, 1), ("y", -1, float("nan"), "a", 2022, 2)]
    df = spark.createDataFrame(data, "load_id string, v int, w double, c string, load_year int, load_month int")
    write = lambda part, mode="append": part.write.mode(mode).partitionBy("load_year", "load_month").parquet(table)
    write(df.where("load_year < 2022"))
    assert len(incremental.update(spark, table, state)) == 8 and incremental.update(spark, table, state) == []
    write(df.where("load_year = 2022"))
    write(df.where("load_year = 2020 and load_month = 3").limit(2))
    assert incremental.update(spark, table, state) == ["load_year=2020/load_month=3", *[f"load_year=2022/load_month={m}" for m in range(1, 5)]]
    all_rows = spark.read.parquet(table).drop("load_year", "load_month")
    whole = {r["column"]: r.asDict() for r in incremental.merged_columns(incremental.column_state(all_rows)).collect()}
    for r in incremental.audit(spark, state).collect():
        for name, value in r.asDict().items():
            assert value == pytest.approx(whole[r["column"]][name]), (r["column"], name)
    missing = {r["column"]: r["missing_count"] for r in audit.missing_report(all_rows).collect()}
    got = {r["column"]: r for r in incremental.audit(spark, state).collect()}
    assert {c: r["missing"] for c, r in got.items()} == missing and got["w"]["infinite"] == 1
    spread = {r["column"]: r["std"] for r in audit.describe_numeric(all_rows.where("w is null or abs(w) < 1e9"), ["v", "w"]).collect()}
    assert got["w"]["std"] == pytest.approx(spread["w"])
    assert abs(got["load_id"]["distinct_estimate"] - 122) <= 4
    counts = {(r["column"], r["value"]): r["n"] for r in incremental.value_counts(spark, state).collect()}
    assert counts["c", "a"] == all_rows.where("c = 'a'").count() and counts["c", None] == all_rows.where("c is null").count()


def test_every_cell_keeps_its_points_or_k_of_them(spark):
    rng = np.random.default_rng(8)
    points = [(f"k{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(3000, 2)) * 0.01)] + [("far", 50.0, 60.0), ("nan", float("nan"), 1.0), ("null", None, 1.0)]
    df = spark.createDataFrame(points, "load_id string, x double, y double")
    got = buckets.scatter_grid(df, "x", "y", cells=8, per_cell=4).collect()
    cells = Counter((r["cell_x"], r["cell_y"]) for r in got)
    rows_of = {(r["cell_x"], r["cell_y"]): r["cell_rows"] for r in got}
    assert sum(rows_of.values()) == 3001 and all(n == min(4, rows_of[c]) for c, n in cells.items())
    assert (7, 7) in cells and {(r["x"], r["y"]) for r in got} >= {(50.0, 60.0)}
    assert "WindowGroupLimit" in plan(buckets.scatter_grid(df, "x", "y"))
    one = buckets.scatter_grid(df.where("load_id = 'far'"), "x", "y").collect()
    assert [tuple(r) for r in one] == [(0, 0, 1, 50.0, 60.0)] and buckets.scatter_grid(df.limit(0), "x", "y").collect() == []
