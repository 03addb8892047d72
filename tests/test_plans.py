"""Physical plans: no Python, no products, pruned and filtered scans, bounded top-k."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.operators import evaluate, rows, strategy, summary
from loadlens.plans import catalog
from loadlens.sources import star, tables


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


CHEAP = [
    n
    for n in catalog.QUERIES
    if n
    not in {
        "ridge_random_split", "ridge_metrics", "rf_random_split", "rf_metrics", "gbt_raw", "gbt_log", "gbt_onehot",
        "gbt_robust", "refined_model", "two_stage_model", "high_rate_classifier", "feature_importance",
        "aggregated_importance", "permutation_importance", "tuning", "rolling_validate", "score_batch",
        "score_saved_model", "score_scenario", "score_stream", "stream_features", "tuning_identity", "resumed_fit",
        "importance_contract", "permutation_by_formula", "dead_letters",
    }
]


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_and_no_product(name, spark, sf_dir):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_top_k_never_sorts_the_table(spark, sf_dir):
    text = plan(rows.top_k(star.loads(spark, sf_dir), K.TARGET, 20, ties=["load_id"]))
    assert "TakeOrderedAndProject" in text


def test_stored_loads_are_pruned(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "loads")
    tables.write_loads(star.loads(spark, sf_dir), folder)
    _, valid = rows.time_split(tables.read_loads(spark, folder).where("load_year = 2001"), catalog.SPLIT)
    text = plan(summary.group_summary(valid, ["equipment"], stats=("count", "mean")))
    assert "PartitionFilters: [isnotnull(load_year" in text
    assert "GreaterThanOrEqual(date," in text
    assert "ReadSchema: struct<equipment:string,date:date,posted_rate:double>" in text


def test_grids_aggregate_before_they_spread(spark, sf_dir):
    text = plan(strategy.strategy_grid(star.scored(spark, sf_dir)))
    assert text.index("HashAggregate") < text.rindex("Generate")
    first_generate = text[: text.rindex("(1) ")].find("Generate")
    assert first_generate > 0 and "Expand" not in text


def test_metrics_are_one_scan(spark, sf_dir):
    df = star.scored(spark, sf_dir).withColumn("other", star.F.col(K.PREDICTION) * 2)
    text = plan(evaluate.metrics_of(df, {"a": K.PREDICTION, "b": "other"}))
    assert text.count("lineitem.parquet") == 1


def test_fact_rows_are_not_shuffled_by_supplier(spark, tmp_path):
    """A small supplier table goes to the fact rows, also where orders are too large for that."""
    tables = {
        "nation": spark.range(5).select(F.expr("id").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name")),
        "supplier": spark.range(40).select(F.expr("id").alias("s_suppkey"), F.expr("if(id = 39, null, id % 6)").alias("s_nationkey")),
        "customer": spark.range(3000).select(F.expr("id").alias("c_custkey"), F.expr("id % 5").alias("c_nationkey")),
        "part": spark.range(60).select(F.expr("id").alias("p_partkey"), F.expr("id % 50").alias("p_size")),
        "orders": spark.range(6000).select(F.expr("id").alias("o_orderkey"), F.expr("(id * 7919) % 3001").alias("o_custkey")),
        "lineitem": spark.range(9000).select(
            F.expr("(id * 31) % 6000").alias("l_orderkey"), F.expr("id % 61").alias("l_partkey"), F.expr("id % 41").alias("l_suppkey"),
            F.expr("cast(id % 7 as int)").alias("l_linenumber"), F.expr("cast(id % 50 as double)").alias("l_quantity"),
            F.expr("0.05D").alias("l_discount"), F.expr("0.02D").alias("l_tax"), F.lit("A").alias("l_returnflag"), F.expr("timestamp '2001-01-01'").alias("l_shipdate"),
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = sorted(map(str, star.loads(spark, str(tmp_path)).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        loads = star.loads(spark, str(tmp_path))
        assert "hashpartitioning(l_orderkey" in plan(loads) and "hashpartitioning(l_suppkey" not in plan(loads)
        assert sorted(map(str, loads.collect())) == whole and len(whole) > 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
