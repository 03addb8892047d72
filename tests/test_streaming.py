"""The streamed predictions equal the batch predictions."""

from pyspark.sql import functions as F

from loadlens.functions import constants as K
from loadlens.operators import rows
from loadlens.plans import models, scoring
from loadlens.plans.catalog import SPLIT
from loadlens.sources import star, tables
from loadlens.streaming import requests


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    train, rest = rows.time_split(star.loads(spark, sf_dir), SPLIT)
    model = scoring.train_final(train, learner=models.gbt(trees=3, depth=3))
    inbox = str(tmp_path / "inbox")
    unlabeled = rest.drop(K.TARGET).withColumn("pickup", F.when(F.col("distance") > 2000, "Nowhere").otherwise(F.col("pickup")))
    unlabeled.select(*[f.name for f in tables.UNLABELED.fields]).repartition(3).write.parquet(inbox)
    live = requests.request_stream(spark, inbox, tables.UNLABELED, files_per_trigger=1)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    requests.run_to_end(live, out, checkpoint, lambda df: requests.accepted(requests.score_requests(df, model)))
    batch = requests.accepted(requests.score_requests(spark.read.parquet(inbox), model))
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())
    # a second run finds nothing new, a late file is picked up alone
    requests.run_to_end(live, out, checkpoint, lambda df: requests.accepted(requests.score_requests(df, model)))
    assert spark.read.parquet(out).count() == batch.count()


def test_gate_drops_unusable_rows(spark):
    df = spark.createDataFrame(
        [("a", 1.0), (None, 1.0), ("b", 0.0), ("c", float("nan")), ("d", float("inf")), ("e", None)],
        "load_id string, predicted_rate double",
    )
    assert [r[0] for r in requests.accepted(df).collect()] == ["a"]
