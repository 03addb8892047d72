"""Shipment requests as a stream: features, stored model, predictions out.

Every step is a projection, so append mode needs no watermark and no state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.functions.features import create_features
from loadlens.plans.scoring import score

REQUEST = "_request"


def request_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return C.without_nan(reader.format(fmt).load(path))


def clean_requests(requests: DataFrame, texts: Sequence[str] = ("pickup", "delivery", "equipment")) -> DataFrame:
    """Requests without blanks around their texts; an empty text is missing, and so is NaN.

    A category with a blank would be an unknown one and get another rate without a word.
    """
    blanks = F.lit(" \t\r\n\u00a0")
    found = {c: F.nullif(F.trim(F.col(c), blanks), F.lit("")) for c in texts if c in requests.columns}
    return C.without_nan(requests.withColumns(found) if found else requests)


def score_requests(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions for a batch or stream of shipments, cleaned first."""
    return score(clean_requests(requests), model)


def accepted(predictions: DataFrame) -> DataFrame:
    """Rows that pass the row-level gate: a key and a finite positive rate."""
    return predictions.where(
        F.col(K.KEY).isNotNull() & C.is_finite(K.PREDICTION) & (F.col(K.PREDICTION) > 0)
    )


def gated(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Every request with its prediction and the reasons, if any, why the row-level gate rejects it.

    Columns: key, prediction, reasons (array, empty for an accepted row), request (the row as it came).
    """
    request = F.struct(*[F.col(f"`{c}`") for c in requests.columns])
    scored = model.transform(create_features(clean_requests(requests.withColumn(REQUEST, request))))
    rate = C.cents(K.PREDICTION)
    reasons = F.array_compact(
        F.array(
            F.when(F.col(K.KEY).isNull(), "missing key"),
            F.when(~F.coalesce(C.is_finite(rate), F.lit(False)), "no finite prediction"),
            F.when(rate <= 0, "prediction not positive"),
        )
    )
    return scored.select(K.KEY, rate.alias(K.PREDICTION), reasons.alias("reasons"), F.col(REQUEST).alias("request"))


def run_with_dead_letters(
    frame: DataFrame, model: PipelineModel, out: str, rejected: str, checkpoint: str, progress: Callable[[int], None] | None = None
) -> None:
    """Write accepted predictions to ``out`` and rejected requests with their reasons to ``rejected``, then stop.

    Each batch of the stream writes its own folder ``batch=<number>`` in both, replacing what an attempt that failed may have
    left there. The stream repeats a batch with the same rows until it is committed, so after any restart each request is in
    exactly one of the tables, once. ``progress`` is called between the two writes of a batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        judged = gated(batch, model).persist()
        try:
            good = judged.where(F.size("reasons") == 0).select(K.KEY, K.PREDICTION)
            good.write.mode("overwrite").parquet(f"{out}/batch={number}")
            if progress:
                progress(number)
            bad = judged.where(F.size("reasons") > 0)
            bad.write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        finally:
            judged.unpersist()

    stream = frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def run_to_end(frame: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write what is available now to a Parquet folder and stop; a rerun continues after the last file."""
    out_frame = transform(frame) if transform else frame
    stream = (
        out_frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    stream.awaitTermination()
