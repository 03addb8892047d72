"""Evaluation of predictions (E1-E14): every table is one aggregate over the scored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.operators.quantiles import group_stats, pairs_below
from loadlens.operators.rows import best_by


def metric_columns(y: str = K.TARGET, p: str = K.PREDICTION) -> dict[str, Column]:
    """MAE, RMSE and R² as aggregate expressions over rows that have both values."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    e = F.col(p) - F.col(y)
    actual = F.when(both, F.col(y))
    spread = F.count(actual) * F.var_pop(actual)
    return {
        "MAE": F.avg(F.abs(e)),
        "RMSE": F.sqrt(F.avg(e * e)),
        "R2": F.lit(1.0) - F.try_divide(F.sum(e * e), spread),
    }


def regression_metrics(
    df: DataFrame, y: str = K.TARGET, p: str = K.PREDICTION, by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, R² over all rows or per group."""
    metrics = [m.alias(n) for n, m in metric_columns(y, p).items()]
    return df.groupBy(*by).agg(F.count(F.when(F.col(p).isNotNull(), F.col(y))).alias("count"), *metrics)


def metrics_of(df: DataFrame, predictions: Mapping[str, str], y: str = K.TARGET) -> DataFrame:
    """One metric row per model, for several prediction columns of one frame, in one scan."""
    wide = df.agg(
        *[m.alias(f"{n}_{i}") for i, p in enumerate(predictions.values()) for n, m in metric_columns(y, p).items()]
    )
    rows = [
        F.struct(F.lit(name).alias("model"), *[F.col(f"{n}_{i}").alias(n) for n in ("MAE", "RMSE", "R2")])
        for i, name in enumerate(predictions)
    ]
    return wide.select(F.inline(F.array(*rows)))


def add_errors(df: DataFrame, y: str = K.TARGET, p: str = K.PREDICTION) -> DataFrame:
    """Signed, absolute and percentage error per row; a zero target has no percentage."""
    e = F.col(p) - F.col(y)
    return df.withColumns(
        {
            "error": e,
            "absolute_error": F.abs(e),
            "percentage_error": C.safe_div(F.abs(e) * 100, y),
            "underpredicted": e < 0,
        }
    )


def error_by(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[str] = ("MAE", "mean_actual", "mean_predicted"),
    y: str = K.TARGET,
    p: str = K.PREDICTION,
    min_count: int | None = None,
    order_by_mae: bool = False,
) -> DataFrame:
    """Error per group; ``stats`` may hold MAE, RMSE, median_error, mean_actual, mean_predicted."""
    part = df.select(*keys, y, p, F.abs(F.col(p) - F.col(y)).alias("_abs"))
    available = {
        "MAE": F.avg("_abs"),
        "RMSE": F.sqrt(F.avg(F.col("_abs") * F.col("_abs"))),
        "mean_actual": F.avg(y),
        "mean_predicted": F.avg(p),
    }
    aggs = [F.count("_abs").alias("count"), *[available[s].alias(s) for s in stats if s in available]]
    median = {"median_error": 0.5} if "median_error" in stats else None
    out = group_stats(part, keys, aggs, of="_abs", quantiles=median).select(*keys, "count", *stats)
    if min_count is not None:
        out = out.where(F.col("count") >= min_count)
    return out.orderBy(*([F.desc("MAE")] if order_by_mae else []), *keys)


def error_by_distance(df: DataFrame, edges: Sequence[float] = K.DISTANCE_EDGES_8) -> DataFrame:
    part = df.withColumn("_idx", C.cut("distance", edges))
    out = error_by(part, ["_idx"], ("MAE", "RMSE"))
    label = C.label_of("_idx", C.interval_labels(edges)).alias("distance_bucket")
    return out.select(label, "count", "MAE", "RMSE")


def error_by_month(df: DataFrame, stats: Sequence[str] = ("MAE", "RMSE")) -> DataFrame:
    return error_by(df.withColumn("month", F.month("date")), ["month"], stats)


def error_by_route(df: DataFrame, min_count: int = 5) -> DataFrame:
    return error_by(df, ["pickup", "delivery"], min_count=min_count, order_by_mae=True)


def bias(df: DataFrame, y: str = K.TARGET, p: str = K.PREDICTION) -> DataFrame:
    """Mean and median signed error, and the share of rows predicted too low."""
    e = F.col(p) - F.col(y)
    return group_stats(
        df.select(e.alias("_e")),
        [],
        [
            F.avg("_e").alias("mean_error"),
            F.avg(F.when(F.col("_e") < 0, 100.0).otherwise(0.0)).alias("underprediction_pct"),
        ],
        of="_e",
        quantiles={"median_error": 0.5},
    ).select("mean_error", "median_error", "underprediction_pct")


def subset_mae(df: DataFrame, predictions: Mapping[str, str], threshold: float = K.HIGH_RATE) -> DataFrame:
    """MAE on high-rate rows per prediction column."""
    df = C.without_nan(df, K.TARGET, *predictions.values())
    high = F.col(K.TARGET) >= threshold
    wide = df.agg(
        F.count(F.when(high, 1)).alias("_n"),
        *[
            F.avg(F.when(high, F.abs(F.col(p) - F.col(K.TARGET)))).alias(f"m{i}")
            for i, p in enumerate(predictions.values())
        ],
    )
    rows = [
        F.struct(F.lit(n).alias("model"), F.col("_n").alias("high_rate_loads"), F.col(f"m{i}").alias("high_rate_MAE"))
        for i, n in enumerate(predictions)
    ]
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- classification


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are first counted per distinct score; negatives below are then cumulated along order-preserving paths of the
    scores, so no task sees all scores, or all scores of a narrow range.
    """
    part = df.where(F.col(label).isNotNull() & C.null_if_nan(F.col(score).cast("double")).isNotNull())
    per_score = part.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"), F.count(F.when(F.col(label) == 0, 1)).alias("_neg")
    )
    both = per_score.agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    # one row each
    wide = both.unionByName(pairs_below(per_score, "_s", "_pos", "_neg"), allowMissingColumns=True)
    pos, neg = F.max("_pos"), F.max("_neg")
    return wide.agg(
        F.coalesce(pos, F.lit(0)).alias("positives"),
        F.coalesce(neg, F.lit(0)).alias("negatives"),
        F.try_divide(F.max("pairs"), pos.cast("double") * neg).alias("roc_auc"),
    )


def classification_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Per-class and averaged precision, recall, F1 and support; 0 where undefined."""
    cells = df.agg(
        *[
            F.count(F.when((F.col(label) == a) & (F.col(predicted) == b), 1)).cast("double").alias(f"n{a}{b}")
            for a in (0, 1)
            for b in (0, 1)
        ]
    )
    n = {(a, b): F.col(f"n{a}{b}") for a in (0, 1) for b in (0, 1)}

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    scores: dict[int, dict[str, Column]] = {}
    for c in (0, 1):
        precision = ratio(n[c, c], n[0, c] + n[1, c])
        recall = ratio(n[c, c], n[c, 0] + n[c, 1])
        scores[c] = {
            "precision": precision,
            "recall": recall,
            "f1": ratio(precision * recall * 2, precision + recall),
            "support": n[c, 0] + n[c, 1],
        }
    total = scores[0]["support"] + scores[1]["support"]
    accuracy = ratio(n[0, 0] + n[1, 1], total)
    names = ("precision", "recall", "f1")
    mean = {k: (scores[0][k] + scores[1][k]) / 2 for k in names}
    weighted = {k: ratio(sum(scores[c][k] * scores[c]["support"] for c in (0, 1)), total) for k in names}

    def row(name: str, values: Mapping[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[values[k].alias(k) for k in names],
            support.cast("long").alias("support"),
        )

    return cells.select(
        F.inline(
            F.array(
                row("0", scores[0], scores[0]["support"]),
                row("1", scores[1], scores[1]["support"]),
                row("accuracy", {k: accuracy for k in names}, total),
                row("macro avg", mean, total),
                row("weighted avg", weighted, total),
            )
        )
    )


def class_balance(df: DataFrame, target: str = K.TARGET, threshold: float = K.HIGH_RATE) -> DataFrame:
    """Rows, high-rate rows and their share."""
    df = C.without_nan(df, target)
    positive = F.col(target) >= threshold
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(positive, 1)).alias("positives"),
        F.avg(F.when(positive, 100.0).otherwise(0.0)).alias("positive_pct"),
    )


# ---------------------------------------------------------------- comparing models


def leaderboard(metrics: DataFrame, by: str = "MAE") -> DataFrame:
    return metrics.orderBy(F.asc_nulls_last(by), "model")


def compare_metrics(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Baseline and candidate side by side; a positive improvement is good for every metric."""

    def tall(df: DataFrame, name: str) -> DataFrame:
        return df.select("MAE", "RMSE", "R2").unpivot([], ["MAE", "RMSE", "R2"], "metric", name)

    joined = tall(baseline, "baseline").join(tall(candidate, "candidate"), "metric")
    gain = F.col("baseline") - F.col("candidate")
    return joined.withColumn("improvement", F.when(F.col("metric") == "R2", -gain).otherwise(gain)).orderBy("metric")


def with_champion(candidates: DataFrame, champion: DataFrame) -> DataFrame:
    """The champion's row above the candidates' rows."""
    cols = ["model", "MAE", "RMSE", "R2"]
    return champion.select(*cols).unionByName(candidates.select(*cols))


def select_best(metrics: DataFrame, by: str = "RMSE") -> str:
    """Name of the model with the smallest metric."""
    row = best_by(metrics, by, ties=["model"]).first()
    if row is None:
        raise ValueError("no metrics to choose from")
    return row["model"]


def fold_summary(metrics: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the fold metrics."""
    names = ("MAE", "RMSE", "R2")
    wide = metrics.agg(*[f(n).alias(f"{k}_{n}") for n in names for k, f in (("m", F.avg), ("s", F.stddev_samp))])
    rows = [F.struct(F.lit(n).alias("metric"), F.col(f"m_{n}").alias("mean"), F.col(f"s_{n}").alias("std")) for n in names]
    return wide.select(F.inline(F.array(*rows)))
