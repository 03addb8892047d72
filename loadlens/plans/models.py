"""Models on engineered features (M3-M14), built from Spark ML's own learners.

A model is a ``PipelineModel`` from engineered columns to ``predicted_rate`` (or ``high_probability``):
fill missing values, code categories, assemble, predict, bring the prediction back to dollars.
"""

from __future__ import annotations

import functools
import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions import columns as C
from loadlens.functions import constants as K
from loadlens.functions.features import BASE_CATEGORICAL, BASE_NUMERIC, FEATURE_INPUTS, sources
from loadlens.operators.audit import long_values
from loadlens.operators.quantiles import group_stats
from loadlens.operators.rows import numbered, permuted, sample_n
from loadlens.plans import binned
from loadlens.plans.parallel import in_parallel
from loadlens.sources.shared import bucketed_once, ensure_checkpoints, ensure_settings, removed_at_end, shared_dir, written_once

LABEL, WEIGHT, FEATURES, FOLD, DEAL = "_label", "_weight", "_features", "_fold", "_deal"
PLACE, INDEX, LEVEL = "__place", "__index", "__level"
NUMBER = "_number"
#: Features from input columns, as ``create_features``.
Derive = Callable[[DataFrame], DataFrame]
PRIOR_ROWS = 10
#: Rows times features, one-hot ones among them, that boosted trees are fitted to by Spark's own learner, which caches four bytes for each.
CELLS = 100_000_000
#: Parts of the training rows; a row's level means come from the other parts.
FOLDS = 5

# ---------------------------------------------------------------- filling missing values (M3, M4)


def with_missing(df: DataFrame, like: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with those of ``cols`` that it lacks, of the types in ``like`` and without values."""
    return df.withColumns({c: F.lit(None).cast(like.schema[c].dataType) for c in cols if c not in df.columns})


def derived_counts(rows: DataFrame, cols: Sequence[str], derive: Derive | None) -> list[tuple[DataFrame, list[str]]]:
    """Frames of ``cols`` and of the number of rows, ``_n``, that each of their rows stands for; every column is in one frame.

    Equal inputs give equal features: rows are counted by the inputs that a group of features is made of, and features are
    derived once for each different combination, not for each row.
    """
    made = sources(derive) if derive else {}
    known = {c: frozenset(made[c]) for c in cols if c in made and set(made[c]) <= set(rows.columns)}
    # features of fewer inputs go with the smallest larger set that holds them
    whole = sorted((s for s in set(known.values()) if not any(s < t for t in known.values())), key=lambda s: (len(s), sorted(s)))
    found = []
    for inputs in whole:
        own = [c for c, s in known.items() if next(t for t in whole if s <= t) == inputs]
        counted = rows.groupBy(*[c for c in rows.columns if c in inputs]).agg(F.count(F.lit(1)).alias("_n"))
        found.append((derive(with_missing(counted, rows, [c for c in FEATURE_INPUTS if c in rows.columns])), own))
    if others := [c for c in cols if c not in known]:
        found.append(((derive(rows) if derive else rows).withColumn("_n", F.lit(1).cast("long")), others))
    return found


def medians(df: DataFrame, cols: Sequence[str], derive: Derive | None = None) -> DataFrame:
    """Exact median per numeric column, as (column, fill) rows; with ``derive``, of the features of inputs ``df``."""
    if derive is None:
        return group_stats(long_values(df, cols), ["column"], [], of="value", quantiles={"fill": 0.5})
    parts = [
        counted.select("_n", *[C.null_if_nan(F.col(c).cast("double")).alias(c) for c in own]).unpivot(["_n"], own, "column", "value")
        for counted, own in derived_counts(df, cols, derive)
    ]
    return group_stats(functools.reduce(DataFrame.unionByName, parts), ["column"], [], of="value", quantiles={"fill": 0.5}, times="_n")


def modes(df: DataFrame, cols: Sequence[str], derive: Derive | None = None) -> DataFrame:
    """Most frequent text per column, the smallest on ties, as (column, fill) rows; ``derive`` as in ``medians``."""
    parts = [
        counted.select("_n", *[F.col(c).cast("string").alias(c) for c in own]).unpivot(["_n"], own, "column", "value")
        for counted, own in derived_counts(df, cols, derive)
    ]
    values = functools.reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())
    counts = values.groupBy("column", "value").agg(F.sum("_n").alias("n"))
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("fill"))


class _FillParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "text columns", TypeConverters.toListString)


class MissingFillerModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces missing values with the numbers and texts learned on the training rows."""

    fills = Param(Params._dummy(), "fills", "fill value per column, as JSON", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        new = {}
        for c in self.getOrDefault(self.numericCols):
            new[c] = F.coalesce(C.null_if_nan(F.col(c).cast("double")), F.lit(float(fills.get(c) or 0.0)))
        for c in self.getOrDefault(self.categoricalCols):
            new[c] = F.coalesce(F.col(c).cast("string"), F.lit(fills.get(c) or "nan"))
        return df.withColumns(new)


class MissingFiller(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians of numeric and modes of text columns on the rows it is fitted on, and only there."""

    def __init__(self, numeric: Sequence[str] = (), categorical: Sequence[str] = ()):
        super().__init__()
        self._set(numericCols=list(numeric), categoricalCols=list(categorical))

    def _fit(self, df: DataFrame) -> MissingFillerModel:
        return learned_fills(df, self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols))


def learned_fills(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], derive: Derive | None = None) -> MissingFillerModel:
    """The filler of rows that hold the columns, or with ``derive`` the inputs that they are derived from."""
    # one row per column
    fills: dict[str, float | str] = {}
    if numeric:
        fills |= {r["column"]: r["fill"] for r in medians(rows, numeric, derive).collect()}
    if categorical:
        fills |= {r["column"]: r["fill"] for r in modes(rows, categorical, derive).collect()}
    model = MissingFillerModel()
    return model._set(numericCols=list(numeric), categoricalCols=list(categorical), fills=json.dumps(fills))


# ---------------------------------------------------------------- coding categories (M5, M6)


def category_stages(categorical: Sequence[str], onehot: bool) -> tuple[list, list[str]]:
    """Stages that code text columns, and the names of the coded columns.

    One-hot keeps a slot for every level seen in training; an unknown level is the zero vector. For tree learners a
    level is coded by the mean label of its training rows: one number per category however many levels it has, so the
    bins of a split do not grow with the levels. An unknown level has the overall mean.
    """
    if not categorical:
        return [], []
    if not onehot:
        index = [c + INDEX for c in categorical]
        return [LevelMeans(categorical, index)], index
    place = [c + PLACE for c in categorical]
    level = [c + LEVEL for c in categorical]
    stages = [
        StringIndexer(inputCols=list(categorical), outputCols=place, handleInvalid="keep"),
        # the last slot, dropped here, is the one the indexer added for unknown levels
        OneHotEncoder(inputCols=place, outputCols=level, dropLast=True),
    ]
    return stages, level


class _LevelParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "text columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "coded columns", TypeConverters.toListString)


class _LevelWriter(MLWriter):
    """Parameters as usual, and the table of levels beside them."""

    def __init__(self, model: LevelMeansModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.levels.write.parquet(f"{path}/levels")


class _LevelReader(MLReader):
    def load(self, path: str) -> LevelMeansModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LevelMeansModel(self.sparkSession.read.parquet(f"{path}/levels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class LevelMeansModel(Model, _LevelParams, MLReadable, MLWritable):
    """Replaces a level by the mean label learned for it, by a join with the table of levels.

    Rows with a ``FOLD`` column, as training rows have, get the mean of the rows of the other folds, so a row's own label
    is never in its features. Levels are a table and never on the driver; Spark sends a small one to all tasks and shuffles
    a large one. ``levels``: column, level, mean, and without: the mean without each fold.
    """

    overall = Param(Params._dummy(), "overall", "mean label, and without each fold", TypeConverters.toListFloat)

    def __init__(self, levels: DataFrame):
        super().__init__()
        self.levels = levels

    def _transform(self, df: DataFrame) -> DataFrame:
        overall = self.getOrDefault(self.overall)
        other = F.get(F.array(*[F.lit(float(m)) for m in overall[1:]]), F.col(FOLD)) if FOLD in df.columns else F.lit(float(overall[0]))
        for column, coded in zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), strict=True):
            own = self.levels.where(F.col("column") == column).select(F.col("level").alias(column), F.col("mean").alias("_mean"), F.col("without").alias("_without"))
            mean = F.get("_without", F.col(FOLD)) if FOLD in df.columns else F.col("_mean")
            df = df.join(own, column, "left").withColumn(coded, F.coalesce(mean, other)).drop("_mean", "_without")
        return df

    def write(self) -> MLWriter:
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelReader()


class LevelMeans(Estimator, _LevelParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the mean label of every level, drawn towards the overall mean by ``PRIOR_ROWS`` rows.

    The table of levels is written to the shared folder. Sums come from one aggregate per level, column and fold, combined
    in each task, so a level with a third of all rows costs a row per task. Sums of doubles depend on the order of the rows:
    rows with a ``DEAL`` column are settled first, with no more columns than the sums need.
    """

    def __init__(self, columns: Sequence[str] = (), coded: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(columns), outputCols=list(coded))

    def _fit(self, df: DataFrame) -> LevelMeansModel:
        columns = self.getOrDefault(self.inputCols)
        if DEAL in df.columns:
            df = settled_rows(df.select(*columns, LABEL, *[c for c in (FOLD,) if c in df.columns], DEAL))
        fold = F.col(FOLD) if FOLD in df.columns else F.lit(0)
        folds = range(FOLDS)
        total = df.agg(F.sum(LABEL), F.count(LABEL), *[f(F.when(fold == i, F.col(LABEL))) for i in folds for f in (F.sum, F.count)]).first()
        level = df.select(*columns, LABEL, fold.alias("_f")).unpivot([LABEL, "_f"], list(columns), "column", "level").where("level is not null")
        fold = F.col("_f")
        sums = [f(F.when(fold == i, F.col(LABEL))).alias(f"{n}{i}") for i in folds for n, f in (("s", F.sum), ("n", F.count))]
        found = level.groupBy("column", "level").agg(F.coalesce(F.sum(LABEL), F.lit(0.0)).alias("s"), F.count(LABEL).alias("n"), *sums)
        return self.drawn_means(found, total)

    def drawn_means(self, found: DataFrame, total: Sequence[float | None]) -> LevelMeansModel:
        """The model of sums by column and level: ``s`` and ``n``, and ``s0``, ``n0``, ... of each fold; ``total`` has those of all rows."""
        folds, columns = range(FOLDS), self.getOrDefault(self.inputCols)
        mean = lambda s, n: (s or 0.0) / n if n else 0.0
        overall = mean(*total[:2])
        others = [mean((total[0] or 0.0) - (total[2 + 2 * i] or 0.0), total[1] - total[3 + 2 * i]) for i in folds]
        drawn = lambda s, n, m: (s + PRIOR_ROWS * m) / (n + PRIOR_ROWS)
        without = [drawn(F.col("s") - F.coalesce(f"s{i}", F.lit(0.0)), F.col("n") - F.col(f"n{i}"), others[i]) for i in folds]
        levels = found.select("column", "level", drawn(F.col("s"), F.col("n"), overall).alias("mean"), F.array(*without).alias("without"))
        model = LevelMeansModel(written_once(levels, "levels"))
        return model._set(inputCols=list(columns), outputCols=self.getOrDefault(self.outputCols), overall=[overall, *others])

    def fit_counted(self, counted: DataFrame, scale: float) -> LevelMeansModel:
        """Fit on rows that stand for many: text columns, fold, ``_n`` labels and ``_s``, their sum times ``scale`` in whole numbers.

        These sums do not depend on the order of the rows, which need not be settled.
        """
        columns, fold = self.getOrDefault(self.inputCols), F.col(FOLD)
        of = lambda i: [F.coalesce(F.sum(F.when(fold == i, F.col(c))), F.lit(0)) for c in ("_s", "_n")]
        each = [x for i in range(FOLDS) for x in of(i)]
        row = counted.agg(F.coalesce(F.sum("_s"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0)), *each).first()
        total = [x / scale if i % 2 == 0 else x for i, x in enumerate(row)]
        level = counted.unpivot([FOLD, "_s", "_n"], list(columns), "column", "level").where("level is not null")
        names = ["s", "n", *(f"{x}{i}" for i in range(FOLDS) for x in "sn")]
        found = level.groupBy("column", "level").agg(*[x.alias(n) for x, n in zip([F.sum("_s"), F.sum("_n"), *each], names, strict=True)])
        return self.drawn_means(found.withColumns({n: F.col(n) / scale for n in names if n[0] == "s"}), total)


def level_counts(prep: PipelineModel, categorical: Sequence[str]) -> dict[str, int]:
    """How many levels each column of level numbers has; fitted one-hot stages."""
    found = [stage for stage in prep.stages if isinstance(stage, StringIndexerModel)]
    return {c + PLACE: len(labels) for stage in found for c, labels in zip(categorical, stage.labelsArray, strict=True)}


def with_folds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Training rows with their fold, by a hash of ``columns``: rows that look alike are in one fold."""
    return df.withColumn(FOLD, F.pmod(F.xxhash64(F.lit(11), *columns), F.lit(FOLDS)).cast("int"))


def preparation(numeric: Sequence[str], categorical: Sequence[str], onehot: bool, filler: MissingFillerModel | None = None) -> Pipeline:
    """``filler``: one that is fitted already."""
    stages, coded = category_stages(categorical, onehot)
    assembler = VectorAssembler(inputCols=[*numeric, *coded], outputCol=FEATURES)
    return Pipeline(stages=[filler or MissingFiller(numeric, categorical), *stages, assembler])


def prepare(
    rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], onehot: bool = False, *more: str, derive: Derive | None = None,
    apart: float = math.inf,
) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages, and the training rows as features, label and ``more``, dealt out as ``settled_rows`` does.

    ``rows`` are stored: the inputs of ``derive``, or without it the columns themselves, with label and ``more``. The inputs are
    fewer than the features, so they are what is dealt out and stored, and each pass derives the features anew. Level means of
    training rows come from other folds. Joins with levels may move rows between partitions, and learners draw by partition,
    so where there are such joins the rows are dealt out after them, with their means. ``apart`` asks for rows of more than so many
    features in all as columns, for ``binned``; these are not dealt out, as that draws rows by their content.
    """
    derived = derive or (lambda df: df)
    columns, inputs = [*numeric, *categorical, LABEL], [c for c in rows.columns if c not in (LABEL, *more)]
    total = rows.count()
    keyed = derived(rows).withColumn(DEAL, F.xxhash64(*columns))
    filler = learned_fills(rows, numeric, categorical, derive)
    if onehot or not categorical:
        prep = preparation(numeric, categorical, onehot, filler).fit(derived(rows))
        levels = level_counts(prep, categorical)
        if total * (len(numeric) + sum(levels.values())) > apart:
            named = prep.transform(derived(rows.withColumn(binned.ROW, F.xxhash64(*inputs, LABEL))))
            return prep, named.select(*numeric, *levels, binned.ROW, LABEL)
        dealt = derived(settled_rows(keyed.select(*inputs, LABEL, *more, DEAL), total))
        return prep, prep.transform(dealt).select(FEATURES, LABEL, *more)
    large = total * (len(numeric) + len(categorical)) > apart
    folded = derived(with_folds(rows.withColumn(binned.ROW, F.xxhash64(*inputs, LABEL)), inputs)) if large else with_folds(keyed, [*numeric, *categorical])
    numbers, texts = filler.copy({filler.categoricalCols: []}), filler.copy({filler.numericCols: []})
    made = sources(derive)

    def needed(cols: Sequence[str]) -> list[str]:
        """Inputs that columns are derived from, as far as that is known."""
        return [c for c in inputs if any(c in made.get(x, inputs) for x in cols)] if derive else list(cols)

    def again(stored: DataFrame) -> DataFrame:
        """The features of stored inputs; those that none of the wanted features is made of need not be there."""
        return derived(with_missing(stored, rows, inputs)) if derive else stored

    (learner,), means = category_stages(categorical, onehot)
    assembler = VectorAssembler(inputCols=[*numeric, *means], outputCol=FEATURES)
    if large:
        # equal inputs give equal texts, so labels are summed by input and fold, and texts are made of the sums
        most = rows.agg(F.max(F.abs(LABEL))).first()[0] or 1.0
        scale = 2.0 ** math.floor(61 - math.log2(total) - math.log2(most))
        labels = [F.sum(F.round(F.col(LABEL) * scale).cast("long")).alias("_s"), F.count(LABEL).alias("_n")]
        counted = texts.transform(again(with_folds(rows, inputs).groupBy(*needed(categorical), FOLD).agg(*labels)))
        coder = learner.fit_counted(counted.select(*categorical, FOLD, F.coalesce("_s", F.lit(0)).alias("_s"), "_n"), scale)
        more = (binned.ROW, *more)
    else:
        # no more is shuffled than the texts are made of; LevelMeans does not deal out rows without DEAL again
        named = again(settled_rows(folded.select(*needed(categorical), LABEL, FOLD, DEAL), total))
        coder = learner.fit(texts.transform(named))
    # fills replace inputs, so these go under other names; rows meet the levels with inputs and texts only, not with all features
    given = {c: f"_in_{c}" for c in needed(numeric)}
    texted = texts.transform(folded.withColumns({new: F.col(c) for c, new in given.items()}))
    coded = coder.transform(texted.select(*given.values(), *categorical, FOLD, LABEL, *more))
    coded = coded.select(*given.values(), *means, LABEL, *more).withColumnsRenamed({new: c for c, new in given.items()})

    if large:
        return PipelineModel([filler, coder, assembler]), numbers.transform(again(coded)).select(*numeric, *means, LABEL, *more)

    def assembled(df: DataFrame) -> DataFrame:
        return assembler.transform(numbers.transform(again(df)))

    kept = assembled(coded.withColumns({new: F.col(c) for c, new in given.items()}))
    kept = kept.withColumn(DEAL, F.xxhash64(vector_to_array(FEATURES), LABEL, *more))
    dealt = settled_rows(kept.select(*given.values(), *means, LABEL, *more, DEAL), total).withColumnsRenamed({new: c for c, new in given.items()})
    return PipelineModel([filler, coder, assembler]), assembled(dealt).select(FEATURES, LABEL, *more)


class RateOutput(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Last stage of a rate model: the prediction in dollars, floored at zero, helper columns dropped."""

    logTarget = Param(Params._dummy(), "logTarget", "prediction is on the log scale", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    def __init__(self, log_target: bool = False, output: str = K.PREDICTION):
        super().__init__()
        self._set(logTarget=log_target, outputCol=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw = F.col("prediction")
        rate = C.from_log_target(raw) if self.getOrDefault(self.logTarget) else C.clip0(raw)
        helpers = [c for c in df.columns if c.endswith((PLACE, INDEX, LEVEL)) or c in (FEATURES, "prediction")]
        return df.withColumn(self.getOrDefault(self.outputCol), rate).drop(*helpers)


class ProbabilityOutput(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Last stage of the high-rate classifier: the probability of the positive class."""

    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    def __init__(self, output: str = "high_probability"):
        super().__init__()
        self._set(outputCol=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        helpers = [c for c in df.columns if c.endswith((PLACE, INDEX, LEVEL))]
        helpers += [FEATURES, "prediction", "rawPrediction", "probability"]
        chance = vector_to_array("probability")[1]
        return df.withColumn(self.getOrDefault(self.outputCol), chance).drop(*helpers)


# ---------------------------------------------------------------- learners


def ridge(prepared: DataFrame, alpha: float = 10.0, label: str = LABEL, solver: str = "normal") -> LinearRegression:
    """Least squares with the penalty ``alpha * |w|²`` for prepared rows.

    ``solver="normal"`` is one pass over the data (normal equations; Spark takes up to 4,096 coded columns),
    ``"l-bfgs"`` serves any number. Spark's own penalty is relative to the number of rows and the label's spread, which
    the two solvers measure with the population and the sample deviation.
    """
    spread_of = F.stddev_pop if solver == "normal" else F.stddev_samp
    row = prepared.agg(F.count(label).alias("n"), spread_of(label).alias("s")).first()
    scale = (row["s"] or 1.0) / max(row["n"], 1)
    return LinearRegression(
        featuresCol=FEATURES, labelCol=label, elasticNetParam=0.0, standardization=False,
        regParam=alpha * scale, solver=solver, maxIter=500, tol=1e-9,
    )


def rf_regressor(trees: int = 200, depth: int = 20, min_leaf: int = 2, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="all", seed=seed,
    )


def rf_classifier(trees: int = 300, depth: int = 12, min_leaf: int = 3, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed,
    )


def gbt(
    trees: int = K.CHAMPION[0],
    rate: float = K.CHAMPION[1],
    depth: int = K.CHAMPION[2],
    min_leaf: int = K.CHAMPION[3],
    rows: float = K.CHAMPION[4],
    cols: float = K.CHAMPION[5],
    loss: str = "squared",
    seed: int = 42,
) -> GBTRegressor:
    """Boosted trees; the lineage is cut every ten trees in the session's checkpoint folder."""
    return GBTRegressor(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=trees, stepSize=rate, maxDepth=depth,
        minInstancesPerNode=min_leaf, subsamplingRate=rows, lossType=loss, seed=seed,
        featureSubsetStrategy="all" if cols >= 1 else str(cols), checkpointInterval=10,
    )


#: Rows of a bucket of numbered rows, and of a part of the training rows as long as there are eight of these.
ROWS_PER_PART = 100_000


def training_parts(total: int) -> int:
    """Parts of the training rows: they and the rows of a part both grow with the root of the number of rows.

    Each part sends the statistics of all open nodes once a level, whatever its rows: with parts of a fixed size these bytes would
    grow with the table. The number follows from the table, not from the machine.
    """
    return max(8, math.ceil(8 * math.sqrt(total / (8 * ROWS_PER_PART))))


def settled_rows(rows: DataFrame, total: int | None = None) -> DataFrame:
    """Rows in the shared folder, dealt out by a hash of their content and sorted by it: one shuffle, however often they are read.

    Fills and learners pass over the rows many times; joins and the shuffle are then done once, and a lost executor costs a
    re-read. Learners draw rows by partition and order, which are the same on any number of cores: a partition is a bucket of
    the table. Rows with a ``DEAL`` column are dealt out by it, else by all columns. ``total`` is their number, if known.
    """
    ensure_checkpoints(rows.sparkSession)
    kept = [c for c in rows.columns if c != DEAL]
    if DEAL not in rows.columns:
        rows = rows.withColumn(DEAL, F.xxhash64(*kept))
    parts = training_parts(rows.count() if total is None else total)
    return bucketed_once(rows.repartition(parts, DEAL), "training", parts, DEAL, [DEAL]).select(*kept)


def training_inputs(
    rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], derive: Derive | None, *more: str, write: bool = True
) -> DataFrame:
    """What ``prepare`` needs of engineered rows, written once; ``write=False`` is for rows that are stored already."""
    ensure_settings(rows.sparkSession)
    inputs = rows.select(*([c for c in FEATURE_INPUTS if c in rows.columns] if derive else [*numeric, *categorical]), LABEL, *more)
    return written_once(inputs, "training") if write else inputs


def fit_learner(prepared: DataFrame, learner: Estimator, bins: int = 256) -> Model:
    """Fit on prepared rows."""
    if learner.hasParam("maxBins"):
        learner = learner.copy({learner.getParam("maxBins"): bins})
    return learner.fit(prepared)


def labeled(df: DataFrame, target: str = K.TARGET, log_target: bool = False) -> DataFrame:
    """Training rows with their label; rows without a target teach nothing."""
    y = C.to_log_target(target) if log_target else F.col(target)
    df = C.without_nan(df, target)
    return df.where(F.col(target).isNotNull()).withColumn(LABEL, y.cast("double"))


def fit_rate_model(
    train: DataFrame,
    learner: Estimator | None = None,
    numeric: Sequence[str] = BASE_NUMERIC,
    categorical: Sequence[str] = BASE_CATEGORICAL,
    log_target: bool = False,
    onehot: bool = False,
    target: str = K.TARGET,
    alpha: float | None = None,
    solver: str = "normal",
    fit: Callable[[DataFrame], Model] | None = None,
    settle: bool = True,
    derive: Derive | None = None,
) -> PipelineModel:
    """Fit a rate model on engineered rows (M6-M11). ``alpha`` and ``solver`` ask for ridge instead of a learner.

    ``fit`` replaces the learner's own fit on prepared rows, as the fits of ``rounds`` do. ``settle=False`` is for rows that
    are stored already and need not be written once more. ``derive`` is the function that made the engineered columns from
    ``FEATURE_INPUTS``; where it is given, only those are stored.
    """
    rows = training_inputs(labeled(train, target, log_target), numeric, categorical, derive, write=settle)
    apart = CELLS if fit is None and isinstance(learner, GBTRegressor) else math.inf
    prep, prepared = prepare(rows, numeric, categorical, onehot, derive=derive, apart=apart)
    if FEATURES not in prepared.columns:
        model = binned.boost(prepared, learner, *for_bins(rows, prep, prepared, categorical))
    else:
        model = fit(prepared) if fit else fit_learner(prepared, learner or ridge(prepared, 10.0 if alpha is None else alpha, solver=solver))
    return PipelineModel([*prep.stages, model, RateOutput(log_target)])


def for_bins(rows: DataFrame, prep: PipelineModel, prepared: DataFrame, categorical: Sequence[str]) -> tuple[list[str], dict[str, int], tuple]:
    """What ``binned`` asks for: numeric columns, levels, and number and ends of the labels."""
    levels = level_counts(prep, categorical)
    known = tuple(rows.agg(F.count(F.lit(1)), F.min(LABEL), F.max(LABEL)).first())
    return [c for c in prepared.columns if c not in (*levels, binned.ROW, LABEL)], levels, known


def with_balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight ``n / (2 n_class)``: both classes weigh the same in total."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos")).first()
    n, pos = row["n"], row["pos"] or 0.0
    weight = F.when(F.col(label) == 1, F.lit(n / (2 * pos) if pos else 1.0)).otherwise(
        F.lit(n / (2 * (n - pos)) if n > pos else 1.0)
    )
    return df.withColumn(WEIGHT, weight)


def fit_high_rate_classifier(
    train: DataFrame,
    learner: Estimator | None = None,
    numeric: Sequence[str] = BASE_NUMERIC,
    categorical: Sequence[str] = BASE_CATEGORICAL,
    onehot: bool = False,
    target: str = K.TARGET,
    threshold: float = K.HIGH_RATE,
    fit: Callable[[DataFrame], Model] | None = None,
    derive: Derive | None = None,
) -> PipelineModel:
    """Probability that a load is high-rate, classes balanced (M12). ``fit`` replaces the learner's own fit."""
    rows = C.without_nan(train, target).where(F.col(target).isNotNull()).withColumn(LABEL, C.flag(F.col(target) >= threshold).cast("double"))
    rows = with_balanced_weights(training_inputs(rows, numeric, categorical, derive))
    prep, prepared = prepare(rows, numeric, categorical, onehot, WEIGHT, derive=derive)
    model = fit(prepared) if fit else fit_learner(prepared, learner or rf_classifier())
    return PipelineModel([*prep.stages, model, ProbabilityOutput()])


# ---------------------------------------------------------------- importance


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Importance per encoded feature, largest first; names come from the assembled column's metadata.

    ``sample`` only provides the input schema, no row of it is read.
    """
    prep = PipelineModel(model.stages[:-2])
    attrs = prep.transform(sample.limit(0)).schema[FEATURES].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    values = model.stages[-2].featureImportances
    rows = [(names[i], source_column(names[i]), float(values[i])) for i in range(values.size)]
    out = sample.sparkSession.createDataFrame(rows, "feature string, source string, importance double")
    return out.orderBy(F.desc("importance"), "feature")


def source_column(feature: str) -> str:
    """The engineered column behind an encoded feature."""
    for mark in (LEVEL, INDEX):
        if mark in feature:
            return feature.split(mark, 1)[0]
    return feature


def aggregate_importance(importance: DataFrame, prefixes: Sequence[str] | None = None) -> DataFrame:
    """Importance summed per source column, or per name prefix when a list of columns is given."""
    group = F.col("source")
    if prefixes is not None:
        name = F.replace(F.replace(F.col("feature"), F.lit(LEVEL), F.lit("")), F.lit(INDEX), F.lit(""))
        group = F.coalesce(*[F.when(name.startswith(c), F.lit(c)) for c in prefixes], name)
    return (
        importance.groupBy(group.alias("feature_group"))
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature_group")
    )


def _by_number(chosen: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int, str]:
    """Rows with their numbers as a table in buckets of the number, so that joins by number leave them where they are."""
    spark = chosen.sparkSession
    found = numbered(chosen, *key, name=NUMBER)
    total = found.count()
    buckets = max(8, -(-total // ROWS_PER_PART))
    name, path = f"lens_numbers_{uuid.uuid4().hex}", f"{shared_dir(spark).rstrip('/')}/numbers-{uuid.uuid4().hex}"
    found.repartition(buckets, NUMBER).write.option("path", path).bucketBy(buckets, NUMBER).sortBy(NUMBER).saveAsTable(name)
    removed_at_end(spark, path)
    return spark.table(name), total, name


def trials(stored: DataFrame, total: int, column: str, repeats: int, seed: int) -> DataFrame:
    """The numbered rows once for each repeat, with the values of ``column`` permuted.

    Only the number and the value are shuffled: each value is sent to the number that the permutation of the column and the
    repeat names.
    """
    sent = [
        F.struct(F.lit(r).alias("repeat"), permuted(NUMBER, total, F.lit(f"{seed}|{column}|{r}")).alias("_to")) for r in range(1, repeats + 1)
    ]
    narrow = stored.select(F.col(column).alias("_donor"), F.inline(F.array(*sent))).select("repeat", F.col("_to").alias(NUMBER), "_donor")
    # Spark takes the sent values for as small as the column that they come from, and would gather them on the driver
    return stored.join(narrow.hint("merge"), NUMBER).withColumn(column, F.col("_donor")).drop("_donor")


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    cols: Sequence[str] = (*BASE_NUMERIC, *BASE_CATEGORICAL),
    key: Sequence[str] = (K.KEY,),
    n: int | None = None,
    repeats: int = 5,
    seed: int = 42,
    target: str = K.TARGET,
    scale: str = "rate",
    parallel: int = 4,
) -> DataFrame:
    """Rise of the MAE when one column is permuted, mean and deviation over repeats.

    All rows are scored, or an exact sample of ``n``. Rows are numbered in the order of ``key`` and stored once in buckets of
    the number. A trial permutes the numbers by a keyed permutation and joins one column back: one shuffle of a number and
    a value. All repeats of a column are one job, ``parallel`` of which run at a time; each returns a row per repeat.
    ``scale='log'`` measures the error between logarithms.
    """
    spark = df.sparkSession
    chosen = C.without_nan(df, target).where(F.col(target).isNotNull())
    chosen = (chosen if n is None else sample_n(chosen, n, key, seed)).select(*dict.fromkeys([*key, *cols, target]))
    stored, total, name = _by_number(chosen, key)
    y, p = F.col(target), F.col(K.PREDICTION)
    error = F.abs(F.log1p(p) - F.log1p(y)) if scale == "log" else F.abs(p - y)

    def of(column: str) -> list[float]:
        scored = model.transform(trials(stored, total, column, repeats, seed))
        return [r["mae"] for r in scored.groupBy("repeat").agg(F.avg(error).alias("mae")).collect()]

    base = model.transform(stored).agg(F.avg(error)).first()[0]
    found = in_parallel(spark, [functools.partial(of, c) for c in cols], parallel, "permute")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rises = [(c, m - base) for c, maes in zip(cols, found, strict=True) for m in maes]
    # one row for each column and repeat
    out = spark.createDataFrame(rises, "feature string, rise double").groupBy("feature")
    return out.agg(F.avg("rise").alias("importance_mean"), F.stddev_pop("rise").alias("importance_std")).orderBy(F.desc("importance_mean"), "feature")


def settings(config: Sequence[float]) -> Mapping[str, float]:
    """A tuning configuration by parameter name."""
    return dict(zip(("trees", "rate", "depth", "min_leaf", "rows", "cols"), config))
