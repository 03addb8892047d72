"""Quality classifier: a sparse ensemble of rules over text statistics.

The paths of a small forest's trees, trained on statistics of labelled texts, are conjunctive rules ("words <= 40 and
upper > 0.2"). A logistic regression with an L1 penalty weighs them and sets most weights to zero. The rules that are
left become Spark column expressions, so scoring is one projection over whole texts without Python.

Learning uses a bounded sample: at most ``SAMPLE`` labelled rows, those of smallest hash of their id. Only statistics of
the text are inputs. Documents are scored all alike, of any length.

* null or empty text: all statistics are 0, and the rules score it like any other
* a label that is null is left out; several labels of an id count as their mean, rounded
* no labelled rows: each score is 0.5; labels of one kind only: their smoothed share
* repeated rows get equal scores; an empty table gives an empty result
* the input's columns are kept as a struct until the end, so their names cannot clash with the statistics
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.shared import stored

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 11


@dataclass(frozen=True)
class Model:
    """Rules as (SQL condition over the statistics, weight), and the score's constant term."""

    rules: tuple[tuple[str, float], ...]
    intercept: float


def with_statistics(documents: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``documents`` as the column ``row``, with one double column per statistic of the whole text."""
    base = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = base.withColumns({"w": F.split(F.trim(F.col("t")), r"\s+"), "l": F.split(F.col("t"), "\n")})
    size = F.greatest(F.length("t"), F.lit(1))
    count = F.size("w")
    lines = F.size("l")
    share = lambda others: F.length(F.regexp_replace("t", others, "")) / size
    columns = {
        "chars": F.length("t").cast("double"),
        "words": F.when(F.length("t") > 0, count).otherwise(0).cast("double"),
        "word_length": F.length("t") / count,
        "line_length": F.length("t") / lines,
        "lines": lines.cast("double"),
        "new_lines": F.size(F.array_distinct("l")) / lines,
        "new_words": F.size(F.array_distinct("w")) / count,
        "variety": F.log(F.size(F.array_distinct("w")) + 1.0) / F.log(count + 1.0),
        "upper": share(r"[^\p{Lu}]+"),
        "letters": share(r"[^\p{L}]+"),
        "digits": share(r"[^\p{Nd}]+"),
        "stops": share(r"[^.!?]+"),
        "bars": share(r"[^|\t]+"),
        "signs": share(r"[\p{L}\p{N}\s.,;:!?'\"|-]+"),
        "shouts": share(r"[^!]+"),
    }
    return base.select("row", *(c.cast("double").alias(n) for n, c in columns.items())), list(columns)


def held_out(doc_id: Column) -> Column:
    """Whether a row is for testing only: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def paths(debug: str, names: list[str]) -> list[str]:
    """The conjunctions on the way to every node below the root, from the description of a forest."""
    found, way = [], []
    for line in debug.splitlines():
        depth = len(line) - len(line.lstrip())
        if line.lstrip().startswith("Tree "):
            way = []
        elif step := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line):
            way = [x for x in way if x[0] < depth] + [(depth, f"`{names[int(step[1])]}` {step[2]} {float(step[3])!r}D")]
            found.append(" AND ".join(sorted({x[1] for x in way})))
    return sorted(set(found))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, quality), leaving the held-out rows aside."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.round(F.avg("quality")).cast("double").alias("label"))
    drawn = known.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    texts = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most ``sample`` labels
    stats, names = with_statistics(texts)
    rows = stated = stored(stats.select("row.doc_id", "row.label", *names), "labelled")
    ones, total = rows.agg(F.sum("label"), F.count("*")).first()
    if not total or ones in (0.0, float(total)):
        odds = 1.0 if not total else (ones + 1) / (total - ones + 1)
        return Model((), math.log(odds))
    rows = stated.repartition(1).sortWithinPartitions("doc_id", "label", *names).limit(2 * sample)
    input_of = VectorAssembler(inputCols=names, outputCol="statistics")
    forest = RandomForestClassifier(featuresCol="statistics", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.7)
    rows = stored(rows, "training").coalesce(1)
    found = paths(forest.fit(input_of.transform(rows)).toDebugString, names)
    if not found:
        return Model((), math.log(ones / (total - ones)))
    held = rows.select("label", *(F.expr(f"CAST({rule} AS double)").alias(f"r{i}") for i, rule in enumerate(found)))
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(found))], outputCol="rules").transform(held)
    lasso = LogisticRegression(featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=100).fit(vectors)
    weights = zip(found, lasso.coefficients.toArray().tolist(), strict=True)
    return Model(tuple((rule, w) for rule, w in weights if w), lasso.intercept)


def accepted(documents: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """``documents`` with a score of ``least`` or more.

    The row number is there for the optimizer: it does not move a filter below such a column, and so does not put the
    statistics, each of which reads the whole text, into every rule of the condition.
    """
    stats, _ = with_statistics(documents, text)
    numbered = stats.withColumn("number", F.monotonically_increasing_id())
    return numbered.where((_probability(model) >= least) & (F.col("number") >= 0)).select("row.*")


def _probability(model: Model) -> Column:
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total = total + F.when(F.expr(rule), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, score): the input's columns as a struct, and the probability of label 1."""
    stats, _ = with_statistics(documents, text)
    return stats.select("row", _probability(model).alias("score"))
