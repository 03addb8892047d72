"""Cleaning of the document table, stage by stage.

Each stage takes all documents that the one before kept, and all but the last return the columns of documents. The
result of a stage is written as Parquet and read again. SQL cannot express the classifier, fingerprints, repeats and
tokens, so there is no ORACLE_SQL; the tests hold the stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import bpe, mixing, quality, repeats, simhash
from loadlens.llm.catalog import RANKS
from loadlens.llm.shared import ready, stored

#: Documents below this quality score go.
LEAST_SCORE = 0.3
#: Near duplicates: similarity of their sets of shingles of so many words.
SIMILARITY, WORDS = 0.8, 5


def _as_read(frame: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of ``documents``; its count of characters is brought up to date."""
    if "n_chars" in frame.columns:
        frame = frame.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return frame.select(*(F.col(f"`{c}`") for c in documents.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ready(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model, LEAST_SCORE)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id."""
    ready(spark)
    return simhash.one_of_each(docs, SIMILARITY, WORDS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated passages; characters stay whole."""
    ready(spark)
    spans = "".join(docs.columns) + "_spans"  # no column has this name
    marked = repeats.mark(docs, into=spans)
    return _as_read(marked.withColumn("text", repeats.kept_text("text", spans)), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one that a source's target cuts stays if half of it is taken."""
    ready(spark)
    return mixing.repeated(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digest of the bytes that they decode to."""
    ready(spark)
    ids = docs.select("doc_id", "source", bpe.encode(F.col("text"), RANKS).alias("ids"))
    raw = ids.withColumn("raw", bpe.decode(F.col("ids"), RANKS))
    return raw.select("doc_id", "source", "ids", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("raw", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole document table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
