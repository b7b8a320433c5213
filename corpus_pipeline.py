"""A corpus from documents: language, near copies, benchmark text, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents``; the last one returns each row's place. Stages are
written and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, language, mixing, near, shards
from siltstone.llm.common import read, save

# Part of the tokens that the mixture keeps, and the powers that temper the
# shares of sources, languages and topics.
FRACTION = 0.9
POWERS = (0.9, 0.9, 1.0)


def _only(docs: DataFrame, stays: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, hash of the text) is among ``stays``; all columns as they were."""
    keys = stays.select("doc_id", "th").distinct()
    rows = docs.select(*docs.columns, F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_th"))
    on = rows["_id"].eqNullSafe(keys["doc_id"]) & (rows["_th"] == keys["th"])
    return rows.join(keys, on, "left_semi").select(*docs.columns)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no language go: null, or without a letter. One that mixes languages is as clean as others and stays."""
    told = save(language.identify(docs, language.learn(language.training_rows(docs))).drop("spans"), "language")
    return _only(docs, told.filter(F.col("lang_pred") != language.UNKNOWN))


def by_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, and one of repeated rows."""
    told = save(near.near_duplicates(docs).filter("kept"), "near")
    once = _only(docs, told.filter("n_same = 1"))
    # A null text is no copy of another, so its rows all stay.
    more = _only(docs, told.filter("n_same > 1"))
    return once.unionByName(more.filter("text is null")).unionByName(
        more.filter("text is not null").dropDuplicates(["doc_id", "text"]))


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of which one word in twenty lies in a benchmark passage go."""
    told = save(decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")).drop("items"), "benchmark")
    return _only(docs, told.filter("not contaminated"))


def by_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with calibrated shares of sources, languages and topics; nulls are values of their own, no rows give none."""
    return _only(docs, mixing.mix(docs, fraction=FRACTION, powers=POWERS).filter("taken"))


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and place in it; a null text weighs its overhead only, no rows give none."""
    return shards.shard_documents(docs, more=("lang", "source"))


STAGES = [
    ("language", by_language),
    ("near_copies", by_near_copies),
    ("benchmark", by_benchmark),
    ("mixture", by_mixture),
    ("shards", into_shards),
]

# Language scores, sketches and raking are not SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
