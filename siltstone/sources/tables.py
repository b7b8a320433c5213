"""Layer tables, views, seeds and multi-target writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources import versions
from siltstone.sources.schemas import SEED_REPO_MAP, SEED_REPOSITORIES


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    materialized: str = "table",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Store a model as a table under ``root/layer/name``, or as the view ``layer_name``.

    Returns the stored form, so later models read the table and not its plan.
    :func:`read_table` reads it again.
    """
    if materialized == "view":
        df.createOrReplaceTempView(f"{layer}_{name}")
        return df.sparkSession.table(f"{layer}_{name}")
    if materialized != "table":
        raise ValueError(f"unknown materialization: {materialized}")
    return full_load(df, f"{root}/{layer}/{name}", partition_by)


def full_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` by ``df``, all at once: until then, and if it fails, the old one stands."""
    return versions.replace(df, path, partition_by)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as of its last complete load."""
    return versions.read(spark, path)


def write_all(df: DataFrame, paths: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """The same rows at several targets: computed once, then copied from the first."""
    stored = full_load(df, paths[0], partition_by)
    for path in paths[1:]:
        full_load(stored, path, partition_by)
    return stored


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose schemas differ in added columns, as one table."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_REPO_MAP) -> DataFrame:
    """A seed CSV with header."""
    return spark.read.schema(schema).option("header", "true").option(
        "enforceSchema", "false"
    ).csv(path)


def read_seed_repositories(spark: SparkSession, path: str) -> DataFrame:
    """The shipped seed (repository_full_name, ...) in the form the mapping reads."""
    return read_seed(spark, path, SEED_REPOSITORIES).select(
        F.col("project_name").alias("project_id"), F.lower("repository_full_name").alias("repo_key")
    )
