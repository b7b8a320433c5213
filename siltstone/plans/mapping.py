"""Project-to-repository mapping and the delivery panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.functions import any_contains, link_key

LINK_COLUMNS = ("website", "link", "ideascale_link")


def map_project_repo(
    seed: DataFrame,
    staged: DataFrame,
    mapped_at: Column,
    link_columns: Sequence[str] = LINK_COLUMNS,
    host: str = rules.CODE_HOST,
    pattern: str = rules.REPO_KEY_PATTERN,
) -> DataFrame:
    """Curated and discovered (project_id, repo_key) pairs with their source.

    Curated rows are kept as they are; discovered ones need a key. ``mapped_at``
    is text: the seed's load time, or the proposal's load stamp.
    """
    curated = seed.select(
        F.col("project_id").cast("string").alias("project_id"),
        "repo_key",
        F.lit("seed").alias("source"),
        mapped_at.cast("string").alias("mapped_at"),
    )
    discovered = (
        staged.filter(any_contains(link_columns, host))
        .select(
            F.col("id").cast("string").alias("project_id"),
            link_key(link_columns, host, pattern).alias("repo_key"),
            F.lit("discovered").alias("source"),
            F.col("_loaded_at").cast("string").alias("mapped_at"),
        )
        .filter("repo_key is not null and repo_key != ''")
    )
    return curated.unionByName(discovered)


def repo_metrics(repositories: DataFrame) -> DataFrame:
    return repositories.groupBy(F.lower("full_name").alias("repo_key")).agg(
        F.count(F.lit(1)).alias("github_repos_count"),
        F.max("created_at").alias("latest_repo_created"),
        F.sum("stargazers_count").alias("total_stars"),
        F.sum("forks_count").alias("total_forks"),
    )


def delivery_panel(
    staged: DataFrame,
    repo_map: DataFrame,
    repositories: DataFrame,
    per_project: bool = False,
    link_columns: Sequence[str] = LINK_COLUMNS,
    host: str = rules.CODE_HOST,
) -> DataFrame:
    """Projects with the metrics of their linked repositories.

    One row per project and linked repository, as a project with n links fans
    out to n rows; ``per_project`` sums them to one. ``has_github_data`` only
    says that a mapping exists. Equi-joins throughout: a repository shared by
    very many projects is left to adaptive skew-join splitting.
    """
    pairs = repo_map.select("project_id", "repo_key").distinct()
    metrics = repo_metrics(repositories)
    activity = pairs.join(metrics, "repo_key", "left").select(
        "project_id", "total_stars", "total_forks", "github_repos_count"
    )
    if per_project:
        activity = activity.groupBy("project_id").agg(
            *[F.sum(c).alias(c) for c in ("total_stars", "total_forks", "github_repos_count")]
        )
    projects = staged.select(
        F.col("id").cast("string").alias("project_id"),
        "title",
        "amount_requested",
        "funding_status",
        any_contains(link_columns, host).alias("has_github"),
    )
    return projects.join(
        activity.withColumn("_mapped", F.lit(True)), "project_id", "left"
    ).select(
        *projects.columns,
        F.coalesce("total_stars", F.lit(0)).alias("github_stars"),
        F.coalesce("total_forks", F.lit(0)).alias("github_forks"),
        F.coalesce("github_repos_count", F.lit(0)).alias("linked_repos_count"),
        F.col("_mapped").isNotNull().alias("has_github_data"),
    )
