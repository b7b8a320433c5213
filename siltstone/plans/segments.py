"""Segmented projects and the competitive landscape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.functions import label_ladder, lowered_text, pct
from siltstone.operators.skew import with_place

# What the landscape has one row for.
GROUP = ["competition_level", "wallet_type"]

Ladder = Sequence[tuple[str, Sequence[str]]]

# The columns of a segment row.
SEGMENT_COLUMNS = [
    "id", "title", "fund_name", "fund_title", "wallet_type", "competition_level",
    "funding_category", "amount_requested", "amount_received", "funding_ratio",
    "has_active_github", "github_repo_count", "github_links", "approval_rate",
    "primary_category", "categories", "problem", "solution", "website", "fund_id", "_loaded_at",
]


def rank_of(column: str, labels: Sequence[str]) -> Column:
    """1, 2, .. for the listed labels, one more for any other."""
    ladder = F.when(F.lit(False), F.lit(0))
    for i, label in enumerate(labels, 1):
        ladder = ladder.when(F.col(column) == label, F.lit(i))
    return ladder.otherwise(F.lit(len(labels) + 1))


def segment_projects(
    enriched: DataFrame,
    funds: DataFrame,
    type_rules: Ladder = rules.WALLET_TYPE_RULES,
    type_default: str = rules.WALLET_TYPE_DEFAULT,
    level_rules: Ladder = rules.COMPETITION_RULES,
    level_default: str = rules.COMPETITION_DEFAULT,
    ordered: bool = True,
) -> DataFrame:
    """Related projects with their type and competition level, strongest competitors first.

    The fund title joins without a hint: Spark broadcasts ``funds`` while its
    size allows. Ask for ``ordered=False`` when another model reads the result.
    """
    titles = funds.select(F.col("id").alias("_fund"), F.col("title").alias("fund_title"))
    rows = (
        enriched.filter("is_wallet_related")
        .withColumn("_text", lowered_text("title", "solution"))
        .withColumns({
            "wallet_type": label_ladder("_text", type_rules, type_default),
            "competition_level": label_ladder("_text", level_rules, level_default),
        })
        .join(titles, F.col("fund_id") == F.col("_fund"), "left")
        .select(*SEGMENT_COLUMNS)
    )
    if not ordered:
        return rows
    # The id lets the range shuffle split rows of equal rank and amount.
    return rows.orderBy(
        rank_of("competition_level", [label for label, _ in level_rules]),
        F.col("amount_received").desc_nulls_last(),
        "id",
    )


def priority_score(
    level: str,
    scores: Mapping[str, int],
    default: int,
    bonuses: Sequence[tuple[str, float, int]],
) -> Column:
    """Score of a label plus points for every column above its threshold."""
    ladder = F.when(F.lit(False), F.lit(default))
    for label, score in scores.items():
        ladder = ladder.when(F.col(level) == label, F.lit(score))
    score = ladder.otherwise(F.lit(default))
    for column, threshold, points in bonuses:
        score = score + F.when(F.col(column) > threshold, points).otherwise(0)
    return score


def landscape(
    segments: DataFrame,
    scores: Mapping[str, int] = rules.COMPETITION_SCORES,
    score_default: int = rules.COMPETITION_SCORE_DEFAULT,
    bonuses: Sequence[tuple[str, float, int]] = rules.SCORE_BONUSES,
) -> DataFrame:
    """Metrics and priority score, one row per competition level and type.

    The funded examples are a table of their own, :func:`landscape_examples`.
    """
    funded = F.col("funding_category") == rules.FUNDED
    return (
        segments.groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("project_count"),
            F.count_if(funded).alias("funded_project_count"),
            F.count_if("has_active_github").alias("projects_with_github"),
            F.sum(F.when(funded, F.col("amount_received")).otherwise(0)).alias("total_funding_received"),
            F.avg(F.when(funded, F.col("amount_received"))).alias("avg_funding_per_funded_project"),
            F.round(F.avg("approval_rate") * 100, 1).alias("avg_approval_rate"),
            F.round(F.avg("funding_ratio") * 100, 1).alias("avg_funding_ratio"),
        )
        .withColumns({
            "funding_success_rate": pct("funded_project_count", "project_count"),
            "github_adoption_rate": pct("projects_with_github", "project_count"),
        })
        .withColumn(
            "strategic_priority_score",
            priority_score("competition_level", scores, score_default, bonuses),
        )
        .orderBy(
            F.desc("strategic_priority_score"),
            F.col("total_funding_received").desc_nulls_last(),
            *GROUP,
        )
    )


def landscape_examples(segments: DataFrame, grain: float | None = 1.0) -> DataFrame:
    """All funded projects of each group with their place, most received first (from 0)."""
    funded = segments.filter(F.col("funding_category") == rules.FUNDED).select(
        *GROUP, "id", "title",
        F.col("amount_received").alias("funding_received"),
        F.col("has_active_github").alias("has_github"),
        F.col("github_repo_count").alias("github_repos"),
    )
    return with_place(funded, GROUP, "funding_received", [F.col("id").asc_nulls_last()], grain=grain)
