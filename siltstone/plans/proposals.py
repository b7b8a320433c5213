"""Staged funds and proposals, and the enriched proposals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.functions import approval_rate, flag, lowered_text, matches_any, ratio, vote_total
from siltstone.operators.common import ts_lit

SOURCE = "governance_api"


def stage_funds(raw: DataFrame, now: datetime, source: str = SOURCE) -> DataFrame:
    return raw.select(
        "id",
        "title",
        F.col("id").alias("fund_number"),
        "proposals_count",
        F.col("amount").alias("funding_available"),
        "currency",
        "launch_date",
        "currency_symbol",
        F.col("link").alias("fund_link"),
        "thumbnail_url",
        "slug",
        F.col("content").alias("description"),
        F.col("content").alias("excerpt"),
        "label",
        "funded_proposals",
        ts_lit(now).alias("_loaded_at"),
        F.lit(source).alias("_source"),
    )


# The columns of a staged proposal.
PROPOSAL_COLUMNS = [
    "id", "user_id", "fund_id", "fund_name", "campaign_id", "campaign_name", "ideascale_id",
    "title", "website", "ideascale_link", "ideascale_user", "problem", "solution",
    "experience", "amount_requested", "amount_received", "currency", "currency_symbol",
    "project_status", "funding_status", "average_rating", "yes_votes_count",
    "no_votes_count", "abstain_votes_count", "unique_wallets_voted", "ranking_total",
    "ca_rating", "link", "has_github", "github_links", "categories", "primary_category",
    "proposal_type",
]
# Those that bear another name in the raw rows.
RAW_NAMES = {"unique_wallets_voted": "unique_wallets", "proposal_type": "type"}


def stage_proposals(raw: DataFrame, loaded_at: str = "ingested_at", source: str = SOURCE) -> DataFrame:
    return raw.select(
        *[F.col(RAW_NAMES.get(c, c)).alias(c) for c in PROPOSAL_COLUMNS],
        F.col(loaded_at).alias("_loaded_at"),
        F.lit(source).alias("_source"),
    )


def funding_category(received: str = "amount_received", status: str = "funding_status") -> Column:
    ladder = F.when(F.col(received) > 0, rules.FUNDED)
    for label, values in rules.FUNDING_STATUS_RULES:
        ladder = ladder.when(F.col(status).isin(values), label)
    return ladder.otherwise(rules.FUNDING_STATUS_DEFAULT)


def enrich_proposals(
    staged: DataFrame,
    related_terms: Sequence[str] = rules.WALLET_TERMS,
    competitor_terms: Sequence[str] = rules.COMPETITOR_TERMS,
    word_boundary: bool = False,
) -> DataFrame:
    """Proposals with funding category and ratio, votes, repository links and text flags.

    Row by row throughout, so a filter on the result reaches the scan.
    """
    text = lowered_text("title", "problem", "solution")
    return (
        staged.withColumn("_text", text)
        .withColumns({
            "funding_category": funding_category(),
            "funding_ratio": F.when(
                F.col("amount_received") > 0, ratio("amount_received", "amount_requested")
            ).otherwise(F.lit(0.0)),
            "total_votes": vote_total("yes_votes_count", "no_votes_count", "abstain_votes_count"),
            "github_repo_count": F.array_size("github_links"),
            "is_wallet_related": flag(matches_any("_text", related_terms, word_boundary)),
            "potential_competitor": flag(matches_any("_text", competitor_terms, word_boundary)),
        })
        .withColumns({
            "approval_rate": approval_rate("yes_votes_count", "total_votes"),
            "has_active_github": flag(F.col("has_github") & (F.col("github_repo_count") > 0)),
        })
        .drop("_text")
    )
