"""Funded projects per funding round."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import rules
from siltstone.functions import has_token, pct
from siltstone.operators.common import join_on
from siltstone.operators.skew import exact_quantile


def funding_summary(
    enriched: DataFrame,
    funds: DataFrame,
    category_counts: Mapping[str, str] = rules.CATEGORY_COUNTS,
    trim: bool = False,
    grain: float | None = 1.0,
) -> DataFrame:
    """Metrics of funded proposals by fund, highest fund first.

    Proposals are aggregated before the fund title is joined on, so only one
    row per fund meets ``funds`` (unique by id). The exact median is computed
    apart, so no task holds all amounts of a fund.
    """
    group = ["fund_id", "fund_name"]
    funded = enriched.filter(F.col("funding_category") == rules.FUNDED)
    is_array = isinstance(enriched.schema["categories"].dataType, T.ArrayType)
    metrics = funded.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_funded_projects"),
        F.sum("amount_received").alias("total_funding_distributed"),
        F.avg("amount_received").alias("avg_funding_per_project"),
        F.max("amount_received").alias("max_single_funding"),
        F.count_if("has_active_github").alias("projects_with_github"),
        F.count_if("is_wallet_related").alias("wallet_ecosystem_projects"),
        F.count_if("potential_competitor").alias("potential_competitors"),
        *[
            F.count_if(has_token("categories", token, is_array, trim)).alias(name)
            for name, token in category_counts.items()
        ],
        F.avg("approval_rate").alias("avg_approval_rate"),
        F.avg("funding_ratio").alias("avg_funding_ratio"),
    )
    median = exact_quantile(
        funded, group, "amount_received", 0.5, "median_funding_per_project", grain=grain
    )
    titles = funds.select(F.col("id").alias("_fund"), F.col("title").alias("fund_title"))
    total = "total_funded_projects"
    return (
        join_on(metrics, median, group, "left")
        .join(titles, F.col("fund_id") == F.col("_fund"), "left")
        .drop("_fund")
        .withColumns({
            "github_adoption_pct": pct("projects_with_github", total),
            "wallet_ecosystem_pct": pct("wallet_ecosystem_projects", total),
            "competition_pct": pct("potential_competitors", total),
        })
        .orderBy(F.col("fund_id").desc_nulls_last())
    )
