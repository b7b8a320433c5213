"""Status and summary reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.rules import FUNDED


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table_name, row_count) per table; a table that is not loaded has a null count."""
    spark = next(t for t in tables.values() if t is not None).sparkSession
    rows = []
    for name, df in tables.items():
        counted = (
            spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
            if df is None else df.agg(F.count(F.lit(1)).alias("row_count"))
        )
        rows.append(counted.select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionByName, rows)


def ecosystem_summary(
    proposals: DataFrame,
    category: str = "primary_category",
    status: str = "funding_status",
    amount: str = "amount_requested",
    has_repo: str = "has_github",
    funded_status: str = FUNDED,
    categories: int | None = None,
) -> DataFrame:
    """(section, name, count, total_amount): totals, all categories (or the largest ones), all statuses.

    The input is aggregated once, by category and status together; each of those
    few cells then adds to its line of every section.
    """
    base = proposals.select(
        F.col(category).alias("_category"),
        F.coalesce(F.col(status), F.lit("Unknown")).alias("_status"),
        F.col(amount).alias("_amount"),
        F.coalesce(F.col(has_repo), F.lit(False)).alias("_repo"),
    )
    cells = base.groupBy("_category", "_status").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_repo").alias("_with_repo"),
        F.sum("_amount").alias("_sum"),
    )
    no_amount = F.lit(None).cast(cells.schema["_sum"].dataType)

    def line(section: str, name: Column, count: Column, total: Column = no_amount) -> Column:
        return F.struct(
            F.lit(section).alias("section"), name.alias("name"),
            count.alias("count"), total.alias("total_amount"),
        )

    funded = F.col("_status") == funded_status
    rows, with_repo = F.col("_n"), F.col("_with_repo")
    lines = (
        cells.select(F.inline(F.array(
            line("totals", F.lit("total_proposals"), rows),
            line("totals", F.lit("github_proposals"), with_repo),
            line("totals", F.lit("funded_proposals"), F.when(funded, rows).otherwise(0)),
            line("totals", F.lit("funded_github_proposals"), F.when(funded, with_repo).otherwise(0)),
            line("categories", F.col("_category"), rows),
            line("funding_status", F.col("_status"), rows, F.col("_sum")),
        )))
        .groupBy("section", "name")
        .agg(F.sum("count").alias("count"), F.sum("total_amount").alias("total_amount"))
    )
    if categories is None:
        return lines
    is_category = F.col("section") == "categories"
    largest = (
        lines.filter(is_category)
        .orderBy(F.desc("count"), F.col("name").asc_nulls_last())
        .limit(categories)
    )
    return lines.filter(~is_category).unionByName(largest)
