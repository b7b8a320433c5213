"""Driver tables cast in the roles of funds, proposals, pull requests, releases.

Amounts are whole cents, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.common import ts_lit
from siltstone.sources import schemas

NOW = datetime(2024, 1, 31)

# Rules over the driver's words (part names are an adjective and a noun).
PART_TYPE_RULES = [
    ("widget", ["widget"]),
    ("fastener", ["bolt", "rod"]),
    ("ring", ["ring"]),
]
PART_LEVEL_RULES = [
    ("direct_competitor", ["red ", "blue "]),
    ("existing_competitor", ["large"]),
    ("indirect_competitor", ["small", "new bolt"]),
]
RELATED_TERMS = ["widget", "bolt", "rod", "ring"]
COMPETITOR_TERMS = ["red", "large widget"]
# Priorities stand in for titles of pull requests.
PRIORITY_RULES = [
    ("bug fix", ["urgent"]),
    ("feature", ["high", "medium", "low"]),
]
SEGMENT_COUNTS = {"building_projects": "BUILDING", "urgent_projects": "1-URGENT"}


# Schemas already read from a table's footer, by path.
_SCHEMAS: dict[str, schemas.T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("long")


def funds(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as funding rounds."""
    nation = table(spark, sf, "nation")
    return schemas.conform(
        nation.select(
            F.col("n_nationkey").cast("long").alias("id"),
            F.col("n_name").alias("title"),
            (F.col("n_regionkey") * 1000).cast("long").alias("amount"),
            F.lower("n_name").alias("slug"),
        ),
        schemas.FUNDS,
    )


def proposals(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as proposals: customer gives fund and category, lines give votes, links and title."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("yes_votes_count"),
        F.count_if(F.col("l_returnflag") == "A").alias("no_votes_count"),
        F.count_if(F.col("l_returnflag") == "N").alias("abstain_votes_count"),
        F.min("l_partkey").alias("first_part"),
        # The line numbers that occur, as bits: no list per order to build up.
        F.bit_or(F.expr("shiftleft(1L, l_linenumber)")).alias("numbers"),
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    price = cents("o_totalprice")
    rows = (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(part, F.col("first_part") == F.col("p_partkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            F.col("c_nationkey").cast("long").alias("fund_id"),
            F.concat(F.lit("Fund "), F.col("c_nationkey")).alias("fund_name"),
            F.col("p_name").alias("title"),
            F.when(F.col("o_orderstatus") != "O", F.lower("c_mktsegment")).alias("problem"),
            F.when(F.col("o_orderstatus") != "P", F.lower("o_orderpriority")).alias("solution"),
            price.alias("amount_requested"),
            F.when(F.col("o_orderstatus") == "F", price).otherwise(0).alias("amount_received"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "approved")
            .when(F.col("o_orderpriority") == "2-HIGH", "pending")
            .otherwise(F.col("o_orderpriority")).alias("funding_status"),
            "yes_votes_count", "no_votes_count", "abstain_votes_count",
            (F.col("o_orderstatus") != "P").alias("has_github"),
            F.when(F.col("numbers").isNotNull(), F.transform(
                F.filter(
                    F.sequence(F.lit(1), F.lit(31)), lambda n: F.getbit(F.col("numbers"), n) == 1
                ),
                lambda n: F.concat(F.lit("https://github.com/org/line"), n),
            )).alias("github_links"),
            F.col("c_mktsegment").alias("primary_category"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("ingested_at"),
            F.concat(F.lit("["), "c_mktsegment", F.lit(", "), "o_orderpriority", F.lit("]"))
            .alias("categories"),
        )
    )
    declared = [f for f in schemas.PROPOSALS.fields if f.name != "categories"]
    return schemas.conform(rows, schemas.T.StructType(declared))


def feature_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as pull requests (repository, title, closed_at), customers' nations as repositories."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("nation/"), F.col("c_nationkey")).alias("repository"),
            F.col("o_orderpriority").alias("title"),
            F.col("o_orderdate").alias("closed_at"),
        )
    )


def raw_pull_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw pull requests: the type is the repository, the hour words the title."""
    hour = F.hour("ts")
    is_open = F.col("value") < 10
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_id").alias("number"),
        F.concat(
            F.when(hour < 4, "Fix ").when(hour < 10, "Add ").when(hour < 14, "Refactor ")
            .when(hour < 18, "Test ").when(hour < 20, "Update docs ").otherwise("Note "),
            F.col("props"),
        ).alias("title"),
        F.col("props").alias("body"),
        F.when(is_open, "open").otherwise("closed").alias("state"),
        F.struct(F.concat(F.lit("u"), F.col("user_id")).alias("login")).alias("user"),
        F.struct(F.lit("main").alias("ref")).alias("base"),
        F.struct(F.concat(F.lit("b"), F.col("event_id")).alias("ref")).alias("head"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.when(~is_open, at).alias("closed_at"),
        F.concat(F.lit("org/"), F.col("event_type")).alias("repository_full_name"),
    )
    return schemas.conform(rows, schemas.PULL_REQUESTS)


def raw_releases(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as raw releases: supplier is the repository, part and line number the tag."""
    at = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("v"), "l_partkey", F.lit("."), "l_linenumber").alias("tag_name"),
        F.concat(F.lit("Line "), "l_orderkey").alias("name"),
        (F.col("l_linestatus") == "O").alias("draft"),
        (F.col("l_returnflag") == "R").alias("prerelease"),
        F.struct(F.col("l_returnflag").alias("login")).alias("author"),
        F.when(F.col("l_tax") > 0, at).alias("published_at"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.concat(F.lit("supplier/"), F.col("l_suppkey")).alias("repository_full_name"),
        F.lit("2024-01-31T00:00:00").alias("fetched_at"),
    )
    return schemas.conform(rows, schemas.RELEASES)


def customers_as_projects(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("title"),
        cents("c_acctbal").alias("amount_requested"),
        F.col("c_mktsegment").alias("funding_status"),
        F.when(F.col("c_mktsegment") == "BUILDING", "https://example.org").alias("website"),
        F.when(
            F.col("c_acctbal") > 0, F.concat(F.lit("https://github.com/cust/"), F.col("c_custkey"))
        ).alias("link"),
    )
    return schemas.conform(rows, schemas.PROPOSALS)


def orders_as_repositories(spark: SparkSession, sf: str) -> DataFrame:
    """Each order is a row of its customer's repository."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Cust/"), F.col("o_custkey")).alias("full_name"),
        cents("o_totalprice").alias("stargazers_count"),
        F.col("o_orderkey").alias("forks_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
    )
    return schemas.conform(rows, schemas.REPOSITORIES)


def repo_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Customers linked to their own repository and to that of a neighbour; pairs repeat per order."""
    customer = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        customer.cast("string").alias("project_id"),
        F.explode(F.array(
            F.concat(F.lit("cust/"), customer), F.concat(F.lit("cust/"), customer + 1)
        )).alias("repo_key"),
    )


def raw_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as issues; the assistant's are pull requests in disguise."""
    rows = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("turn").alias("number"),
        F.col("text").alias("title"),
        F.lit("open").alias("state"),
        F.when(F.col("role") == "assistant", F.struct(F.lit("pull").alias("url")))
        .alias("pull_request"),
        F.concat(F.lit("org/"), F.col("role")).alias("repository_full_name"),
    )
    return schemas.conform(rows, schemas.ISSUES)


def now() -> Column:
    return ts_lit(NOW)
