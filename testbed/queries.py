"""Registered queries: every operator on whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import rules
from siltstone.functions import (
    any_contains, flag, has_token, label_ladder, link_key, lowered_text, matches_any,
    nested_contains, repo_name, repo_owner,
)
from siltstone.functions.temporal import month_of
from siltstone.operators import incremental as inc
from siltstone.operators import quality, ranges, reports, sketches, windows
from siltstone.operators.common import ts_lit
from siltstone.operators.quality import Suite
from siltstone.operators.skew import exact_quantile, with_place
from siltstone.plans import activity, funding, mapping, segments
from siltstone.plans import proposals as plans
from siltstone.session import workspace
from siltstone.sources import buckets, landing, logs, rollups, schemas, tables
from siltstone.streaming import jobs
from testbed import roles
from testbed.roles import NOW, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Schema of loaded ranges, without their key.
PLACE = T.StructType([T.StructField("at", T.TimestampNTZType()), T.StructField("tie", T.LongType())])
RANGE = T.StructType([T.StructField("low", PLACE), T.StructField("high", PLACE)])

# Small enough that the split paths run at test size too.
COARSE = 200.0


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- activity ----------------------------------------------------------------


def _features(spark: SparkSession, sf: str) -> DataFrame:
    orders = roles.feature_orders(spark, sf).withColumn("_text", lowered_text("title"))
    label = label_ladder("_text", roles.PRIORITY_RULES, rules.PR_TITLE_DEFAULT)
    return activity.features(orders.withColumn("feat_classifier", label))


@query
def activity_monthly(spark, sf):
    return activity.activity_monthly(
        _features(spark, sf), "repository", "closed_at", count="feature_pr_count"
    )


@query
def pinned_vs_top_monthly(spark, sf):
    return activity.pinned_vs_top_monthly(
        _features(spark, sf), "repository", "closed_at", "nation/7", pinned_label="pinned",
        month="pr_month", count="feature_pr_count",
    )


@query
def median_gap_vs_top(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts")
    return activity.median_gap_vs_top(events, "user_id", "ts", 7, out="median_days")


@query
def median_gap_vs_top_sliced(spark, sf):
    """The same over event types, each of which is cut into many slices."""
    events = table(spark, sf, "events").select("event_type", "ts")
    return activity.median_gap_vs_top(
        events, "event_type", "ts", "error", n=3, pinned_label="pinned", with_group=True,
        out="median_days", digits=6, grain=COARSE,
    )


@query
def staged_pull_requests(spark, sf):
    raw = landing.stamp(roles.raw_pull_requests(spark, sf), NOW)
    return activity.stage_pull_requests(activity.passthrough(raw))


@query
def features_from_staged(spark, sf):
    raw = landing.stamp(roles.raw_pull_requests(spark, sf), NOW)
    staged = activity.stage_pull_requests(raw)
    return activity.activity_monthly(
        activity.features(staged), "repository", "closed_at", count="feature_pr_count"
    )


@query
def staged_releases(spark, sf):
    return activity.stage_releases(activity.passthrough(roles.raw_releases(spark, sf))).withColumn(
        "row_num", F.col("row_num").cast("long")
    )


def _releases(spark: SparkSession, sf: str) -> DataFrame:
    return activity.latest_release_times(roles.raw_releases(spark, sf))


@query
def releases_monthly(spark, sf):
    return activity.activity_monthly(
        _releases(spark, sf), "repository", "published_at", "release_month", "release_count"
    )


@query
def releases_vs_top_monthly(spark, sf):
    return activity.pinned_vs_top_monthly(
        _releases(spark, sf), "repository", "published_at", "supplier/3",
        pinned_label="pinned", month="release_month", count="release_count",
    )


@query
def median_gap_releases(spark, sf):
    return activity.median_gap_vs_top(
        _releases(spark, sf), "repository", "published_at", "supplier/3",
        out="median_days_between_releases",
    )


@query
def positional_group_by(spark, sf):
    """Grouping and ordering by position, as SQL text."""
    return spark.sql(
        """select event_type, cast(trunc(cast(ts as date), 'MM') as timestamp_ntz) as month,
               count(*) as n, max(value) as highest
           from {events} group by 1, 2 order by 2, 1""",
        events=table(spark, sf, "events"),
    )


# --- windows and quantiles ---------------------------------------------------


@query
def latest_per_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return windows.latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def _previous_event(spark: SparkSession, sf: str, **sizes: float) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return windows.with_previous(events, "event_type", "ts", **sizes)


@query
def previous_event(spark, sf):
    return _previous_event(spark, sf)


@query
def previous_event_sliced(spark, sf):
    return _previous_event(spark, sf, grain=COARSE)


@query
def previous_event_even(spark, sf):
    """Slices from a sampled order in place of hours."""
    return _previous_event(spark, sf, grain=None)


@query
def places_among_ties(spark, sf):
    """Lines numbered per return flag by a column of two values, so that nearly all of them tie."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")
    return with_place(
        lines, "l_returnflag", "l_linestatus", [F.asc("l_orderkey"), F.asc("l_linenumber")], grain=None)


@query
def event_gaps(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return windows.gaps(events, "user_id", "ts")


@query
def gap_counts(spark, sf):
    return _gap_counts(spark, sf)


@query
def gap_counts_sliced(spark, sf):
    return _gap_counts(spark, sf, grain=COARSE)


def _gap_counts(spark: SparkSession, sf: str, **sizes: float) -> DataFrame:
    """Gaps between order dates per nation: many orders share a day."""
    gaps = windows.gap_counts(
        roles.feature_orders(spark, sf), "repository", "closed_at", **sizes
    )
    return gaps.groupBy("repository", "days_diff").agg(F.sum("gaps").alias("gaps"))


@query
def quantile_by_key(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", roles.cents("l_extendedprice").alias("price")
    )
    p90 = exact_quantile(lines, ["l_returnflag", "l_linestatus"], "price", 0.9, "p90")
    return p90.withColumn("p90", F.round("p90", 4))


@query
def quantile_by_key_sliced(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", roles.cents("l_extendedprice").alias("price")
    )
    p90 = exact_quantile(
        lines, ["l_returnflag", "l_linestatus"], "price", 0.9, "p90", grain=COARSE
    )
    return p90.withColumn("p90", F.round("p90", 4))


@query
def quantile_by_key_even(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", roles.cents("l_extendedprice").alias("price")
    )
    p90 = exact_quantile(lines, ["l_returnflag", "l_linestatus"], "price", 0.9, "p90", grain=None)
    return p90.withColumn("p90", F.round("p90", 4))


# --- rules and text ----------------------------------------------------------


@query
def label_ladder_parts(spark, sf):
    part = table(spark, sf, "part").withColumn("_text", lowered_text("p_name", "p_type"))
    return part.select(
        "p_partkey", "p_name",
        label_ladder("_text", roles.PART_TYPE_RULES, "other").alias("part_type"),
        label_ladder("_text", roles.PART_LEVEL_RULES, "other").alias("part_level"),
        label_ladder("_text", [("rod", ["rod"]), ("promo", ["pro"])], "none", word_boundary=True)
        .alias("whole_word"),
    )


@query
def label_ladder_docs(spark, sf):
    docs = table(spark, sf, "documents").withColumn("_text", lowered_text("text"))
    return docs.select(
        "doc_id",
        label_ladder("_text", rules.PR_TITLE_RULES, rules.PR_TITLE_DEFAULT).alias("title_class"),
        label_ladder("_text", rules.PR_TITLE_SHORT_RULES, rules.PR_TITLE_SHORT_DEFAULT)
        .alias("short_class"),
        label_ladder("_text", rules.PR_TITLE_TEST_FIRST_RULES, rules.PR_TITLE_DEFAULT)
        .alias("test_first_class"),
        label_ladder("_text", rules.WALLET_TYPE_RULES, rules.WALLET_TYPE_DEFAULT)
        .alias("wallet_type"),
        label_ladder("_text", rules.COMPETITION_RULES, rules.COMPETITION_DEFAULT)
        .alias("competition_level"),
    )


@query
def text_flags(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    docs = docs.withColumn("note", F.when(F.col("quality") == 1, F.col("source")))
    docs = docs.withColumn("_text", lowered_text("note", "text", "lang"))
    plain = lowered_text("text", "note")
    return docs.select(
        "doc_id",
        flag(matches_any("_text", ["src1", "heon", "de"])).alias("noted"),
        flag(matches_any(plain, rules.WALLET_TERMS)).alias("is_wallet_related"),
        flag(matches_any(plain, rules.COMPETITOR_TERMS)).alias("potential_competitor"),
        any_contains(["note", "lang", "text"], "src7").alias("mentions_src7"),
    )


@query
def bracket_tokens(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("["), "o_orderstatus", F.lit(", "), "o_orderpriority", F.lit("]"))
        .alias("tags"),
    )
    return orders.select(
        "o_orderkey",
        has_token("tags", "F").alias("first_found"),
        has_token("tags", "1-URGENT").alias("second_found"),
        has_token("tags", "1-URGENT", trim=True).alias("second_trimmed"),
    )


@query
def link_parts(spark, sf):
    pages = table(spark, sf, "pages")
    key = link_key(["url"], "example.", r"://([^/]+/[^/]+)")
    uris = F.array(F.array("url"), F.array(F.lit(None).cast("string"), "html"))
    return pages.select("page_id", key.alias("full_name"), uris.alias("uris")).select(
        "page_id", "full_name",
        repo_owner("full_name").alias("owner"),
        repo_name("full_name").alias("name"),
        nested_contains("uris", "spam-farm").alias("has_spam_uri"),
    )


# --- proposals ---------------------------------------------------------------


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return plans.stage_proposals(roles.proposals(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return plans.enrich_proposals(_staged(spark, sf), roles.RELATED_TERMS, roles.COMPETITOR_TERMS)


def _staged_funds(spark: SparkSession, sf: str) -> DataFrame:
    return plans.stage_funds(roles.funds(spark, sf), NOW)


@query
def staged_funds(spark, sf):
    return _staged_funds(spark, sf).select(
        "id", "title", "fund_number", "funding_available", "slug", "description", "_loaded_at",
        "_source",
    )


@query
def staged_proposals(spark, sf):
    return _staged(spark, sf).select(
        "id", "user_id", "fund_id", "fund_name", "title", "problem", "solution",
        "amount_requested", "amount_received", "funding_status", "yes_votes_count",
        "no_votes_count", "abstain_votes_count", "unique_wallets_voted", "has_github",
        "categories", "proposal_type", "_loaded_at", "_source",
    )


@query
def enrich_proposals(spark, sf):
    return _enriched(spark, sf).select(
        "id", "fund_id", "fund_name", "title", "amount_requested", "amount_received",
        "funding_status", "funding_category", "funding_ratio", "total_votes", "approval_rate",
        "has_active_github", "github_repo_count", "is_wallet_related", "potential_competitor",
        "primary_category", "_loaded_at", "_source",
    )


def _summary(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "avg_approval_rate": F.round("avg_approval_rate", 8),
        "avg_funding_ratio": F.round("avg_funding_ratio", 8),
    })


@query
def funding_summary(spark, sf):
    return _summary(funding.funding_summary(
        _enriched(spark, sf), _staged_funds(spark, sf), roles.SEGMENT_COUNTS
    ))


@query
def funding_summary_sliced(spark, sf):
    return _summary(funding.funding_summary(
        _enriched(spark, sf), _staged_funds(spark, sf), roles.SEGMENT_COUNTS, grain=COARSE
    ))


def _segments(spark: SparkSession, sf: str, ordered: bool) -> DataFrame:
    return segments.segment_projects(
        _enriched(spark, sf), _staged_funds(spark, sf),
        roles.PART_TYPE_RULES, "infrastructure", roles.PART_LEVEL_RULES, "other", ordered,
    )


@query
def segment_projects(spark, sf):
    return _segments(spark, sf, True).select(
        "id", "title", "fund_title", "wallet_type", "competition_level", "funding_category",
        "amount_received", "funding_ratio", "has_active_github", "approval_rate", "solution",
    )


def _landscape(spark: SparkSession, sf: str) -> DataFrame:
    return segments.landscape(
        _segments(spark, sf, False), bonuses=[
            ("funding_success_rate", 30, 20), ("total_funding_received", 10_000_000_000, 15),
        ],
    )


def _landscape_pages(spark: SparkSession, sf: str, **sizes: float) -> DataFrame:
    """The metrics with the examples in pages of 25."""
    funded = _segments(spark, sf, False).filter("funding_category = 'funded'")
    example = F.struct(
        "title", F.col("amount_received").alias("funding_received"),
        F.col("has_active_github").alias("has_github"),
        F.col("github_repo_count").alias("github_repos"),
    )
    pages = windows.ranked_pages(
        funded, segments.GROUP, "amount_received", example, 25, ["id"], "top_funded_examples", **sizes
    ).withColumnRenamed("page", "examples_page")
    as_json = F.to_json("top_funded_examples", {"ignoreNullFields": "false"})
    return _landscape(spark, sf).join(pages, segments.GROUP, "left").withColumns({
        "examples_page": F.coalesce("examples_page", F.lit(0)), "top_funded_examples": as_json,
    })


@query
def landscape(spark, sf):
    return _landscape(spark, sf)


@query
def landscape_examples(spark, sf):
    return segments.landscape_examples(_segments(spark, sf, False))


@query
def landscape_paged(spark, sf):
    return _landscape_pages(spark, sf)


@query
def landscape_sliced(spark, sf):
    return _landscape_pages(spark, sf, grain=COARSE)


@query
def map_entity_links(spark, sf):
    seed_path = workspace(spark, "seed")
    table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("project_id"), F.lower("n_name").alias("repo_key")
    ).write.option("header", "true").csv(seed_path)
    staged = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.when(F.col("url").startswith("https"), F.col("url")).alias("website"),
        F.col("url").alias("link"),
        F.lit(None).cast("string").alias("ideascale_link"),
        F.lit("load-1").alias("_loaded_at"),
    )
    return mapping.map_project_repo(
        tables.read_seed(spark, seed_path), staged, ts_lit(NOW),
        host="example.com", pattern=r"example\.com/([^/]+/[^/]+)",
    )


@query
def delivery_panel(spark, sf):
    return mapping.delivery_panel(
        roles.customers_as_projects(spark, sf), roles.repo_pairs(spark, sf),
        roles.orders_as_repositories(spark, sf),
    )


@query
def delivery_panel_per_project(spark, sf):
    return mapping.delivery_panel(
        roles.customers_as_projects(spark, sf), roles.repo_pairs(spark, sf),
        roles.orders_as_repositories(spark, sf), per_project=True,
    )


# --- incremental loads -------------------------------------------------------


def _lines_by_date(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem")
    split = ts_lit(datetime(1999, 1, 1))
    return lines.filter(F.col("l_shipdate") < split), lines.filter(F.col("l_shipdate") >= split)


@query
def upsert_latest(spark, sf):
    old, new = _lines_by_date(spark, sf)
    return inc.upsert(old, new, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def merge_into_latest(spark, sf):
    old, new = _lines_by_date(spark, sf)
    keys = ["l_orderkey", "l_linenumber"]
    return inc.merge_into(windows.latest_per_key(old, keys, "l_shipdate"), new, keys, "l_shipdate")


@query
def sketched_quantiles(spark, sf):
    """Quartiles of the values per event type out of stored sketches per user and day: are their ranks within the bound?"""
    events = table(spark, sf, "events").select("event_type", "user_id", "value", F.to_date("ts").alias("day"))
    stored = tables.full_load(
        sketches.sketched(events, ["event_type", "user_id", "day"], "value"), f"{workspace(spark, 'sketches')}/daily")
    told = sketches.merged(stored, "event_type").select(
        "event_type", sketches.values_in().alias("n"), *[sketches.quantile(q).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75)])
    tall = told.unpivot(["event_type", "n"], ["q25", "q50", "q75"], "quartile", "estimate")
    ranked = events.join(tall, "event_type").groupBy("event_type", "quartile", "n").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto"))
    want = F.substring("quartile", 2, 2).cast("double") / 100 * F.col("n")
    off = F.greatest(F.col("below") - want, want - F.col("upto")) / F.col("n")
    return ranked.select("event_type", "quartile", "n", (off <= sketches.rank_error()).alias("within"))


@query
def bucketed_merge(spark, sf):
    """A stored base, merged with two loads of updates that touch some of its buckets."""
    old, new = _lines_by_date(spark, sf)
    root = workspace(spark, "buckets")
    buckets.create(old, f"{root}/lines", ["l_orderkey", "l_linenumber"], "l_shipdate", buckets=16)
    late = F.col("l_shipdate") >= ts_lit(datetime(1998, 6, 1))
    for part in (new.filter(~late), new.filter(late)):
        buckets.merge(spark, f"{root}/lines", part)
    return tables.read_table(spark, f"{root}/lines")


@query
def incremental_monthly(spark, sf):
    """Orders and amounts per status and month, kept up to date over three loads that correct earlier rows.

    The first load dates a third of its orders two months early, another third has no status.
    Later loads correct them, bring the missing orders, repeat some and bring outdated ones.
    """
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", roles.cents("o_totalprice").alias("amount"), F.lit(1).alias("edition"))
    of = F.col("o_orderkey") % 3
    wrong = orders.withColumns({
        "o_orderdate": F.when(of == 0, F.add_months("o_orderdate", -2).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")),
        "o_orderstatus": F.when(of != 1, F.col("o_orderstatus")), "amount": F.col("amount") + of, "edition": F.lit(0)})
    late = F.col("o_orderkey") % 5 == 4
    root = workspace(spark, "rollup")
    rollup = rollups.Rollup(
        {"status": F.col("o_orderstatus"), "month": month_of("o_orderdate")}, {"amount": F.col("amount")})
    rollups.create(orders, f"{root}/orders", "o_orderkey", "edition", 16)
    loads = [wrong.filter(~late), orders.filter(late | (of == 0)), orders.filter(of != 0).unionByName(wrong.filter(of == 0))]
    for batch, updates in enumerate(loads):
        rollups.load(spark, f"{root}/orders", f"{root}/log", updates, rollup, batch)
    return rollups.read(spark, f"{root}/log", rollup, "order_count")


@query
def merged_levels(spark, sf):
    """The latest event per user out of ten batches, of which levels have been merged on the way."""
    root, order = workspace(spark, "levels"), ["ts", "event_id"]
    events = table(spark, sf, "events")
    resolve = logs.newest("user_id", order)
    for batch in range(10):
        logs.append(events.filter(F.col("event_id") % 10 == batch), f"{root}/log", resolve, batch, "load")
    return logs.read_log(spark, f"{root}/log", resolve)


@query
def loaded_ranges(spark, sf):
    """How often each event was loaded by two capped loads and a whole one, the last of which met new events."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    root, key = workspace(spark, "ranges"), "event_type"
    early = F.col("ts") < ts_lit(datetime(2024, 1, 20))
    done = spark.createDataFrame([], T.StructType([events.schema[key], *RANGE.fields]))
    # The caps and the arrivals are the feature: together the loads take all rows.
    for n, (cap, arrived) in enumerate([(1000, events.filter(early)), (2500, events.filter(early)), (None, events)]):
        rows = windows.cap_per_key(ranges.outside(arrived, done, key, "ts", "event_id"), key, cap, ["ts", "event_id"])
        loaded = tables.full_load(rows, f"{root}/load{n}")
        both = done.unionByName(ranges.covered(loaded, key, "ts", "event_id", cap is not None))
        done = tables.full_load(ranges.merged(both, key), f"{root}/done{n}")
    every = reduce(DataFrame.unionByName, [tables.read_table(spark, f"{root}/load{n}") for n in range(3)])
    return every.groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("loads"))


@query
def full_load_counts(spark, sf):
    """A full load to two targets, read back from the second."""
    root = workspace(spark, "layers")
    tables.write_all(table(spark, sf, "events"), [f"{root}/local/events", f"{root}/lake/events"])
    stored = tables.write_layer(
        tables.read_table(spark, f"{root}/lake/events"), root, "bronze", "events"
    )
    view = tables.write_layer(stored, root, "silver", "events", "view")
    return view.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")
    )


@query
def merged_drift(spark, sf):
    """Two loads whose columns differ, read as one table."""
    root = workspace(spark, "drift")
    orders = table(spark, sf, "orders")
    new = F.col("o_orderdate") >= ts_lit(datetime(1998, 1, 1))
    orders.filter(~new).select("o_orderkey", "o_custkey").write.parquet(f"{root}/load=1")
    orders.filter(new).select("o_orderkey", "o_orderpriority").write.parquet(f"{root}/load=2")
    return tables.read_merged(spark, root).select("o_orderkey", "o_custkey", "o_orderpriority")


def _loaded_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat_ws("/", "event_type", "user_id").alias("repo"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("fetched_at"),
        (F.col("ts") - F.expr("interval 5 days")).alias("updated_at"),
    )


@query
def freshness_by_key(spark, sf):
    return inc.freshness(_loaded_events(spark, sf), "repo", ["fetched_at", "updated_at"], NOW, 2)


@query
def freshness_inclusive(spark, sf):
    """Order dates have no time of day, so some keys are exactly as old as the limit."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    return inc.freshness(
        orders, "o_custkey", ["fetched_at", "o_orderdate"], datetime(2001, 8, 1), 60, inclusive=True
    )


@query
def stale_keys(spark, sf):
    events = _loaded_events(spark, sf)
    fresh = inc.freshness(events, "repo", ["fetched_at", "updated_at"], NOW, 2)
    return inc.stale_keys(events.select("repo").distinct(), fresh, "repo")


@query
def watermark_since(spark, sf):
    events = table(spark, sf, "events")
    seen = events.filter((F.col("ts") < ts_lit(datetime(2024, 1, 20))) & (F.col("value") > 50))
    marks = inc.watermark(seen, ["user_id", "event_type"], "ts")
    return inc.since(events, marks, ["user_id", "event_type"], "ts")


@query
def cap_per_key(spark, sf):
    return windows.cap_per_key(table(spark, sf, "events"), "user_id", 5, ["ts", "event_id"])


@query
def cap_per_key_large(spark, sf):
    """A cap above Spark's own pre-shuffle limit."""
    return windows.cap_per_key(table(spark, sf, "events"), "event_type", 1500, ["ts", "event_id"])


@query
def cap_per_key_even(spark, sf):
    return windows.cap_per_key(table(spark, sf, "events"), "event_type", 1500, ["ts", "event_id"], grain=None)


@query
def state_after_run(spark, sf):
    events = table(spark, sf, "events").withColumn("repo", F.col("user_id").cast("string"))
    early = events.filter(F.col("ts") < ts_lit(datetime(2024, 1, 15)))
    late = events.filter((F.col("ts") >= ts_lit(datetime(2024, 1, 15))) & (F.col("value") > 60))
    first = inc.state_rows(early, "pull_requests", datetime(2024, 1, 15), "repo")
    second = inc.state_rows(late, "pull_requests", NOW, "repo", metadata={"run": "second"})
    return inc.update_state(first, second)


@query
def run_manifest_rows(spark, sf):
    return inc.run_manifest(
        table(spark, sf, "events"), "activity", "events_daily", NOW, detail={"prefix": "bronze"}
    )


# --- landed JSON -------------------------------------------------------------


# Rows of a landed file at most.
LANDED_ROWS = 500_000


def _land(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    root = workspace(df.sparkSession, "landing")
    # As text the rows are many times their size. A gzip file is read by one task, so files stay small.
    writer = df.write.option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS)
    writer.partitionBy(*partition_by).json(f"{root}/{name}")
    return root


@query
def landing_proposals(spark, sf):
    """Orders as paged responses of 50, landed as JSON and read back."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        roles.cents("o_totalprice").alias("amount_requested"),
        F.col("o_custkey").alias("fund_id"),
    )
    page = F.floor(F.col("id") / rules.PROPOSALS_PER_PAGE).cast("int") + 1
    pages = (
        orders.groupBy(page.alias("page"))
        .agg(F.collect_list(F.struct("id", "title", "amount_requested", "fund_id")).alias("data"))
        .withColumn("links", F.struct(
            # Every fourth page is the end of a crawl of its own.
            F.when(F.col("page") % 4 != 0, F.concat(F.lit("?page="), F.col("page") + 1)).alias("next")))
    )
    root = _land(pages, "proposals")
    return landing.read_proposals(spark, root, NOW).select(
        "page", "id", "title", "amount_requested", "fund_id", "ingested_at"
    )


@query
def landing_funds(spark, sf):
    """Customers as funds, half the answers bare lists and half wrapped."""
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"),
        roles.cents("c_acctbal").alias("amount"),
    )
    bare = F.col("amount") >= 0
    item = F.struct("id", "title", "amount")
    mixed = rows.select(
        *[F.when(bare, F.col(c)).alias(c) for c in ("id", "title", "amount")],
        F.when(~bare, F.array(item)).alias("data"),
    )
    root = _land(mixed, "funds")
    return landing.read_funds(spark, root, NOW).select("id", "title", "amount", "ingested_at")


@query
def unwrap_envelope(spark, sf):
    """The JSON text of events as nested, then flat columns."""
    events = table(spark, sf, "events").select(
        "event_id", F.struct(F.from_json("props", "k int").alias("props"), "value").alias("raw")
    )
    return landing.flatten_struct(events)


@query
def landing_pull_requests(spark, sf):
    """Closed pull requests newer than the marks of an earlier load, capped per repository."""
    raw = roles.raw_pull_requests(spark, sf)
    root = _land(raw, "pull_requests", (landing.REPOSITORY,))
    earlier = raw.filter((F.col("updated_at") < "2024-01-10") & (F.col("state") == "open"))
    marks = inc.watermark(earlier, landing.REPOSITORY, "updated_at")
    repos = ["org/click", "org/view", "org/error"]
    return landing.read_pull_requests(
        spark, root, NOW, repos, "closed", max_per_repo=40, marks=marks
    ).select("id", "title", "updated_at", F.col("user.login").alias("login"),
             "repository_full_name", "fetched_at")


@query
def landing_releases(spark, sf):
    root = _land(roles.raw_releases(spark, sf).drop("fetched_at"), "releases")
    limit = landing.limits("dev")["max_releases"]
    return landing.read_releases(spark, root, NOW, max_per_repo=limit).groupBy(
        "repository_full_name"
    ).agg(F.count(F.lit(1)).alias("n"), F.min("published_at").alias("first_published"))


@query
def landing_issues(spark, sf):
    root = _land(roles.raw_issues(spark, sf), "issues", (landing.REPOSITORY,))
    return landing.read_issues(spark, root, NOW).select(
        "id", "title", "repository_full_name", "fetched_at"
    )


@query
def landing_repositories(spark, sf):
    root = _land(roles.orders_as_repositories(spark, sf), "repositories")
    return landing.read_repositories(spark, root, NOW).select(
        "id", "full_name", "stargazers_count", "fetched_at"
    )


# --- checks and reports ------------------------------------------------------


@query
def quality_report(spark, sf):
    customer, orders, lines = (table(spark, sf, t) for t in ("customer", "orders", "lineitem"))
    staged = activity.stage_pull_requests(
        landing.stamp(roles.raw_pull_requests(spark, sf), NOW)
    )
    return quality.quality_report({
        "customer.c_custkey unique": quality.unique(customer, "c_custkey"),
        "customer.c_name not_null": quality.not_null(customer, "c_name"),
        "orders.o_orderstatus accepted": quality.accepted_values(orders, "o_orderstatus", ["O", "F"]),
        "orders.o_custkey parent": quality.orphans(orders, customer, "o_custkey", "c_custkey"),
        "lineitem.l_orderkey parent": quality.orphans(lines, orders, "l_orderkey", "o_orderkey"),
        "lineitem key unique": quality.unique(lines, ["l_orderkey", "l_linenumber"]),
        "pull_requests.feat_classifier accepted": quality.accepted_values(
            staged, "feat_classifier", rules.PR_TITLE_LABELS
        ),
        "pull_requests.closed_at not_null": quality.not_null(staged, "closed_at"),
        "orders columns": quality.required_columns(orders, ["o_orderkey", "o_comment"]),
    })


@query
def suite_report(spark, sf):
    """Declared checks of three tables, each scanned once."""
    return quality.suite_report({
        "customer": (table(spark, sf, "customer"), Suite(("c_name", "c_acctbal"), (("c_custkey",),), required=("c_custkey", "c_phone"))),
        "lineitem": (table(spark, sf, "lineitem"), Suite(
            ("l_shipdate",), (("l_orderkey", "l_linenumber"),), (("l_returnflag", ("A", "N")), ("l_linestatus", ("O", "F"))))),
        "events": (table(spark, sf, "events"), Suite(("ts", "value"), accepted=(("event_type", ("click", "error")),))),
    })


@query
def checks_while_writing(spark, sf):
    """Pull requests staged and stored, with the checks that the write observed."""
    staged = activity.stage_pull_requests(landing.stamp(roles.raw_pull_requests(spark, sf), NOW))
    suite = Suite(("repository", "closed_at"), (("id",), ("repository", "title")), (("feat_classifier", ("feature", "not clear")),))
    root = workspace(spark, "checked")
    _, told = quality.checked_write(staged, "pulls", suite, lambda rows: tables.full_load(rows, f"{root}/pulls"))
    return quality.report_of(spark, told)


@query
def null_counts(spark, sf):
    panel = roles.customers_as_projects(spark, sf)
    return quality.null_counts(panel, ["id", "title", "website", "link"])


@query
def status_counts(spark, sf):
    names = ("region nation customer supplier part orders lineitem events documents "
             "embeddings pages benchmark labels conversations").split()
    loaded: dict[str, DataFrame | None] = {n: table(spark, sf, n) for n in names}
    return reports.table_counts({**loaded, "not_loaded": None})


@query
def ecosystem_summary(spark, sf):
    rows = roles.proposals(spark, sf).withColumn(
        "funding_status",
        F.when(F.col("amount_received") > 0, "funded")
        .when(F.col("funding_status") != "5-LOW", F.col("funding_status")),
    )
    return reports.ecosystem_summary(rows)


# --- streams -----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return (
        spark.readStream.schema(table(spark, sf, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(sf)
    )


@query
def stream_upsert(spark, sf):
    """The latest event per user, loaded through a stream."""
    root = workspace(spark, "stream-upsert")
    order = ["ts", "event_id"]
    jobs.upsert_stream(
        _event_stream(spark, sf), "user_id", order, f"{root}/log", f"{root}/checkpoint"
    ).awaitTermination()
    return jobs.read_upserts(spark, f"{root}/log", "user_id", order)


@query
def stream_daily_to_monthly(spark, sf):
    root = workspace(spark, "stream-daily")
    jobs.daily_counts_stream(
        _event_stream(spark, sf), "event_type", "ts", f"{root}/log", f"{root}/checkpoint"
    ).awaitTermination()
    return jobs.monthly_from_daily(spark, f"{root}/log", "event_type")


@query
def stream_ingest(spark, sf):
    """Landed JSON appended to a table, once now and once after more files arrived."""
    root = _land(roles.orders_as_repositories(spark, sf).filter("created_at < '1998-01-01'"), "raw/1")
    sink, checkpoint = f"{root}/sink", f"{root}/checkpoint"
    for load in (1, 2):
        if load == 2:
            roles.orders_as_repositories(spark, sf).filter(
                "created_at >= '1998-01-01'"
            ).write.json(f"{root}/raw/2")
        jobs.ingest_landing(
            spark, f"{root}/raw/*", schemas.REPOSITORIES, sink, checkpoint
        ).awaitTermination()
    return spark.read.parquet(sink).select("id", "full_name", "stargazers_count", "created_at")
