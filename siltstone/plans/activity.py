"""Staged code-host activity, monthly counts, and pinned-against-top comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.functions import label_ladder, lowered_text, month_of
from siltstone.operators.common import as_time, join_on
from siltstone.operators.keys import only_keys, pinned_or_top
from siltstone.operators.skew import exact_quantile
from siltstone.operators.windows import gap_counts, latest_per_key
from siltstone.sources.landing import flatten_struct

Ladder = Sequence[tuple[str, Sequence[str]]]


def passthrough(raw: DataFrame) -> DataFrame:
    """Bronze models of the code host: the raw table as it is."""
    return raw


def stage_pull_requests(
    raw: DataFrame,
    title_rules: Ladder = rules.PR_TITLE_RULES,
    default: str = rules.PR_TITLE_DEFAULT,
    word_boundary: bool = False,
) -> DataFrame:
    """Pull requests with flat author and branches, and a class read from the title."""
    return flatten_struct(raw).withColumn("_text", lowered_text("title")).select(
        F.col("repository_full_name").alias("repository"),
        "id", "number", "title",
        F.col("body").alias("description"),
        "state",
        F.col("user__login").alias("author"),
        F.col("base__ref").alias("base_branch"),
        F.col("head__ref").alias("head_branch"),
        F.col("html_url").alias("url"),
        "created_at", "closed_at", "merged_at", "fetched_at",
        label_ladder("_text", title_rules, default, word_boundary).alias("feat_classifier"),
    )


def stage_releases(raw: DataFrame) -> DataFrame:
    """Published releases, the latest per repository and tag (the highest id on equal dates)."""
    rows = flatten_struct(raw).filter(F.col("published_at").isNotNull()).select(
        F.col("repository_full_name").alias("repository"),
        "id",
        F.col("name").alias("release_name"),
        F.col("tag_name").alias("tag"),
        F.col("author__login").alias("release_author"),
        "published_at", "created_at", "updated_at",
        F.col("html_url").alias("release_url"),
        "body",
        F.col("draft").alias("is_draft"),
        F.col("prerelease").alias("is_prerelease"),
        "fetched_at",
    )
    return latest_per_key(
        rows, ["repository", "tag"], ["published_at", "id"], rank_col="row_num", break_ties=False
    )


def features(pull_requests: DataFrame, wanted: str = "feature") -> DataFrame:
    """(repository, closed_at) of the pull requests in one class."""
    return pull_requests.filter(F.lower("feat_classifier") == wanted).select(
        "repository", as_time(pull_requests, "closed_at").alias("closed_at")
    )


def release_times(releases: DataFrame) -> DataFrame:
    return releases.select("repository", as_time(releases, "published_at").alias("published_at"))


def latest_release_times(raw: DataFrame) -> DataFrame:
    """:func:`release_times` straight from raw releases: the last time per repository and tag.

    A hash aggregate over parsed times; no release travels or is sorted whole.
    """
    rows = raw.filter(F.col("published_at").isNotNull())
    return rows.groupBy(F.col("repository_full_name").alias("repository"), "tag_name").agg(
        F.max(as_time(raw, "published_at")).alias("published_at")
    ).select("repository", "published_at")


def _monthly(events: DataFrame, key: str, ts: str, month: str, count: str) -> DataFrame:
    return events.groupBy(key, month_of(ts).alias(month)).agg(F.count(F.lit(1)).alias(count))


def activity_monthly(
    events: DataFrame, key: str, ts: str, month: str = "month", count: str = "event_count"
) -> DataFrame:
    """Events per key and month; undated events form a null month."""
    return _monthly(events, key, ts, month, count).orderBy(
        F.col(key).asc_nulls_last(), F.col(month).asc_nulls_last()
    )


def pinned_vs_top_monthly(
    events: DataFrame,
    key: str,
    ts: str,
    pinned=rules.PINNED_REPOSITORY,
    n: int = rules.TOP_N,
    pinned_label: str = rules.PINNED_LABEL,
    top_label: str = rules.TOP_LABEL,
    month: str = "month",
    count: str = "event_count",
) -> DataFrame:
    """Monthly counts of the pinned key and of the ``n`` busiest keys.

    The input is read once: the busiest keys are found in the monthly counts.
    """
    monthly = _monthly(events, key, ts, month, count)
    groups = pinned_or_top(
        monthly, key, n, pinned, pinned_label, top_label, weight=count, group="repo_group"
    )
    return only_keys(monthly, groups, key, "repo_group").select(
        key, "repo_group", month, count
    ).orderBy(F.col(month).asc_nulls_last(), key)


def median_gap_vs_top(
    events: DataFrame,
    key: str,
    ts: str,
    pinned=rules.PINNED_REPOSITORY,
    n: int = rules.TOP_N,
    pinned_label: str = rules.PINNED_LABEL,
    top_label: str = rules.TOP_LABEL,
    digits: int | None = 2,
    with_group: bool = False,
    out: str = "median_days",
    grain: float | None = 1.0,
) -> DataFrame:
    """Median days between consecutive events, for the pinned and the busiest keys.

    The busiest keys are counted in the same plan, so nothing runs before the
    result is asked for; they are n + 1 rows, by which the events are filtered
    where they are read.
    A key whose only second event is undated appears with a null median.
    """
    rows = events.select(key, ts)
    # n + 1 rows at most, whatever the events are.
    picked = F.broadcast(pinned_or_top(rows, key, n, pinned).select(key).distinct())
    marks = rows.join(picked, key, "left_semi").groupBy(key, ts).agg(F.count(F.lit(1)).alias("_events"))
    medians = exact_quantile(
        gap_counts(marks, key, ts, "_gap", grain, weight="_events"), key, "_gap", 0.5, out, "gaps", grain
    )
    # Two events of which one is dated make a gap.
    dated = F.when(F.col(ts).isNotNull(), F.col("_events")).otherwise(0)
    with_gaps = marks.groupBy(key).agg(
        F.sum("_events").alias("_all"), F.sum(dated).alias("_dated")
    ).filter("_all > 1 and _dated > 0")
    result = join_on(with_gaps.select(key), medians, [key], "left")
    if digits is not None:
        result = result.withColumn(out, F.round(out, digits))
    if with_group:
        label = F.when(F.col(key) == F.lit(pinned), pinned_label).otherwise(top_label)
        result = result.withColumn("repo_group", label)
    return result.orderBy(F.col(out).asc_nulls_last(), key)
