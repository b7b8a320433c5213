"""Whole runs: ingest a landing folder, then build the layers on it.

Loaded tables are logs of batches (:mod:`siltstone.sources.logs`): a run appends
what is new and rewrites nothing but a level that is full, so a read meets a
bounded number of copies of a row. Beside them stand two small logs. ``state``
says when a repository was loaded last, ``ranges`` which stretches of its rows
were; a run asks these and never scans what was loaded. A capped run leaves a
range with rows before it, which a later run takes up from there, and does not
make a repository fresh for an uncapped run.

What a run reads follows from other runs only, so running it again for the same
time, also after half a run, reads the same rows and replaces its own batch by
them. Once its batch has been merged into a level it cannot be replaced; the
run then adds what is new since.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.operators import incremental as inc
from siltstone.operators import ranges
from siltstone.operators.common import ts_lit
from siltstone.operators.quality import Suite, checked_write, report_of
from siltstone.operators.windows import latest_per_key
from siltstone.plans import activity, funding, mapping, proposals, segments
from siltstone.plans.checks import SUITES
from siltstone.sources import landing, logs, tables
from siltstone.sources.landing import REPOSITORY
from siltstone.sources.logs import BATCH, RUN

# Code-host resources: their repository column, the column of their loaded ranges, cap, and
# whether fresh repositories are skipped.
RESOURCES = {
    "repositories": ("full_name", None, None, True),
    "pull_requests": (REPOSITORY, "updated_at", "max_prs", True),
    "releases": (REPOSITORY, "published_at", "max_releases", True),
    "issues": (REPOSITORY, None, "max_prs", False),
}


def _batch(now: datetime) -> int:
    """Microseconds since 1970: runs of different times have different batches."""
    at = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    return int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000 + 0.5)


def _newest_state(rows: DataFrame) -> DataFrame:
    return logs.newest(["pipeline_state_id", "environment"], ["last_updated"])(rows)


def _closed_ranges(rows: DataFrame) -> DataFrame:
    return ranges.merged(rows, REPOSITORY)


def _load(rows: DataFrame, path: str, now: datetime, order_by: Sequence[str], run: str = "") -> DataFrame:
    """Append one run's latest row per id; returns what was stored."""
    return logs.append(rows, path, logs.newest("id", order_by), _batch(now), run)


def _record(manifest: DataFrame, root: str, name: str, now: datetime) -> None:
    """The manifest row of a run; a repeated run replaces its own."""
    manifest.write.mode("overwrite").parquet(f"{root}/manifest/table={name}/{BATCH}={_batch(now)}")


def _without(spark: SparkSession, path: str, now: datetime, run: str, **tags: object) -> DataFrame | None:
    """The rows of a log but for this run's own batch, of the parts with these tags."""
    return logs.stored(spark, path, lambda part: not logs.is_batch(part, _batch(now), run) and all(
        part.tags["more"].get(k) == v for k, v in tags.items()))


def _due(
    spark: SparkSession, root: str, name: str, now: datetime, cap: str | None, environment: str,
    repositories: Sequence[str], days: float, run: str,
) -> list[str]:
    """The repositories that no other run has loaded within ``days``.

    For an uncapped run only uncapped ones count, as a capped one may have left rows.
    """
    known = _without(spark, f"{root}/state", now, run, table=name)
    if known is not None and cap is not None and landing.limits(environment)[cap] is None:
        whole = [e for e in rules.LIMITS if landing.limits(e)[cap] is None]
        known = known.filter(F.col("environment").isin(whole))
    if known is None:
        return list(repositories)
    wanted = spark.createDataFrame([(r,) for r in repositories], "repo string")
    fresh = inc.freshness(known, "repository_name", ["last_updated"], now, days).withColumnRenamed("repository_name", "repo")
    # At most the repositories asked for.
    return [r["repo"] for r in inc.stale_keys(wanted, fresh, "repo").collect()]


def current(spark: SparkSession, path: str, order_by: Sequence[str]) -> DataFrame:
    """The newest row per id of a loaded table."""
    return logs.read_log(spark, path, logs.newest("id", order_by))


def ingest_governance(
    spark: SparkSession, source: str, root: str, now: datetime, environment: str = "prod"
) -> dict[str, DataFrame]:
    """Full dump of funds and proposals, with a manifest row after both.

    The dump is merged by id: a run with fewer pages adds to what is stored.
    """
    pages = landing.limits(environment)["max_pages"]
    loaded = {
        "funds": landing.read_funds(spark, source, now),
        "proposals": landing.read_proposals(spark, source, now, max_pages=pages),
    }
    stored = {
        name: _load(rows, f"{root}/raw/{name}", now, ["ingested_at"])
        for name, rows in loaded.items()
    }
    for name, rows in stored.items():
        _record(inc.run_manifest(rows, "governance", name, now, environment), root, name, now)
    return stored


def ingest_code_host(
    spark: SparkSession,
    source: str,
    root: str,
    now: datetime,
    repositories: Sequence[str] | None = None,
    environment: str = "prod",
    force: bool = False,
    days: float = rules.FRESHNESS_DAYS,
) -> dict[str, DataFrame]:
    """New rows of every stale repository, per resource; state follows from what landed.

    Issues are read in every run. Without ``repositories`` the default ones are
    loaded, or the sample ones in the sample environment.
    """
    caps = landing.limits(environment)
    if repositories is None:
        sample = environment == "sample"
        repositories = rules.SAMPLE_REPOSITORIES if sample else rules.DEFAULT_REPOSITORIES
    read: dict[str, Callable[..., DataFrame]] = {
        "repositories": landing.read_repositories,
        "pull_requests": landing.read_pull_requests,
        "releases": landing.read_releases,
        "issues": landing.read_issues,
    }
    stored = {}
    for name, (key, ts, cap, gated) in RESOURCES.items():
        path, marks, run = f"{root}/raw/{name}", f"{root}/ranges/{name}", name
        # A batch that a level has swallowed stays; the run adds to it under another name.
        logged = [(path, run), (marks, run), (f"{root}/state", run)]
        if any(logs.merged_already(logs.parts_of(spark, where), _batch(now), r) for where, r in logged):
            run = f"{name}, again"
        due = list(repositories)
        if gated and not force:
            due = _due(spark, root, name, now, cap, environment, repositories, days, run)
        options: dict[str, object] = {"max_per_repo": caps[cap]} if cap else {}
        if ts and not force:
            options["loaded"] = _without(spark, marks, now, run)
        rows = read[name](spark, source, now, repos=due, **options)
        stored[name] = _load(rows, path, now, ["updated_at", "fetched_at"], run)
        if ts:
            done = ranges.covered(stored[name], REPOSITORY, ts, "id", caps[cap] is not None)
            logs.append(done, marks, _closed_ranges, _batch(now), run)
        state = inc.state_rows(stored[name], name, now, key, environment)
        logs.append(state, f"{root}/state", _newest_state, _batch(now), run, {"table": name})
        _record(inc.run_manifest(stored[name], "code_host", name, now, environment), root, name, now)
    return stored


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The newest state row per table and repository."""
    return latest_per_key(logs.read_log(spark, f"{root}/state", _newest_state), "pipeline_state_id", "last_updated")


def _writer(root: str, told: list[tuple[str, int]]) -> Callable[[str, str, DataFrame], DataFrame]:
    """Writes models; those with declared checks add what failed to ``told``."""
    def write(layer: str, name: str, df: DataFrame) -> DataFrame:
        stored, found = checked_write(df, name, SUITES.get(name, Suite()), lambda rows: tables.write_layer(rows, root, layer, name))
        told.extend(found)
        return stored

    return write


def build_governance(
    spark: SparkSession, root: str, now: datetime, seed: DataFrame
) -> dict[str, DataFrame]:
    """Staged, enriched and report models of the funding programme, and the report of their checks."""
    told: list[tuple[str, int]] = []
    write = _writer(root, told)
    raw = {name: current(spark, f"{root}/raw/{name}", ["ingested_at"]) for name in ("funds", "proposals")}
    funds = write("bronze", "stg_funds", proposals.stage_funds(raw["funds"], now))
    staged = write("bronze", "stg_proposals", proposals.stage_proposals(raw["proposals"]))
    enriched = write("silver", "proposals_enriched", proposals.enrich_proposals(staged))
    repo_map = write("map", "map_project_repo", mapping.map_project_repo(seed, staged, ts_lit(now)))
    found = write(
        "gold", "segmented_projects", segments.segment_projects(enriched, funds, ordered=False)
    )
    repositories = current(spark, f"{root}/raw/repositories", ["updated_at", "fetched_at"])
    return {
        "stg_funds": funds,
        "stg_proposals": staged,
        "proposals_enriched": enriched,
        "map_project_repo": repo_map,
        "segmented_projects": found,
        "funding_summary": write("gold", "funding_summary", funding.funding_summary(enriched, funds)),
        "landscape": write("gold", "landscape", segments.landscape(found)),
        "landscape_examples": write("gold", "landscape_examples", segments.landscape_examples(found)),
        "delivery_panel": write(
            "gold", "delivery_panel", mapping.delivery_panel(staged, repo_map, repositories)
        ),
        "quality_report": tables.write_layer(report_of(spark, told), root, "checks", "governance"),
    }


def build_activity(
    spark: SparkSession, root: str, pinned: str = rules.PINNED_REPOSITORY, n: int = rules.TOP_N
) -> dict[str, DataFrame]:
    """Staged pull requests and releases, monthly counts and median gaps, and the report of their checks."""
    told: list[tuple[str, int]] = []
    write = _writer(root, told)
    order = ["updated_at", "fetched_at"]
    pulls = write("silver", "stg_pull_requests", activity.stage_pull_requests(
        current(spark, f"{root}/raw/pull_requests", order)
    ))
    releases = write("silver", "stg_releases", activity.stage_releases(
        current(spark, f"{root}/raw/releases", order)
    ))
    built = {"stg_pull_requests": pulls, "stg_releases": releases}
    events = {
        "feature_prs": (activity.features(pulls), "closed_at", "feature_pr_count"),
        "releases": (activity.release_times(releases), "published_at", "release_count"),
    }
    for name, (rows, ts, count) in events.items():
        models = {
            f"{name}_monthly": activity.activity_monthly(rows, "repository", ts, count=count),
            f"{name}_vs_top": activity.pinned_vs_top_monthly(
                rows, "repository", ts, pinned, n, count=count
            ),
            f"{name}_median_gap": activity.median_gap_vs_top(rows, "repository", ts, pinned, n),
        }
        built.update({m: write("gold", m, df) for m, df in models.items()})
    built["quality_report"] = tables.write_layer(report_of(spark, told), root, "checks", "activity")
    return built
