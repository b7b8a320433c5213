"""Landing to reports, in two runs."""

import json
from datetime import datetime

import pytest

from siltstone.operators.incremental import freshness
from siltstone.plans import jobs
from siltstone.sources import logs

FIRST, SECOND = datetime(2024, 1, 20), datetime(2024, 1, 31)
REPOS = ["org/app", "org/lib"]


def land(root, name, lines, repo=None, part="1"):
    path = root / name / (f"repository_full_name={repo.replace('/', '%2F')}" if repo else "")
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{part}.json").write_text("\n".join(json.dumps(line) for line in lines))


def pull(i, day, title="Add thing", **more):
    at = f"2024-01-{day:02d}T00:00:00Z"
    return {"id": i, "number": i, "title": title, "state": "closed", "created_at": at,
            "updated_at": at, "closed_at": at, **more}


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "landing"
    land(root, "funds", [{"data": [{"id": 1, "title": "Fund 1", "amount": 500000}]}])
    land(root, "proposals", [{
        "page": 1, "links": {"next": None}, "data": [
            {"id": 1, "title": "Browser wallet", "fund_id": 1, "fund_name": "Fund 1",
             "amount_requested": 100, "amount_received": 50, "website": "https://github.com/org/app",
             "has_github": True, "github_links": ["https://github.com/org/app"], "categories": ["DeFi"]},
            {"id": 2, "title": "Education", "fund_id": 1, "fund_name": "Fund 1",
             "amount_requested": 100, "amount_received": 0},
        ]}])
    land(root, "repositories", [
        {"id": i, "full_name": repo, "stargazers_count": 10 * i, "forks_count": i,
         "updated_at": "2024-01-01T00:00:00Z"} for i, repo in enumerate(REPOS, 1)
    ])
    land(root, "pull_requests", [pull(1, 1), pull(2, 3), pull(3, 4, "Fix bug")], "org/app")
    land(root, "pull_requests", [pull(4, 2)], "org/lib")
    for repo, tag in zip(REPOS, ("v1", "v2")):
        land(root, "releases", [{"id": ord(tag[1]), "tag_name": tag, "published_at": "2024-01-05T00:00:00Z",
                                 "updated_at": "2024-01-05T00:00:00Z"}], repo)
        land(root, "issues", [{"id": ord(tag[1]), "title": "x", "state": "open"}], repo)
    return root


def test_two_runs_and_all_models(spark, tmp_path, values, source):
    root = str(tmp_path / "lake")
    jobs.ingest_governance(spark, str(source), root, FIRST)
    jobs.ingest_code_host(spark, str(source), root, FIRST, REPOS)

    # Eleven days on: one repository has news, an updated row and an old one.
    land(source, "pull_requests", [
        pull(2, 25, "Add thing, renamed"), pull(5, 28), pull(1, 1, body="rewritten without an update"),
    ], "org/app", part="2")
    loaded = jobs.ingest_code_host(spark, str(source), root, SECOND, REPOS)
    assert values(loaded["pull_requests"], "id") == [(2,), (5,)]
    # The same run again reads the same rows and replaces its own batch.
    same = jobs.ingest_code_host(spark, str(source), root, SECOND, REPOS)
    assert values(same["pull_requests"], "id") == [(2,), (5,)]
    jobs.ingest_code_host(spark, str(source), root, SECOND, REPOS, force=True)
    order = ["updated_at", "fetched_at"]
    pulls = jobs.current(spark, f"{root}/raw/pull_requests", order)
    assert [r[0] for r in values(pulls, "id")] == [1, 2, 3, 4, 5]
    assert pulls.filter("id = 2").first()["title"] == "Add thing, renamed"

    # Everything is fresh now: nothing is due but issues, which are read every time.
    land(source, "issues", [{"id": 77, "title": "new", "state": "open"}], "org/app", part="2")
    again = jobs.ingest_code_host(spark, str(source), root, datetime(2024, 2, 1), REPOS)
    assert values(again.pop("issues"), "id") == [(49,), (50,), (77,)]
    assert all(df.count() == 0 for df in again.values())

    state = jobs.read_state(spark, root)
    assert state.count() == 8
    marked = freshness(state, "pipeline_state_id", ["last_updated"], datetime(2024, 2, 7), 7, inclusive=True)
    assert marked.filter("is_fresh").count() == 8
    assert spark.read.parquet(f"{root}/manifest").filter("pipeline = 'pull_requests'").count() == 3

    seed = spark.createDataFrame([("2", "org/lib")], "project_id string, repo_key string")
    built = jobs.build_governance(spark, root, SECOND, seed)
    assert values(built["map_project_repo"], "project_id", "repo_key") == [("1", "org/app"), ("2", "org/lib")]
    panel = values(built["delivery_panel"], "project_id", "github_stars", "has_github_data")
    assert panel == [("1", 10, True), ("2", 20, True)]
    assert built["funding_summary"].first()["defi_projects"] == 1
    assert built["landscape"].first()["competition_level"] == "direct_competitor"
    assert built["segmented_projects"].count() == 1
    checks = {r.check_name: r.failing for r in built["quality_report"].collect()}
    assert checks["stg_proposals.id unique"] == 0 == checks["stg_funds.id not_null"]

    built = jobs.build_activity(spark, root, "org/lib", 1)
    assert values(built["feature_prs_monthly"], "repository", "feature_pr_count") == [
        ("org/app", 3), ("org/lib", 1),
    ]
    assert values(built["feature_prs_vs_top"], "repository", "repo_group") == [
        ("org/app", "top_10"), ("org/lib", "lace"),
    ]
    assert values(built["feature_prs_median_gap"]) == [("org/app", 13.5)]
    assert {r.check_name: r.failing for r in built["quality_report"].collect()}["stg_pull_requests.feat_classifier accepted"] == 0
    assert values(built["releases_monthly"], "repository", "release_count") == [
        ("org/app", 1), ("org/lib", 1),
    ]


def test_caps_of_the_sample(spark, tmp_path, source):
    land(source, "releases", [
        {"id": 100 + i, "tag_name": f"t{i}", "published_at": f"2024-01-{i:02d}T00:00:00Z"}
        for i in range(1, 21)
    ], "org/app", part="many")
    loaded = jobs.ingest_code_host(
        spark, str(source), str(tmp_path / "lake"), FIRST, REPOS, environment="sample"
    )
    assert loaded["releases"].filter("repository_full_name = 'org/app'").count() == 10


def test_the_same_time_again_changes_nothing(spark, tmp_path, values, source):
    root, order = str(tmp_path / "lake"), ["updated_at", "fetched_at"]
    kept = []
    for _ in range(2):
        jobs.ingest_code_host(spark, str(source), root, FIRST, REPOS)
        pulls = jobs.current(spark, f"{root}/raw/pull_requests", order)
        kept.append((values(pulls, "id"), values(jobs.read_state(spark, root))))
    assert kept[0] == kept[1] and len(kept[0][0]) == 4 and len(kept[0][1]) == 8
    assert spark.read.parquet(f"{root}/manifest").count() == 4


def test_a_retry_after_half_a_run(spark, tmp_path, values, source, monkeypatch):
    root = str(tmp_path / "lake")

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs.landing, "read_releases", broken)
        with pytest.raises(RuntimeError):
            jobs.ingest_code_host(spark, str(source), root, FIRST, REPOS)
    jobs.ingest_code_host(spark, str(source), root, FIRST, REPOS)
    for name, n in (("repositories", 2), ("pull_requests", 4), ("releases", 2), ("issues", 2)):
        assert logs.stored(spark, f"{root}/raw/{name}").count() == n


def test_capped_runs_lose_nothing(spark, tmp_path, source):
    land(source, "releases", [
        {"id": 100 + i, "tag_name": f"t{i}", "published_at": f"2024-01-{i:02d}T00:00:00Z"}
        for i in range(1, 16)
    ], "org/app", part="many")
    land(source, "proposals", [
        {"page": p, "links": {"next": "x"}, "data": [{"id": 10 * p, "title": "t", "fund_id": 1}]} for p in range(2, 7)
    ], part="more")
    root = str(tmp_path / "lake")
    order = ["updated_at", "fetched_at"]
    for environment, now in (("sample", FIRST), ("prod", datetime(2024, 1, 21)), ("sample", SECOND)):
        jobs.ingest_code_host(spark, str(source), root, now, REPOS, environment=environment)
        jobs.ingest_governance(spark, str(source), root, now, environment)
    assert jobs.current(spark, f"{root}/raw/releases", order).count() == 17
    assert jobs.current(spark, f"{root}/raw/proposals", ["ingested_at"]).count() == 7


def only(monkeypatch, name):
    """Let runs load one resource."""
    monkeypatch.setattr(jobs, "RESOURCES", {name: jobs.RESOURCES[name]})


def test_any_order_of_runs_loads_every_row_once(spark, tmp_path, values, source, monkeypatch):
    only(monkeypatch, "releases")
    # 40 releases at few instants, so that caps cut through ties.
    land(source, "releases", [
        {"id": 100 + i, "tag_name": f"t{i}", "published_at": f"2024-01-{1 + i // 8:02d}T00:00:00Z"} for i in range(40)
    ], "org/app", part="many")
    root, loaded = str(tmp_path / "lake"), []
    environments = ["sample", "sample", "dev", "prod", "sample", "prod"]
    for day, environment in enumerate(environments):
        now = datetime(2024, 1, 20 + 10 * (day // 3), day)
        if day == 4:
            land(source, "releases", [{"id": 500, "tag_name": "new", "published_at": "2024-01-29T00:00:00Z"}], "org/app", part="new")
        found = jobs.ingest_code_host(spark, str(source), root, now, REPOS, environment=environment, days=0)
        loaded.append([r["id"] for r in found["releases"].filter("repository_full_name = 'org/app'").collect()])
    flat = [i for ids in loaded for i in ids]
    assert sorted(flat) == sorted([49, 500, *range(100, 140)])
    assert [len(ids) for ids in loaded[:2]] == [10, 10]


def test_twenty_runs_keep_few_copies(spark, tmp_path, values, source):
    root = str(tmp_path / "lake")
    for run in range(20):
        now = datetime(2024, 1, 20, run)
        land(source, "proposals", [{"page": 1, "links": {}, "data": [
            {"id": 1, "title": f"title {run}", "fund_id": 1}, {"id": 100 + run, "title": "one run only", "fund_id": 1}]}])
        jobs.ingest_governance(spark, str(source), root, now)
    path = f"{root}/raw/proposals"
    assert len(logs.parts_of(spark, path)) == 2  # 20 = 1 * 16 + 1 * 4
    assert logs.stored(spark, path).filter("id = 1").count() == 2
    now = jobs.current(spark, path, ["ingested_at"])
    assert now.count() == 21 and now.filter("id = 1").first()["title"] == "title 19"
    # What is no longer part of a kept version is gone.
    assert sum(1 for d in (tmp_path / "lake" / "raw" / "proposals").iterdir() if d.name.startswith("data-")) <= 10


def test_a_merged_batch_is_added_to_and_loses_nothing(spark, tmp_path, values, source, monkeypatch):
    only(monkeypatch, "pull_requests")
    root = str(tmp_path / "lake")
    for day in range(4):
        jobs.ingest_code_host(spark, str(source), root, datetime(2024, 1, 20, day), REPOS, days=0)
    land(source, "pull_requests", [pull(9, 30)], "org/app", part="2")
    for _ in range(2):  # the first of them once more, and again
        jobs.ingest_code_host(spark, str(source), root, datetime(2024, 1, 20, 0), REPOS, days=0)
    pulls = jobs.current(spark, f"{root}/raw/pull_requests", ["updated_at", "fetched_at"])
    assert [r[0] for r in values(pulls, "id")] == [1, 2, 3, 4, 9]
    assert jobs.read_state(spark, root).count() == 2
