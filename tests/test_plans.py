from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone import rules
from siltstone.operators.common import ts_lit
from siltstone.plans import activity, funding, mapping, segments
from siltstone.plans import proposals as plans
from siltstone.sources import schemas

NOW = datetime(2024, 1, 31)


def raw_proposals(spark, *rows):
    return schemas.conform(
        spark.createDataFrame([{**r, "ingested_at": "2024-01-30"} for r in rows],
                              schema=schemas.T.StructType([
                                  *schemas.PROPOSALS.fields,
                                  schemas.T.StructField("ingested_at", schemas.T.StringType()),
                              ])),
        schemas.PROPOSALS,
    )


def enriched(spark, *rows):
    return plans.enrich_proposals(plans.stage_proposals(raw_proposals(spark, *rows)))


GITHUB = {
    "id": 1, "title": "DeFi Proposal with GitHub", "problem": "Need better DeFi tools",
    "solution": "Building DeFi platform", "amount_requested": 50000, "amount_received": 45000,
    "has_github": True, "github_links": ["https://github.com/test/defi-repo"],
    "categories": ["DeFi", "Developer Tools"], "primary_category": "DeFi",
    "yes_votes_count": 3, "no_votes_count": 1, "abstain_votes_count": 0,
}
EDUCATION = {
    "id": 2, "title": "Education Proposal", "problem": "Need better education",
    "solution": "Creating educational content", "amount_requested": 20000, "amount_received": 0,
    "has_github": False, "github_links": [], "funding_status": "pending",
}


def test_enriched_proposals(spark):
    rows = enriched(
        spark, GITHUB, EDUCATION,
        {"id": 3, "title": "Yoroi mobile wallet", "funding_status": "approved",
         "amount_received": None, "amount_requested": 5},
        {"id": 4, "title": None, "solution": "a wallet", "amount_received": 5, "amount_requested": 0,
         "has_github": None, "github_links": ["x"]},
        {"id": 5, "title": "Nothing", "funding_status": "rejected", "has_github": True},
    ).orderBy("id").collect()
    assert [r["funding_category"] for r in rows] == [
        "funded", "in_progress", "approved", "funded", "not_funded",
    ]
    assert [r["funding_ratio"] for r in rows] == [0.9, 0.0, 0.0, None, 0.0]
    assert [r["total_votes"] for r in rows] == [4, None, None, None, None]
    assert [r["approval_rate"] for r in rows] == [0.75, None, None, None, None]
    assert [r["has_active_github"] for r in rows] == [True, False, False, False, False]
    assert [r["github_repo_count"] for r in rows] == [1, 0, None, 1, None]
    # A null title makes the whole text null, which is no match.
    assert [r["is_wallet_related"] for r in rows] == [False, False, True, False, False]
    assert [r["potential_competitor"] for r in rows] == [False, False, True, False, False]


def test_staging_columns(spark):
    funds = plans.stage_funds(
        schemas.conform(spark.createDataFrame([(3, 500)], "id long, amount long"), schemas.FUNDS), NOW
    )
    row = funds.first()
    assert (row["fund_number"], row["funding_available"], row["_loaded_at"]) == (3, 500, NOW)
    staged = plans.stage_proposals(raw_proposals(spark, {"id": 1, "unique_wallets": 4, "type": "t"}))
    row = staged.first()
    assert (row["unique_wallets_voted"], row["proposal_type"], row["_loaded_at"]) == (4, "t", "2024-01-30")


def test_filter_on_enriched_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    raw_proposals(spark, GITHUB, EDUCATION).write.parquet(path)
    staged = plans.stage_proposals(spark.read.parquet(path))
    plan = plans.enrich_proposals(staged).filter("fund_id = 3").select(
        "id", "funding_category"
    )._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(fund_id,3)" in plan
    read = plan[plan.index("ReadSchema"):]
    assert "solution" not in read and "github_links" not in read


@pytest.fixture
def funds(spark):
    raw = schemas.conform(
        spark.createDataFrame([(1, "Fund 1"), (2, "Fund 2")], "id long, title string"), schemas.FUNDS
    )
    return plans.stage_funds(raw, NOW)


def funded(i, fund, amount, **more):
    return {"id": i, "title": f"P{i}", "fund_id": fund, "fund_name": f"F{fund}",
            "amount_received": amount, "amount_requested": amount * 2, **more}


@pytest.mark.parametrize("grain", [1, 1e6])
def test_funding_summary(spark, funds, grain):
    rows = enriched(
        spark, funded(1, 1, 10, **{k: GITHUB[k] for k in ("categories", "has_github", "github_links")}),
        funded(2, 1, 40), funded(3, 1, 30), funded(4, 1, 20, title="wallet"), funded(5, 2, 7),
        funded(6, None, 9), {**funded(7, 1, 0)},
    )
    got = funding.funding_summary(rows, funds, grain=grain).collect()
    assert [r["fund_id"] for r in got] == [2, 1, None]
    one = got[1]
    assert one["fund_title"] == "Fund 1" and got[2]["fund_title"] is None
    assert one["total_funded_projects"] == 4 and one["total_funding_distributed"] == 100
    assert one["avg_funding_per_project"] == 25 and one["median_funding_per_project"] == 25
    assert one["max_single_funding"] == 40
    assert one["defi_projects"] == 1 and one["devtools_projects"] == 1
    assert one["github_adoption_pct"] == 25.0 and one["wallet_ecosystem_pct"] == 25.0
    assert one["avg_funding_ratio"] == 0.5 and one["avg_approval_rate"] is None


SEGMENTED = [
    funded(1, 1, 300, title="Lace browser wallet"),
    funded(2, 1, 200, title="Yoroi wallet"),
    funded(3, 2, 100, title="Mobile wallet"),
    funded(4, 2, 50, title="New", solution="hardware wallet with ledger"),
    funded(5, 2, 0, title="Wallet SDK"),
    funded(6, 9, 20, title="Eternl and browser wallet"),
    funded(7, 1, 80, title="Unrelated"),
    {**funded(8, 1, 0, title="A wallet"), "amount_received": None},
]


def test_segments(spark, funds):
    got = segments.segment_projects(enriched(spark, *SEGMENTED), funds).collect()
    assert [(r["id"], r["wallet_type"], r["competition_level"]) for r in got] == [
        (1, "lace", "direct_competitor"),
        (6, "eternl", "direct_competitor"),
        (2, "yoroi", "existing_competitor"),
        (3, "mobile_wallet_generic", "indirect_competitor"),
        (5, "wallet_infrastructure", "ecosystem_enabler"),
        (4, "hardware_wallet_integration", "other"),
        (8, "wallet_infrastructure", "other"),
    ]
    assert [r["fund_title"] for r in got][:2] == ["Fund 1", None]


@pytest.mark.parametrize("grain", [1, 1e6])
def test_landscape(spark, funds, grain):
    more = [funded(100 + i, 1, 60_000 + i, title="Yoroi wallet") for i in range(3)]
    found = segments.segment_projects(enriched(spark, *SEGMENTED, *more), funds, ordered=False)
    got = segments.landscape(found).collect()
    listed = segments.landscape_examples(found, grain).filter("wallet_type = 'yoroi'").collect()
    assert sorted((r["place"], r["funding_received"]) for r in listed) == [
        (0, 60_002), (1, 60_001), (2, 60_000), (3, 200)]
    yoroi = [r for r in got if r["wallet_type"] == "yoroi"]
    assert len(yoroi) == 1
    assert yoroi[0]["project_count"] == 4 and yoroi[0]["funding_success_rate"] == 100.0
    # 75 for the level, 20 for the success rate, 15 for the total.
    assert yoroi[0]["strategic_priority_score"] == 110
    none = [r for r in got if r["wallet_type"] == "wallet_infrastructure"]
    assert [(r["total_funding_received"], r["avg_funding_per_funded_project"]) for r in none] == [(0, None)] * 2
    scores = [r["strategic_priority_score"] for r in got]
    assert scores == sorted(scores, reverse=True) and scores[0] == 120


def test_project_repo_map(spark, values):
    seed = spark.createDataFrame([("5", "a/b"), ("6", None)], "project_id string, repo_key string")
    staged = plans.stage_proposals(raw_proposals(
        spark,
        {"id": 1, "website": "https://github.com/Org/Repo/tree", "link": "https://github.com/x/y"},
        {"id": 2, "website": "https://github.com/org"},
        {"id": 3, "link": "https://example.org"},
        {"id": 4, "ideascale_link": "github.com/c/d"},
    ))
    got = mapping.map_project_repo(seed, staged, ts_lit(NOW))
    assert values(got) == [
        ("1", "org/repo", "discovered", "2024-01-30"), ("4", "c/d", "discovered", "2024-01-30"),
        ("5", "a/b", "seed", "2024-01-31 00:00:00"), ("6", None, "seed", "2024-01-31 00:00:00"),
    ]


def test_delivery_panel(spark, values):
    staged = plans.stage_proposals(raw_proposals(
        spark, {"id": 1, "title": "one", "link": "https://github.com/a/b"}, {"id": 2, "title": "two"},
        {"id": 3, "title": "three"},
    ))
    repo_map = spark.createDataFrame(
        [("1", "a/b"), ("1", "a/b"), ("1", "c/d"), ("2", "gone/gone")], "project_id string, repo_key string"
    )
    repos = schemas.conform(spark.createDataFrame(
        [(1, "A/B", 10, 1), (2, "a/b", 5, None), (3, "c/d", 1, 1)],
        "id long, full_name string, stargazers_count long, forks_count long"), schemas.REPOSITORIES)
    columns = ["project_id", "has_github", "github_stars", "github_forks", "linked_repos_count", "has_github_data"]
    assert values(mapping.delivery_panel(staged, repo_map, repos), *columns) == [
        ("1", True, 1, 1, 1, True), ("1", True, 15, 1, 2, True),
        ("2", False, 0, 0, 0, True), ("3", False, 0, 0, 0, False),
    ]
    assert values(mapping.delivery_panel(staged, repo_map, repos, per_project=True), *columns) == [
        ("1", True, 16, 2, 3, True), ("2", False, 0, 0, 0, True), ("3", False, 0, 0, 0, False),
    ]


def pulls(spark, *rows):
    df = spark.createDataFrame(
        [(i, title, repo, closed) for i, (title, repo, closed) in enumerate(rows)],
        "id long, title string, repository_full_name string, closed_at string",
    )
    raw = schemas.conform(df, schemas.PULL_REQUESTS)
    return activity.stage_pull_requests(raw.withColumn("fetched_at", F.lit("2024-01-31")))


def test_staged_pull_requests(spark):
    raw = schemas.conform(
        spark.sql("""select 1L id, 'Fix bug in wallet component' title,
            named_struct('login', 'dev') user, named_struct('ref', 'master') base,
            'test/repo' repository_full_name, '2024' fetched_at"""),
        schemas.PULL_REQUESTS,
    )
    row = activity.stage_pull_requests(raw).first()
    assert (row["author"], row["base_branch"], row["head_branch"]) == ("dev", "master", None)
    assert (row["repository"], row["feat_classifier"]) == ("test/repo", "bug fix")


def test_monthly_counts_keep_open_pull_requests_in_a_null_month(spark):
    events = activity.features(pulls(
        spark, ("Add a", "r", "2024-01-02T00:00:00Z"), ("Add b", "r", "2024-01-30T00:00:00Z"),
        ("Add c", "r", None), ("Fix d", "r", "2024-01-05T00:00:00Z"), ("feat", "a", "2024-03-01T00:00:00Z"),
    ))
    got = activity.activity_monthly(events, "repository", "closed_at").collect()
    assert [tuple(r) for r in got] == [
        ("a", datetime(2024, 3, 1), 1), ("r", datetime(2024, 1, 1), 2), ("r", None, 1),
    ]


def test_pinned_against_top(spark, values):
    rows = [("Add", repo, f"2024-0{m}-01T00:00:00Z") for repo, n in
            {"big": 5, "mid": 4, "tie1": 2, "tie2": 2, "pin": 1}.items() for m in range(1, n + 1)]
    events = activity.features(pulls(spark, *rows))
    got = activity.pinned_vs_top_monthly(events, "repository", "closed_at", "pin", n=3)
    assert {(r["repository"], r["repo_group"]) for r in got.collect()} == {
        ("big", "top_10"), ("mid", "top_10"), ("tie1", "top_10"), ("pin", "lace"),
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 3


@pytest.mark.parametrize("grain", [1, 1e6])
def test_median_gaps(spark, grain):
    events = activity.features(pulls(
        spark,
        ("Add", "r", "2024-01-01T00:00:00Z"), ("Add", "r", "2024-01-02T00:00:00Z"),
        ("Add", "r", "2024-01-04T12:00:00Z"), ("Add", "r", None), ("Add", "r", None),
        ("Add", "one", "2024-01-01T00:00:00Z"), ("Add", "one", None),
        ("Add", "single", "2024-01-01T00:00:00Z"),
        ("Add", "open", None), ("Add", "open", None),
        ("Add", "same", "2024-01-01T00:00:00Z"), ("Add", "same", "2024-01-01T00:00:00Z"),
        ("Add", "same", "2024-01-01T00:00:00Z"), ("Add", "same", "2024-01-09T00:00:00Z"),
    ))
    got = activity.median_gap_vs_top(
        events, "repository", "closed_at", "r", out="median", with_group=True, grain=grain
    ).collect()
    assert [tuple(r) for r in got] == [
        ("same", 0.0, "top_10"), ("r", 1.75, "lace"), ("one", None, "top_10"),
    ]


def test_staged_releases(spark, values):
    df = spark.createDataFrame(
        [(1, "r", "v1", "2024-01-01T00:00:00Z"), (2, "r", "v1", "2024-02-01T00:00:00Z"),
         (3, "r", "v1", None), (4, "r", "v2", "2024-01-01T00:00:00Z"), (5, "r", "v2", "2024-01-01T00:00:00Z")],
        "id long, repository_full_name string, tag_name string, published_at string",
    ).withColumn("fetched_at", F.lit("x"))
    staged = activity.stage_releases(schemas.conform(df, schemas.RELEASES))
    assert values(staged, "id", "tag", "row_num") == [(2, "v1", 1), (5, "v2", 1)]
    whole = schemas.conform(df, schemas.RELEASES)
    assert sorted(activity.latest_release_times(whole).collect()) == sorted(activity.release_times(staged).collect())
    plan = activity.release_times(staged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("body") <= 1


def test_default_rules_are_well_formed():
    for ladder in (rules.PR_TITLE_RULES, rules.WALLET_TYPE_RULES, rules.COMPETITION_RULES):
        assert all(t == t.lower() for _, terms in ladder for t in terms)
    assert {label for label, _ in rules.PR_TITLE_RULES} < set(rules.PR_TITLE_LABELS)


def test_median_gaps_run_nothing_before_they_are_asked_for(spark):
    from datetime import datetime

    from siltstone.plans import activity

    rows = [(f"k{i % 4}" if i % 9 else None, datetime(2024, 1, 1 + i % 20) if i % 7 else None) for i in range(200)]
    events = spark.createDataFrame(rows, "k string, at timestamp_ntz")
    spark.sparkContext.setJobGroup("planning", "no job may start")
    try:
        result = activity.median_gap_vs_top(events, "k", "at", "k3", n=2)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup("after", "")
    assert {r.k for r in result.collect()} <= {"k0", "k1", "k2", "k3"} and result.count() in (2, 3)
