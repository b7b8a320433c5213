import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental as inc
from siltstone.session import workspace
from siltstone.sources import landing, schemas, tables

NOW = datetime(2024, 1, 31, 12)


def land(root, name, lines, folder=""):
    path = root / name / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("\n".join(json.dumps(line) for line in lines))


@pytest.mark.parametrize("answer", [
    [{"data": [{"id": 1, "title": "Fund 1"}, {"id": 2, "title": "Fund 2"}]}],
    [[{"id": 1, "title": "Fund 1"}, {"id": 2, "title": "Fund 2"}]],
])
def test_funds_bare_or_wrapped(spark, tmp_path, values, answer):
    land(tmp_path, "funds", answer)
    funds = landing.read_funds(spark, str(tmp_path), NOW)
    assert values(funds, "id", "title", "ingested_at") == [
        (1, "Fund 1", "2024-01-31T12:00:00"), (2, "Fund 2", "2024-01-31T12:00:00"),
    ]
    assert funds.columns == [*schemas.FUNDS.fieldNames(), "ingested_at"]


def test_answer_without_data_gives_no_rows(spark, tmp_path):
    land(tmp_path, "funds", [{"message": "unauthorized"}, {"data": []}])
    assert landing.read_funds(spark, str(tmp_path), NOW).count() == 0


def page(number, ids, last=False, fund=1):
    return {"page": number, "data": [{"id": i, "fund_id": fund} for i in ids],
            "links": {"next": None if last else f"?page={number + 1}"}}


@pytest.mark.parametrize("pages,max_pages,fund,expected", [
    ([page(1, [1, 2]), page(2, [3]), page(3, [4], last=True)], None, None, [1, 2, 3, 4]),
    ([page(1, [1, 2]), page(2, [3]), page(3, [4], last=True)], 2, None, [1, 2, 3]),
    ([page(1, [1, 2]), page(2, [3]), page(3, [4], last=True)], 0, None, []),
    # Two crawls of different length: the end of one doesn't cut the other.
    ([page(1, [1]), page(2, [2], last=True), page(1, [5], fund=2), page(3, [3], fund=2)], None, None, [1, 2, 3, 5]),
    ([page(1, [1]), page(2, []), page(3, [3])], None, None, [1, 3]),
    ([page(1, [1]), page(2, [2], fund=9)], None, 9, [2]),
])
def test_proposal_pages(spark, tmp_path, pages, max_pages, fund, expected):
    land(tmp_path, "proposals", pages)
    df = landing.read_proposals(spark, str(tmp_path), NOW, fund, max_pages)
    assert sorted(r["id"] for r in df.collect()) == expected


def test_one_crawl_up_to_its_end(spark, tmp_path):
    land(tmp_path, "proposals", [page(1, [1]), page(2, [2], last=True), page(3, [3])])
    df = landing.read_proposals(spark, str(tmp_path), NOW, until_end=True)
    assert sorted(r["id"] for r in df.collect()) == [1, 2]


def test_proposals_as_one_list(spark, tmp_path):
    land(tmp_path, "proposals", [[{"id": 1, "embedded_uris": [["https://github.com/a/b"]]}, {"id": 2}]])
    df = landing.read_proposals(spark, str(tmp_path), NOW, max_pages=1)
    assert sorted(r["id"] for r in df.collect()) == [1, 2]


def pull(i, day, state="closed"):
    at = f"2023-12-{day:02d}T10:00:00Z"
    return {"id": i, "number": i, "title": f"PR {i}", "state": state, "user": {"login": "dev"},
            "labels": [{"name": "x"}], "updated_at": at}


def test_pull_requests_select_filter_cap_and_stamp(spark, tmp_path):
    land(tmp_path, "pull_requests", [pull(i, i) for i in range(1, 11)], "repository_full_name=a%2Fb")
    land(tmp_path, "pull_requests", [pull(21, 1, "open")], "repository_full_name=c%2Fd")
    root = str(tmp_path)

    def ids(**options):
        return sorted(r["id"] for r in landing.read_pull_requests(spark, root, NOW, **options).collect())

    assert ids() == [*range(1, 11), 21]
    assert ids(repos=["a/b"]) == list(range(1, 11))
    assert ids(state="open") == [21]
    for cap in (1, 5, 10):
        assert ids(repos=["a/b"], max_per_repo=cap) == list(range(11 - cap, 11))
    marks = inc.watermark(
        spark.createDataFrame([("a/b", "2023-12-08T10:00:00Z")], "repository_full_name string, updated_at string"),
        "repository_full_name", "updated_at",
    )
    assert ids(marks=marks) == [9, 10, 21]
    row = landing.read_pull_requests(spark, root, NOW, ["c/d"]).first()
    assert (row["repository_full_name"], row["fetched_at"]) == ("c/d", "2024-01-31T12:00:00")


def test_selected_repositories_prune_folders(spark, tmp_path):
    for repo in ("a%2Fb", "c%2Fd"):
        land(tmp_path, "pull_requests", [pull(1, 1)], f"repository_full_name={repo}")
    df = landing.read_pull_requests(spark, str(tmp_path), NOW, ["a/b"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_mixed_page_keeps_its_new_rows(spark, tmp_path):
    new = {"id": 2, "tag_name": "v2", "published_at": "2023-12-02T10:00:00Z"}
    old = {"id": 1, "tag_name": "v1", "published_at": "2023-11-30T10:00:00Z"}
    land(tmp_path, "releases", [new, old], "repository_full_name=a%2Fb")
    seen = spark.createDataFrame([("a/b", "2023-12-01T10:00:00Z")], "repository_full_name string, published_at string")
    marks = inc.watermark(seen, "repository_full_name", "published_at")
    got = landing.read_releases(spark, str(tmp_path), NOW, marks=marks).collect()
    assert [r["id"] for r in got] == [2]


def test_issues_leave_out_pull_requests(spark, tmp_path):
    land(tmp_path, "issues", [
        {"id": 1, "title": "real", "state": "open"},
        {"id": 2, "title": "pr", "state": "open", "pull_request": {"url": "u"}},
        {"id": 3, "title": "odd pr", "state": "open", "pull_request": {}},
        {"id": 4, "title": "done", "state": "closed"},
    ], "repository_full_name=a%2Fb")
    got = landing.read_issues(spark, str(tmp_path), NOW, state="open").collect()
    assert [r["id"] for r in got] == [1]


def test_repositories(spark, tmp_path):
    land(tmp_path, "repositories", [{"id": 1, "full_name": "a/b"}, {"id": 2, "full_name": "c/d"}])
    got = landing.read_repositories(spark, str(tmp_path), NOW, ["a/b"]).collect()
    assert [r["id"] for r in got] == [1]


def test_limits():
    assert landing.limits("sample") == {"max_prs": 50, "max_releases": 10, "max_pages": 2}
    assert landing.limits("prod")["max_prs"] is None


def test_flatten_struct(spark):
    df = spark.sql("select 1 id, named_struct('login', 'x', 'org', named_struct('n', 2)) user, array(1) l")
    flat = landing.flatten_struct(df)
    assert flat.columns == ["id", "user__login", "user__org__n", "l"]
    assert tuple(flat.first()) == (1, "x", 2, [1])


def test_conform(spark):
    df = spark.createDataFrame([("7", "x")], "id string, other string")
    got = schemas.conform(df, schemas.REPOSITORIES)
    assert got.columns == [*schemas.REPOSITORIES.fieldNames(), "other"]
    assert (got.first()["id"], got.first()["name"]) == (7, None)


def test_layers_views_and_merged_schemas(spark, tmp_path, values):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    table = tables.write_layer(df, str(tmp_path), "silver", "things", partition_by=["k"])
    assert values(table.select("id", "k")) == [(1, "a"), (2, "b")]
    assert len(list((tmp_path / "silver" / "things").glob("data-*/k=a"))) == 1
    view = tables.write_layer(df, str(tmp_path), "gold", "things", "view")
    assert values(view) == values(spark.table("gold_things"))
    with pytest.raises(ValueError):
        tables.write_layer(df, str(tmp_path), "gold", "things", "incremental")

    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    tables.write_all(df, paths)
    assert values(tables.read_table(spark, paths[1])) == values(df)
    tables.full_load(df.select("id", F.lit(True).alias("new")), paths[1])
    loads = [str(tmp_path / "load1"), str(tmp_path / "load2")]
    for path, load in zip(paths, loads):
        tables.read_table(spark, path).write.parquet(load)
    assert values(tables.read_merged(spark, *loads), "id", "k", "new") == [
        (1, "a", None), (1, None, True), (2, "b", None), (2, None, True),
    ]


def test_seeds(spark, tmp_path, values):
    (tmp_path / "map.csv").write_text("project_id,repo_key\n7,a/b\n")
    assert values(tables.read_seed(spark, str(tmp_path / "map.csv"))) == [("7", "a/b")]
    (tmp_path / "repos.csv").write_text(
        "repository_full_name,project_name,project_type,organization\nOrg/Repo,Proj,library,Org\n"
    )
    assert values(tables.read_seed_repositories(spark, str(tmp_path / "repos.csv"))) == [
        ("Proj", "org/repo")
    ]


class FakeSession:
    """A session on a cluster, with or without the shared folder set."""

    def __init__(self, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": "yarn"})()


def test_workspace_is_shared(spark):
    on_cluster = FakeSession(**{"spark.checkpoint.dir": "/shared/work/"})
    assert workspace(on_cluster, "x").startswith("/shared/work/x-")
    with pytest.raises(ValueError):
        workspace(FakeSession(), "x")
    assert workspace(spark, "x") != workspace(spark, "x")
