"""Every registered query against its DuckDB SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from testbed import queries
from testbed.check import compare, connect
from testbed.oracle import ORACLE
from testbed.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_entry(spark):
    assert driver.entry(spark).columns == ["repository", "month", "feature_pr_count"]


def test_landed_files_are_small_and_read_back(spark, tmp_path, monkeypatch):
    root = tmp_path / "landed"
    monkeypatch.setattr(queries, "workspace", lambda spark, purpose: str(root))
    monkeypatch.setattr(queries, "LANDED_ROWS", 1000, raising=False)
    rows = [(i, f"title {i}" if i % 7 else None, f"org/{i % 2}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, title string, repository string").coalesce(1)
    queries._land(df, "releases", ("repository",))
    files = list(root.rglob("part-*"))
    # Four files of a thousand rows, a fraction of their 40 bytes a row.
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 4000 * 20
    back = spark.read.schema(df.schema).json(f"{root}/releases")
    assert sorted(map(tuple, back.collect())) == rows
