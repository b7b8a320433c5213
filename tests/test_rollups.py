"""Figures kept by signed changes against a rebuild."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.operators.incremental import SIGN, merge_into, signed_changes
from siltstone.sources import logs, rollups, tables

SCHEMA = "id int, fund string, month int, amount long, version int"


@pytest.fixture
def rollup(spark):
    return rollups.Rollup({"fund": F.col("fund"), "month": F.col("month")}, {"amount": F.col("amount")})


def rebuilt(rows):
    """(fund, month) -> rows and sum, of rows that are one per id."""
    groups = defaultdict(list)
    for _, fund, month, amount, _ in rows:
        groups[fund, month].append(amount)
    return {g: (len(v), sum(a for a in v if a is not None) if any(a is not None for a in v) else None) for g, v in groups.items()}


def told(df):
    return {(r.fund, r.month): (r.n, r.amount) for r in df.collect()}


def merged(state, updates):
    for row in updates:
        if row[0] not in state or row[4] >= state[row[0]][4]:
            state[row[0]] = row


def test_signed_changes(spark, values):
    base = spark.createDataFrame([(1, "a", 1, 5, 1), (2, "a", 1, 6, 1), (None, "b", 2, 7, 1)], SCHEMA)
    new = [(1, "a", 2, 5, 2), (2, "x", 9, 9, 0), (3, None, None, None, 1), (None, "b", 2, 8, 1)]
    updates = spark.createDataFrame(new, SCHEMA)
    got = values(signed_changes(base, updates, "id", "version"), SIGN, "id", "fund", "month", "amount")
    assert got == sorted([
        (-1, 1, "a", 1, 5), (1, 1, "a", 2, 5), (1, 3, None, None, None), (-1, None, "b", 2, 7), (1, None, "b", 2, 8)], key=str)
    # A base with its changes is what a merge gives.
    whole = base.withColumn(SIGN, F.lit(1)).unionByName(signed_changes(base, updates, "id", "version"))
    left = whole.groupBy("id", "fund", "month", "amount", "version").agg(F.sum(SIGN).alias("n")).filter("n > 0").drop("n")
    assert values(left) == values(merge_into(base, updates, "id", "version").select(*left.columns))


def test_loads_equal_a_rebuild(spark, tmp_path, rollup):
    rng = random.Random(5)
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    rollups.create(spark.createDataFrame([], SCHEMA), table, "id", "version", 4)
    state = {}
    for batch in range(6):
        ids = rng.sample(range(60), 25)
        rows = [(i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, 1, 20, 300]), rng.randint(0, 4)) for i in ids]
        merged(state, rows)
        rollups.load(spark, table, log, spark.createDataFrame(rows, SCHEMA), rollup, batch)
        if batch in (0, 5):
            assert told(rollups.read(spark, log, rollup)) == rebuilt(state.values())
    assert sorted(map(tuple, tables.read_table(spark, table).collect()), key=str) == sorted(state.values(), key=str)


def test_a_load_can_be_repeated_after_any_failure(spark, tmp_path, monkeypatch, rollup):
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    rollups.create(spark.createDataFrame([], SCHEMA), table, "id", "version", 4)
    rows = spark.createDataFrame([(i, "a", i % 2, 10, 1) for i in range(10)], SCHEMA)
    moved = spark.createDataFrame([(i, "b", 7, None, 2) for i in range(5)], SCHEMA)
    rollups.load(spark, table, log, rows, rollup, 0)

    def fails(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollups.buckets, "merge", fails)
        with pytest.raises(OSError):
            rollups.load(spark, table, log, moved, rollup, 1)
    with monkeypatch.context() as m:
        m.setattr(rollups.logs, "append", fails)
        with pytest.raises(OSError):
            rollups.load(spark, table, log, spark.createDataFrame([(99, "a", 1, 1, 1)], SCHEMA), rollup, 2)
    for _ in range(2):
        rollups.load(spark, table, log, moved, rollup, 1)
    assert told(rollups.read(spark, log, rollup)) == {("b", 7): (5, None), ("a", 0): (2, 20), ("a", 1): (3, 30)}
    assert tables.read_table(spark, table).count() == 10
    # No group is left of rows that all went.
    away = spark.createDataFrame([(i, "c", 1, 1, 3) for i in range(10)], SCHEMA)
    rollups.load(spark, table, log, away, rollup, 2)
    assert told(rollups.read(spark, log, rollup)) == {("c", 1): (10, 10)}
    assert len(logs.parts_of(spark, log)) <= 3
