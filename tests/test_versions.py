"""Versioned tables, bucketed merges and loaded ranges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone.operators import incremental as inc
from siltstone.operators import ranges
from siltstone.operators.windows import cap_per_key
from siltstone.sources import buckets, tables, versions


def folders(path):
    return sorted(d.name for d in path.iterdir() if d.name.startswith("data-"))


def test_a_failed_load_leaves_the_old_table(spark, tmp_path, values):
    path = tmp_path / "t"
    old = tables.full_load(spark.range(5), str(path))
    # Some tasks write their files before another one fails.
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.full_load(bad, str(path))
    assert values(tables.read_table(spark, str(path))) == values(old) == [(i,) for i in range(5)]
    assert len(folders(path)) == 1 and versions.latest(spark, str(path)).number == 1
    # A writer that dies before its commit leaves a folder that nobody reads.
    versions.write_part(spark.range(9), str(path))
    assert tables.read_table(spark, str(path)).count() == 5
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path, values):
    path = str(tmp_path / "t")
    first = tables.full_load(spark.range(4).withColumn("k", F.lit("x")), path, ["k"])
    tables.full_load(tables.read_table(spark, path).filter("id > 1"), path)
    assert values(tables.read_table(spark, path), "id", "k") == [(2, "x"), (3, "x")]
    assert first.count() == 4 and versions.read(spark, path, 1).count() == 4
    for n in range(4):
        tables.full_load(spark.range(n), path)
    assert len(folders(tmp_path / "t")) == versions.KEPT and tables.read_table(spark, path).count() == 3
    assert tables.full_load(spark.range(0), path).count() == 0 == tables.read_table(spark, path).count()


def test_the_second_of_two_writers_starts_again(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_load(spark.range(1), path)
    base = versions.latest(spark, path)
    part = versions.Part(versions.write_part(spark.range(2), path))
    versions.commit(spark, path, base, [part], base.schema)
    with pytest.raises(versions.VersionConflict):
        versions.commit(spark, path, base, [part], base.schema)
    seen = []

    def step(found):
        seen.append(found.number)
        if len(seen) == 1:  # another writer in between
            versions.commit(spark, path, found, found.parts, found.schema)
        return [*found.parts, part], found.schema, {}

    assert versions.change(spark, path, step).number == 4 and seen == [2, 3]


SCHEMA = "id long, at string, note string"


def test_merge_rewrites_only_touched_buckets(spark, tmp_path, values):
    path = str(tmp_path / "t")
    base = spark.range(1000).selectExpr("id", "'2024-01-02' as at", "concat('old', id) as note")
    buckets.create(base, path, "id", "at", buckets=16)
    before = {p.tags["_bucket"]: p.folder for p in versions.latest(spark, path).parts}
    assert len(before) == 16
    updates = spark.createDataFrame([(5, "2024-01-03", "new"), (5, "2024-01-02", "same"), (7, "2024-01-01", "late"), (2000, None, "added")], SCHEMA)
    got = buckets.merge(spark, path, updates)
    assert values(got) == values(inc.upsert(base, updates, "id", "at"))
    after = {p.tags["_bucket"]: p.folder for p in versions.latest(spark, path).parts}
    changed = {b for b in after if before[b] != after[b]}
    hashed = {r[0] for r in updates.select(F.pmod(F.xxhash64("id"), F.lit(16))).collect()}
    assert changed == hashed and len(changed) <= 3
    # Nothing of the others was read: they may even be gone.
    kept = {b for b in after if b not in changed}
    assert len(folders(tmp_path / "t")) == 2 and kept
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_merges_equal_upserts(spark, tmp_path, values):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "b", "x"), (None, "b", "n"), (2, None, "y"), (1, "a", "older")], SCHEMA)
    want = inc.upsert(base.limit(0), base, "id", "at")
    assert values(buckets.create(base, path, "id", "at", buckets=3)) == values(want)
    steps = [
        [(1, "b", "tie wins"), (None, "a", "late")], [(2, "a", "dated"), (3, "c", "new"), (3, "d", "newer")], [], [(None, "c", "n2")]]
    for step in steps:
        updates = spark.createDataFrame(step, SCHEMA)
        want = inc.upsert(want, updates, "id", "at")
        assert values(buckets.merge(spark, path, updates)) == values(want)
    # Keys of another type and a new column.
    wider = spark.createDataFrame([(3, "e", "z", 1.5)], "id int, at string, note string, extra double")
    got = buckets.merge(spark, path, wider)
    assert got.columns == ["id", "at", "note", "extra"]
    assert got.filter("id = 3").first()["extra"] == 1.5 and got.filter("extra is null").count() == 3
    with pytest.raises(FileNotFoundError):
        buckets.merge(spark, str(tmp_path / "other"), wider)


def test_a_failing_merge_leaves_the_table(spark, tmp_path, values):
    path = str(tmp_path / "t")
    buckets.create(spark.createDataFrame([(1, "a", "x")], SCHEMA), path, "id", "at", buckets=2)
    bad = spark.range(3).select("id", F.lit("z").alias("at"), F.raise_error(F.lit("lost")).cast("string").alias("note"))
    with pytest.raises(Exception, match="lost"):
        buckets.merge(spark, path, bad)
    assert values(versions.read(spark, path)) == [(1, "a", "x")] and len(folders(tmp_path / "t")) == 1


RANGE = "k string, low struct<at:timestamp_ntz,tie:long>, high struct<at:timestamp_ntz,tie:long>"


def day(d, tie=0):
    return (datetime(2024, 1, d), tie)


def test_ranges_that_meet_become_one(spark, values):
    df = spark.createDataFrame([
        ("a", day(5), day(9)), ("a", day(8), day(12)), ("a", day(20), day(21)), ("a", day(6), day(7)),
        ("b", None, day(3)), ("b", None, day(5)), ("b", day(6), day(7)), ("c", day(1, 1), day(1, 4)), ("c", day(1, 4), day(1, 9))], RANGE)
    got = [(r.k, tuple(r.low) if r.low else None, tuple(r.high)) for r in ranges.merged(df, "k").collect()]
    assert sorted(got, key=str) == sorted([
        ("a", day(5), day(12)), ("a", day(20), day(21)), ("b", None, day(5)), ("b", day(6), day(7)),
        ("c", day(1, 1), day(1, 9))], key=str)


@pytest.mark.parametrize("loads", [[(2, 9), (1, 3), (None, 4), (5, 8)], [(0, 1), (3, 12), (3, 0), (2, 12)]])
def test_loads_of_any_caps_take_each_row_once(spark, loads):
    """(cap, rows that have arrived): the newest in no range, up to the cap; at last all."""
    made = [(f"k{i % 2}", i, datetime(2024, 1, 1 + i // 4)) for i in range(0, 24)]
    done, taken = spark.createDataFrame([], RANGE), []
    arrived = 0
    for cap, more in [*loads, (None, 24)]:
        arrived = min(arrived + more, 24)
        source = spark.createDataFrame(made[:arrived], "k string, id long, at timestamp_ntz")
        rows = cap_per_key(ranges.outside(source, done, "k", "at", "id"), "k", cap, ["at", "id"]).collect()
        taken += [r.id for r in rows]
        loaded = spark.createDataFrame(rows, source.schema)
        both = done.unionByName(ranges.covered(loaded, "k", "at", "id", cap is not None))
        done = spark.createDataFrame(ranges.merged(both, "k").collect(), done.schema)
    assert sorted(taken) == list(range(24))
