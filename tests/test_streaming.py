import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone.operators.windows import latest_per_key
from siltstone.plans.activity import activity_monthly
from siltstone.sources import logs, schemas
from siltstone.streaming import jobs

SCHEMA = "id int, k string, ts timestamp_ntz, v int"


@pytest.fixture
def batches(spark):
    rows = [
        (i, f"k{i % 5}", datetime(2024, 1 + i % 3, 1 + i % 28, i % 24), i) for i in range(120)
    ]
    rows.sort(key=lambda r: r[2])
    return [rows[i:i + 40] for i in range(0, 120, 40)]


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest_takes_each_file_once(spark, tmp_path):
    landing, sink, checkpoint = (str(tmp_path / n) for n in ("landing", "sink", "checkpoint"))
    (tmp_path / "landing").mkdir()
    for load, ids in enumerate([[1, 2], [3], []]):
        if ids:
            (tmp_path / "landing" / f"{load}.json").write_text(
                "\n".join(json.dumps({"id": i, "full_name": "a/b"}) for i in ids)
            )
        jobs.ingest_landing(spark, landing, schemas.REPOSITORIES, sink, checkpoint, 1).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_upsert_stream_equals_batch(spark, tmp_path, values, batches):
    source, log, checkpoint = (str(tmp_path / n) for n in ("source", "log", "checkpoint"))
    for rows in batches:
        write(spark, rows, source)
        jobs.upsert_stream(stream(spark, source), "k", ["ts", "id"], log, checkpoint).awaitTermination()
    whole = latest_per_key(spark.read.schema(SCHEMA).parquet(source), "k", ["ts", "id"])
    assert values(jobs.read_upserts(spark, log, "k", ["ts", "id"]), "id", "k") == values(whole, "id", "k")


def test_replayed_batches_change_nothing(spark, tmp_path, values, batches):
    source, log = str(tmp_path / "source"), str(tmp_path / "log")
    for rows in batches:
        write(spark, rows, source)
    results = []
    for run in ("first", "again"):
        jobs.upsert_stream(
            stream(spark, source), "k", ["ts", "id"], log, str(tmp_path / run)
        ).awaitTermination()
        results.append(values(jobs.read_upserts(spark, log, "k", ["ts", "id"])))
    assert results[0] == results[1]


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path, values, batches):
    log = str(tmp_path / "log")
    for i, rows in enumerate(batches):
        source = str(tmp_path / f"source{i}")
        write(spark, rows, source)
        jobs.upsert_stream(
            stream(spark, source), "k", ["ts", "id"], log, str(tmp_path / f"checkpoint{i}")
        ).awaitTermination()
    whole = latest_per_key(
        spark.createDataFrame([r for rows in batches for r in rows], SCHEMA), "k", ["ts", "id"])
    assert values(jobs.read_upserts(spark, log, "k", ["ts", "id"]), "id", "k") == values(whole, "id", "k")
    compacted = jobs.compact_upserts(spark, log, "k", ["ts", "id"])
    assert values(compacted, "id", "k") == values(whole, "id", "k")
    assert len(logs.parts_of(spark, log)) == 1


def test_streams_and_jobs_share_a_log(spark, tmp_path, values, batches):
    log, order = str(tmp_path / "log"), ["ts", "id"]
    for i, rows in enumerate(batches * 3):
        df = spark.createDataFrame([(*r[:3], r[3] + i) for r in rows], SCHEMA)
        if i % 2:
            logs.append(df, log, logs.newest("k", order), i, "job")
        else:
            source = str(tmp_path / f"source{i}")
            df.coalesce(1).write.parquet(source)
            jobs.upsert_stream(stream(spark, source), "k", order, log, str(tmp_path / f"c{i}")).awaitTermination()
    every = spark.createDataFrame([(*r[:3], r[3] + i) for i, rows in enumerate(batches * 3) for r in rows], SCHEMA)
    # Stream batches all have number 0, so of equal rows a job's one is the later.
    got = values(jobs.read_upserts(spark, log, "k", order), "id", "k", "ts")
    assert got == values(latest_per_key(every, "k", order), "id", "k", "ts")
    assert len(logs.parts_of(spark, log)) <= 4


def test_a_replayed_count_that_was_merged_counts_once(spark, tmp_path, values):
    log = str(tmp_path / "log")
    for batch in (0, 1, 2, 3, 1, 3):
        counts = spark.createDataFrame([("a", datetime(2024, 1, 1 + batch), 5)], "k string, day timestamp_ntz, n long")
        logs.append(counts, log, jobs._summed(["k"]), batch, "one", once=True)
    assert len(logs.parts_of(spark, log)) == 1
    assert values(jobs.monthly_from_daily(spark, log, "k")) == [("a", datetime(2024, 1, 1), 20)]


def test_daily_stream_rolls_up_to_the_batch_months(spark, tmp_path, values, batches):
    source, log, checkpoint = (str(tmp_path / n) for n in ("source", "log", "checkpoint"))
    for rows in batches:
        write(spark, rows, source)
        jobs.daily_counts_stream(stream(spark, source), "k", "ts", log, checkpoint).awaitTermination()
    batch = activity_monthly(spark.read.schema(SCHEMA).parquet(source), "k", "ts")
    assert values(jobs.monthly_from_daily(spark, log, "k")) == values(batch)


def test_late_rows_of_any_age_count(spark, tmp_path, values):
    source, log, checkpoint = (str(tmp_path / n) for n in ("source", "log", "checkpoint"))
    steps = [
        [(1, "a", datetime(2024, 1, 31), 0), (2, "a", datetime(2024, 1, 30), 0)],
        [(3, "a", datetime(2024, 2, 2), 0)],
        # One row three days late, one by months.
        [(4, "a", datetime(2024, 1, 30, 5), 0), (5, "a", datetime(2023, 11, 1), 0)],
    ]
    for rows in steps:
        write(spark, rows, source)
        jobs.daily_counts_stream(stream(spark, source), "k", "ts", log, checkpoint).awaitTermination()
    want = [
        ("a", datetime(2023, 11, 1), 1), ("a", datetime(2024, 1, 1), 3), ("a", datetime(2024, 2, 1), 1),
    ]
    assert values(jobs.monthly_from_daily(spark, log, "k")) == want
    # A new checkpoint counts everything again, as a run of its own.
    jobs.daily_counts_stream(stream(spark, source), "k", "ts", log, checkpoint + "2").awaitTermination()
    assert values(jobs.monthly_from_daily(spark, log, "k", runs="repeat")) == want
    with pytest.raises(ValueError, match="2 runs"):
        jobs.monthly_from_daily(spark, log, "k")
    with pytest.raises(ValueError):
        jobs.monthly_from_daily(spark, log, "k", runs="other")


def test_runs_over_different_sources_add_up(spark, tmp_path, values):
    log = str(tmp_path / "log")
    for i, n in enumerate((5, 3)):
        source = str(tmp_path / f"source{i}")
        write(spark, [(j, "a", datetime(2024, 1, 3, j), 0) for j in range(n)], source)
        jobs.daily_counts_stream(stream(spark, source), "k", "ts", log, str(tmp_path / f"c{i}")).awaitTermination()
    assert values(jobs.monthly_from_daily(spark, log, "k", runs="add")) == [("a", datetime(2024, 1, 1), 8)]


def test_days_are_utc_in_any_session_zone(spark, tmp_path, values):
    source, log, checkpoint = (str(tmp_path / n) for n in ("source", "log", "checkpoint"))
    write(spark, [(1, "a", datetime(2024, 1, 31, 23), 0), (2, "a", datetime(2024, 2, 1, 1), 0)], source)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        jobs.daily_counts_stream(stream(spark, source), "k", "ts", log, checkpoint).awaitTermination()
        assert values(jobs.monthly_from_daily(spark, log, "k")) == [
            ("a", datetime(2024, 1, 1), 1), ("a", datetime(2024, 2, 1), 1),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
