"""Scheduled ingest, keyed upserts and activity counts on streams.

Every job reads what arrived since its checkpoint and stops (``availableNow``),
which is how a schedule runs it; pass another trigger to keep it running.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.temporal import month_of, utc_instant, utc_wall_time
from siltstone.operators.common import as_list
from siltstone.sources import logs
from siltstone.sources.logs import BATCH, RUN


def _run_of(checkpoint: str) -> str:
    """A name for the checkpoint: batch ids start anew with each one."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def ingest_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """New JSON files of a landing folder appended to a Parquet table, each exactly once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.json(landing).writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )


def upsert_stream(
    rows: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    log: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append each micro-batch's latest row per key to a log of batches, with the checkpoint as its run.

    A replayed batch replaces its own part, so the result is the same after a
    failure. Levels of the log that are full are merged on the way.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        logs.append(batch, log, logs.newest(keys, order_by), batch_id, run)

    run = _run_of(checkpoint)
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserts(
    spark: SparkSession, log: str, keys: str | Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The current row per key of an upsert log; on equal order the later batch wins."""
    return logs.read_log(spark, log, logs.newest(keys, order_by))


def compact_upserts(
    spark: SparkSession, log: str, keys: str | Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Merge a whole log into one part, in place. Readers of the version before still find it."""
    logs.merge_all(spark, log, logs.newest(keys, order_by))
    return read_upserts(spark, log, keys, order_by)


def _summed(names: Sequence[str]) -> logs.Resolve:
    """Counts per key, day and run of several batches."""
    return lambda rows: rows.groupBy(*names, "day", RUN).agg(F.sum("n").alias("n"), F.max(BATCH).alias(BATCH))


def daily_counts_stream(
    events: DataFrame,
    key: str,
    ts: str,
    log: str,
    checkpoint: str,
) -> StreamingQuery:
    """Events per key and day of each micro-batch, to a log of batches, with the checkpoint as its run.

    Nothing is kept between batches, so a row counts however late it comes;
    :func:`monthly_from_daily` adds the batches up. A replayed batch replaces
    its own part, or is left out if that has been merged into a level.
    """
    rows = events.select(key, utc_instant(ts).alias("_at"))

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(key, F.window("_at", "1 day").alias("_day")).agg(
            F.count(F.lit(1)).alias("n")
        ).select(key, utc_wall_time("_day.start").alias("day"), "n")
        logs.append(counts, log, _summed([key]), batch_id, run, once=True)

    run = _run_of(checkpoint)
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def monthly_from_daily(
    spark: SparkSession, log: str, key: str, month: str = "month", count: str = "event_count",
    runs: str | None = None,
) -> DataFrame:
    """Monthly counts from the log of :func:`daily_counts_stream`: its batches, summed.

    A log with several runs (checkpoints) needs to be told what they are:
    ``runs="add"`` if they read different sources, so that counts add up, or
    ``runs="repeat"`` if each reads the same source from the start, so that the one
    that has counted most of a key's day holds.
    """
    names = as_list(key)
    if runs not in (None, "add", "repeat"):
        raise ValueError('runs is "add" or "repeat"')
    several = {r for p in logs.parts_of(spark, log) for r in p.tags["runs"]}
    if runs is None and len(several) > 1:
        raise ValueError(f'{log} has {len(several)} runs: say whether they "add" to or "repeat" one another')
    daily = logs.stored(spark, log)
    if daily is None:
        raise FileNotFoundError(f"{log} holds no batch")
    daily = daily.groupBy(*names, "day", RUN).agg(F.sum("n").alias("n"))
    if runs == "repeat":
        daily = daily.groupBy(*names, "day").agg(F.max("n").alias("n"))
    return daily.groupBy(*names, month_of("day").alias(month)).agg(
        F.sum("n").alias(count)
    )
