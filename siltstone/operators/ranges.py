"""Loaded ranges: which stretches of a key's rows, in the order of (time, id), were loaded.

One high mark per key says that all before it is there, which a capped load
makes untrue: it takes the newest rows and stops. A set of ranges says what is
there, so a later load takes the rest. A range is closed on both ends; a null
``low`` reaches back to the first row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.common import as_list, as_time, join_on

LOW, HIGH = "low", "high"


def place_of(df: DataFrame, ts: str, tie: str) -> Column:
    """Where a row stands among those of its key; null without a time."""
    at = as_time(df, ts)
    return F.when(at.isNotNull(), F.struct(at.alias("at"), F.col(tie).cast("long").alias("tie")))


def outside(df: DataFrame, ranges: DataFrame, key: str | Sequence[str], ts: str, tie: str) -> DataFrame:
    """Rows in no range of their key. Rows without time pass: nothing says that they were loaded."""
    keys = as_list(key)
    # A key has as many ranges as gaps, which capped loads leave; merged() closes them.
    of_key = ranges.groupBy(*keys).agg(F.collect_list(F.struct(LOW, HIGH)).alias("_ranges"))
    placed = df.withColumn("_place", place_of(df, ts, tie))
    within = F.exists("_ranges", lambda r: (r[LOW].isNull() | (F.col("_place") >= r[LOW])) & (F.col("_place") <= r[HIGH]))
    loaded = F.coalesce(F.col("_place").isNotNull() & within, F.lit(False))
    return join_on(placed, of_key, keys, "left").filter(~loaded).drop("_ranges", "_place")


def covered(loaded: DataFrame, key: str | Sequence[str], ts: str, tie: str, capped: bool) -> DataFrame:
    """(key, low, high): the range that a load of the newest rows in no range has completed.

    All rows down to its last one are there now, by it or by a load before. What
    is not ``capped`` took the rows before that, too. Rows without time have no place.
    """
    keys = as_list(key)
    placed = loaded.withColumn("_place", place_of(loaded, ts, tie)).filter(F.col("_place").isNotNull())
    low = F.min("_place")
    return placed.groupBy(*keys).agg((low if capped else F.when(F.lit(False), low)).alias(LOW), F.max("_place").alias(HIGH))


def merged(ranges: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The same ranges without overlaps: those that meet become one, with the highest of their other columns."""
    keys = as_list(key)
    more = [c for c in ranges.columns if c not in (*keys, LOW, HIGH)]
    by_low = Window.partitionBy(*keys).orderBy(F.col(LOW).asc_nulls_first())
    before = by_low.rowsBetween(Window.unboundedPreceding, -1)
    reach = ranges.withColumn("_reach", F.max(HIGH).over(before))
    apart = F.col("_reach").isNull() | F.coalesce(F.col(LOW) > F.col("_reach"), F.lit(False))
    numbered = reach.withColumn("_apart", apart.cast("int")).withColumn(
        "_group", F.sum("_apart").over(by_low.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # A null low is the least one, which min() would pass over.
    low = F.when(F.count_if(F.col(LOW).isNull()) == 0, F.min(LOW)).alias(LOW)
    return numbered.groupBy(*keys, "_group").agg(
        low, F.max(HIGH).alias(HIGH), *[F.max(c).alias(c) for c in more]).drop("_group")
