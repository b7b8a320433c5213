"""Order within groups of any size without putting one group into one task.

A window or an exact percentile sends each group to a single task. Here a group
is cut into slices by a fixed rule on the value: the hour of a time, the leading
digits of a number. The rule needs no sample and no count, so every key takes
the same plan and a repeated task cuts alike. A summary of one row per slice
links the slices: rows in the slices before, or the last value there.

A key has at most as many slices as hours in its period, or as magnitudes among
its numbers. One slice is sorted in one task, by Spark's spilling sort.

Where a key's values are tied, missing or all close to one another, that rule puts
them into one slice. With ``grain=None`` the operators cut by :func:`even_slices`
instead: ranges of a sampled total order, which go on cutting among ties by the
columns that follow. That costs one more shuffle and a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.common import as_list, join_on, orderable
from siltstone.session import workspace

SLICE = "_slice"
# Seconds of a slice of times, and slices per factor e of a number.
SLICE_SECONDS = 3600
SLICE_STEPS = 4096
# Characters of a slice of texts: an ISO time up to its hour.
SLICE_PREFIX = 13


def slice_of(df: DataFrame, column: str, grain: float = 1.0) -> Column:
    """A number (or text prefix) that never falls as the column rises; null for null.

    ``grain`` is the size of a slice against the usual one; it affects balance
    only, never a result. NaN has the highest slice.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    seconds = SLICE_SECONDS * grain
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_seconds(value) / seconds)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return F.floor((F.unix_date(value.cast("date")).cast("long") * 86_400 + clock) / seconds)
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        magnitude = F.floor(F.log1p(F.abs(number)) * (SLICE_STEPS / grain))
        return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(F.signum(number) * magnitude)
    if isinstance(kind, T.StringType):
        return F.substring(value, 1, SLICE_PREFIX)
    return value


def even_slices(
    df: DataFrame, order: Sequence[str | Column], rising: bool = True, slices: int | None = None
) -> DataFrame:
    """``df`` with slice numbers: ranges of ``order`` that hold about as many rows each.

    A range ends wherever rows are many, within a key, a value or a run of ties,
    so only rows that are equal in all of ``order`` are sure to share a slice.
    Numbers rise along the order, or fall. The ranges come from a sample and would
    differ in a second run, so the dealt rows are written to the work folder.
    ``slices`` is spark.sql.shuffle.partitions if not given, of which adaptive
    execution joins small ones.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    number = F.spark_partition_id()
    dealt = dealt.withColumn(SLICE, number if rising else -number)
    path = workspace(spark, "slices")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def _row_hash(df: DataFrame) -> list[Column]:
    columns = orderable(df)
    return [F.xxhash64(*columns)] if columns else []


def with_place(
    df: DataFrame,
    keys: str | Sequence[str],
    by: str,
    ties: Sequence[Column] = (),
    out: str = "place",
    first: int | None = None,
    grain: float | None = 1.0,
) -> DataFrame:
    """Number the rows of each key from 0, by ``by`` descending (nulls last), then ``ties``.

    With ``first`` only that many rows of each key stay; slices behind them are
    left out before any row is sorted. With ``grain=None`` rows that tie in ``by``
    are cut by ``ties`` and at last by their hash.
    """
    keys = as_list(keys)
    if grain is None:
        sliced = even_slices(df, [*keys, F.col(by).desc_nulls_last(), *ties, *_row_hash(df)], rising=False)
    else:
        sliced = df.withColumn(SLICE, slice_of(df, by, grain))
    earlier = (
        Window.partitionBy(*keys).orderBy(F.col(SLICE).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = (
        sliced.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, SLICE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(F.col(by).desc_nulls_last(), *ties)
    if first is not None:
        cells = cells.filter(F.col("_before") < first)
    rows = join_on(sliced, cells, [*keys, SLICE], "inner").withColumn(
        "_nth", F.row_number().over(in_slice)
    )
    if first is not None:
        rows = rows.filter(F.col("_nth") <= first).filter(F.col("_before") + F.col("_nth") <= first)
    return rows.withColumn(out, F.col("_before") + F.col("_nth") - 1).drop(SLICE, "_before", "_nth")


def previous_value(
    df: DataFrame, keys: str | Sequence[str], value: str, out: str = "previous", grain: float | None = 1.0
) -> DataFrame:
    """Add the next lower value of the same key, for rows unique by (keys, value).

    A row without value comes after all others.
    """
    keys = as_list(keys)
    if grain is None:
        sliced = even_slices(df, [*keys, F.col(value).asc_nulls_last()])
    else:
        sliced = df.withColumn(SLICE, slice_of(df, value, grain))
    slices = Window.partitionBy(*keys).orderBy(F.col(SLICE).asc_nulls_last())
    ends = (
        sliced.groupBy(*keys, SLICE).agg(F.max(value).alias("_end"))
        .select(*keys, SLICE, F.lag("_end").over(slices).alias("_end"))
    )
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(F.col(value).asc_nulls_last())
    return (
        join_on(sliced, ends, [*keys, SLICE], "inner")
        .withColumn(out, F.coalesce(F.lag(value).over(in_slice), "_end"))
        .drop(SLICE, "_end")
    )


def exact_quantile(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    q: float = 0.5,
    out: str = "quantile",
    weight: str | None = None,
    grain: float | None = 1.0,
) -> DataFrame:
    """Exact interpolated ``q``-quantile of ``value`` per key (nulls ignored).

    Equal values are counted before the shuffle, the slice that holds the wanted
    rank is located by cumulative counts, and only that one is sorted. Keys with
    no value give no row.
    """
    keys = as_list(keys)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        count.cast("long").alias("_w")
    )
    if grain is None:
        sliced = even_slices(counts, [*keys, value])
    else:
        sliced = counts.withColumn(SLICE, slice_of(counts, value, grain))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = (F.col("_total") - 1) * F.lit(float(q))
    cells = (
        sliced.groupBy(*keys, SLICE).agg(F.sum("_w").alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
        .withColumns({
            "_before": F.col("_upto") - F.col("_n"),
            "_pos": position,
            "_lo": F.floor(position),
            "_hi": F.ceil(position),
        })
    )
    holds_rank = (F.col("_before") <= F.col("_hi")) & (F.col("_lo") < F.col("_upto"))
    # At most two slices per key are left.
    wanted = cells.filter(holds_rank).drop("_n", "_upto", "_total")
    in_slice = (
        Window.partitionBy(*keys, SLICE).orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        join_on(sliced, wanted, [*keys, SLICE], "inner")
        .withColumn("_end", F.col("_before") + F.sum("_w").over(in_slice))
        .withColumn("_start", F.col("_end") - F.col("_w"))
    )

    def at(rank: str) -> Column:
        hit = (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    between = (
        (F.col("_lo") + 1 - F.col("_pos")) * F.col("_low")
        + (F.col("_pos") - F.col("_lo")) * F.col("_high")
    )
    return (
        ranked.groupBy(*keys)
        .agg(
            at("_lo").alias("_low"), at("_hi").alias("_high"),
            F.max("_pos").alias("_pos"), F.max("_lo").alias("_lo"),
        )
        .select(
            *keys,
            F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between).alias(out),
        )
    )
