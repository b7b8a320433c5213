"""Latest row per key, row caps, previous value, gaps, paged rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.temporal import days_between
from siltstone.operators.common import as_list, join_on, orderable
from siltstone.operators.skew import previous_value, with_place


def _descending(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in columns]


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str | Column],
    rank_col: str | None = None,
    break_ties: bool = True,
) -> DataFrame:
    """One row per key: the highest by ``order_by`` (names sort descending, nulls last).

    With ``break_ties`` the remaining columns complete the order, so the choice
    is deterministic. Spark keeps one row per key and map task before the
    shuffle, so a hot key does not travel as a whole.
    """
    keys = as_list(keys)
    order_by = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    named = [c for c in order_by if isinstance(c, str)]
    order = _descending(order_by)
    if break_ties:
        order += _descending(orderable(df, skip=[*keys, *named]))
    rank = rank_col or "_rank"
    ranked = df.withColumn(
        rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).filter(F.col(rank) == 1)
    return ranked if rank_col else ranked.drop(rank)


def cap_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    n: int | None,
    order_by: str | Sequence[str],
    grain: float | None = 1.0,
) -> DataFrame:
    """At most ``n`` rows per key, highest by ``order_by`` first. ``None`` keeps all, 0 none.

    Counts per slice of the first column tell which slices hold the first ``n``
    rows; only these are ranked, each on its own, whatever ``n`` is. The other
    columns complete the order. Rows that tie in the first column share a slice,
    unless ``grain`` is None (see :mod:`siltstone.operators.skew`).
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("the cap must not be negative")
    if n == 0:
        return df.filter(F.lit(False))
    keys, order_by = as_list(keys), as_list(order_by)
    ties = _descending([*order_by[1:], *orderable(df, skip=[*keys, *order_by])])
    return with_place(df, keys, order_by[0], ties, "_place", n, grain).drop("_place")


def with_previous(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    out: str = "prev_date",
    grain: float | None = 1.0,
) -> DataFrame:
    """Add the previous ``ts`` of the same key (ascending, nulls last).

    One row of each (keys, ts) follows the instant before, the others follow a
    row of their own instant. It is a copy of the row whose other columns hash
    lowest, so a task run again names the same one. Neither the rows of one
    instant nor those without time share a task, only equal rows do.
    """
    keys = as_list(keys)
    others = orderable(df, skip=[*keys, ts])
    rows = df.withColumn("_mark", F.xxhash64(*others) if others else F.lit(0).cast("long"))
    instants = rows.groupBy(*keys, ts).agg(F.min("_mark").alias("_lead"))
    copies = Window.partitionBy(*keys, ts, "_mark").orderBy("_mark")
    numbered = rows.withColumn("_nth", F.row_number().over(copies))
    leads = (F.col("_mark") == F.col("_lead")) & (F.col("_nth") == 1)
    return (
        join_on(numbered, previous_value(instants, keys, ts, "_before", grain), [*keys, ts], "inner")
        .withColumn(out, F.when(leads, F.col("_before")).otherwise(F.col(ts)))
        .drop("_mark", "_nth", "_lead", "_before")
    )


def gaps(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    out: str = "days_diff",
    grain: float | None = 1.0,
) -> DataFrame:
    """Rows that follow another of their key, with the days since it."""
    rows = with_previous(df, keys, ts, "_prev", grain)
    return (
        rows.filter(F.col("_prev").isNotNull())
        .withColumn(out, days_between("_prev", ts))
        .drop("_prev")
    )


def gap_counts(
    df: DataFrame, key: str, ts: str, out: str = "days_diff", grain: float | None = 1.0, weight: str | None = None
) -> DataFrame:
    """Gaps in days between consecutive events of a key, as (key, gap, number of gaps).

    A gap that occurs again takes another row. Events at the same instant are counted before the shuffle and give zero
    gaps. An event without time follows the last dated one with a null gap.
    With ``weight`` the rows are unique by (key, ts) and stand for that many events.
    """
    marks = df.withColumnRenamed(weight, "_n") if weight else df.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"))
    dated = F.col(ts).isNotNull()
    found = F.explode(F.array(
        F.struct(
            days_between("_prev", ts).alias(out),
            F.when(F.col("_prev").isNotNull(), F.lit(1)).otherwise(0).cast("long").alias("n"),
        ),
        F.struct(
            F.lit(0.0).alias(out),
            F.when(dated, F.col("_n") - 1).otherwise(0).cast("long").alias("n"),
        ),
    ))
    return (
        previous_value(marks, key, ts, "_prev", grain)
        .select(key, found.alias("_g"))
        .select(key, f"_g.{out}", F.col("_g.n").alias("gaps"))
        .filter(F.col("gaps") > 0)
    )


def ranked_pages(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str,
    item: Column,
    page_rows: int = 10_000,
    ties: Sequence[str] = (),
    out: str = "items",
    grain: float | None = 1.0,
) -> DataFrame:
    """Per key, all items by ``order_by`` descending as arrays of at most ``page_rows``.

    One row per (keys, page), pages from 0. No array holds more than a page, no
    sort more than a slice, and no item is dropped. Rows with null ``order_by`` end up last.
    """
    keys = as_list(keys)
    order = [F.col(t).asc_nulls_last() for t in ties]
    placed = with_place(df.withColumn("_item", item), keys, order_by, order, "_place", grain=grain)
    page = F.floor(F.col("_place") / page_rows).cast("int")
    return (
        placed.groupBy(*keys, page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_item"))).alias("_items"))
        .select(*keys, "page", F.col("_items._item").alias(out))
    )
