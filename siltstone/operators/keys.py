"""Top keys by count, and the pinned-key-or-top selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siltstone.operators.common import join_on


def top_keys(df: DataFrame, key: str, n: int, weight: str | None = None) -> DataFrame:
    """The ``n`` keys with most rows (or the largest sum of ``weight``); ties by key."""
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.groupBy(key).agg(total.alias("_total"))
        .orderBy(F.desc("_total"), F.col(key).asc_nulls_last())
        .limit(n)
        .select(key)
    )


def pinned_or_top(
    df: DataFrame,
    key: str,
    n: int,
    pinned,
    pinned_label: str = "pinned",
    top_label: str = "top",
    weight: str | None = None,
    group: str = "key_group",
) -> DataFrame:
    """(key, group) for the pinned key and the top ``n``: ``n + 1`` rows at most."""
    top = top_keys(df, key, n, weight).filter(F.col(key) != F.lit(pinned))
    pin = df.sparkSession.range(1).select(F.lit(pinned).cast(df.schema[key].dataType).alias(key))
    return pin.withColumn(group, F.lit(pinned_label)).unionByName(
        top.withColumn(group, F.lit(top_label))
    )


def only_keys(df: DataFrame, groups: DataFrame, key: str, group: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in ``groups``, with its label if ``group`` is named.

    The null-safe join adds no filter below ``df``, so when ``groups`` was
    computed from ``df`` both share one shuffle. ``groups`` has no null key.
    """
    if group is None:
        return join_on(df, groups.select(key), [key], "left_semi")
    return join_on(df, groups.select(key, group), [key], "inner")


def pick_keys(df: DataFrame, key: str, n: int, pinned) -> list[Row]:
    """(key, rows) of the pinned key, if it occurs, and of the top ``n``.

    Runs a job that returns ``n + 1`` rows, for plans that filter by literal
    keys (which reach the scan) or depend on how large the keys are.
    """
    is_pinned = F.coalesce(F.col(key) == F.lit(pinned), F.lit(False))
    first = (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(is_pinned.desc(), F.desc("rows"), F.col(key).asc_nulls_last())
        .limit(n + 1)
        .collect()
    )
    ranked = sorted(first, key=lambda r: (-r["rows"], r[key] is None, r[key]))
    return [
        r for r in first if r[key] is not None and (r[key] == pinned or r in ranked[:n])
    ]
