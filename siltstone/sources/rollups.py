"""Counts and sums per group that follow a merged table without being rebuilt.

A load merges updates into a bucketed table. The rows it takes out count -1, the
rows it puts in count 1, and these signed figures per group are appended to a log
whose batches add up. A row that moves to another group leaves the old one by that,
however old it is. A load reads the buckets it touches and nothing else, and what
is appended has a row per group that changed.

Only figures that can be subtracted are kept: rows, and sums with the number of
values in them, from which averages follow. Sums of fractions would keep rounding
errors, so give integers or decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.incremental import SIGN, signed_changes
from siltstone.sources import buckets, logs
from siltstone.sources.logs import BATCH, RUN

ROWS = "_rows"


@dataclass(frozen=True)
class Rollup:
    """Names and columns of the groups, and of what is summed in them."""

    group: Mapping[str, Column]
    sums: Mapping[str, Column] = field(default_factory=dict)

    def figures(self) -> list[str]:
        return [ROWS, *self.sums, *[f"_known_{s}" for s in self.sums]]

    def signed(self, changes: DataFrame) -> DataFrame:
        """The figures of signed rows per group; groups in which nothing changes are left out."""
        sign = F.col(SIGN)
        rows = changes.select(*[c.alias(n) for n, c in self.group.items()], sign, *[c.alias(n) for n, c in self.sums.items()])
        totals = rows.groupBy(*self.group).agg(
            F.sum(sign).alias(ROWS),
            *[F.coalesce(F.sum(sign * F.col(s)), F.lit(0)).alias(s) for s in self.sums],
            *[F.sum(F.when(F.col(s).isNotNull(), sign).otherwise(0)).alias(f"_known_{s}") for s in self.sums])
        return totals.filter(" or ".join(f"`{f}` <> 0" for f in self.figures()))

    def added(self, rows: DataFrame) -> DataFrame:
        """Batches of the log as one."""
        return rows.groupBy(*self.group, RUN).agg(
            *[F.sum(f).cast(rows.schema[f].dataType).alias(f) for f in self.figures()], F.max(BATCH).alias(BATCH))


def create(
    empty: DataFrame, table: str, keys: str | Sequence[str], order_by: str | Sequence[str], n_buckets: int = buckets.BUCKETS
) -> None:
    """An empty bucketed table with the columns of ``empty``, for :func:`load`."""
    buckets.create(empty.filter(F.lit(False)), table, keys, order_by, n_buckets)


def load(spark: SparkSession, table: str, log: str, updates: DataFrame, rollup: Rollup, batch: int, run: str = "load") -> DataFrame:
    """Merge ``updates`` into the table, and what that changes into the log. Returns the table.

    The log comes first: a load that fails between the two is repeated with the
    same batch and the same updates, finds its figures there and only merges. A
    load that has ended can be repeated as well and changes nothing. Loads of
    one table follow one another. Updates that lose against the stored row, or equal
    it, leave the figures as they are; a null in a key or group is a value like others.
    """
    parts = logs.parts_of(spark, log)
    if not logs.merged_already(parts, batch, run) and not any(logs.is_batch(p, batch, run) for p in parts):
        stored, keys, order_by = buckets.touched(spark, table, updates)
        changes = signed_changes(stored, updates, keys, order_by)
        logs.append(rollup.signed(changes), log, rollup.added, batch, run, once=True)
    return buckets.merge(spark, table, updates)


def read(spark: SparkSession, log: str, rollup: Rollup, count: str = "n") -> DataFrame:
    """Groups that have rows, with their number and sums; a sum of nulls only is null."""
    def whole(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*rollup.group).agg(*[F.sum(f).cast(rows.schema[f].dataType).alias(f) for f in rollup.figures()])

    return logs.read_log(spark, log, whole).filter(F.col(ROWS) > 0).select(
        *rollup.group, F.col(ROWS).alias(count), *[F.when(F.col(f"_known_{s}") > 0, F.col(s)).alias(s) for s in rollup.sums])
