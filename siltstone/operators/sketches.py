"""Quantiles from stored sketches: one per key and period, merged when they are read.

An exact quantile needs all values again; a sketch of a closed period never
changes, so a report over any periods and coarser keys merges what is stored.
The answer is a value whose rank is off by :func:`rank_error` at most (with a
chance of 99 percent per answer), whatever the number of values or of merges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.common import as_list

SKETCH = "sketch"
# Size of a sketch: some 10 KB at most, a rank error of 0.9 percent.
SIZE = 512


def rank_error(size: int = SIZE) -> float:
    """By how much a rank may be off, as a part of all values: the published bound of the KLL sketch."""
    return 2.296 / size ** 0.9021


def sketched(df: DataFrame, keys: str | Sequence[str], value: str, size: int = SIZE, out: str = SKETCH) -> DataFrame:
    """(keys, sketch): the values of each group. Nulls and NaN are left out; a group of nothing else gives no row."""
    number = F.col(value).cast("double")
    rows = df.filter(number.isNotNull() & ~F.isnan(number))
    # Partial sketches are merged after the shuffle, so a large group is summed up where its rows are.
    return rows.groupBy(*as_list(keys)).agg(F.kll_sketch_agg_double(number, F.lit(size)).alias(out))


def merged(sketches: DataFrame, keys: str | Sequence[str], sketch: str = SKETCH) -> DataFrame:
    """(keys, sketch) over all rows of coarser keys."""
    return sketches.groupBy(*as_list(keys)).agg(F.kll_merge_agg_double(sketch).alias(sketch))


def quantile(q: float, sketch: str = SKETCH) -> Column:
    """A value of about this rank."""
    if not 0 <= q <= 1:
        raise ValueError("q must be between 0 and 1")
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(q)))


def values_in(sketch: str = SKETCH) -> Column:
    """How many values a sketch stands for."""
    return F.kll_sketch_get_n_double(sketch)
