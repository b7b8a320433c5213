"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.temporal import parse_ts


def as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def ts_lit(now: datetime) -> Column:
    """A naive UTC datetime as TIMESTAMP_NTZ, whatever the session time zone."""
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def as_time(df: DataFrame, column: str) -> Column:
    """The column as TIMESTAMP_NTZ, parsed if it is text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return parse_ts(column)
    return F.col(column).cast("timestamp_ntz")


def orderable(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    """Columns usable as tie-breaks: everything sortable that is not in ``skip``."""
    return [
        f.name for f in df.schema.fields
        if f.name not in skip and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches null keys; key columns come from ``left``."""
    renamed = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(renamed)
    same = reduce(Column.__and__, [left[k].eqNullSafe(right[r]) for k, r in renamed.items()])
    return left.join(right, same, how).drop(*renamed.values())
