"""Arithmetic that never fails on zero or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double; null when ``whole`` is zero or null."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def pct(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def vote_total(yes: Column | str, no: Column | str, abstain: Column | str) -> Column:
    """Sum of the three counts; null when any of them is null."""
    return _col(yes) + _col(no) + _col(abstain)


def approval_rate(yes: Column | str, total: Column | str) -> Column:
    return F.when(_col(total) > 0, ratio(yes, total))
