"""Data checks: single ones that return the failing rows, and suites checked in one scan or while a table is written."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.common import as_list


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once (nulls do not count), with their count."""
    columns = as_list(columns)
    return (
        df.dropna(subset=columns)
        .groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not listed (nulls pass; check them with :func:`not_null`)."""
    return df.filter(~F.col(column).isin(list(values)))


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Required columns the schema lacks."""
    return [n for n in names if n not in df.columns]


def required_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, names)
    rows = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(m) for m in missing]).cast("array<string>")).alias("column_name")
    )
    return rows


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.filter(F.col(child_key).isNotNull()).join(
        keys, F.col(child_key) == F.col("_parent_key"), "left_anti"
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failing) for several not-null checks in a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failing")


def quality_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, failing, passed), one row per named check."""
    counts = [
        failing.agg(F.count(F.lit(1)).alias("failing")).select(
            F.lit(name).alias("check_name"), "failing"
        )
        for name, failing in checks.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("passed", F.col("failing") == 0)


@dataclass(frozen=True)
class Suite:
    """The declared checks of a model: columns without null, keys that occur once, listed values, columns that must be there."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    accepted: tuple[tuple[str, tuple], ...] = ()
    required: tuple[str, ...] = ()

    def named(self, df: DataFrame) -> list[str]:
        """Columns that the suite needs and ``df`` lacks."""
        used = [*self.required, *self.not_null, *[c for key in self.unique for c in key], *[c for c, _ in self.accepted]]
        return missing_columns(df, list(dict.fromkeys(used)))

    def row_checks(self, df: DataFrame) -> dict[str, Column]:
        """Whether a row fails, by the name of the check; only for columns that are there."""
        found = {f"{c} not_null": F.col(c).isNull() for c in self.not_null if c in df.columns}
        return found | {
            f"{c} accepted": F.coalesce(~F.col(c).isin(list(values)), F.lit(False))
            for c, values in self.accepted if c in df.columns}

    def keys(self, df: DataFrame) -> list[tuple[str, ...]]:
        return [key for key in self.unique if not missing_columns(df, key)]


def _key_failures(df: DataFrame, name: str, key: Sequence[str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """(check_name, failing) of one key, and of row checks, by a single aggregate over the key."""
    more = dict(more or {})
    once = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(test).alias(f"_c{i}") for i, test in enumerate(more.values())])
    totals = [F.count_if(once & (F.col("_n") > 1)), *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)) for i in range(len(more))]]
    checks = [f"{name}.{'+'.join(key)} unique", *[f"{name}.{check}" for check in more]]
    counted = per_key.agg(*[t.cast("long").alias(c) for t, c in zip(totals, checks)])
    return counted.unpivot([], [F.col(f"`{c}`") for c in checks], "check_name", "failing")


def suite_report(tables: Mapping[str, tuple[DataFrame, Suite]]) -> DataFrame:
    """(check_name, failing, passed) of several tables, each scanned once per key of its suite, and at least once.

    Null and value checks are counted beside the first key, before anything is shuffled.
    """
    parts = []
    for name, (df, suite) in tables.items():
        rows, keys = suite.row_checks(df), suite.keys(df)
        for i, key in enumerate(keys):
            parts.append(_key_failures(df, name, key, rows if i == 0 else None))
        if rows and not keys:
            counted = df.agg(*[F.count_if(test).alias(f"{name}.{check}") for check, test in rows.items()])
            parts.append(counted.unpivot([], [F.col(f"`{c}`") for c in counted.columns], "check_name", "failing"))
        if suite.required:
            missing = F.lit(len(suite.named(df))).cast("long").alias("failing")
            parts.append(df.sparkSession.range(1).select(F.lit(f"{name} columns").alias("check_name"), missing))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failing") == 0)


def checked_write(
    df: DataFrame, name: str, suite: Suite, write: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(what ``write`` returns, (check, failing rows) pairs).

    Null and value checks are observed by the write itself, so they cost no
    scan; keys are counted on what was stored, of which only they are read.
    """
    told = [(f"{name} columns", len(suite.named(df)))] if suite.required or suite.named(df) else []
    tests = suite.row_checks(df)
    if tests:
        seen = Observation()
        rows = df.observe(seen, *[F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())])
        stored = write(rows)
        counts = seen.get
        told += [(f"{name}.{check}", counts[f"c{i}"]) for i, check in enumerate(tests)]
    else:
        stored = write(df)
    for key in suite.keys(df):
        told += [tuple(r) for r in _key_failures(stored, name, key).collect()]
    return stored, told


def report_of(spark: SparkSession, told: Sequence[tuple[str, int]]) -> DataFrame:
    """(check_name, failing, passed) of counted checks."""
    return spark.createDataFrame(list(told), "check_name string, failing long").withColumn("passed", F.col("failing") == 0)
