"""Logs of batches that are merged level by level.

A load appends a batch and rewrites nothing. When ``FANOUT`` batches of a level
have gathered, they become one batch of the next level that holds what they
resolve to: the newest row per key, or sums. So after n loads a reader meets at
most ``FANOUT - 1`` copies of a row for each of the log's levels, of which there
are log n, and a row is rewritten once per level.

Rows keep the number of the batch they came with, so the order between equal
rows is the same before and after. Jobs and streams use the same layout: a part
of the version knows its run, the range of its batches, its level and tags;
only parts of the same tags are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.windows import latest_per_key
from siltstone.sources import versions
from siltstone.sources.versions import Part, Version

BATCH = "batch"
RUN = "run"
FANOUT = 4

Resolve = Callable[[DataFrame], DataFrame]


def newest(keys: str | Sequence[str], order_by: Sequence[str | Column]) -> Resolve:
    """The highest row per key; on equal order the one of the later batch."""
    return lambda rows: latest_per_key(rows, keys, [*order_by, F.desc(BATCH), F.desc(RUN)])


def parts_of(spark: SparkSession, path: str) -> tuple[Part, ...]:
    version = versions.latest(spark, path)
    return version.parts if version else ()


def is_batch(part: Part, batch: int, run: str) -> bool:
    """Whether the part is this batch and nothing else."""
    return part.tags["level"] == 0 and part.tags["runs"] == [run] and part.tags["low"] == batch


def merged_already(parts: Sequence[Part], batch: int, run: str) -> bool:
    """Whether a merged part may hold this batch, so that it can't be replaced any more."""
    return any(p.tags["level"] and run in p.tags["runs"] and p.tags["low"] <= batch <= p.tags["high"] for p in parts)


def _wider(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """All columns of both; one that both have must be of one type."""
    if known is None:
        return new
    types = {f.name: f.dataType for f in known.fields}
    for f in new.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()} in the log, {f.dataType.simpleString()} here")
    return T.StructType([*known.fields, *[f for f in new.fields if f.name not in types]])


def append(
    rows: DataFrame, path: str, resolve: Resolve, batch: int, run: str = "", tags: Mapping | None = None,
    once: bool = False, fanout: int = FANOUT,
) -> DataFrame:
    """Append a batch, resolved in itself, and merge levels that are full. Returns the rows of the batch.

    The same batch of the same run again replaces it. If it has been merged
    already, its rows are added, which newest rows bear; ``once`` leaves them
    out instead, as sums need it.
    """
    spark, more = rows.sparkSession, dict(tags or {})
    stamped = rows.withColumns({BATCH: F.lit(batch).cast("long"), RUN: F.lit(run)})
    if once and merged_already(parts_of(spark, path), batch, run):
        return stamped.limit(0).drop(BATCH, RUN)
    resolved = resolve(stamped)
    part = Part(versions.write_part(resolved, path), {
        "level": 0, "low": batch, "high": batch, "runs": [run], "more": more})

    def step(base: Version | None):
        others = [p for p in base.parts if not is_batch(p, batch, run)] if base else []
        return [*others, part], _wider(base.schema if base else None, resolved.schema), {}

    versions.change(spark, path, step)
    merge_levels(spark, path, resolve, fanout)
    return versions.read_parts(spark, path, [part], resolved.schema).drop(BATCH, RUN)


def merge_levels(spark: SparkSession, path: str, resolve: Resolve, fanout: int = FANOUT) -> None:
    """Merge the parts of each level that has ``fanout`` of them, from the lowest level on."""
    while True:
        groups: dict[tuple, list[Part]] = {}
        for p in parts_of(spark, path):
            groups.setdefault((p.tags["level"], str(sorted(p.tags["more"].items()))), []).append(p)
        full = [found for _, found in sorted(groups.items(), key=lambda g: g[0]) if len(found) >= fanout]
        if not full or not _merge(spark, path, resolve, full[0]):
            return


def merge_all(spark: SparkSession, path: str, resolve: Resolve) -> None:
    """Merge all parts of the same tags."""
    groups: dict[str, list[Part]] = {}
    for p in parts_of(spark, path):
        groups.setdefault(str(sorted(p.tags["more"].items())), []).append(p)
    for found in groups.values():
        if len(found) > 1:
            _merge(spark, path, resolve, found)


def _merge(spark: SparkSession, path: str, resolve: Resolve, found: Sequence[Part]) -> bool:
    """Put one part in the place of several. False if one of them went meanwhile; the work is dropped then."""
    schema = versions.latest(spark, path).schema
    rows = resolve(versions.read_parts(spark, path, found, schema))
    part = Part(versions.write_part(rows, path), {
        "level": max(p.tags["level"] for p in found) + 1, "low": min(p.tags["low"] for p in found),
        "high": max(p.tags["high"] for p in found), "runs": sorted({r for p in found for r in p.tags["runs"]}),
        "more": dict(found[0].tags["more"])})
    gone = {p.folder for p in found}

    def step(base: Version | None):
        if not gone <= {p.folder for p in base.parts}:
            return None
        return [*[p for p in base.parts if p.folder not in gone], part], base.schema, base.info

    made = versions.change(spark, path, step)
    return any(p.folder == part.folder for p in made.parts)


def stored(spark: SparkSession, path: str, only: Callable[[Part], bool] = lambda part: True) -> DataFrame | None:
    """All rows of the log's parts for which ``only`` holds, with batch and run; None if there is no such part."""
    version = versions.latest(spark, path)
    parts = [p for p in version.parts if only(p)] if version else []
    return versions.read_parts(spark, path, parts, version.schema) if parts else None


def read_log(spark: SparkSession, path: str, resolve: Resolve) -> DataFrame:
    """What the log resolves to."""
    rows = stored(spark, path)
    if rows is None:
        raise FileNotFoundError(f"{path} holds no batch")
    return resolve(rows).drop(BATCH, RUN)
