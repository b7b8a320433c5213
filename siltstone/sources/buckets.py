"""Tables stored by buckets of their key's hash, so that a merge rewrites few of them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.common import as_list
from siltstone.operators.windows import latest_per_key
from siltstone.sources import files, versions
from siltstone.sources.versions import Part

BUCKET = "_bucket"
BUCKETS = 64


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stored(df: DataFrame, path: str) -> list[Part]:
    """Write rows by bucket; one part per bucket that has rows."""
    folder = versions.write_part(df, path, [BUCKET])
    found = [re.fullmatch(f"{BUCKET}=(\\d+)", n) for n in files.names(df.sparkSession, f"{path}/{folder}")]
    return [Part(f"{folder}/{m[0]}", {BUCKET: int(m[1])}) for m in found if m]


def create(df: DataFrame, path: str, keys: str | Sequence[str], order_by: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Store the latest row per key in ``buckets`` buckets, in place of what the table held."""
    spark, keys, order_by = df.sparkSession, as_list(keys), as_list(order_by)
    dealt = df.withColumn(BUCKET, _bucket_of(keys, buckets)).repartition(buckets, BUCKET)
    parts = _stored(latest_per_key(dealt, [BUCKET, *keys], order_by), path)
    info = {"keys": keys, "order_by": order_by, "buckets": buckets}
    versions.change(spark, path, lambda base: (parts, df.schema, info))
    return versions.read(spark, path)


def touched(spark: SparkSession, path: str, updates: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """The stored rows in whose buckets :func:`merge` would put ``updates``, and the table's keys and order.

    Other buckets are not read. What comes to the driver is a number per bucket.
    """
    base = versions.latest(spark, path)
    if base is None or "buckets" not in base.info:
        raise FileNotFoundError(f"{path} is no bucketed table")
    keys, n = base.info["keys"], base.info["buckets"]
    known = {f.name: f.dataType for f in base.schema.fields}
    cast = updates.select(*[F.col(k).cast(known[k]).alias(k) for k in keys])
    found = {r[0] for r in cast.select(_bucket_of(keys, n)).distinct().collect()}
    parts = [p for p in base.parts if p.tags[BUCKET] in found]
    return versions.read_parts(spark, path, parts, base.schema), keys, base.info["order_by"]


def merge(spark: SparkSession, path: str, updates: DataFrame) -> DataFrame:
    """Merge rows into the table: per key the highest by the table's order stays, on equal order the update.

    The updates are stored by bucket first, which tells the buckets they touch;
    only these are read and written anew, in one shuffle by bucket. All others
    stay in the files they are in, and are not read. A column that the table
    lacks is added; keys and columns are cast to the table's types. If another
    writer changed the table in between, :class:`VersionConflict` tells so and
    nothing has changed.
    """
    base = versions.latest(spark, path)
    if base is None or "buckets" not in base.info:
        raise FileNotFoundError(f"{path} is no bucketed table")
    keys, order_by, buckets = base.info["keys"], base.info["order_by"], base.info["buckets"]
    known = {f.name: f.dataType for f in base.schema.fields}
    if missing := [c for c in keys if c not in updates.columns]:
        raise ValueError(f"the updates lack {missing}")
    cast = updates.select(*[F.col(c).cast(known[c]).alias(c) if c in known else F.col(c) for c in updates.columns])
    schema = base.schema
    for f in cast.schema.fields:
        if f.name not in known:
            schema = type(schema)([*schema.fields, f])
    order = [*order_by, F.desc("_new")]
    arrived = cast.withColumn(BUCKET, _bucket_of(keys, buckets)).repartition(BUCKET)
    incoming = _stored(latest_per_key(arrived, [BUCKET, *keys], [c for c in order_by if c in cast.columns] or keys), path)
    try:
        touched = {p.tags[BUCKET] for p in incoming}
        if not touched:
            return versions.read(spark, path)
        stays = [p for p in base.parts if p.tags[BUCKET] not in touched]
        stale = [p for p in base.parts if p.tags[BUCKET] in touched]
        both = versions.read_parts(spark, path, stale, schema).withColumn("_new", F.lit(0)).unionByName(
            versions.read_parts(spark, path, incoming, schema).withColumn("_new", F.lit(1)))
        dealt = both.withColumn(BUCKET, _bucket_of(keys, buckets)).repartition(len(touched), BUCKET)
        fresh = _stored(latest_per_key(dealt, [BUCKET, *keys], order).drop("_new"), path)
        versions.commit(spark, path, base, [*stays, *fresh], schema, base.info)
    finally:
        for folder in {p.folder.split("/")[0] for p in incoming}:
            files.remove(spark, f"{path}/{folder}")
    return versions.read(spark, path)
