"""Contiguous shards of nearly equal bytes, by prefix sums over a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import save

OVERHEAD = 16
SHARDS = 40
# A group of equal order keys up to this part of a shard's target is not cut.
WHOLE = 0.05


def byte_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def shard_by_bytes(
    rows: DataFrame, size: str, order: list[str], n_shards: int = SHARDS, group: str | None = None, whole: float = WHOLE
) -> DataFrame:
    """Add shard (0 .. n_shards - 1) and slot (0, 1, .. within the shard) to ``rows``.

    The rows are dealt to range partitions in ``order``; ties, such as repeated
    rows, stand in any order, which changes nothing but which of two equal rows
    comes first. Each partition's bytes are summed, the sums of the partitions
    before it are its offset, and a row's shard is the one whose target range
    holds the byte at which the row starts: shard = offset * n_shards / total.
    With ``group``, the leading order column, rows of one group follow the
    start of their group if the group is small (``whole`` times the target at
    most); larger groups are cut like all else. A shard exceeds its target by
    the larger of one row and such a group at most. Rows are never gathered: a
    group with any part of all rows lies over many partitions. An empty table
    gives none. Existing columns shard and slot are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # The range cuts come from a sample and would differ on a second run.
    dealt = rows.drop("shard", "slot").repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    dealt = save(dealt, "dealt")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = dealt.withColumn("_start", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    totals = dealt.groupBy("_part").agg(F.sum(size).alias("_bytes"))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_before"),
        F.sum("_bytes").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"))
    placed = start.join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_before") + F.col("_start"))
    if group:
        bounds = placed.groupBy(F.col(group).alias("_group")).agg(
            F.min("_at").alias("_first"), F.sum(size).alias("_all"), F.count(F.lit(1)).alias("_rows"))
        bounds = bounds.filter("_rows > 1").drop("_rows")
        placed = placed.join(bounds, placed[group].eqNullSafe(bounds["_group"]), "left")
        small = F.col("_all") * n_shards <= F.col("_total") * F.lit(whole)
        placed = placed.withColumn("_cut", F.when(small, F.col("_first")).otherwise(F.col("_at")))
    else:
        placed = placed.withColumn("_cut", F.col("_at"))
    placed = placed.withColumn("shard", F.least(
        F.floor(F.col("_cut").cast("decimal(38,0)") * n_shards / F.col("_total")).cast("int"), F.lit(n_shards - 1)))
    placed = save(placed.select(*dealt.columns, "shard"), "placed")
    # Slots by the same scheme: rows per partition and shard, and those before.
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("shard", "_part").orderBy(*order)
    numbered = placed.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(F.broadcast(counts), ["shard", "_part"]).select(
        *[c for c in dealt.columns if c != "_part"], "shard", (F.col("_ahead") + F.col("_own")).cast("long").alias("slot"))


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS, more: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (and columns ``more``) of every row.

    The order is by a hash of the text, then by id, so equal texts are
    neighbours and stay together unless there are too many. Null texts weigh
    their overhead only and have a null checksum.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), byte_size(text_col).alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("_key"), *more)
    return shard_by_bytes(rows, "size", ["_key", "doc_id"], n_shards, "_key").drop("_key")
