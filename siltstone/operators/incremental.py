"""Incremental loads: upsert, freshness, watermarks, state and run records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.common import as_list, as_time, join_on, ts_lit
from siltstone.operators.windows import latest_per_key


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str | Column],
) -> DataFrame:
    """All keys of both sides, one row each, the highest by ``order_by``.

    Works for any inputs, also a base that is not unique yet; a column missing
    on one side is null there. On equal order the update wins.
    """
    order_by = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    both = base.withColumn("_is_update", F.lit(0)).unionByName(
        updates.withColumn("_is_update", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, keys, [*order_by, F.desc("_is_update")]).drop("_is_update")


# 1 for rows that a merge puts into a table, -1 for those it takes out.
SIGN = "_sign"


def _paired(base: DataFrame, latest: DataFrame, keys: Sequence[str], order_by: Sequence[str], how: str) -> tuple[DataFrame, Column]:
    """Rows of ``latest`` beside the row of ``base`` with their key, and whether they win against it.

    Columns bear the prefixes _new_ and _old_; _in_updates and _in_base tell which sides there are.
    """
    old = base.select(*[F.col(c).alias(f"_old_{c}") for c in base.columns], F.lit(True).alias("_in_base"))
    new = latest.select(*[F.col(c).alias(f"_new_{c}") for c in latest.columns], F.lit(True).alias("_in_updates"))
    same = reduce(Column.__and__, [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    # Nulls are least among the fields of a struct, as they come last in a descending order.
    ours = F.struct(*[_side(c, latest, "_new_") for c in order_by])
    theirs = F.struct(*[_side(c, base, "_old_") for c in order_by])
    wins = F.col("_in_updates").isNotNull() & (F.col("_in_base").isNull() | (ours >= theirs))
    return old.join(new, same, how), wins


def _side(name: str, df: DataFrame, prefix: str) -> Column:
    return F.col(f"{prefix}{name}") if name in df.columns else F.lit(None)


def _latest(updates: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return latest_per_key(updates, keys, [c for c in order_by if c in updates.columns] or keys)


def merge_into(
    base: DataFrame, updates: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]
) -> DataFrame:
    """:func:`upsert` for a base that already has one row per key.

    The base is read once and not ranked: each of its rows meets at most one
    update. A stored base that is large beside the updates belongs in
    :mod:`siltstone.sources.buckets`, whose merge reads only what they touch.
    """
    keys, order_by = as_list(keys), as_list(order_by)
    latest = _latest(updates, keys, order_by)
    both, wins = _paired(base, latest, keys, order_by, "full_outer")
    columns = [*base.columns, *[c for c in latest.columns if c not in base.columns]]
    return both.select(*[
        F.when(wins, _side(c, latest, "_new_")).otherwise(_side(c, base, "_old_")).alias(c) for c in columns])


def signed_changes(
    base: DataFrame, updates: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]
) -> DataFrame:
    """The rows that :func:`merge_into` takes out of ``base`` (SIGN -1) and puts in (1), in the columns of ``base``.

    An update that loses against the row there gives none. One that equals it gives
    both, which cancel in any sum.
    """
    keys, order_by = as_list(keys), as_list(order_by)
    latest = _latest(updates, keys, order_by)
    both, wins = _paired(base, latest, keys, order_by, "right_outer")
    kinds = {f.name: f.dataType for f in base.schema.fields}
    put = F.struct(F.lit(1).alias(SIGN), *[_side(c, latest, "_new_").cast(t).alias(c) for c, t in kinds.items()])
    out = F.struct(F.lit(-1).alias(SIGN), *[F.col(f"_old_{c}").alias(c) for c in kinds])
    rows = F.array_compact(F.array(put, F.when(F.col("_in_base").isNotNull(), out)))
    return both.filter(wins).select(F.explode(rows).alias("_row")).select("_row.*")


def first_available_max(
    df: DataFrame, key: str | Sequence[str], columns: Sequence[str], out: str = "last_updated"
) -> DataFrame:
    """Per key, the maximum of the first of ``columns`` that exists and holds a value."""
    keys = as_list(key)
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.select(*keys).distinct().withColumn(out, F.lit(None).cast("timestamp_ntz"))
    latest = F.coalesce(*[F.max(as_time(df, c)) for c in present])
    return df.groupBy(*keys).agg(latest.alias(out))


def freshness(
    df: DataFrame,
    key: str | Sequence[str],
    ts_columns: Sequence[str],
    now: datetime,
    days: float = 7,
    inclusive: bool = False,
) -> DataFrame:
    """(key, last_updated, is_fresh); no time at all means stale.

    A key is fresh when its last update is younger than ``days`` (``inclusive``:
    or exactly that old).
    """
    cutoff = ts_lit(now - timedelta(days=days))
    last = F.col("last_updated")
    test = last >= cutoff if inclusive else last > cutoff
    return first_available_max(df, key, ts_columns).withColumn(
        "is_fresh", F.coalesce(test, F.lit(False))
    )


def stale_keys(
    keys: DataFrame, fresh: DataFrame, key: str | Sequence[str], force: bool = False
) -> DataFrame:
    """The keys to load: all with ``force``, else those not marked fresh."""
    if force:
        return keys
    names = as_list(key)
    return join_on(keys, fresh.filter("is_fresh").select(*names), names, "left_anti")


def watermark(
    df: DataFrame, key: str | Sequence[str], ts: str, out: str = "high_mark"
) -> DataFrame:
    """Highest ``ts`` per key."""
    return df.groupBy(*as_list(key)).agg(F.max(as_time(df, ts)).alias(out))


def since(
    df: DataFrame, marks: DataFrame, key: str | Sequence[str], ts: str, mark: str = "high_mark"
) -> DataFrame:
    """Rows newer than their key's mark; a key without mark keeps all its rows.

    ``ts`` must be the column the marks were taken from. Rows without a time
    pass: nothing says that they were seen.
    """
    newer = F.col(mark).isNull() | as_time(df, ts).isNull() | (as_time(df, ts) > F.col(mark))
    return join_on(df, marks, as_list(key), "left").filter(newer).drop(mark)


def state_rows(
    landed: DataFrame,
    table: str,
    now: datetime,
    key: str | None = None,
    environment: str = "prod",
    metadata: Mapping[str, object] | None = None,
) -> DataFrame:
    """One state row per key that really landed (or one for the table, if anything did)."""
    if key:
        found = landed.groupBy(F.col(key).alias("repository_name")).agg(
            F.count(F.lit(1)).alias("_rows")
        )
        name = F.concat_ws("#", F.lit(table), "repository_name")
    else:
        found = landed.agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 0").withColumn(
            "repository_name", F.lit(None).cast("string")
        )
        name = F.lit(table)
    extra = [F.lit(v).alias(k) for k, v in (metadata or {}).items()]
    return found.select(
        name.alias("pipeline_state_id"),
        F.lit(now.isoformat() + "+00:00").alias("last_updated"),
        F.lit(table).alias("table_name"),
        F.lit(environment).alias("environment"),
        F.col("repository_name").cast("string"),
        *extra,
    )


def update_state(state: DataFrame, new_rows: DataFrame) -> DataFrame:
    """State with one row per ``pipeline_state_id``, the newest."""
    return upsert(state, new_rows, "pipeline_state_id", "last_updated")


def run_manifest(
    landed: DataFrame,
    source: str,
    pipeline: str,
    now: datetime,
    environment: str = "prod",
    detail: Mapping[str, object] | None = None,
) -> DataFrame:
    """The record of one finished load with its row count, to append to the manifest table."""
    return landed.agg(F.count(F.lit(1)).alias("rows_landed")).select(
        F.lit(source).alias("source"),
        F.lit("ingestion.complete").alias("detail_type"),
        F.lit(environment).alias("env"),
        F.lit(pipeline).alias("pipeline"),
        F.lit(now.isoformat()).alias("timestamp"),
        "rows_landed",
        *[F.lit(v).alias(k) for k, v in (detail or {}).items()],
    )
