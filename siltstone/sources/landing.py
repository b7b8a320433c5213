"""API exports landed as JSON, read with declared schemas.

Layout of a landing folder: ``<landing>/<resource>/`` holds JSON lines. The two
governance resources keep the API's responses (a list, or an object with
``data``, ``links`` and the requested ``page``); the code-host resources hold
one object per line under ``repository_full_name=<owner%2Frepo>/``, so a
selection of repositories prunes folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.common import as_time
from siltstone.operators.incremental import since
from siltstone.operators.ranges import outside
from siltstone.operators.windows import cap_per_key
from siltstone.rules import LIMITS
from siltstone.sources import schemas

REPOSITORY = "repository_full_name"


def unwrap(df: DataFrame, item: T.StructType, field: str = "data") -> DataFrame:
    """Rows of an envelope: the objects in ``field``, or the object itself if it came bare.

    ``df`` was read with :func:`envelope`. An object with neither gives no rows;
    columns outside ``item`` are kept.
    """
    outer = [c for c in df.columns if c not in (field, "links", *item.fieldNames())]
    bare = F.struct(*[F.col(f.name) for f in item.fields])
    first = item.fields[0].name
    rows = F.when(F.col(field).isNotNull(), F.col(field)).when(
        F.col(first).isNotNull(), F.array(bare)
    )
    return df.select(*outer, F.inline(rows))


def envelope(item: T.StructType, field: str = "data") -> T.StructType:
    """Read schema that fits both forms of a response."""
    return T.StructType([
        *item.fields,
        T.StructField(field, T.ArrayType(item)),
        T.StructField("links", T.StructType([T.StructField("next", T.StringType())])),
        T.StructField("page", T.IntegerType()),
    ])


def stamp(df: DataFrame, now: datetime, column: str = "fetched_at", **literals: str) -> DataFrame:
    """Add the load time as ISO text, and constant columns."""
    return df.withColumns({
        column: F.lit(now.isoformat()), **{k: F.lit(v) for k, v in literals.items()}
    })


def flatten_struct(df: DataFrame, sep: str = "__") -> DataFrame:
    """Nested objects as flat columns ``outer__inner``, to any depth."""
    def leaves(field: T.StructField, path: Column, name: str) -> list[Column]:
        if not isinstance(field.dataType, T.StructType):
            return [path.alias(name)]
        return [
            leaf for f in field.dataType.fields
            for leaf in leaves(f, path[f.name], f"{name}{sep}{f.name}")
        ]

    return df.select(*[
        leaf for f in df.schema.fields for leaf in leaves(f, F.col(f"`{f.name}`"), f.name)
    ])


def limits(environment: str) -> dict[str, int | None]:
    """Row and page caps of an environment: ``sample``, ``dev`` or ``prod`` (none)."""
    return dict(LIMITS[environment])


def read_funds(spark: SparkSession, landing: str, now: datetime) -> DataFrame:
    raw = spark.read.schema(envelope(schemas.FUNDS)).json(f"{landing}/funds")
    return stamp(unwrap(raw, schemas.FUNDS).drop("page"), now, "ingested_at")


def read_proposals(
    spark: SparkSession,
    landing: str,
    now: datetime,
    fund_id: int | None = None,
    max_pages: int | None = None,
    until_end: bool = False,
) -> DataFrame:
    """Proposals of all landed pages; the API's client lands nothing behind the end of a crawl.

    ``until_end`` cuts a landing of one single crawl at its first page that is
    empty or names no next page, which takes a scan of its own. Never use it on
    a folder that holds several crawls: the shortest would cut the others.
    """
    raw = spark.read.schema(envelope(schemas.PROPOSALS)).json(f"{landing}/proposals")
    # A bare list has no page number and no links: it is the whole answer.
    pages = raw
    if until_end:
        ends = F.col("data").isNotNull() & (
            (F.size("data") == 0) | F.col("links.next").isNull()
        )
        last = raw.filter(ends).agg(F.min("page").alias("page"))
        pages = raw.filter(
            F.col("page").isNull() | last.scalar().isNull() | (F.col("page") <= last.scalar())
        )
    if max_pages is not None:
        pages = pages.filter(F.col("page").isNull() | (F.col("page") <= max_pages))
    rows = unwrap(pages, schemas.PROPOSALS)
    if fund_id is not None:
        rows = rows.filter(F.col("fund_id") == fund_id)
    return stamp(rows, now, "ingested_at")


def _read_per_repository(
    spark: SparkSession, path: str, schema: T.StructType, repos: Sequence[str] | None
) -> DataFrame:
    declared = T.StructType([*schema.fields, T.StructField(REPOSITORY, T.StringType())])
    df = spark.read.schema(declared).json(path)
    return df if repos is None else df.filter(F.col(REPOSITORY).isin(list(repos)))


def read_repositories(
    spark: SparkSession, landing: str, now: datetime, repos: Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.schema(schemas.REPOSITORIES).json(f"{landing}/repositories")
    if repos is not None:
        df = df.filter(F.col("full_name").isin(list(repos)))
    return stamp(df, now)


def _activity(
    df: DataFrame, now: datetime, marks: DataFrame | None, ts: str, n: int | None, loaded: DataFrame | None = None
) -> DataFrame:
    if marks is not None:
        df = since(df, marks, REPOSITORY, ts)
    if loaded is not None:
        df = outside(df, loaded, REPOSITORY, ts, "id")
    # By the parsed time and the id, as loaded ranges have it.
    capped = cap_per_key(df.withColumn("_at", as_time(df, ts)), REPOSITORY, n, ["_at", "id"]).drop("_at")
    return stamp(capped, now)


def read_pull_requests(
    spark: SparkSession,
    landing: str,
    now: datetime,
    repos: Sequence[str] | None = None,
    state: str = "all",
    max_per_repo: int | None = None,
    marks: DataFrame | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Pull requests, newest update first under a cap, newer than ``marks`` or in no range of ``loaded`` if given."""
    df = _read_per_repository(spark, f"{landing}/pull_requests", schemas.PULL_REQUESTS, repos)
    if state != "all":
        df = df.filter(F.col("state") == state)
    return _activity(df, now, marks, "updated_at", max_per_repo, loaded)


def read_releases(
    spark: SparkSession,
    landing: str,
    now: datetime,
    repos: Sequence[str] | None = None,
    max_per_repo: int | None = None,
    marks: DataFrame | None = None,
    ts: str = "published_at",
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Releases; ``ts`` orders the cap and must be the column of ``marks`` or ``loaded``."""
    df = _read_per_repository(spark, f"{landing}/releases", schemas.RELEASES, repos)
    return _activity(df, now, marks, ts, max_per_repo, loaded)


def read_issues(
    spark: SparkSession,
    landing: str,
    now: datetime,
    repos: Sequence[str] | None = None,
    state: str = "all",
    max_per_repo: int | None = None,
) -> DataFrame:
    """Issues without the pull requests the API lists among them."""
    df = _read_per_repository(spark, f"{landing}/issues", schemas.ISSUES, repos)
    df = df.filter(F.col("pull_request").isNull())
    if state != "all":
        df = df.filter(F.col("state") == state)
    return _activity(df, now, None, "updated_at", max_per_repo)
