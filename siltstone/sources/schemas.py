"""Declared schemas of the raw resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, TEXT, REAL, BOOL = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Field names and types as the exports have them.
FUNDS = _struct(
    id=LONG, title=TEXT, status=TEXT, amount=LONG, proposals_count=LONG, currency=TEXT,
    currency_symbol=TEXT, launch_date=TEXT, link=TEXT, thumbnail_url=TEXT, slug=TEXT,
    content=TEXT, label=TEXT, funded_proposals=LONG,
)

PROPOSALS = _struct(
    id=LONG, user_id=LONG, fund_id=LONG, fund_name=TEXT, campaign_id=LONG, campaign_name=TEXT,
    ideascale_id=LONG, title=TEXT, website=TEXT, ideascale_link=TEXT, ideascale_user=TEXT,
    problem=TEXT, solution=TEXT, experience=TEXT, link=TEXT, amount_requested=LONG,
    amount_received=LONG, currency=TEXT, currency_symbol=TEXT, project_status=TEXT,
    funding_status=TEXT, type=TEXT, average_rating=REAL, ca_rating=REAL, ranking_total=LONG,
    yes_votes_count=LONG, no_votes_count=LONG, abstain_votes_count=LONG, unique_wallets=LONG,
    has_github=BOOL, github_links=T.ArrayType(TEXT), categories=T.ArrayType(TEXT),
    primary_category=TEXT, embedded_uris=T.ArrayType(T.ArrayType(TEXT)),
)

REPOSITORIES = _struct(
    id=LONG, name=TEXT, full_name=TEXT, stargazers_count=LONG, forks_count=LONG, created_at=TEXT,
    updated_at=TEXT,
)

PULL_REQUESTS = _struct(
    id=LONG, number=LONG, title=TEXT, body=TEXT, state=TEXT, user=_struct(login=TEXT),
    base=_struct(ref=TEXT), head=_struct(ref=TEXT), labels=T.ArrayType(_struct(name=TEXT)),
    html_url=TEXT, additions=LONG, deletions=LONG, changed_files=LONG, commits=LONG,
    created_at=TEXT, updated_at=TEXT, closed_at=TEXT, merged_at=TEXT,
)

RELEASES = _struct(
    id=LONG, tag_name=TEXT, name=TEXT, body=TEXT, draft=BOOL, prerelease=BOOL,
    author=_struct(login=TEXT), html_url=TEXT, published_at=TEXT, created_at=TEXT,
    updated_at=TEXT,
)

ISSUES = _struct(
    id=LONG, number=LONG, title=TEXT, body=TEXT, state=TEXT, user=_struct(login=TEXT),
    pull_request=_struct(url=TEXT), html_url=TEXT, created_at=TEXT, updated_at=TEXT,
    closed_at=TEXT,
)

SEED_REPO_MAP = _struct(
    project_id=TEXT, repo_key=TEXT,
)
SEED_REPOSITORIES = _struct(
    repository_full_name=TEXT, project_name=TEXT, project_type=TEXT, organization=TEXT,
)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """``df`` with every column of ``schema``: cast where present, null where missing."""
    present = {f.name: f.dataType for f in df.schema.fields}

    def wanted(field: T.StructField) -> Column:
        if present.get(field.name) == field.dataType:
            return F.col(field.name)
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    extra = [c for c in present if c not in schema.fieldNames()] if keep_extra else []
    return df.select(*[wanted(f) for f in schema.fields], *extra)
