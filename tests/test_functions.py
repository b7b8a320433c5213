from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone import functions as fn
from siltstone import rules

TITLES = {
    "Fix bug in authentication": ("bug fix", "bug fix", "bug_fix"),
    "Add new dashboard feature": ("feature", "feature", "feature"),
    "Refactor user service": ("refactor", "refactor", "refactor"),
    "Add unit tests for wallet": ("feature", "test", "feature"),
    "Update API documentation": ("documentation", "documentation", "documentation"),
    "Random change": ("not clear", "not clear", "other"),
    "Implement login": ("feature", "feature", "other"),
    "Cleanup": ("refactor", "refactor", "other"),
}


def one(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_title_rule_sets(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "title string")
    text = fn.lowered_text("title")
    rows = df.select(
        "title",
        fn.label_ladder(text, rules.PR_TITLE_RULES, rules.PR_TITLE_DEFAULT),
        fn.label_ladder(text, rules.PR_TITLE_TEST_FIRST_RULES, rules.PR_TITLE_DEFAULT),
        fn.label_ladder(text, rules.PR_TITLE_SHORT_RULES, rules.PR_TITLE_SHORT_DEFAULT),
    ).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == TITLES


def test_null_title_takes_the_default(spark):
    label = fn.label_ladder(F.lit(None).cast("string"), rules.PR_TITLE_RULES, "not clear")
    assert one(spark, label) == "not clear"


def test_terms_match_inside_words_unless_bounded(spark):
    text = F.lit("update the address prefix")
    assert one(spark, fn.matches_any(text, ["add"])) is True
    assert one(spark, fn.matches_any(text, ["add"], word_boundary=True)) is False
    assert one(spark, fn.matches_any(text, ["address"], word_boundary=True)) is True
    assert one(spark, fn.matches_any(text, [])) is False


@pytest.mark.parametrize("title,solution,expected", [
    ("A", "B", "a b"), ("A", None, "a "), (None, "B", None),
])
def test_lowered_text_nulls(spark, title, solution, expected):
    df = spark.createDataFrame([(title, solution)], "t string, s string")
    assert df.select(fn.lowered_text("t", "s")).first()[0] == expected


@pytest.mark.parametrize("links,expected", [
    (("https://github.com/Org/r.git?x=1#y/tree", None, None), "org/r.git?x=1#y"),
    (("https://github.com/org", "https://github.com/a/b", None), ""),
    (("https://example.org", "see github.com/A/B", "github.com/c/d"), "a/b"),
    ((None, None, "http://github.com/c/d/issues/1"), "c/d"),
    (("https://example.org", None, None), None),
    ((None, None, None), None),
])
def test_link_key(spark, links, expected):
    df = spark.createDataFrame([links], "a string, b string, c string")
    key = fn.link_key(["a", "b", "c"], rules.CODE_HOST, rules.REPO_KEY_PATTERN)
    assert df.select(key).first()[0] == expected
    holds = df.select(fn.any_contains(["a", "b", "c"], rules.CODE_HOST)).first()[0]
    assert holds is (expected is not None)


def test_tokens_keep_blanks_unless_trimmed(spark):
    tags = F.lit("[DeFi, Developer Tools]")
    assert one(spark, fn.has_token(tags, "DeFi")) is True
    assert one(spark, fn.has_token(tags, "Developer Tools")) is False
    assert one(spark, fn.has_token(tags, "Developer Tools", trim=True)) is True
    array = F.array(F.lit("DeFi"), F.lit("Developer Tools"))
    assert one(spark, fn.has_token(array, "Developer Tools", is_array=True)) is True


def test_nested_uris_and_repository_parts(spark):
    uris = F.array(F.array(F.lit("x")), F.array(F.lit("https://github.com/a/b")))
    assert one(spark, fn.nested_contains(uris, "github.com")) is True
    assert one(spark, fn.nested_contains(uris, "gitlab")) is False
    assert one(spark, fn.nested_contains(F.lit(None).cast("array<array<string>>"), "x")) is False
    assert one(spark, fn.repo_owner(F.lit("a/b"))) == "a"
    assert one(spark, fn.repo_name(F.lit("a/b"))) == "b"


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
    ("2024-01-01T00:00:00.5", datetime(2024, 1, 1, 0, 0, 0, 500000)),
    ("2024-01-01T00:00:00+02:00", datetime(2023, 12, 31, 22)),
    ("2024-01-01", datetime(2024, 1, 1)),
    ("yesterday", None),
    (None, None),
])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_ts(spark, text, expected, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(fn.parse_ts("t")).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_month_and_day_difference_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [("2024-03-01 00:00:00", "2024-04-01 06:00:00")], "a string, b string"
        ).select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
        row = df.select(fn.month_of("b"), fn.days_between("a", "b")).first()
        assert row[0] == datetime(2024, 4, 1)
        assert row[1] == 31.25
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_guarded_arithmetic(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, fn.pct(F.lit(1), F.lit(16))) == 6.3
    assert one(spark, fn.vote_total(F.lit(1), F.lit(None).cast("int"), F.lit(2))) is None
    assert one(spark, fn.approval_rate(F.lit(0), F.lit(0))) is None
    assert one(spark, fn.approval_rate(F.lit(3), F.lit(4))) == 0.75
