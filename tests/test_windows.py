"""Window and skew operators against plain Python, with slices of several sizes."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import keys as key_ops
from siltstone.operators import skew, windows

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """One key holds a third of the rows; instants repeat, some are missing, one key is null."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        seconds = int(rng.expovariate(1 / 50_000))
        at = None if rng.random() < 0.02 else START + timedelta(seconds=seconds // 60 * 60)
        rows.append((i, key, at, rng.randint(0, 400)))
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz, v int")
    return rows, df.repartition(5).cache()


def previous_by_hand(rows):
    groups = defaultdict(list)
    for _, key, at, _ in rows:
        groups[key].append(at)
    out = Counter()
    for key, times in groups.items():
        times.sort(key=lambda t: (t is None, t))
        for before, at in zip([None, *times], times):
            out[key, at, before] += 1
    return out


@pytest.mark.parametrize("grain", [0.01, 1, 1e6, None])
def test_with_previous(events, grain):
    rows, df = events
    got = windows.with_previous(df, "k", "ts", "prev", grain).select("k", "ts", "prev").collect()
    assert Counter(tuple(r) for r in got) == previous_by_hand(rows)


@pytest.mark.parametrize("grain", [0.01, 1, 1e6, None])
def test_gap_counts(events, grain):
    rows, df = events
    wanted = Counter()
    for (key, at, before), n in previous_by_hand(rows).items():
        if before is not None:
            gap = None if at is None else (at - before) / timedelta(days=1)
            wanted[key, gap] += n
    got = Counter()
    for key, gap, n in windows.gap_counts(df, "k", "ts", grain=grain).collect():
        got[key, gap] += n
    assert got == wanted


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("grain", [1, 300, 1e6, None])
def test_exact_quantile(events, q, grain):
    rows, df = events
    groups = defaultdict(list)
    for _, key, _, v in rows:
        groups[key].append(v)
    got = {r[0]: r[1] for r in skew.exact_quantile(df, "k", "v", q, "p", grain=grain).collect()}
    assert got == {k: pytest.approx(np.quantile(v, q)) for k, v in groups.items()}


@pytest.mark.parametrize("grain", [1, 1e6, None])
def test_weighted_quantile_ignores_nulls(spark, grain):
    rows = [("x", float(i % 40), 1 + i % 7) for i in range(200)] + [("x", None, 50), ("y", None, 3)]
    df = spark.createDataFrame(rows, "k string, v double, n int")
    values = [v for _, v, n in rows if v is not None for _ in range(n)]
    got = skew.exact_quantile(df, "k", "v", 0.5, "m", "n", grain).filter("m is not null").collect()
    assert [tuple(r) for r in got] == [("x", np.median(values))]


@pytest.mark.parametrize("column, made", [
    ("double", "case when id % 50 = 0 then double('nan') when id % 7 = 0 then -pow(10, id % 30) "
               "when id = 1 then double('infinity') else pow(1.01, id) end"),
    ("timestamp_ntz", "timestamp_ntz '1969-12-30 12:00:00' + make_dt_interval(0, 0, id * 37)"),
    ("timestamp", "timestamp '1969-12-30 12:00:00' + make_dt_interval(0, 0, id * 37)"),
    ("string", "cast(timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, id * 37) as string)"),
    ("date", "date_add(date '2024-01-01', cast(id as int))"),
])
def test_slices_follow_the_order(spark, column, made):
    df = spark.range(400).select(F.expr(made).cast(column).alias("v"))
    rows = df.select("v", skew.slice_of(df, "v", 0.7).alias("s")).orderBy("v").collect()
    slices = [r["s"] for r in rows]
    assert slices == sorted(slices) and len(set(slices)) > 5
    assert df.select(F.lit(None).cast(column).alias("v")).select(skew.slice_of(df, "v")).first()[0] is None


@pytest.mark.parametrize("page_rows", [7, 100, 10_000])
@pytest.mark.parametrize("grain", [1, 300, 1e6, None])
def test_ranked_pages_keep_every_item_in_order(events, page_rows, grain):
    rows, df = events
    groups = defaultdict(list)
    for i, key, _, v in rows:
        groups[key].append((-v, i))
    got = windows.ranked_pages(
        df, "k", "v", F.col("id"), page_rows, ["id"], "ids", grain
    ).collect()
    listed = defaultdict(list)
    for key, page, ids in sorted(got, key=lambda r: r["page"]):
        assert len(ids) <= page_rows
        assert page == len(listed[key]) // page_rows
        listed[key] += ids
    assert listed == {k: [i for _, i in sorted(v)] for k, v in groups.items()}


def test_keys_without_any_time_or_with_one_instant(spark):
    rows = [("none", None, i) for i in range(50)] + [("same", START, i) for i in range(50)]
    rows += [("nan", START + timedelta(days=i % 3), i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    got = windows.with_previous(df, "k", "ts", "prev").select("k", "ts", "prev").collect()
    wanted = previous_by_hand([(v, k, at, v) for k, at, v in rows])
    assert Counter(tuple(r) for r in got) == wanted
    value = F.when(F.col("k") == "nan", F.lit(float("nan"))).otherwise(F.col("v").cast("double"))
    nulls = df.withColumn("x", F.when(F.col("k") != "none", value))
    found = {r["k"]: r["m"] for r in skew.exact_quantile(nulls, "k", "x", 0.5, "m").collect()}
    assert set(found) == {"same", "nan"}
    assert found["same"] == 24.5 and np.isnan(found["nan"])


def test_one_key_a_third_null_a_third_tied(spark):
    """Copies of one row, rows tied in time and rows without time, all of one key."""
    rows = [("hot", None if i % 3 == 0 else START if i % 3 == 1 else START + timedelta(minutes=i), i // 9)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int").repartition(7)
    got = windows.with_previous(df, "k", "ts", "prev").collect()
    assert Counter((r["k"], r["ts"], r["v"]) for r in got) == Counter(rows)
    wanted = previous_by_hand([(v, k, at, v) for k, at, v in rows])
    assert Counter((r["k"], r["ts"], r["prev"]) for r in got) == wanted
    nulls = df.withColumn("x", F.when(F.col("ts").isNotNull(), F.least("v", F.lit(100))))
    held = sorted(min(v, 100) for _, at, v in rows if at is not None)
    assert skew.exact_quantile(nulls, "k", "x", 0.3, "m").first()["m"] == pytest.approx(np.quantile(held, 0.3))
    assert windows.cap_per_key(df, "k", 1234, ["ts"]).count() == 1234


def test_latest_per_key(spark, values):
    df = spark.createDataFrame(
        [("r", "v1", "2024-01-01", 1), ("r", "v1", "2024-02-01", 2), ("r", "v1", None, 3),
         ("r", "v2", "2024-01-01", 4), ("r", "v2", "2024-01-01", 5), (None, "v1", None, 6)],
        "repo string, tag string, at string, id int",
    )
    got = values(windows.latest_per_key(df, ["repo", "tag"], "at"), "id")
    assert got == [(2,), (5,), (6,)]
    ranked = windows.latest_per_key(df, ["repo", "tag"], "at", rank_col="row_num")
    assert {r["row_num"] for r in ranked.collect()} == {1}


def test_latest_is_cut_before_the_shuffle(spark):
    df = windows.latest_per_key(spark.range(100).withColumn("k", F.col("id") % 3), "k", "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("cap", [1, 5, 10, 2000])
def test_cap_per_key(spark, events, cap):
    rows, df = events
    sizes = Counter(r[1] for r in rows)
    got = windows.cap_per_key(df, "k", cap, ["v", "id"]).collect()
    assert Counter(r["k"] for r in got) == {k: min(cap, n) for k, n in sizes.items()}
    best = defaultdict(list)
    for i, key, _, v in rows:
        best[key].append((-v, -i))
    wanted = {(k, -i) for k, pairs in best.items() for _, i in sorted(pairs)[:cap]}
    assert {(r["k"], r["id"]) for r in got} == wanted


def test_cap_edge_values(events):
    rows, df = events
    assert windows.cap_per_key(df, "k", None, "v").count() == len(rows)
    assert windows.cap_per_key(df, "k", 0, "v").count() == 0
    with pytest.raises(ValueError):
        windows.cap_per_key(df, "k", -1, "v")


def test_top_keys_break_ties_by_key(spark, values):
    df = spark.createDataFrame([(k,) for k in "ccbbaad"], "k string")
    assert values(key_ops.top_keys(df, "k", 2)) == [("a",), ("b",)]
    groups = key_ops.pinned_or_top(df, "k", 2, "d", "pin", "top")
    assert values(groups) == [("a", "top"), ("b", "top"), ("d", "pin")]
    # A pinned key within the top takes one of its places.
    assert values(key_ops.pinned_or_top(df, "k", 2, "a", "pin", "top")) == [("a", "pin"), ("b", "top")]
    assert values(key_ops.only_keys(df, groups, "k", "key_group")).count(("a", "top")) == 2


@pytest.mark.parametrize("pinned", ["a", "b", "d", "zz"])
def test_pick_keys_agrees_with_pinned_or_top(spark, pinned):
    df = spark.createDataFrame([(k,) for k in [*"ccbbaad", None, None, None]], "k string")
    lazy = {r["k"] for r in key_ops.only_keys(df, key_ops.pinned_or_top(df, "k", 2, pinned), "k").collect()}
    assert {r["k"] for r in key_ops.pick_keys(df, "k", 2, pinned)} == lazy


CLOSE = "1e9 + id * 1e-6"


@pytest.mark.parametrize("value", ["5", "cast(null as double)", CLOSE, "if(id % 2 = 0, null, 7)"])
def test_tied_missing_and_close_values_are_dealt_to_many_tasks(spark, value):
    """One key holds all rows; no slice holds more than twice its part, and places are those of a plain order."""
    n, parts = 40_000, 20
    df = spark.range(0, n, 1, 6).select(F.lit("k").alias("k"), "id", F.expr(f"cast({value} as double)").alias("v"))
    order = ["k", F.col("v").desc_nulls_last(), F.col("id").desc()]
    held = skew.even_slices(df, order, slices=parts).groupBy(skew.SLICE).count().collect()
    assert len(held) >= parts - 2 and max(r["count"] for r in held) <= 2 * n / parts
    rows = df.select("id", "v").collect()
    best = sorted(rows, key=lambda r: (r.v is None, -(r.v or 0), -r.id))
    got = skew.with_place(df, "k", "v", [F.col("id").desc()], grain=None).collect()
    assert {r.id: r.place for r in got} == {r.id: i for i, r in enumerate(best)}
    capped = windows.cap_per_key(df, "k", 777, ["v", "id"], grain=None).collect()
    assert {r.id for r in capped} == {r.id for r in best[:777]}


def test_even_slices_of_equal_rows_and_no_rows(spark):
    same = spark.range(0, 900, 1, 5).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    assert sorted(r.place for r in skew.with_place(same, "k", "v", grain=None).collect()) == list(range(900))
    assert skew.with_place(same.limit(0), "k", "v", grain=None).count() == 0
    assert skew.exact_quantile(same, "k", "v", 0.5, "m", grain=None).first()["m"] == 1.0
    assert skew.exact_quantile(same.limit(0), "k", "v", 0.5, "m", grain=None).count() == 0
