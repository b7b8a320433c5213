"""Graph search against all pairs: recall, exact scores, ties and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import neighbours as nb
from siltstone.llm.oracle import ORACLE
from siltstone.llm.queries import QUERIES
from testbed.check import connect

SF = "/root/testdata/sf0.1"


def product(q, v):
    total = 0.0  # term by term: sum() would correct what rounding loses
    for a, b in zip(q, v):
        total += a * b
    return total


def all_pairs(rows, is_query, k=20):
    """{(query_id, vector): [(vec_id, score)]} of (vec_id, vector) rows."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None
                   and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, q in good:
        if is_query(i):
            found = [(-product(q, v), j) for j, v in good if j != i]
            out[i, q] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(a)] for q, a in out.items() if [r for r, _, _ in sorted(a)] == list(range(1, len(a) + 1))}


def test_query_equals_sql(spark):
    small = "/root/testdata/sf0.001"
    relation = connect(small).sql(ORACLE["op12_neighbours"])
    got = QUERIES["op12_neighbours"](spark, small).select(*relation.columns)
    assert sorted(map(tuple, got.collect())) == sorted(relation.fetchall())


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    told = answers(QUERIES["op12_neighbours"](spark, SF))
    assert sorted(told) == sorted(ids[ids % 20 == 0])
    hits = 0
    for q, found in told.items():
        scores = x @ x[ids == q][0]
        best = ids[np.lexsort((ids, np.where(ids == q, np.inf, -scores)))[:20]]
        hits += len({i for i, _ in found} & set(best.tolist()))
        by_id = dict(zip(ids.tolist(), scores))
        assert len(found) == 20 and all(s == pytest.approx(by_id[i], abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits >= 0.99 * 20 * len(told)


def test_copies_ties_and_lengths(spark):
    # A third of the rows are equal, lengths differ by far, one vector is very long, one row stands twice.
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 1, (900, 6)) * rng.choice([0.1, 1, 5], (900, 1)), 1)
    x[::3], x[1] = x[0], [3000.0, -2000.0, 0.0, 0.0, 1.0, 0.0]
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(900), x)]
    rows += [rows[10], (20, [9.0] * 6)]  # and an id with two vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = all_pairs(rows, lambda i: i % 20 == 0)
    got = {}
    for r in nb.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add((r.vec_id, r.score))
    assert set(got) == {i for i, _ in want}
    true = {}
    for (i, _), found in want.items():
        true.setdefault(i, set()).update(found)
    assert sum(len(got[i] & true[i]) for i in true) >= 0.98 * sum(map(len, true.values()))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, -0.0]), (2, [2.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, [None, 1.0]), (7, [0.0, 0.0]), (None, [9.0, 9.0]), (8, [-1.0, 0.0]), (0, [1.0, 0.0]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", F.lit(1).alias("rank"), F.lit(2.0).alias("score"), F.lit("k").alias("key"), F.lit(0).alias("shard"))
    told = answers(nb.nearest(df, F.col("vec_id") % 20 == 0))
    assert told == {0: [(1, 2.0), (2, 2.0), (20, 0.5), (8, -1.0)], 20: [(1, 1.0), (2, 1.0), (0, 0.5), (8, -0.5)]}
    assert answers(nb.nearest(df, F.col("vec_id") % 20 == 0, k=1)) == {0: [(1, 2.0)], 20: [(1, 1.0)]}
    assert nb.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nb.nearest(df.filter("vec_id = 0"), F.lit(True)).count() == 0
    with pytest.raises(Exception, match="unequal length"):
        nb.nearest(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"), F.lit(True)).count()


def test_graph_has_bounded_diverse_edges():
    rng = np.random.default_rng(2)
    x = nb.lengthened(rng.normal(0, 1, (1500, 12)), 9.0)
    edges, entry = nb.build_graph(x, degree=16)
    assert edges.shape == (1500, 16) and len(entry) == nb.ENTRY_NODES
    for i, row in enumerate(edges):
        some = row[row >= 0]
        assert len(some) and len(set(some)) == len(some) and i not in some and some.max() < 1500
    again, _ = nb.build_graph(x, degree=16)
    assert (again == edges).all()
    # From the pruning rule: no edge is much nearer to an earlier edge's target than to its node.
    own = np.arange(40, dtype=np.int32)
    some = nb.prune(x, own, np.broadcast_to(np.arange(1500, dtype=np.int32), (40, 1500)), 16, 1.2)
    for i, row in zip(own, some):
        row = row[row >= 0]
        d = ((x[row] - x[i]) ** 2).sum(1)
        assert (np.diff(d) >= -1e-4).all()
        for j in range(len(row)):
            for e in row[:j]:
                assert 1.44 * ((x[row[j]] - x[e]) ** 2).sum() > d[j] - 1e-3


def test_shards_are_bounded(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(0, 1, (1200, 5)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    graph, longest = nb.build_index(df, shard_nodes=200)
    sizes = [r["count"] for r in graph.groupBy("shard").count().collect()]
    assert len(sizes) == 6 and sum(sizes) == 1200 and max(sizes) < 280
    told = answers(nb.nearest(df, F.col("vec_id") % 20 == 0, index=(graph, longest)))
    want = {i: found for (i, _), found in all_pairs(rows, lambda i: i % 20 == 0).items()}
    assert np.mean([len({j for j, _ in told[i]} & {j for j, _ in want[i]}) / 20 for i in want]) > 0.98
