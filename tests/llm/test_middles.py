"""Fill-in-middle texts against DuckDB, plain Python and round trips."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import middles
from siltstone.llm.oracle import ORACLE
from siltstone.llm.queries import QUERIES
from testbed.check import connect

SF = "/root/testdata/sf0.001"


def python_version(doc_id, text):
    text = text or ""
    told = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_query_equals_sql(spark):
    con = connect(SF)
    relation = con.sql(ORACLE["op13_middles"])
    got = QUERIES["op13_middles"](spark, SF).select(*relation.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(relation.fetchall(), key=str)


def test_edge_cases_against_python(spark, edges, empty, pairs, tuples):
    more = [(i, "<x <P" * i) for i in range(20)] + [(i, "é<ж\U0001F600" * i) for i in range(100, 140)] + [
        (50, "a<P>b"), (51, "<S>"), (52, "x<M>"), (53, "<" * 40), (54, "<P<S<M")]
    other = spark.createDataFrame(more, "doc_id long, text string")
    for docs in (edges, other):
        want = sorted((python_version(i, t) for i, t in pairs(docs)), key=str)
        told = middles.fill_in_middle(docs)
        assert tuples(told, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == want
        back = told.select("doc_id", middles.restored().alias("text"))
        assert tuples(back, "doc_id", "text") == sorted(((i, t or "") for i, t in pairs(docs)), key=str)
    assert middles.fill_in_middle(empty).collect() == []


def test_portions_change_nothing(edges, tuples, monkeypatch):
    want = tuples(middles.fill_in_middle(edges), "*")
    monkeypatch.setattr(middles, "PORTION", 7)
    import pyarrow as pa

    rows = edges.select("doc_id", "text").collect()
    batch = pa.RecordBatch.from_pydict({"doc_id": [r.doc_id for r in rows], "text": [r.text for r in rows]})
    parts = list(middles._rows("1")(iter([batch])))
    assert len(parts) > 5
    assert sorted((tuple(r.values()) for p in parts for r in p.to_pylist()), key=str) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=400), st.sampled_from([1, 2, 10, 127]))
def test_index_is_exact(steps, error):
    offsets = np.cumsum(np.array(steps, np.int64))
    index = middles.RankIndex.fit(offsets, error)
    assert (index.offset(np.arange(len(offsets))) == offsets).all()
    assert not len(offsets) or np.abs(index.residual.astype(int)).max() <= error


def test_segments_are_few_and_bounded():
    # A slow change of script: far fewer segments than code points, each residual within the bound.
    rng = np.random.default_rng(1)
    steps = np.concatenate([np.ones(50_000, int), rng.integers(1, 4, 50_000), np.full(50_000, 3)])
    offsets = np.append(0, np.cumsum(steps))
    index = middles.RankIndex.fit(offsets)
    assert len(index.start) < 100 and (index.offset(np.arange(len(offsets))) == offsets).all()
    with pytest.raises(ValueError):
        middles.RankIndex.fit(offsets, 128)
