import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"

# Null columns, empty and long texts, ties, repeated rows, repeated ids.
EDGES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "a"),
    (5, "The cat sat on the mat today. " * 3, "en", "a"), (5, "The cat sat on the mat today. " * 3, "en", "a"),
    (5, "another text with the same id as two others, long enough to count as a text", "en", "b"),
    (None, "a row without an id but with quite a few words in it.", "en", None),
    (None, None, None, None), (7, "é" * 400, "fr", "c"), (8, "ab" * 500, "xx", "c"), (9, "12 34 56 !!! ???", "en", "a"),
    (10, " ".join(f"w{i % 97}" for i in range(30_000)), "en", "a"), (11, "ЖЖ привет мир это текст", "ru", "c"),
    (12, "line one is here\n\nline one is here\nLine ONE, is here!", "en", "a"), (13, "\\l<turn>\\b</turn>\n", "en", "a"),
]


@pytest.fixture(scope="module")
def edges(spark):
    """The cases above, with columns whose names operators use themselves."""
    rows = [(*r, 1, "x", 2, 3.0, 4) for r in EDGES]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, shard int, th string, n int, w double, slot int")


@pytest.fixture(scope="module")
def empty(edges):
    return edges.limit(0)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def pairs():
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def tuples():
    return lambda df, *columns: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
