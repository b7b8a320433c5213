"""The pipeline's stages on edge cases, its decisions on the driver's table, and the registered names."""

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from siltstone.llm import near
from siltstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, documents):
    """The table after each stage, by name."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out[name] = docs
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_operator_is_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in driver.queries()
    assert set(names) == set(QUERIES)


def test_stages_keep_the_columns(stages, documents):
    for name, docs in list(stages.items())[:-1]:
        assert docs.columns == documents.columns, name
    assert {"doc_id", "shard", "slot"} <= set(stages["shards"].columns)


def test_clean_documents_stay(stages, documents):
    assert ids(stages["language"]) == ids(documents)


def test_texts_of_several_languages_stay(spark, documents):
    by = {r.lang: r.text for r in documents.filter("length(text) > 900").collect()}
    parts = [by[k][:n] for k, n in zip(sorted(by), (400, 300, 300))]
    mixed = documents.limit(0).union(documents.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit("\n".join(parts))}))
    more = documents.unionByName(mixed.select(documents.columns))
    assert len(parts) == 3 and ids(corpus_pipeline.by_language(spark, more, SF)) == sorted([-1, *ids(documents)])


def test_one_of_each_group_stays(stages, documents):
    kept = ids(stages["near_copies"])
    assert len(kept) == len(set(kept)) < documents.count()
    groups = {r.doc_id: r.class_id for r in near.near_duplicates(documents).collect()}
    assert sorted({groups[i] for i in kept}) == sorted(set(groups.values()))


def test_benchmark_text_goes(spark, stages, pairs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    told = brute.contamination(pairs(stages["near_copies"]), items)
    assert ids(stages["benchmark"]) == sorted(r[0] for r in told if not r[5])
    assert any(r[5] for r in told)


def test_mixture_and_shards(stages):
    assert set(ids(stages["mixture"])) <= set(ids(stages["benchmark"]))
    assert stages["mixture"].count() >= 0.7 * stages["benchmark"].count()
    assert ids(stages["shards"]) == ids(stages["mixture"])


def test_stages_on_edge_cases(spark, edges, empty):
    for docs in (edges, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "shards" or out.columns == docs.columns
            rows = out.collect()
            assert len(rows) <= docs.count()
            if name == "near_copies" and docs is edges:
                assert sum(r.doc_id == 5 for r in rows) == 2  # of a repeated row one, and another text with its id
                assert sum(r.text is None for r in rows) == 2
