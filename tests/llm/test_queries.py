"""The registered queries beside their SQL, and the pipeline against its own rules."""

import re
import sys

import pytest
from conftest_llm import SF, rows

sys.path.insert(0, "/root/repo/tests")
import corpus_pipeline
from lotledger.llm import queries, toxicity
from oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, queries.QUERIES[name], queries.SQL.get(name)) is None


def test_stages_keep_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(rows()), name
        assert stage(spark, docs.where("false"), SF).count() == 0, name


def test_toxicity_stage_keeps_a_column_of_its_own_name(spark, docs):
    more = docs.withColumn("_Toxicity", docs["score"]).withColumn("_toxicity_", docs["n"])
    assert corpus_pipeline.without_toxic(spark, more, SF).columns == more.columns


def test_pipeline(spark):
    from test_operators import components_by_hand, windows_by_hand

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    left = [(r["doc_id"], r["text"]) for r in toxicity.score(docs, model, "p").where("p < 0.3").collect()]
    first = {i for i, _, c in components_by_hand(left, 5, 80) if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, t in left if i in first and not windows_by_hand(t, items)[-1]}
    out = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == want and all(n > 0 or not re.search(r"\S", dict(left)[i] or "") for i, n in out.items())
