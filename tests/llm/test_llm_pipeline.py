"""The pipeline's stages one by one, and the registered queries."""

import corpus_pipeline
import pytest

import tenura.llm.queries as queries
from tenura.llm import decontamination, ngram_join
from tenura.llm.storage import clear, shared_folder, stored

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
    assert "pipeline" in queries.QUERIES and corpus_pipeline.ORACLE_SQL is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        rows = {r["doc_id"]: r for r in out.collect()}
        assert len(rows) == out.count() and set(rows) <= set(ids)
        if name == "language_id":
            gone = set(ids) - set(rows)
            assert len(gone) < 0.05 * len(ids) and all(len(ids[i]) < 200 for i in gone)
        elif name == "line_dedup":
            assert set(rows) == set(ids)
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        elif name == "ngram_join":
            classes = {r["doc_id"]: r["class_id"] for r in ngram_join.near_duplicates(docs).collect()}
            assert set(rows) == {i for i in ids if i in rows and (classes[i] == i)} and len(rows) == len(set(classes.values()))
        else:
            found = decontamination.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert set(rows) == {r["doc_id"] for r in found.collect() if r["n_hit"] == 0}
        docs, ids = out, {i: r["text"] for i, r in rows.items()}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in mixed.select("doc_id").distinct().collect()} <= set(ids)


def test_stages_without_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    source = "pages" if name.startswith(("op1_", "op6_", "op8_")) else "documents"
    found = queries.QUERIES[name](spark, SF)
    rows = spark.read.parquet(f"{SF}/{source}.parquet").count()
    assert found.count() == rows if name != "pipeline" else found.count() > 0


def test_stored_tables(spark):
    table = stored(spark.range(5))
    assert table.count() == 5 and table.inputFiles()[0].startswith(("file:", "/"))
    assert shared_folder(spark).split("/")[-1].startswith("tenura-") and callable(clear)
