"""The registered queries on the small tables, and the pipeline."""

import importlib

import duckdb
import pytest
from helpers import documents
from pyspark.sql import functions as F

from querytrail.llm import queries as Q
from querytrail.llm.oracles import SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(SQL[name])
    cols = [c[0] for c in want.description]
    got = Q.QUERIES[name](spark, SMALL).select(*cols).collect()
    key = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    assert sorted(map(key, got), key=str) == sorted(map(key, want.fetchall()), key=str)


COLUMNS = {
    "op2_ngram_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op3_substring_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op4_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op5_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_id_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op12_relative_lz": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_schema_and_whole_table(spark, name):
    df = Q.QUERIES[name](spark, SMALL)
    assert dict(df.dtypes) == COLUMNS[name]
    assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_schemas_of_searches(spark):
    assert dict(Q.QUERIES["op13_ranked_search"](spark, SMALL).dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    types = {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    df = Q.QUERIES["op11_whitening"](spark, SMALL)
    assert dict(df.dtypes) == types
    assert df.select("vec_id").distinct().count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_keep_columns_and_whole_result(spark, pipeline):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash", "decontaminate", "pii", "packing"]
    before = docs
    for name, stage in pipeline.STAGES:
        after = pipeline.written(stage(spark, before, SMALL), f"test-{name}")
        if name != "packing":
            assert after.columns == docs.columns
            assert after.count() <= before.count()
            assert after.join(docs, "doc_id", "left_anti").count() == 0
            before = after
    ids = before.select("doc_id").distinct().count()
    assert after.select("doc_id").distinct().count() == ids
    whole = pipeline.run(spark, SMALL)
    assert whole.columns == after.columns
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(map(str, after.drop("sequence_id", "offset").collect()))


def test_stages_take_odd_rows(spark, pipeline):
    rows = [(1, None), (2, ""), (None, "text without an id"), (3, "w " * 30_000), (3, "w " * 30_000), (4, "same"), (4, "same"), (None, None)]
    for docs in (documents(spark, rows), documents(spark, [])):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.count() <= docs.count() + 20
            assert name == "packing" or out.columns == docs.columns


def test_clean_documents_stay(spark, pipeline):
    rows = [(i, f"clean{i} " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(50)]
    docs = documents(spark, rows)
    for name, stage in pipeline.STAGES[:3]:
        assert stage(spark, docs, SMALL).count() == 50, name
    assert sorted(r["text"] for r in pipeline.STAGES[3][1](spark, docs, SMALL).collect()) == sorted(t for _, t in rows)
    assert docs.where(F.col("doc_id").isNull()).count() == 0
