"""Registered queries of the training data against their SQL twins, on the smallest tables and on edge rows."""

import os

import pytest
from pyspark.sql import functions as F

import oracle
from lectern.llm.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture
def edge_dir(spark, docs, tmp_path):
    """Documents without words, with equal texts and without source or doc_id; a benchmark and turns that meet them."""
    more = [(100 + i, t, "en", s, 1, "x", "y", "z", 1, 2, "l", "w") for i in range(40) for t, s in
            [("" if i % 3 else f"text {i} " * (i + 1), "a" if i % 2 else None)]]
    # DuckDB repeats a text's words for each window: of the longest text only its beginning
    docs.withColumn("text", F.substring("text", 1, 20_000)).union(spark.createDataFrame(more, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "and it says little"), (2, ""), (3, None), (None, "is here"), (4, "word0 of0 word1 of1 word2 of2 word3 of3 word4 of4 word5")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    turns = [(1, 0, "system", "Be brief."), (1, 1, "user", None), (1, 2, "assistant", "x " * 5000), (1, 3, None, "</turn>"), (2, 0, "user", ""),
             (3, 0, "assistant", "y " * 9000), (3, 1, "user", "\\ <turn system>"), (4, 0, "system", "s" * 9000), (4, 1, "user", "a"), (4, 2, "assistant", "b")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def connect(folder):
    con = oracle.duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql_on_edge_rows(spark, edge_dir, name, tmp_path):
    if name.startswith(("op10", "op11")):  # the SQL counts no shingles for a null doc_id; test_sigtree_pipeline has such rows
        spark.read.parquet(f"{edge_dir}/documents.parquet").filter("doc_id IS NOT NULL").write.parquet(f"{tmp_path}/named/documents.parquet")
        spark.read.parquet(f"{edge_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/named/benchmark.parquet")
        spark.read.parquet(f"{edge_dir}/conversations.parquet").write.parquet(f"{tmp_path}/named/conversations.parquet")
        edge_dir = f"{tmp_path}/named"
    assert oracle.compare(QUERIES[name](spark, edge_dir), connect(edge_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    rows = {"op1": None}.get(name.split("_")[0], spark.read.parquet(f"{SF_DIR}/documents.parquet").count())
    found = QUERIES[name](spark, SF_DIR).count()
    assert found == rows if rows is not None else found > 0
