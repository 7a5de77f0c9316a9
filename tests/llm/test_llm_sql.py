"""Queries that SQL can state, against DuckDB: on a given table and on awkward rows."""

import pytest

import __spark_entry__ as E
from helpers import as_tables, edge_docs, empty_docs
from linestream.llm import catalog
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = list(E.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, name):
    ok, msg = compare(spark, name, catalog.QUERIES[name], catalog.ORACLES[name], SF, duck(SF))
    assert ok, msg


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql_on_awkward_rows(spark, tmp_path, name):
    folder, con = as_tables(spark, tmp_path, edge_docs(spark))
    if name == "op3_pfair_mix":  # rows with equal ids are placed in any order among themselves
        from collections import Counter

        got = catalog.QUERIES[name](spark, folder).toPandas()
        want = con.execute(catalog.ORACLES[name]).df()
        assert Counter(got["slot"]) == Counter(want["slot"])
        assert sorted(got["position"]) == sorted(want["position"]) == list(range(len(got)))
        return
    ok, msg = compare(spark, name, catalog.QUERIES[name], catalog.ORACLES[name], folder, con)
    assert ok, msg


#: Queries of documents; the others (pages, conversations) have such tests beside their operators.
OF_DOCUMENTS = [n for n in catalog.QUERIES if not n.startswith(("op5_", "op13_"))]


def label_rows(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (8, 0, 1), (9, None, None), (None, 1, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_empty_table(spark, tmp_path, name):
    as_tables(spark, tmp_path, label_rows(spark).where("doc_id > 50" if name.startswith("op11_") else "1 = 0"), "labels")
    folder, _ = as_tables(spark, tmp_path, empty_docs(spark))
    assert catalog.QUERIES[name](spark, folder).count() == 0


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_one_row_for_each_awkward_row(spark, tmp_path, name):
    as_tables(spark, tmp_path, label_rows(spark), "labels")
    df = edge_docs(spark)
    folder, _ = as_tables(spark, tmp_path, df)
    out = catalog.QUERIES[name](spark, folder)
    if name.startswith("op6_"):
        out = out.where("piece = 0")
    assert sorted(map(repr, (r[0] for r in out.select("doc_id").collect()))) == \
        sorted(map(repr, (r[0] for r in df.select("doc_id").collect())))
