"""Registered queries and the pipeline on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from zonecast.llm import queries as q

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"  # enough labels to learn from


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(q.ORACLES[name]).fetchall()
    cols = [d[0] for d in con.description]
    got = [tuple(r[c] for c in cols) for r in q.QUERIES[name](spark, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLES)))
def test_queries_without_sql_give_rows(spark, name):
    out = q.QUERIES[name](spark, SF)
    assert len(out.columns) == len(set(out.columns)) and out.count() > 0


def test_pipeline_stages(spark):
    docs = q.table(spark, SF_MID, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out, _ = corpus_pipeline.write_table(stage(spark, docs, SF_MID), f"t-{name}")
        if name != "sentencepiece":
            assert out.columns == columns
        if name in ("toxicity", "near_dedup"):
            assert 0 < out.count() < before
        if name == "secrets":
            assert out.count() == docs.count() and out.where("text LIKE '%[SECRET]%'").count() > 0
        if name == "sentencepiece":
            assert out.count() == docs.count() and out.where("NOT round_trip").count() == 0
        docs = out
