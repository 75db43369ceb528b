"""The registered queries: names, DuckDB results, native plans, the pipeline."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from raincheck.llm import queries, winnowing
from raincheck.llm.common import stored, table

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries()
    assert set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_duckdb(llm_spark, small_sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_sf}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    want = sorted(map(str, want.fetchall()))
    got = queries.QUERIES[name](llm_spark, small_sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == want


@pytest.mark.parametrize("name", ["op4_chat_format", "op5_url_filter", "op8_document_fingerprints"])
def test_native_plans_have_no_python(llm_spark, small_sf, name):
    plan = queries.QUERIES[name](llm_spark, small_sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_document_fingerprints_exchange_texts_once(llm_spark, small_sf):
    df = winnowing.with_next(table(llm_spark, small_sf, "documents"), run_rows=20)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 2


def test_pipeline_stages(llm_spark, small_sf):
    docs = table(llm_spark, small_sf, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(llm_spark, docs, small_sf), name)
        assert docs.columns == DOCUMENT_COLUMNS
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] == counts[2] and counts[-1] < counts[0]
    last = corpus_pipeline.STAGES[-1][1](llm_spark, docs, small_sf)
    kept = {r[0] for r in docs.select("doc_id").collect()}
    assert {r[0] for r in last.select("doc_id").collect()} == kept
    assert corpus_pipeline.run(llm_spark, small_sf).count() == last.count()


def test_repository_has_no_tokenizer_files():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert not [f for _, _, names in os.walk(os.path.join(top, "raincheck")) for f in names if f.endswith((".model", ".tiktoken"))]
