"""Registered text queries: twins where SQL can express them, and the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from boxlake.llm.queries import QUERIES
from boxlake.llm.twins import TWINS
from tests.oracle import compare


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(TWINS) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duckdb_con, sf_dir, name):
    problems, n, _, diff = compare(duckdb_con, QUERIES[name](spark, sf_dir), TWINS[name])
    assert not problems, (problems, diff)
    assert n > 0


def test_native_queries_have_no_python(spark, sf_dir):
    for name in ("op2_line_dedup", "op6_decontamination", "op10_pii"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]
    final = corpus_pipeline.run(spark, sf_dir)
    kept = final.count()
    assert 0 < kept < docs.count() and final.select("doc_id").distinct().count() == kept
