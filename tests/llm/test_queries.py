"""Registered queries against DuckDB, the pipeline step by step, and what the subpackage may touch."""

from __future__ import annotations

import pytest

import corpus_pipeline
from checks.compare import check
from payscope.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_agrees_with_duckdb(spark, duck, sf_dir, name):
    problem, rows = check(spark, duck, sf_dir, name, QUERIES[name], ORACLE[name])
    assert problem is None
    assert rows > 0


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))


def test_pipeline(spark, duck, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        kept.append(docs.count())
    assert all(a > b for a, b in zip(kept, kept[1:4]))
    assert docs.groupBy("text").count().where("count > 1").isEmpty()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, pieces.select("doc_id", "piece", "ids_crc32").collect())
    )
