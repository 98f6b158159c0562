"""Queries against their SQL in the second engine, over the whole given tables and odd rows."""

from pathlib import Path

import duckdb
import pytest

from offerlens.llm.oracle import LLM_ORACLES
from offerlens.llm.queries import LLM_QUERIES


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", LLM_ORACLES)
@pytest.mark.parametrize("odd", [False, True])
def test_query_agrees_with_sql(spark, sf_dir, odd_documents, tmp_path, name, odd):
    folder = sf_dir
    if odd:
        folder = str(tmp_path)
        odd_documents.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    engine = duckdb.connect()
    for table in ("documents", "benchmark"):
        path = Path(folder, f"{table}.parquet")
        files = [str(path)] if path.is_file() else [str(f) for f in path.glob("*.parquet")]
        engine.sql(f"create view {table} as select * from read_parquet({files})")
    found = LLM_QUERIES[name](spark, folder)
    expected = engine.sql(LLM_ORACLES[name])
    assert comparable(found.columns, found.collect()) == comparable(expected.columns, expected.fetchall())
