"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from tidewake.llm import queries

KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir), con.sql(queries.ORACLES[name])
    assert {c: KINDS[str(t)] for c, t in zip(want.columns, want.types, strict=True)} == dict(got.dtypes)
    as_text = lambda rows: sorted(rows, key=str)
    assert as_text(tuple(r[c] for c in want.columns) for r in got.collect()) == as_text(want.fetchall())
