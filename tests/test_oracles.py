"""Every registered query of the archive engine against its SQL in DuckDB."""

import datetime
import math
import os

import duckdb
import pytest

from tidewake.queries import everything

QUERIES, ORACLES = everything()
TABLES = "region nation customer supplier part orders lineitem events".split()
KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DATE": "date"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert os.path.isdir(sf_dir)
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    kinds = dict(got.dtypes)
    assert {c: KINDS[str(t)] for c, t in zip(want.columns, want.types, strict=True)} == kinds
    order = [want.columns.index(c) for c in names]
    as_text = lambda rows: sorted(rows, key=str)
    assert as_text(tuple(norm(r[c]) for c in names) for r in got.collect()) == as_text(tuple(norm(r[k]) for k in order) for r in want.fetchall())
