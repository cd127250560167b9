"""Every registered query against its DuckDB oracle (row count, names, values)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from cases import SF_SMALL
from driftlog.plans.catalog import QUERIES
from driftlog.plans.oracle import ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["board_key", "event_type", "value"]
    assert df.count() > 0


DUCK_TO_SPARK = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BLOB": "binary", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    described = duck.execute(f"DESCRIBE {ORACLE[key]}").fetchall()
    oracle_types = {c[0]: DUCK_TO_SPARK.get(c[1], c[1]) for c in described}
    assert dict(df.dtypes) == oracle_types
