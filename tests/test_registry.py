"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import hashlib
import math
from decimal import Decimal

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from encore.registry import build

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# The library's own queries; those of the text operators are tested beside them.
QUERIES = build().queries
ORACLE = build().oracle


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, Decimal):
        return str(v.normalize())
    return str(v)


def digest(rows):
    return sorted(hashlib.md5("|".join(norm(v) for v in r).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and ORACLE.items() <= E.oracle_sql().items()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["period", "nbr", "name", "rsi", "rsi_rank"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    dcols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert digest(srows) == digest(drows)
