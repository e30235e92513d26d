"""Every registered query with SQL against DuckDB on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as e

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return repr(v)


CORE = sorted(k for k in e.oracle_sql() if not (k.startswith("op") and k[2].isdigit()) and k != "pipeline")


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = e.queries()[name](spark, D)
    rel = duck.execute(e.oracle_sql()[name])
    names, kinds = [c[0] for c in rel.description], {c[0]: str(c[1]) for c in rel.description}
    columns = sorted(df.columns)
    assert columns == sorted(names)
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall())
    assert got == want


NUMERIC = sorted(k for k in e.queries() if k not in e.oracle_sql() and not (k.startswith("op") and k[2].isdigit()) and k != "pipeline")


@pytest.mark.parametrize("name", NUMERIC)
def test_without_sql_runs_over_its_table(spark, name):
    """Their results are held against NumPy and known parameters in test_numeric.py."""
    assert e.queries()[name](spark, D).count() > 0


def test_entry(spark):
    assert e.entry(spark).count() > 0
