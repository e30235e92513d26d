"""The queries with SQL against DuckDB on the same tables."""

import duckdb
import pytest

from sectile.llm import queries

D = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df = queries.QUERIES[name](spark, D)
    rel = c.execute(queries.ORACLE_SQL[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(repr(r[n]) for n in names) for r in df.collect()) == sorted(tuple(map(repr, r)) for r in rel.fetchall())
