"""Registration of queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of tables; the function gets a reader of tables."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def r(c, n: int = 6):
    """A double rounded so that two engines agree."""
    return F.round(c if not isinstance(c, str) else F.col(c), n)


def seconds(c):
    """Whole seconds of a timestamp."""
    return F.unix_timestamp(F.col(c).cast("timestamp") if isinstance(c, str) else c)


def micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))
