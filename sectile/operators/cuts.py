"""Cutting of lineage in loops."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame

_MADE: dict[str, DataFrame] = {}
_FILED: dict[str, DataFrame] = {}


def shared_folder(spark) -> str:
    """The folder that driver and executors share; a local one only in local mode."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or "file:///tmp/sectile-checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """df as a table that is written once to the shared folder; what follows reads it and not df's plan."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/sectile-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = _MADE[path] = spark.read.schema(df.schema).parquet(path)
    return out


#: Rows of a part where dealt() deals a table out.
PART = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt out by the keys to as many parts as `rows` need. Otherwise the number of parts is a setting, and small packed
    rows are put together until a part has many millions, all of which a task's tables and sorts hold unpacked."""
    return df.repartition(max(8, -(-rows // PART)), *keys)


def filed(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df as a table that is written once, dealt out by the keys and bucketed: joins and groups by all keys read it without a
    shuffle, as often as they like."""
    spark, name = df.sparkSession, f"sectile_cut_{uuid.uuid4().hex}"
    path, parts = f"{shared_folder(spark).rstrip('/')}/sectile-cut-{name}", min(max(8, -(-rows // PART)), 100_000)
    df.repartition(parts, *keys).write.format("parquet").option("path", path).bucketBy(parts, *keys).saveAsTable(name)
    out = _MADE[path] = _FILED[name] = spark.table(name)
    return out


@atexit.register
def _tidy() -> None:
    for name, df in _FILED.items():
        with contextlib.suppress(Exception):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # its files go below
    for path, df in _MADE.items():
        with contextlib.suppress(Exception):  # its Spark may be gone
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
