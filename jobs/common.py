"""What the jobs' command lines and queries share."""

from __future__ import annotations

import argparse
import logging
import tomllib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sectile.operators.cuts import shared_folder

log = logging.getLogger("sectile.jobs")


def settings(path: str | None, section: str) -> dict:
    """One section of a TOML file; nothing where no file is given."""
    if path is None:
        return {}
    with open(path, "rb") as f:
        return tomllib.load(f).get(section, {})


def main(section: str, doc: str, paths: list[str], run: Callable[..., dict]) -> None:
    """The command line: --config, and a path for each of `paths`; options and missing paths come from the file."""
    p = argparse.ArgumentParser(description=doc)
    p.add_argument("--config", help=f"TOML file with a section [{section}]")
    for name in paths:
        p.add_argument(f"--{name}")
    given = vars(p.parse_args())
    options = settings(given.pop("config"), section) | {k: v for k, v in given.items() if v is not None}
    missing = [x for x in paths if x not in options]
    if missing:
        p.error(f"no path for: {', '.join(missing)}")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(section).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, **options)
    finally:
        spark.stop()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call uses, under spark.checkpoint.dir."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
