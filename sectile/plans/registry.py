"""All registered queries of the core library, with the SQL that an independent engine runs on the same tables."""

from __future__ import annotations

from . import base, q_aggregates, q_align, q_core, q_joins, q_numeric, q_scalars, q_stitch, q_windows

QUERIES = base.QUERIES
ORACLE_SQL = base.ORACLE_SQL


def entry(spark, sf_dir: str):
    """The flagship query: display levels."""
    return QUERIES["display_levels"](spark, sf_dir)
