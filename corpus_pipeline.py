"""From raw documents to token ids: quality rules, near-duplicates, repeated passages, mixture, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. run()
writes each stage's rows to the shared folder and goes on from there, so a lost executor costs one stage at most.

Defined results: nulls, empty texts, repeated rows and ties as each stage's operator states them; very long texts pass
whole; extra columns, clashing ones too, reach the last stage as they are; an empty table passes all stages.

The order of rows does not outlive a table, so the last stage adds their places, which follow from the rows alone: (slot,
start_byte) of a row of the result is its place in the mixture. No stage knows anything but its own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sectile.llm import bpe, mixing, near_dedup, quality_rules, suffix_dedup
from sectile.llm.common import cut, table


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text fails the base rule or is more likely bad than good go; a null text has no words and goes."""
    return quality_rules.keep(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each class stays, of rows with one id the first text; rows with a null id stay."""
    return near_dedup.keep(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages of 50 bytes and more that a document of smaller id has; n_chars follows. No row goes."""
    return suffix_dedup.strip(docs, n_chars="n_chars" if "n_chars" in [c.lower() for c in docs.columns] else None)


def in_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mixture."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of digests for each row, with its place in the mixture; a null text counts as empty."""
    placed = mixing.with_places(docs, mixing.positions(docs))
    return bpe.round_trip(placed, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, also=["slot", "start_byte"])


STAGES = [
    ("quality rules", by_quality),
    ("near-duplicates", without_near_copies),
    ("repeated passages", without_repeated_passages),
    ("mixture", in_mixture),
    ("byte-level BPE", encoded),
]

#: The stages' similarity search and suffix sort have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
