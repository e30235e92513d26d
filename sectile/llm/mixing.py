"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

Each source is dealt, in an order fixed by a digest of the key, into blocks of equal bytes. Target weights become
whole shares of a period. Block j of a source with share a of a period Q (both counted from 0) is released at slot
floor(j Q / a) and due before slot ceil((j + 1) Q / a); the earliest deadline among the released blocks takes each
slot. As the shares add up to the period, every block runs inside its window, so at any slot each source is less than
one block away from its target, until a source has no more blocks: then its slots stay empty. The windows repeat with
the period, so one period is scheduled and the rest follows by arithmetic.

Every row is kept. Running bytes within a source are summed in two levels (4,096 digest ranges, then within a range),
so a source that holds most rows is spread over many tasks.

Defined results: a null or empty source is the source ''; a null text has no bytes; each row counts one byte more than
its text, so that rows of empty texts have places too; repeated rows each have a place (rows of one key are ordered by
size and by the hash of their text, equal rows are interchangeable); a row is never cut, so a very long text fills its
block and stands for several; a target of 0 or no target still gives a source one slot of a period, as no row is
dropped; extra columns, clashing ones too, come back as they are; an empty table gives an empty table.

A period has at least 32 slots for each source and is scheduled in one row, in a time that grows with the square of the
number of sources: meant for tens or hundreds of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import only, rolled, unrolled

#: Bytes of a block; slots of a period at least, and for each source.
BLOCK_BYTES, PERIOD, PERIOD_PER_SOURCE = 1 << 16, 1000, 32
#: Text bytes of a partition of the mixed table.
PARTITION_BYTES = 128 << 20
_RANGE_DIGITS = 3  # hexadecimal digits of the digest: 4,096 ranges


def shares(sizes: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(source, bytes, share, period). Without targets the weights are the square roots of the sources' bytes."""
    if targets is None:
        weight: Column = F.floor(F.sqrt("bytes") * 1000)
    else:
        weight = F.coalesce(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])[F.col("source")] if targets else F.lit(None), F.lit(0.0))
        weight = F.floor(weight * 1_000_000)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # a row for each source
    out = sizes.withColumn("w", F.greatest(weight.cast("long"), F.lit(1))).withColumn("n", F.count(F.lit(1)).over(every)).withColumn("total", F.sum("w").over(every))
    out = out.withColumn("period", F.greatest(F.lit(PERIOD), F.col("n") * PERIOD_PER_SOURCE))
    scaled = F.col("w") * (F.col("period") - F.col("n"))
    out = out.withColumn("whole", F.expr("1 + (w * (period - n)) div total")).withColumn("rest", scaled % F.col("total"))
    left = F.col("period") - F.sum("whole").over(every)
    return out.withColumn("left", left).withColumn("rank", F.row_number().over(W.orderBy(F.desc("rest"), "source"))).select("source", "bytes", (F.col("whole") + (F.col("rank") <= F.col("left")).cast("long")).alias("share"), F.col("period").cast("long"))


def schedule(shared: DataFrame) -> DataFrame:
    """(source, share, period, k, slot): where block k of each source stands in a period, by earliest deadline first."""
    released = "x.j * q div x.share <= t"
    due = "((x.j + 1) * q + x.share - 1) div x.share"
    pick = f"array_min(transform(filter(s.state, x -> {released}), x -> struct({due} AS due, x.source AS source, x.j AS k)))"
    advance = "transform(s.state, x -> struct(x.source AS source, x.share AS share, x.j + cast(x.source = c.source AS bigint) AS j))"
    step = f"element_at(transform(array({pick}), c -> struct(concat(s.done, array(struct(t AS slot, c.source AS source, c.k AS k))) AS done, {advance} AS state)), 1)"
    start = "struct(cast(array() AS array<struct<slot: bigint, source: string, k: bigint>>) AS done, transform(state, x -> struct(x.source AS source, x.share AS share, 0L AS j)) AS state)"
    one = shared.agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("state"), F.max("period").alias("q"))
    slots = one.filter("q IS NOT NULL").select("q", F.explode(F.expr(f"aggregate(sequence(0L, q - 1), {start}, (s, t) -> {step}).done")).alias("d")).select(F.col("q").alias("period"), "d.*")
    return slots.join(F.broadcast(shared.select("source", "share")), "source")


def _rows(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """row (all columns of docs), and of each row: source, size, and what fixes its order within the source."""
    rows = rolled(docs, key=key, source=source, text=text)
    return rows.select("row", "key", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), _size("text").alias("n_bytes"), F.md5(F.coalesce(F.col("key").cast("string"), F.lit(""))).alias("digest"), F.xxhash64("text").alias("of_text"))


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _placed(rows: DataFrame, targets: dict[str, float] | None, block_bytes: int) -> DataFrame:
    """rows with start_byte (within the source), block, release, due, slot, share, period."""
    rows = rows.withColumn("part", F.substring("digest", 1, _RANGE_DIGITS))
    ranges = rows.groupBy("source", "part").agg(F.sum("n_bytes").alias("b"))  # 4,096 rows for each source at most
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = ranges.select("source", "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("before"))
    shared = shares(ranges.groupBy("source").agg(F.sum("b").alias("bytes")), targets)
    table = schedule(shared).select("source", "k", F.col("slot").alias("at"))
    within = W.partitionBy("source", "part").orderBy("digest", "key", "n_bytes", "of_text").rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumn("inside", F.coalesce(F.sum("n_bytes").over(within), F.lit(0))).join(before, ["source", "part"])
    out = out.withColumn("start_byte", F.col("before") + F.col("inside")).withColumn("block", F.floor(F.col("start_byte") / F.lit(block_bytes)))
    out = out.join(F.broadcast(shared.select("source", "share", "period")), "source").withColumn("k", F.col("block") % F.col("share"))  # a row for each source
    out = out.join(F.broadcast(table), ["source", "k"])  # a row for each slot of one period
    return out.withColumns({"slot": F.expr("(block div share) * period + at"), "release": F.expr("block * period div share"), "due": F.expr("((block + 1) * period + share - 1) div share")})


def positions(docs: DataFrame, targets: dict[str, float] | None = None, block_bytes: int = BLOCK_BYTES, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """A row for each row of docs: its block and slot. (slot, start_byte) is its place in the mixture."""
    out = _placed(_rows(only(docs, key, source, text), key, source, text).drop("row"), targets, block_bytes)
    return out.select(F.col("key").alias(key), "source", "n_bytes", "start_byte", "block", "release", "due", "slot", "share", "period")


def mixed(docs: DataFrame, targets: dict[str, float] | None = None, block_bytes: int = BLOCK_BYTES, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of docs in the order of the mixture: partitions by ranges of slots, rows in order within."""
    size = only(docs, text).agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    out = _placed(_rows(docs, key, source, text), targets, block_bytes)
    return unrolled(out.repartitionByRange(n, "slot", "start_byte").sortWithinPartitions("slot", "start_byte"), docs)


def with_places(docs: DataFrame, places: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """docs with slot and start_byte of their positions(), in place of columns of these names. Rows of one key, source and
    size take their places in turn."""
    docs = docs.drop("slot", "start_byte")
    rows = _rows(docs, key, source, text).withColumn("turn", F.row_number().over(W.partitionBy("key", "source", "n_bytes").orderBy("of_text")))
    turn = F.row_number().over(W.partitionBy("_k", "_s", "_b").orderBy("start_byte"))
    at = places.select(F.col(key).alias("_k"), F.col("source").alias("_s"), F.col("n_bytes").alias("_b"), "slot", "start_byte").withColumn("_t", turn)
    met = F.col("key").eqNullSafe(F.col("_k")) & (F.col("source") == F.col("_s")) & (F.col("n_bytes") == F.col("_b")) & (F.col("turn") == F.col("_t"))
    found = rows.join(at, met, "left")
    return found.select(*(F.col(f"row.c{i}").alias(f"c{i}") for i in range(len(docs.columns))), "slot", "start_byte").toDF(*docs.columns, "slot", "start_byte")
