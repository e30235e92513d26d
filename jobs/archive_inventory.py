"""Inventory of an archive of text files: what is there, what is damaged, what was copied, and the list to go on with.

    python -m jobs.archive_inventory --config jobs/jobs.toml --documents PATH --output PATH

Before anything is computed from an archive, each file is checked against its label: it has an id and a text, the text is
as long as its label says, its labels are set, and no file of a smaller id holds the same bytes (an upload that went wrong
shows as a copy, often under another source). What passes gets a running number `z` over the whole archive, the position
that later steps work by.

Output, in folders of `output`; a run replaces them, and gives the same for the same input:
  files   a row for each different (doc_id, source, lang, n_chars, text), partitioned by source (`folder`)
  report  a row for each source and status: files, rows, bytes, smallest and largest id

status is the first that holds: no_id, empty, copy, length, label, ok. Rows that are equal in all five columns are one
file, with `times` rows. A null text is empty; null sources and languages are kept, and are label faults.

Copies are found by a group of digests with map-side combining; the join back deals each digest of two files and more out
to SALTS tasks, so one file copied over a third of the archive is no hot key. Writing is balanced by Spark (rebalance), so a
large source is written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, main
from sectile.operators.cuts import cut
from sectile.operators.windows import global_index

FILES = "folder string, doc_id bigint, source string, lang string, n_chars bigint, n_bytes bigint, found_chars bigint, digest string, times bigint, copy_of bigint, copy_source string, status string, z bigint"
REPORT = "source string, status string, n_files bigint, n_rows bigint, n_bytes bigint, first_id bigint, last_id bigint"
#: Tasks that the copies of one content are dealt to.
SALTS = 16
_ROW = ["doc_id", "source", "lang", "n_chars"]


def listed(documents: DataFrame) -> DataFrame:
    """A row for each different file; the text is reduced to its digest and sizes before any shuffle."""
    t = F.coalesce("text", F.lit(""))
    slim = documents.select(*_ROW, F.octet_length(t).cast("long").alias("n_bytes"), F.length(t).cast("long").alias("found_chars"), F.sha2(t, 256).alias("digest"))
    return slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("times"))


def with_copies(files: DataFrame) -> DataFrame:
    """copy_of and copy_source: the smallest id that holds the same bytes, and its source (the least, where it is in several)."""
    first = F.min(F.struct("doc_id", "source"))
    groups = files.filter("doc_id IS NOT NULL AND n_bytes > 0").groupBy("digest").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    dealt = groups.select(F.col("digest").alias("_digest"), "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = files.withColumn("_s", F.pmod(F.xxhash64("doc_id", "source"), F.lit(SALTS)))
    j = salted.join(dealt, (F.col("digest") == F.col("_digest")) & (F.col("_s") == F.col("_salt")), "left")
    other = F.struct("doc_id", "source") > F.col("_first")
    return j.withColumn("copy_of", F.when(other & (F.col("doc_id") > F.col("_first.doc_id")), F.col("_first.doc_id"))).withColumn("copy_source", F.when(F.col("copy_of").isNotNull(), F.col("_first.source"))).select(*files.columns, "copy_of", "copy_source")


def judged(files: DataFrame) -> DataFrame:
    why = (
        F.when(F.col("doc_id").isNull(), "no_id").when(F.col("n_bytes") == 0, "empty").when(F.col("copy_of").isNotNull(), "copy")
        .when(F.coalesce(F.col("n_chars") != F.col("found_chars"), F.lit(True)), "length").when(F.col("lang").isNull() | F.col("source").isNull(), "label").otherwise("ok")
    )
    return files.withColumn("status", why)


def numbered(files: DataFrame, bucket: int) -> DataFrame:
    """z of the files that are ok, by id, without a task that sees all of them."""
    ok = global_index(files.filter("status = 'ok'"), "doc_id", F.floor(F.col("doc_id") / bucket), "z")
    return ok.select(*files.columns, "z").unionByName(files.filter("status <> 'ok'").withColumn("z", F.lit(None).cast("long")))


def run(spark: SparkSession, documents: str, output: str, bucket: int = 100_000) -> dict[str, int]:
    """Reads the table of documents at the path, writes files and report under output; returns counts of rows."""
    docs = spark.read.parquet(documents)
    files = cut(listed(docs))  # each later step reads this slim table and not the texts
    out = numbered(judged(with_copies(files)), bucket)
    folder = F.when(F.col("source").isNull(), "none").otherwise(F.concat(F.lit("s-"), "source"))
    out = out.withColumn("folder", folder).select(*(c.split()[0] for c in FILES.split(", "))).hint("rebalance", "folder")
    out.write.mode("overwrite").partitionBy("folder").parquet(f"{output}/files")
    done = spark.read.schema(FILES).parquet(f"{output}/files")
    report = done.groupBy("source", "status").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("times").alias("n_rows"), F.sum(F.col("n_bytes") * F.col("times")).alias("n_bytes"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    report.coalesce(1).write.mode("overwrite").parquet(f"{output}/report")  # a row for each source and status
    n = spark.read.schema(REPORT).parquet(f"{output}/report").agg(F.sum("n_files"), F.sum(F.when(F.col("status") == "ok", F.col("n_files")))).first()
    counts = {"read": docs.count(), "files": n[0] or 0, "ok": n[1] or 0}
    log.info("read %d rows of %s; wrote %d files, %d of them ok, to %s", counts["read"], documents, counts["files"], counts["ok"], output)
    return counts


if __name__ == "__main__":
    main("archive_inventory", __doc__.split("\n")[0], ["documents", "output"], run)
