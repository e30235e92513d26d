"""The jobs as queries: each runs twice into one new folder, and its output as it stands then is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import archive_inventory, preview_statistics
from jobs.common import new_folder, read_back


def job1_archive_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "job1")
    for _ in range(2):
        archive_inventory.run(spark, f"{sf_dir}/documents.parquet", out)
    return read_back(spark, f"{out}/files", archive_inventory.FILES).drop("folder")


def job2_preview_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "job2")
    for _ in range(2):
        preview_statistics.run(spark, f"{sf_dir}/events.parquet", f"{out}/output", f"{out}/checkpoint")
    stats = read_back(spark, f"{out}/output/stats", preview_statistics.STATS)
    return stats.select(F.col("day").cast("string").alias("day"), "tile", "n", "n_missing", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high", "p5", "p50", "p95")), F.round("std", 4).alias("std"))


QUERIES = {f.__name__: f for f in (job1_archive_inventory, job2_preview_statistics)}

ORACLE_SQL = {
    "job1_archive_inventory": """WITH f AS (SELECT doc_id, source, lang, n_chars, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, CAST(length(coalesce(text, '')) AS BIGINT) AS found_chars, sha256(coalesce(text, '')) AS digest, count(*) AS times FROM documents GROUP BY 1, 2, 3, 4, 5, 6, 7),
g AS (SELECT digest, min(doc_id) AS least FROM f WHERE doc_id IS NOT NULL AND n_bytes > 0 GROUP BY 1), h AS (SELECT g.digest, least, min(source) AS s, count(*) FILTER (WHERE source IS NULL) AS nulls FROM g JOIN f ON f.digest = g.digest AND f.doc_id = least GROUP BY 1, 2),
c AS (SELECT f.*, CASE WHEN f.doc_id > least AND n_bytes > 0 THEN least END AS copy_of, CASE WHEN f.doc_id > least AND n_bytes > 0 AND nulls = 0 THEN s END AS copy_source FROM f LEFT JOIN h USING (digest)),
j AS (SELECT *, CASE WHEN doc_id IS NULL THEN 'no_id' WHEN n_bytes = 0 THEN 'empty' WHEN copy_of IS NOT NULL THEN 'copy' WHEN coalesce(n_chars <> found_chars, true) THEN 'length' WHEN lang IS NULL OR source IS NULL THEN 'label' ELSE 'ok' END AS status FROM c)
SELECT doc_id, source, lang, n_chars, n_bytes, found_chars, digest, times, copy_of, copy_source, status, CASE WHEN status = 'ok' THEN CAST(dense_rank() OVER (PARTITION BY status ORDER BY doc_id) - 1 AS BIGINT) END AS z FROM j""",
    "job2_preview_statistics": """WITH e AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS tile, CASE WHEN isfinite(value) THEN value END AS v FROM events), b AS (SELECT *, CAST(floor(v) AS BIGINT) AS bin FROM e),
h AS (SELECT day, tile, bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY 1, 2, 3), u AS (SELECT *, sum(n) OVER (PARTITION BY day, tile ORDER BY bin) AS up, sum(n) OVER (PARTITION BY day, tile) AS every FROM h),
p AS (SELECT day, tile, min(bin) FILTER (WHERE up >= 0.05::DOUBLE * every)::DOUBLE AS p5, min(bin) FILTER (WHERE up >= 0.5::DOUBLE * every)::DOUBLE AS p50, min(bin) FILTER (WHERE up >= 0.95::DOUBLE * every)::DOUBLE AS p95 FROM u GROUP BY 1, 2),
s AS (SELECT day, tile, count(v) AS n, count(*) - count(v) AS n_missing, round(avg(v), 6) AS mean, round(stddev_pop(v), 4) AS std, round(min(v), 6) AS low, round(max(v), 6) AS high FROM b GROUP BY 1, 2)
SELECT s.day, s.tile, n, n_missing, mean, low, high, p5, p50, p95, std FROM s LEFT JOIN p ON p.day IS NOT DISTINCT FROM s.day AND p.tile IS NOT DISTINCT FROM s.tile""",
}
