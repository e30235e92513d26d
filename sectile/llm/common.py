"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a function sees at once. Spark ends a batch at 64 MB (spark.sql.execution.arrow.maxBytesPerBatch), so no setting is needed.
TEXT_BATCH = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the cluster names. Where none is set, a local one, in local mode only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return found or "file:///tmp/sectile-checkpoints"


#: Tables that go when the driver's Python ends; for each thread, those of the only_last() calls that are running.
_WRITTEN: dict[str, SparkSession] = {}
_OPEN = threading.local()


def _remove(spark: SparkSession, path: str) -> None:
    _WRITTEN.pop(path, None)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _remove_written() -> None:
    for path, spark in list(_WRITTEN.items()):
        with contextlib.suppress(Exception):  # its Spark may be gone
            _remove(spark, path)


atexit.register(_remove_written)


def only_last(make: Callable[[], DataFrame]) -> DataFrame:
    """cut(make()), after which the tables that make() wrote on the way are removed."""
    outer, _OPEN.paths = getattr(_OPEN, "paths", None), []
    try:
        out = cut(make())
        *between, last = _OPEN.paths
    finally:
        _OPEN.paths = outer
    if outer is not None:
        outer.append(last)
    for path in between:
        _remove(out.sparkSession, path)
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables that cut() wrote, once everything made from them is written itself."""
    for t in tables:
        path = t.sectile_path
        if path in (getattr(_OPEN, "paths", None) or ()):
            _OPEN.paths.remove(path)
        _remove(t.sparkSession, path)


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from there; survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/sectile-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.sectile_path = path
    return out


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """mapInArrow where fn turns one batch into dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in _pieces(batches, TEXT_BATCH):
            for cols in fn(b):
                yield to_batch(cols, arrow)

    return df.mapInArrow(run, schema)


def arrow_fold(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: T.StructType, rows: int = TEXT_BATCH) -> DataFrame:
    """mapInArrow where fn turns the batches of a partition, of `rows` rows at most, into dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for cols in fn(_pieces(batches, rows)):
            yield to_batch(cols, arrow)

    return df.mapInArrow(run, schema)


def to_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cols[f.name] if isinstance(cols[f.name], pa.Array) else pa.array(cols[f.name], type=f.type) for f in schema], schema=schema)


def int_lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """values, cut before each of starts (the first is 0)."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values.astype(np.int32)))


def ids_and_texts(b: pa.RecordBatch, key: str = "doc_id", text: str = "text") -> tuple[list, list[str]]:
    return b.column(key).to_pylist(), [x or "" for x in b.column(text).to_pylist()]


def place(df: DataFrame, name: str) -> int:
    """Position of the column of that name: the one spelt so, else the first that differs in case only."""
    names = df.columns
    for i, c in enumerate(names):
        if c == name:
            return i
    for i, c in enumerate(names):
        if c.lower() == name.lower():
            return i
    raise ValueError(f"missing column: {name}")


def _numbered(df: DataFrame) -> list[str]:
    return [f"c{i}" for i in range(len(df.columns))]


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, under these names; extra columns, clashing ones too, play no part."""
    at = [place(df, n) for n in names]
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*(F.col(quoted(df.columns[i])).alias(n) for i, n in zip(at, names)))
    return df.toDF(*_numbered(df)).select(*(F.col(f"c{i}").alias(n) for i, n in zip(at, names)))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rolled(df: DataFrame, **names: str) -> DataFrame:
    """(row, and a column for each of names): row holds all columns of df by number, so that no name can clash."""
    plain = df.toDF(*_numbered(df))
    return plain.select(F.struct(*plain.columns).alias("row"), *(F.col(f"c{place(df, n)}").alias(k) for k, n in names.items()))


def unrolled(rows: DataFrame, like: DataFrame, **changed: str) -> DataFrame:
    """The columns of `like` from `row`; those of changed (column of like = column of rows) are replaced."""
    new = {place(like, k): v for k, v in changed.items()}
    return rows.select(*(F.col(new.get(i, f"row.c{i}")).alias(f"c{i}") for i in range(len(like.columns)))).toDF(*like.columns)


# Arrays as bytes: byte planes (so that equal high bytes lie together), then zstd.


def pack(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a)
    planes = raw.view(np.uint8).reshape(-1, raw.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).reshape(-1)


def squeeze(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


# Hashes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int, base: int, key: str) -> np.ndarray:
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        m = max(n, 1 << 16)
        out = np.empty(m, np.uint64)
        out[0] = 1
        k = 1
        while k < m:
            step = np.uint64(pow(base, k, 1 << 64))
            take = min(k, m - k)
            out[k : k + take] = out[:take] * step
            k += take
        _POWERS[key] = have = out
    return have[:n]


#: Bytes hashed at once: bounds the arrays of 8 bytes per text byte.
_SLAB = 1 << 20


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs outside [\\x20\\x09-\\x0D]."""
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the byte spans (sorted, not overlapping); they depend on nothing but the bytes and the length."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _SLAB, side="right")))
        hi = int(ends[j - 1])
        n = hi - lo
        cum = np.zeros(n + 1, np.uint64)
        np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * _powers(n, _P, "p"), out=cum[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        h = (cum[e] - cum[s]) * _powers(n, _P_INV, "i")[s]
        out[i:j] = mix(h ^ mix((e - s).astype(np.uint64)))
        i = j
    return out


def bucket_count(rows: float, per_bucket: float, least: int = 12) -> int:
    """Buckets of per_bucket each, however many."""
    return int(max(least, -(-rows // per_bucket)))
