"""Small file formats and helpers around them."""

from __future__ import annotations

import io
import os
import re
import struct
import tempfile
import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def atomic_write(path: str, write: Callable[[str], None]) -> None:
    """write(temporary path), then rename; nothing is left behind on failure."""
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)), prefix=".part-")
    os.close(fd)
    try:
        write(tmp)
        mask = os.umask(0)
        os.umask(mask)
        os.chmod(tmp, 0o666 & ~mask)
        os.replace(tmp, path)
    except BaseException:
        os.unlink(tmp)
        raise


def png(image: np.ndarray) -> bytes:
    """8-bit grey or RGB."""
    h, w = image.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(image, np.uint8))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def ply(points: np.ndarray, faces: np.ndarray) -> bytes:
    """A triangle mesh, binary little-endian."""
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {len(points)}\nproperty float x\nproperty float y\nproperty float z\nelement face {len(faces)}\nproperty list uchar int vertex_indices\nend_header\n"
    body = np.zeros(len(faces), [("n", "u1"), ("i", "<i4", 3)])
    body["n"], body["i"] = 3, faces
    return head.encode() + points.astype("<f4").tobytes() + body.tobytes()


def byte_range(header: str, size: int) -> tuple[int, int] | None:
    """First and last byte of a single-range request; None if it can't be met."""
    m = re.fullmatch(r"bytes=(\d*)-(\d*)", header.strip())
    if not m or not (m[1] or m[2]):
        return None
    if not m[1]:
        lo, hi = max(0, size - int(m[2])), size - 1
    else:
        lo, hi = int(m[1]), min(int(m[2]) if m[2] else size - 1, size - 1)
    return (lo, hi) if lo <= hi else None


def precomputed_info(shape: tuple[int, int, int], voxel_nm: tuple[float, float, float], scales: int, chunk: int = 64) -> dict:
    """Metadata of a precomputed multiscale volume (x, y, z order)."""
    out = []
    for s in range(scales):
        f = 2**s
        out.append({"key": "_".join(str(int(v * f)) for v in voxel_nm), "size": [-(-n // f) for n in shape], "resolution": [v * f for v in voxel_nm], "chunk_sizes": [[chunk] * 3], "encoding": "raw", "voxel_offset": [0, 0, 0]})
    return {"type": "image", "data_type": "uint8", "num_channels": 1, "scales": out}


def local_files(root: str) -> dict[str, int]:
    """Sizes of all files below root, by relative path."""
    at = Path(root)
    return {f.relative_to(at).as_posix(): f.stat().st_size for f in sorted(at.rglob("*")) if f.is_file()}


def copy_ends(source: str, target: str) -> tuple[Path, Path]:
    """Both folders resolved; refused if the source is none, or if one of them is or holds the other."""
    a, b = Path(source).resolve(), Path(target).resolve()
    if not a.is_dir():
        raise ValueError(f"{source} is not a folder")
    if a == b or a in b.parents or b in a.parents:
        raise ValueError(f"{source} and {target} are one folder, or one lies in the other")
    return a, b


def write_chunks(df: DataFrame, folder: str, by: str, columns: list[str]) -> DataFrame:
    """One npz file for each value of `by` (a chunk of bounded size) in a folder that all executors share, written when the
    result (by, path, n) is read. A repeated task replaces its file; a null value of `by` is refused."""

    def put(key, pdf):
        if key[0] is None or key[0] != key[0]:
            raise ValueError(f"a chunk needs a value of {by}")
        path = f"{folder}/{key[0]}.npz"

        def save(tmp):
            with open(tmp, "wb") as f:
                np.savez_compressed(f, **{c: np.stack(pdf[c]) if len(pdf) and isinstance(pdf[c].iloc[0], (list, np.ndarray)) else pdf[c].to_numpy() for c in columns})

        atomic_write(path, save)
        return pd.DataFrame({by: [key[0]], "path": [path], "n": [len(pdf)]})

    return df.select(by, *(c for c in columns if c != by)).groupBy(by).applyInPandas(put, f"`{by}` {dict(df.dtypes)[by]}, path string, n long")


def read_chunks(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all npz files of a folder; the columns of schema are their arrays."""
    names = spark.createDataFrame([], schema).columns

    def rows(frames):
        for f in frames:
            for content in f["content"]:
                with np.load(io.BytesIO(content)) as z:
                    yield pd.DataFrame({c: list(z[c]) if z[c].ndim > 1 else z[c] for c in names})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("content").mapInPandas(rows, schema)
