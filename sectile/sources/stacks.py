"""Raw image stacks: a reader for contiguous TIFF stacks, listings with named groups, and content fingerprints."""

from __future__ import annotations

import glob
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThanOrEqual, InputPartition, LessThanOrEqual

#: Nanometres of the units that stack headers name.
UNITS = {"micron": 1000.0, "um": 1000.0, "µm": 1000.0, "nm": 1.0, "mm": 1_000_000.0, "cm": 10_000_000.0, "inch": 25_400_000.0}


def unit_nm(unit: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), unit)


def named_groups(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """A column for each named group of the pattern (Python syntax), and `matched`."""
    names = re.findall(r"\(\?P<(\w+)>", pattern)
    plain = re.sub(r"\(\?P<\w+>", "(", pattern)
    order = [re.compile(pattern).groupindex[n] for n in names]
    return df.withColumns({n: F.regexp_extract(col, plain, i) for n, i in zip(names, order)} | {"matched": F.col(col).rlike(plain)})


def fingerprint(content: str, size: int) -> Column:
    """md5 of the first, middle and last `size` characters; '-' for a constant sample."""
    c = F.col(content)
    parts = [F.substring(c, 1, size), F.substring(c, F.floor(F.length(c) / 2) + 1, F.lit(size)), F.right(c, F.lit(size))]
    return F.concat_ws(";", *[F.when(F.length(F.replace(p, F.right(p, F.lit(1)), F.lit(""))) == 0, F.lit("-")).otherwise(F.md5(p)) for p in parts])


def read_header(path: str) -> dict:
    """Header of an uncompressed, contiguous 16-bit stack: only the first directory is read."""
    with open(path, "rb") as f:
        head = f.read(8)
        end = {b"II": "<", b"MM": ">"}.get(head[:2])
        if end is None or struct.unpack(end + "H", head[2:4])[0] != 42:
            raise ValueError("not a TIFF stack")
        f.seek(struct.unpack(end + "I", head[4:8])[0])
        tags = {}
        for _ in range(struct.unpack(end + "H", f.read(2))[0]):
            tag, kind, n, raw = struct.unpack(end + "HHI4s", f.read(12))
            tags[tag] = (kind, n, raw)

        def number(tag, default=None):
            if tag not in tags:
                return default
            kind, _, raw = tags[tag]
            return struct.unpack(end + {3: "H", 4: "I", 1: "B"}[kind], raw[: {3: 2, 4: 4, 1: 1}[kind]])[0]

        text = ""
        if 270 in tags:
            _, n, raw = tags[270]
            if n > 4:
                f.seek(struct.unpack(end + "I", raw)[0])
                raw = f.read(n)
            text = raw[:n].rstrip(b"\0").decode("latin-1")
        count = int(dict(re.findall(r"(\w+)=(\S+)", text)).get("images", 1))
        unit = dict(re.findall(r"(\w+)=(\S+)", text)).get("unit")
        size = os.path.getsize(path)
        h, w, at = number(257), number(256), number(273)
        whole = max(0, min(count, (size - at) // (h * w * 2)))
        return {"file": path, "n_slices": count, "height": h, "width": w, "byteorder": end, "data_offset": at, "bits": number(258, 16), "complete": whole, "truncated": whole < count, "size_bytes": size, "unit": unit}


class _Block(InputPartition):
    def __init__(self, header: dict, first: int, last: int):
        self.header, self.first, self.last = header, first, last


class StackReader(DataSourceReader):
    """Slices of all stacks that match a path; slice ranges are pushed to the files, and rows and columns are options."""

    def __init__(self, options):
        self.options = options
        self.first, self.last = 0, 1 << 60

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("index",):
                self.first = max(self.first, f.value)
            elif isinstance(f, LessThanOrEqual) and f.attribute == ("index",):
                self.last = min(self.last, f.value)
            else:
                yield f

    def partitions(self):
        size = int(self.options.get("slices", 8))
        out = []
        for path in sorted(glob.glob(self.options["path"])):
            h = read_header(path)
            for a in range(0, h["complete"], size):
                lo, hi = max(a, self.first), min(a + size - 1, h["complete"] - 1, self.last)
                if lo <= hi:
                    out.append(_Block(h, lo, hi))
        return out or [_Block({}, 0, -1)]

    def read(self, part):
        h = part.header
        for i in range(part.first, part.last + 1):
            r0, r1 = int(self.options.get("row0", 0)), int(self.options.get("row1", h["height"]))
            c0, c1 = int(self.options.get("col0", 0)), int(self.options.get("col1", h["width"]))
            a = read_block(h, i, (r0, r1), (c0, c1))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((h["file"], i, r0, c0, r1 - r0, c1 - c0, a.tobytes()), (pa.string(), *[pa.int32()] * 5, pa.binary()))], ["file", "index", "row0", "col0", "h", "w", "pixels"])


def read_block(h: dict, i: int, rows: tuple[int, int], cols: tuple[int, int]) -> np.ndarray:
    """Part of slice i as little-endian 16-bit: one read for full rows, else a read for each row."""
    start = h["data_offset"] + i * h["height"] * h["width"] * 2
    n, w = rows[1] - rows[0], cols[1] - cols[0]
    with open(h["file"], "rb") as f:
        if w == h["width"]:
            f.seek(start + rows[0] * w * 2)
            raw = f.read(n * w * 2)
        else:
            parts = []
            for y in range(*rows):
                f.seek(start + (y * h["width"] + cols[0]) * 2)
                parts.append(f.read(w * 2))
            raw = b"".join(parts)
    if len(raw) != n * w * 2:
        raise OSError(f"{h['file']}: slice {i} ends early")
    return np.frombuffer(raw, h["byteorder"] + "u2").reshape(n, w).astype("<u2")


class StackSource(DataSource):
    """spark.dataSource.register(StackSource); spark.read.format("stack").load("/data/*.tif")"""

    @classmethod
    def name(cls):
        return "stack"

    def schema(self):
        return "file string, index int, row0 int, col0 int, h int, w int, pixels binary"

    def reader(self, schema):
        return StackReader(self.options)


def write_stack(path: str, slices: np.ndarray, unit: str = "nm") -> None:
    """A contiguous big-endian 16-bit stack, as acquisition software writes them."""
    n, h, w = slices.shape
    text = f"ImageJ=1.53\nimages={n}\nslices={n}\nunit={unit}\n".encode() + b"\0"
    tags = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, 16 << 16), (259, 3, 1, 1 << 16), (262, 3, 1, 1 << 16), (270, 2, len(text), 0), (273, 4, 1, 0), (277, 3, 1, 1 << 16), (278, 4, 1, h), (279, 4, 1, h * w * 2)]
    at = 8 + 2 + 12 * len(tags) + 4
    data = at + len(text)
    with open(path, "wb") as f:
        f.write(b"MM" + struct.pack(">HI", 42, 8) + struct.pack(">H", len(tags)))
        for tag, kind, count, value in tags:
            f.write(struct.pack(">HHII", tag, kind, count, at if tag == 270 else data if tag == 273 else value))
        f.write(struct.pack(">I", 0) + text + slices.astype(">u2").tobytes())
