"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_key(tile: str) -> Column:
    """'2-0' before '10-0': an array of numbers to sort by."""
    return F.transform(F.split(tile, "-"), lambda x: x.cast("int"))


def nice_length(x: Column) -> Column:
    """The largest 1, 2 or 5 times a power of ten that is at most x."""
    base = F.pow(F.lit(10.0), F.floor(F.log10(x)))
    return F.when(x >= 5 * base, 5 * base).when(x >= 2 * base, 2 * base).otherwise(base)


def ease(u: Column) -> Column:
    """Smooth step from 0 to 1."""
    v = F.least(F.greatest(u, F.lit(0.0)), F.lit(1.0))
    return v * v * (3 - 2 * v)


def morton(x: Column, y: Column, z: Column, bits: int) -> Column:
    """Interleaved bits of three coordinates, x lowest."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for k, c in enumerate((x, y, z)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), 3 * b + k))
    return out


def size_text(n: Column, top: str = "GB") -> Column:
    """Bytes in words, tenths cut off; `top` (MB or GB) is the largest unit."""

    def tenths(unit: int) -> Column:
        return F.floor(n / float(unit) * 10) / 10.0

    big = F.when((n >= 1 << 30) & F.lit(top == "GB"), F.format_string("%.1f GB", tenths(1 << 30))).when(n >= 1 << 20, F.format_string("%.1f MB", tenths(1 << 20)))
    return big.when(n >= 1 << 10, F.format_string("%.1f kB", tenths(1 << 10))).otherwise(F.format_string("%d B", n.cast("long")))


def to_grey(v: Column, lo: Column, hi: Column) -> Column:
    """0 ... 255 within the window, cut off below the point."""
    return F.least(F.greatest((v - lo) * 255 / (hi - lo), F.lit(0.0)), F.lit(255.0)).cast("int")


def clipped_round(x: Column) -> Column:
    """To the nearest whole number, halves to even."""
    return F.bround(x)


def outside_domain(df, domains: dict[str, tuple], keys: list[str]):
    """(keys, setting, value, allowed) of values outside their domain; nulls are outside."""
    from functools import reduce

    wrong = [df.filter(~F.coalesce(F.col(c).isin(*allowed), F.lit(False))).select(*keys, F.lit(c).alias("setting"), F.col(c).cast("string").alias("value"), F.lit(", ".join(map(str, allowed))).alias("allowed")) for c, allowed in domains.items()]
    return reduce(lambda a, b: a.unionByName(b), wrong)


def percentile_name(percent, tissue: bool = False):
    """0.5 -> p0_5; of tissue 5 -> t_p5."""
    plain = F.regexp_replace(percent.cast("double").cast("string"), r"\.0$", "")
    return F.concat(F.lit("t_p" if tissue else "p"), F.replace(plain, F.lit("."), F.lit("_")))


def stale_parents(children, made, parent: str, changed: str, when: str):
    """(parent, children, redo): parents that are not made, or were made before the newest change of what they come from."""
    newest = children.groupBy(parent).agg(F.count(F.lit(1)).alias("children"), F.max(changed).alias("_newest"))
    return newest.join(made, parent, "left").select(parent, "children", (F.col(when).isNull() | (F.col(when) <= F.col("_newest"))).alias("redo"))


def seam_summary(df, z: str, a: str, b: str, values: list[str], cuts: list[int], large: float):
    """Per band of z: seams of tiles ("row-column") in one row or column, the median size of each value's median over a
    seam, and how many are over `large`."""
    row, column = (F.split(a, "-")[i] == F.split(b, "-")[i] for i in (0, 1))
    seams = df.filter(row | column).groupBy(z, a, b).agg(*[F.median(v).alias(v) for v in values])
    band = F.lit(f"{cuts[-1]}-")
    for lo, hi in reversed(list(zip([0, *cuts], cuts))):
        band = F.when(F.col(z) < hi, f"{lo}-{hi}").otherwise(band)
    out = [F.count(F.lit(1)).alias("seams")]
    for v in values:
        out += [F.median(F.abs(v)).alias(f"{v}_med"), F.count(F.when(F.abs(v) > large, 1)).alias(f"{v}_n{large:g}")]
    return seams.groupBy(band.alias("band")).agg(*out)


def mesh_camera(z, start, reveal, zoom, yaw_deg: float, tilt_deg: float, pull: float, focal: float):
    """(lowest plane shown or null, yaw, tilt, distance, plane looked at) of a frame at the cut z while meshes from `start`
    up to the cut are revealed (0 to 1)."""
    top = z + 0.5
    shown = start.isNotNull() & (top > start)
    part = F.coalesce(reveal, F.lit(0.0))
    look = top - F.when(shown, part * (top - start) / 2).otherwise(0.0)
    return F.when(shown, start), F.radians(F.lit(yaw_deg)) * part, F.radians(F.lit(tilt_deg)) * part, focal * zoom * (1 + (pull - 1) * part), look


def widened(lo: Column, hi: Column, black: float, white: float) -> tuple[Column, Column]:
    """The window under which the ends of lo to hi come out at the grey values black and white."""
    span = (hi - lo) * 255.0 / (white - black)
    start = lo - black / 255.0 * span
    return start, start + span


def turned(lo: Column, hi: Column, size: Column) -> tuple[Column, Column]:
    """The range lo to hi (not included) of an axis turned by half a turn."""
    return size - hi, size - lo
