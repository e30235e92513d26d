"""2 x 3 affine transforms as six columns a, b, tx, c, d, ty: (x, y) -> (a x + b y + tx, c x + d y + ty)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAMES = ("a", "b", "tx", "c", "d", "ty")


def columns(prefix: str = "") -> dict[str, Column]:
    return {n: F.col(prefix + n) for n in NAMES}


def compose(p: dict, q: dict) -> dict:
    """First q, then p."""
    return {
        "a": p["a"] * q["a"] + p["b"] * q["c"],
        "b": p["a"] * q["b"] + p["b"] * q["d"],
        "tx": p["a"] * q["tx"] + p["b"] * q["ty"] + p["tx"],
        "c": p["c"] * q["a"] + p["d"] * q["c"],
        "d": p["c"] * q["b"] + p["d"] * q["d"],
        "ty": p["c"] * q["tx"] + p["d"] * q["ty"] + p["ty"],
    }


def invert(p: dict) -> dict:
    det = p["a"] * p["d"] - p["b"] * p["c"]
    out = {"a": p["d"] / det, "b": -p["b"] / det, "c": -p["c"] / det, "d": p["a"] / det}
    return out | {"tx": -(out["a"] * p["tx"] + out["b"] * p["ty"]), "ty": -(out["c"] * p["tx"] + out["d"] * p["ty"])}


def apply(p: dict, x: Column, y: Column) -> tuple[Column, Column]:
    return p["a"] * x + p["b"] * y + p["tx"], p["c"] * x + p["d"] * y + p["ty"]


def is_translation(p: dict) -> Column:
    return (F.abs(p["a"] - 1) < 1e-12) & (F.abs(p["d"] - 1) < 1e-12) & (F.abs(p["b"]) < 1e-12) & (F.abs(p["c"]) < 1e-12)


def bbox(p: dict, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    """Of the image of the rectangle (0, 0, w, h)."""
    zero = F.lit(0.0)
    corners = [apply(p, x, y) for x in (zero, w) for y in (zero, h)]
    xs, ys = zip(*corners)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def snapped(p: dict) -> dict:
    """Shifts of pure translations to whole pixels."""
    t = is_translation(p)
    return p | {k: F.when(t, F.floor(p[k] + 0.5).cast("double")).otherwise(p[k]) for k in ("tx", "ty")}
