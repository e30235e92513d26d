"""Join operators. Names of columns are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cuts import cut, dealt


def required_left(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left rows with their right row and the flag `unmatched`; the right side has one row for each key at most."""
    return left.join(right.withColumn("_m", F.lit(True)), on, "left").withColumn("unmatched", F.col("_m").isNull()).drop("_m")


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row: empty before a many-to-one join."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def pairs_within(df: DataFrame, group: list[str], order: list[str], keep: list[str], names=("a", "b")) -> DataFrame:
    """Pairs of rows of one group, the first before the second in `order`. Groups are small (tiles of a slice)."""
    a = df.select(*group, *[F.col(c).alias(f"{c}_{names[0]}") for c in dict.fromkeys([*order, *keep])])
    b = df.select(*group, *[F.col(c).alias(f"{c}_{names[1]}") for c in dict.fromkeys([*order, *keep])])
    less = F.struct(*[f"{c}_{names[0]}" for c in order]) < F.struct(*[f"{c}_{names[1]}" for c in order])
    return a.join(b, group).filter(less)


def cells(lo: str | Column, hi: str | Column, size: float) -> Column:
    """Numbers of the cells of a size that an interval meets."""
    first, last = (F.floor((F.col(c) if isinstance(c, str) else c) / size) for c in (lo, hi))
    return F.sequence(first, F.greatest(first, last))


def overlapping(a: DataFrame, b: DataFrame, on: list[str], box_a: tuple, box_b: tuple, cell: tuple[float, float], least: float = 0.0) -> DataFrame:
    """Pairs whose boxes (x0, y0, x1, y1) meet in at least `least` of either axis, with the common box.

    Boxes meet in the cells of a grid that they cover (choose cells about as large as boxes); a pair comes from the cell that
    holds the common box's corner, so it comes once."""
    def dealt(df, box, x, y):
        return df.withColumn(x, F.explode(cells(box[0], box[2], cell[0]))).withColumn(y, F.explode(cells(box[1], box[3], cell[1])))

    j = dealt(a, box_a, "_cx", "_cy").join(dealt(b, box_b, "_cx", "_cy"), [*on, "_cx", "_cy"])
    lo = [F.greatest(box_a[i], box_b[i]) for i in (0, 1)]
    hi = [F.least(box_a[i], box_b[i]) for i in (2, 3)]
    j = j.withColumns({"ox0": lo[0], "oy0": lo[1], "ox1": hi[0], "oy1": hi[1]}).filter((F.col("ox1") - F.col("ox0") >= least) & (F.col("oy1") - F.col("oy0") >= least))
    return j.filter((F.floor(F.col("ox0") / cell[0]) == F.col("_cx")) & (F.floor(F.col("oy0") / cell[1]) == F.col("_cy"))).drop("_cx", "_cy")


def inside(points: DataFrame, boxes: DataFrame, on: list[str], at: str, lo: str, hi: str, cell: float) -> DataFrame:
    """Pairs of a point and a half-open interval lo <= at < hi of one key; both meet in cells of a size."""
    p = points.withColumn("_cell", F.floor(F.col(at) / cell))
    b = boxes.withColumn("_cell", F.explode(cells(lo, hi, cell)))
    return p.join(b, [*on, "_cell"]).filter((F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi))).drop("_cell")


def band(df: DataFrame, k: int, order, by: list[str], carry: list[str]) -> DataFrame:
    """Each row with its next k rows by position: one shuffle, no self join."""
    w = W.partitionBy(*by).orderBy(*order)
    nxt = F.array(*[F.when(F.lead(F.lit(1), i).over(w).isNotNull(), F.struct(F.lit(i).alias("step"), *[F.lead(c, i).over(w).alias(f"{c}_b") for c in carry])) for i in range(1, k + 1)])
    return df.withColumn("_n", nxt).withColumn("_n", F.explode("_n")).filter("_n IS NOT NULL").select("*", "_n.*").drop("_n")


def bracketed(points: DataFrame, samples: DataFrame, at: str, value: str, by: list[str]) -> DataFrame:
    """As-of join from both sides: for each point the sample at or before it and the one at or after it.

    One sort of the union of both sides; no range join."""
    s = samples.select(*by, F.col(at).alias("_x"), F.col(value).alias("_v"), F.lit(0).alias("_k"))
    p = points.select(*by, F.col(at).alias("_x"), F.lit(None).cast(samples.schema[value].dataType).alias("_v"), F.lit(1).alias("_k"))
    both = s.unionByName(p).withColumn("_xs", F.when(F.col("_k") == 0, F.col("_x")))
    back = W.partitionBy(*by).orderBy("_x", "_k").rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*by).orderBy("_x", F.desc("_k")).rowsBetween(0, W.unboundedFollowing)
    out = both.withColumns({"x_before": F.last("_xs", True).over(back), "v_before": F.last("_v", True).over(back), "x_after": F.first("_xs", True).over(ahead), "v_after": F.first("_v", True).over(ahead)})
    return out.filter("_k = 1").withColumnRenamed("_x", at).drop("_v", "_k", "_xs")


def interpolated(points: DataFrame, samples: DataFrame, at: str, value: str, by: list[str], out: str = "v") -> DataFrame:
    """Linear interpolation between samples, ends held."""
    j = bracketed(points, samples, at, value, by)
    span = F.col("x_after") - F.col("x_before")
    lerp = F.col("v_before") + (F.col("v_after") - F.col("v_before")) * (F.col(at) - F.col("x_before")) / span
    return j.withColumn(out, F.when(F.col("x_before").isNull(), F.col("v_after")).when(F.col("x_after").isNull(), F.col("v_before")).when(span == 0, F.col("v_before")).otherwise(lerp)).select(*by, at, out)


def crossing(pairs: DataFrame, lo: str, hi: str, cuts: DataFrame, cut: str, on: list[str]) -> DataFrame:
    """Pairs that straddle a cut: lo < cut <= hi. The cuts of a key are gathered (few), so pairs are not multiplied."""
    few = cuts.groupBy(*on).agg(F.collect_set(cut).alias("_c"))
    return pairs.join(few, on).filter(F.exists("_c", lambda c: (F.col(lo) < c) & (F.col(hi) >= c))).drop("_c")


def compared(a: DataFrame, b: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Two runs side by side: name_a, name_b and their ratio."""
    x = a.select(*on, *[F.col(v).alias(f"{v}_a") for v in values])
    y = b.select(*on, *[F.col(v).alias(f"{v}_b") for v in values])
    return x.join(y, on).withColumns({f"{v}_ratio": F.col(f"{v}_b") / F.col(f"{v}_a") for v in values})


def differences(a: DataFrame, b: DataFrame, key: str, checks: list[str]) -> DataFrame:
    """Keys with what is wrong: missing (only in a), extra (only in b) or the first check that differs."""
    x = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in checks]).withColumn("_a", F.lit(True))
    y = b.select(key, *[F.col(c).alias(f"_b_{c}") for c in checks]).withColumn("_b", F.lit(True))
    why: Column = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra")
    for c in checks:
        why = why.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), c)
    return x.join(y, key, "full_outer").select(key, why.alias("problem")).filter("problem IS NOT NULL")


def same_rows(new: DataFrame, old: DataFrame, columns: list[str], frame: str) -> DataFrame:
    """New rows equal to an old row in all columns (nulls equal): new frame -> smallest old frame.

    Old rows that are equal are one row before the join, so a new row meets one row at most."""
    a, b = new.alias("a"), old.groupBy(*columns).agg(F.min(frame).alias(frame)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])
    return a.join(b, same).groupBy(F.col(f"a.{frame}").alias("frame")).agg(F.min(f"b.{frame}").alias("old_frame"))


def nearest_two(a: DataFrame, b: DataFrame, id_: str, vector: str, ratio: float, block: int = 2048) -> DataFrame:
    """Exact two nearest neighbours of each row of a in b (L2), kept when the nearer is clearly nearer.

    Both sides are packed into blocks by size; a pair of blocks yields two rows for each row of a at most, by one product
    of matrices, and distances of the rows that can still be among the two are taken anew, term by term."""
    import numpy as np
    import pandas as pd

    def packed(df, name):
        n = max(1, -(-df.count() // block))
        rows = df.select((F.pmod(F.xxhash64(id_), F.lit(n)).cast("int")).alias(name), F.col(id_).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
        return n, rows.repartition(n, name)

    def to_block(name):
        def run(pdf):
            return pd.DataFrame({name: [pdf[name].iloc[0]], f"ids_{name}": [pdf["id"].to_numpy(np.int64).tobytes()], f"data_{name}": [np.stack(pdf["v"].to_numpy()).astype(np.float64).tobytes()]})

        return run

    _, rows_a = packed(a, "p")
    n_b, rows_b = packed(b, "q")
    blocks_a = rows_a.groupBy("p").applyInPandas(to_block("p"), "p int, ids_p binary, data_p binary").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_b - 1))))
    blocks_b = rows_b.groupBy("q").applyInPandas(to_block("q"), "q int, ids_q binary, data_q binary")

    def near(batches):
        for pdf in batches:
            for ids_p, data_p, ids_q, data_q in zip(pdf["ids_p"], pdf["data_p"], pdf["ids_q"], pdf["data_q"]):
                i, j = np.frombuffer(ids_p, np.int64), np.frombuffer(ids_q, np.int64)
                x, y = np.frombuffer(data_p).reshape(len(i), -1), np.frombuffer(data_q).reshape(len(j), -1)
                xx, yy = (x * x).sum(1), (y * y).sum(1)
                d2 = xx[:, None] + yy - 2 * (x @ y.T)
                slack = 1e-9 * (xx[:, None] + yy)
                second = np.partition(d2 + slack, 1, axis=1)[:, 1:2] if len(j) > 1 else np.full((len(i), 1), np.inf)
                r, c = np.nonzero(d2 - slack <= second)
                yield pd.DataFrame({"a": i[r], "b": j[c], "d": ((x[r] - y[c]) ** 2).sum(1)})

    met = blocks_a.join(blocks_b, "q").select("ids_p", "data_p", "ids_q", "data_q").mapInPandas(near, "a long, b long, d double")
    near_two = met.withColumn("k", F.row_number().over(W.partitionBy("a").orderBy("d", "b"))).filter("k <= 2")
    both = near_two.groupBy("a").agg(F.min(F.when(F.col("k") == 1, F.col("b"))).alias("b"), F.min(F.when(F.col("k") == 1, F.sqrt("d"))).alias("d1"), F.min(F.when(F.col("k") == 2, F.sqrt("d"))).alias("d2"))
    return both.filter(F.col("d1") < ratio * F.col("d2"))


def components(edges: DataFrame, nodes: DataFrame, a: str, b: str, node: str) -> DataFrame:
    """(node, component): the smallest node connected to each.

    The graph shrinks as it goes: in each round every node hooks onto its smallest neighbour, hooks are followed to their
    ends, and edges between the ends are all that is left. Each round at least halves the nodes that have edges. All tables
    are dealt out by their rows, so what a task holds does not grow."""
    given = cut(edges.select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v")).filter("_u <> _v"))
    ends, levels = cut(dealt(given, given.count(), "_u", "_v").distinct()), []
    while rows := ends.count():
        both = ends.unionByName(ends.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        hook = cut(dealt(both, 2 * rows, "_u").groupBy("_u").agg(F.least(F.col("_u"), F.min("_v")).alias("_h")))  # never upwards, so hooks make no rings
        hooks = hook.count()
        while True:
            onward = dealt(hook.select(F.col("_u").alias("_h"), F.col("_h").alias("_hh")), hooks, "_h")
            new = cut(dealt(hook, hooks, "_h").join(onward, "_h").select("_u", F.col("_hh").alias("_h"), (F.col("_hh") != F.col("_h")).alias("_moved")))
            hook = new.drop("_moved")
            if new.filter("_moved").isEmpty():
                break
        levels.append((hook, hooks))
        to = hook.select(F.col("_u").alias("_v"), F.col("_h").alias("_y"))
        most = max(rows, hooks)
        left = dealt(ends, most, "_u").join(dealt(hook.withColumnRenamed("_h", "_x"), most, "_u"), "_u")
        left = dealt(left, most, "_v").join(dealt(to, most, "_v"), "_v").filter("_x <> _y")
        ends = cut(dealt(left.select(F.greatest("_x", "_y").alias("_u"), F.least("_x", "_y").alias("_v")), rows, "_u", "_v").distinct())
    out = nodes.select(F.col(node).alias("_n"))
    out = cut(dealt(out, out.count(), "_n").distinct().withColumn("_c", F.col("_n")))
    rows = out.count()
    for hook, hooks in levels:
        most = max(rows, hooks)
        told = dealt(hook.select(F.col("_u").alias("_c"), "_h"), most, "_c")
        out = dealt(out, most, "_c").join(told, "_c", "left").select("_n", F.coalesce("_h", "_c").alias("_c"))
    return out.select(F.col("_n").alias(node), F.col("_c").alias("component"))
