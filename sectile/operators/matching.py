"""Matches of keypoints between images: a search from coarse to fine for pairs, and matching again around a prediction.

Keypoints are rows of one table; images are never read here. All gates are joins and group aggregates, so pairs and
slices of any number are spread. Keypoints are dealt out by image, then by pair, to as many tasks as their number needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuts import cut, dealt

#: How stiff the plane of a few matches is, in squares of a cell.
STIFF = 0.3


def unique_words(keypoints: DataFrame, image: list[str]) -> DataFrame:
    """Keypoints whose descriptor word occurs once in their image: the others can't be told apart."""
    once = keypoints.groupBy(*image, "word").agg(F.count(F.lit(1)).alias("_n"), F.first("x").alias("x"), F.first("y").alias("y")).filter("_n = 1")
    return once.select(*image, "word", "x", "y")


def voted_offsets(words: DataFrame, pairs: DataFrame, by: list[str], bin_: float, rows: int | None = None) -> DataFrame:
    """by, a, b, dx, dy, n: for each pair of tiles the displacement that most common words agree on.

    words: unique_words of (by, tile); pairs: by, a, b; rows: of the words that the pairs see, about. Words vote for a bin of
    displacements; the bin and its eight neighbours with most votes win (ties to the smaller bin), and the mean of their
    displacements is the offset."""
    sides = pairs.select(*by, "a", "b").distinct().select(*by, "a", "b", F.explode(F.array(*[F.struct(F.col(c).alias("tile"), F.lit(k).alias("side")) for k, c in enumerate("ab")])).alias("_s")).select(*by, "a", "b", "_s.*")
    seen = words.filter("word IS NOT NULL").join(sides, [*by, "tile"]).select(*by, "a", "b", "word", "side", "x", "y")
    seen = seen if rows is None else dealt(seen, rows, *by, "a", "b")  # votes and winners need no other shuffle
    at = lambda c, k: F.max(F.when(F.col("side") == k, F.col(c)))
    met = seen.groupBy(*by, "a", "b", "word").agg((at("x", 0) - at("x", 1)).alias("dx"), (at("y", 0) - at("y", 1)).alias("dy"), F.min("side").alias("_l"), F.max("side").alias("_h")).filter("_l < _h")  # a word meets one word at most
    own = met.withColumns({"i": F.floor(F.col("dx") / bin_), "j": F.floor(F.col("dy") / bin_)}).groupBy(*by, "a", "b", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("dx").alias("sx"), F.sum("dy").alias("sy"))
    around = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in (-1, 0, 1) for q in (-1, 0, 1)]))
    spread = own.withColumn("_o", around).withColumns({"i": F.col("i") + F.col("_o.p"), "j": F.col("j") + F.col("_o.q")}).groupBy(*by, "a", "b", "i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy")))
    best = spread.groupBy(*by, "a", "b").agg(F.max_by(F.struct("n", "sx", "sy"), F.struct("n", (-F.col("i")).alias("i"), (-F.col("j")).alias("j"))).alias("m"))
    return best.select(*by, "a", "b", (F.col("m.sx") / F.col("m.n")).alias("dx"), (F.col("m.sy") / F.col("m.n")).alias("dy"), F.col("m.n").alias("n"))


def agreeing(found: DataFrame, known: DataFrame, z: str, window: int, tolerance: float, least: int = 2) -> DataFrame:
    """Finds with `agrees`: false where `least` and more finds of the same pair within `window` slices have a median that is
    farther than the tolerance in x or y, null where there are fewer. known: the finds to compare with (own slice aside)."""
    near = known.select("a", "b", F.explode(F.array(*[F.col(z) + k for k in range(-window, window + 1) if k])).alias(z), F.col("dx").alias("kx"), F.col("dy").alias("ky"))
    mid = near.groupBy("a", "b", z).agg(F.count(F.lit(1)).alias("_k"), F.percentile_approx("kx", 0.5).alias("_x"), F.percentile_approx("ky", 0.5).alias("_y"))  # 2 * window values at most
    apart = F.greatest(F.abs(F.col("dx") - F.col("_x")), F.abs(F.col("dy") - F.col("_y")))
    return found.join(mid, ["a", "b", z], "left").withColumn("agrees", F.when(F.col("_k") >= least, apart <= tolerance)).drop("_k", "_x", "_y")


def search_pairs(keypoints: DataFrame, pairs: DataFrame, z: str, levels: list[int], reach: float, tolerance: float, least: int = 6, window: int = 3) -> tuple[DataFrame, list[int]]:
    """(z, a, b, dx, dy, n, level, ok, reason) for each pair, and the size of the frontier at each level.

    keypoints: z, tile, level, word, x, y; pairs: z, a, b, ex, ey (the nominal displacement). At each level, coarse to
    fine, the pairs of the frontier are matched by the keypoints of that level. A pair is settled if `least` words agree, its
    displacement is within `reach` of the nominal one (plausible), and it agrees with the finds of the same pair in the
    slices around it, those settled before and those of this level. The others go on to the next level."""
    frontier, settled, sizes, last = cut(pairs.select(z, "a", "b", "ex", "ey")), None, [], None
    rows = {r["level"]: r["count"] for r in keypoints.groupBy("level").count().collect()}  # a row for each level
    for level in levels:
        sizes.append(frontier.count())
        if not sizes[-1]:
            break
        points = dealt(keypoints.filter(F.col("level") == level), rows.get(level, 0), z, "tile")
        tiles = frontier.select(z, F.explode(F.array("a", "b")).alias("tile")).groupBy(z, "tile").count().agg(F.avg("count")).first()[0] or 1.0
        found = voted_offsets(unique_words(points, [z, "tile"]), frontier, [z], tolerance * level, round(rows.get(level, 0) * tiles))
        found = found.join(frontier, [z, "a", "b"], "right").withColumn("level", F.lit(level))
        few = F.coalesce(F.col("n") < least, F.lit(True))
        off = F.greatest(F.abs(F.col("dx") - F.col("ex")), F.abs(F.col("dy") - F.col("ey"))) > reach
        found = cut(found.withColumn("reason", F.when(few, "few matches").when(off, "not plausible")))
        known = found.filter("reason IS NULL").select(z, "a", "b", "dx", "dy")
        known = known if settled is None else known.unionByName(settled.select(*known.columns))
        judged = agreeing(found, known, z, window, tolerance * level).withColumn("reason", F.coalesce("reason", F.when(~F.col("agrees"), "does not agree"))).drop("agrees")
        last = cut(judged)
        good = last.filter("reason IS NULL")
        settled = good if settled is None else settled.unionByName(good)
        frontier = last.filter("reason IS NOT NULL").select(z, "a", "b", "ex", "ey")
    rest = last.filter("reason IS NOT NULL")
    columns = [z, "a", "b", "dx", "dy", "n", "level"]
    out = settled.select(*columns, F.lit(True).alias("ok"), F.lit(None).cast("string").alias("reason")).unionByName(rest.select(*columns, F.lit(False).alias("ok"), "reason"))
    return out, sizes


def squared_distance(a: str, b: str) -> Column:
    """Of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def near_prediction(a: DataFrame, b: DataFrame, by: list[str], radius: float) -> DataFrame:
    """For each point of a (by, id, px, py, d) the point of b (by, id, x, y, d) within the radius of (px, py) whose
    descriptor is nearest, ties to the smaller id; and each point of b is given once, to its nearest.

    Points meet by cells as wide as the radius: a point of a looks into nine cells."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    around = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in (-1, 0, 1) for q in (-1, 0, 1)]))
    left = a.select(*by, F.col("id").alias("ia"), "px", "py", F.col("d").alias("da"), around.alias("o")).withColumns({"cx": cell("px") + F.col("o.p"), "cy": cell("py") + F.col("o.q")}).drop("o")
    right = b.select(*by, F.col("id").alias("ib"), "x", "y", F.col("d").alias("db")).withColumns({"cx": cell("x"), "cy": cell("y")})
    close = (F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2 <= radius * radius
    met = left.join(right, [*by, "cx", "cy"]).filter(close).select(*by, "ia", "ib", squared_distance("da", "db").alias("e"))
    one = met.groupBy(*by, "ia").agg(F.min(F.struct("e", "ib")).alias("m")).select(*by, "ia", F.col("m.ib").alias("ib"), F.col("m.e").alias("e"))
    return one.groupBy(*by, "ib").agg(F.min(F.struct("e", "ia")).alias("m")).select(*by, F.col("m.ia").alias("ia"), "ib", F.col("m.e").alias("e"))


def rematched(a: DataFrame, b: DataFrame, seeds: DataFrame, by: list[str], cell: float, radius: float, most: float, shrink: float = 0.75, rounds: int = 12) -> tuple[DataFrame, list[int]]:
    """(by, ia, ib, e) and the number of matches of each round: matching again, block by block, from a few sure matches.

    a, b: by, id, x, y, d; seeds: by, ia, ib. Displacements in a cell of a follow the plane that fits the matches of the cell
    and of the eight around it, so matches spread outward from the seeds. In each round every point that has such a plane looks
    for its like around where it should be, within a radius that shrinks; matches whose descriptors differ by more than
    `most` are left out. It ends when a round gains none."""
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    points = cut(a.withColumns({"cx": at("x"), "cy": at("y")}))
    targets = b.select(*by, F.col("id").alias("ib"), F.col("x").alias("bx"), F.col("y").alias("by_"))
    around = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in (-1, 0, 1) for q in (-1, 0, 1)]))
    middle_of = lambda name: [(F.col(c) / cell - F.col(k) - 0.5).alias(f"{name}{n}") for c, k, n in (("x", "cx", "u"), ("y", "cy", "v"))]
    middle = middle_of("")
    found, counts = seeds.select(*by, "ia", "ib", F.lit(0.0).alias("e")), []
    for k in range(rounds):
        at_a = found.join(points.select(*by, F.col("id").alias("ia"), "x", "y", "cx", "cy"), [*by, "ia"]).join(targets, [*by, "ib"])
        lent = at_a.withColumn("o", around).withColumns({"cx": F.col("cx") + F.col("o.p"), "cy": F.col("cy") + F.col("o.q")})
        lent = lent.select(*by, "cx", "cy", *middle, (F.col("bx") - F.col("x")).alias("dx"), (F.col("by_") - F.col("y")).alias("dy"))
        u, v = F.col("u"), F.col("v")
        sums = {"uu": u * u, "uv": u * v, "vv": v * v, **{f"{p}{q}": F.col(p) * F.col(q) for p in "uv" for q in ("dx", "dy")}}
        plane = lent.groupBy(*by, "cx", "cy").agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m_{c}") for c in ("u", "v", "dx", "dy")), *(F.avg(e).alias(c) for c, e in sums.items()))
        guess = points.join(plane, [*by, "cx", "cy"]).select(*by, "id", "x", "y", "d", "cx", "cy", "n", *[f"m_{c}" for c in ("u", "v", "dx", "dy")], *sums, *middle_of("here_"))
        cuu, cuv, cvv = F.col("uu") - F.col("m_u") ** 2 + STIFF / F.col("n"), F.col("uv") - F.col("m_u") * F.col("m_v"), F.col("vv") - F.col("m_v") ** 2 + STIFF / F.col("n")
        det = cuu * cvv - cuv * cuv

        def there(d):  # the plane through the displacements, at the point
            cu, cv = F.col(f"u{d}") - F.col("m_u") * F.col(f"m_{d}"), F.col(f"v{d}") - F.col("m_v") * F.col(f"m_{d}")
            return F.col(f"m_{d}") + (cu * cvv - cv * cuv) / det * (F.col("here_u") - F.col("m_u")) + (cv * cuu - cu * cuv) / det * (F.col("here_v") - F.col("m_v"))

        guess = guess.select(*by, "id", (F.col("x") + there("dx")).alias("px"), (F.col("y") + there("dy")).alias("py"), "d")
        new = cut(near_prediction(guess, b, by, max(radius * shrink**k, radius / 4)).filter(F.col("e") <= most))
        counts.append(new.count())
        if k and counts[-1] <= counts[-2]:
            return (new if counts[-1] == counts[-2] else found), counts
        found = new
    return found, counts

