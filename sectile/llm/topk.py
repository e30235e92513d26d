"""Exact top-k search by inner product with KD-trees per shard.

Vectors are integers: floor(256 x) of each component. They are dealt by a hash of their id into shards of about SHARD, or
more of them where there would be over MOST shards, up to LARGEST. A shard's tree splits at the median of its widest
dimension; each node has its tight bounding box and smallest id. For a query, the largest inner product with any point
of a box bounds what the box can give; the nodes are visited best bound first, until no bound reaches the kth score so
far. A query is first searched in its own shard; its kth score then goes with it to the others, where only what reaches
it comes back.

The query set is stated (ids divisible by a number). Queries travel in packed blocks, one row for each shard and block; a
shard's points travel once for each TASK_BLOCKS blocks, and its tree is built once there. As long as the root boxes of
all shards take ROOTS bytes at most they are broadcast, and a query goes only to shards whose box can reach its kth score.

Scores are exact: in float64 while no sum of products can reach 2**53, else in 64-bit integers, with bounds widened by
their rounding error; components for which a score would not fit 64 bits raise. Shorter vectors count as padded with
zeros. Vectors that are null or hold null or non-finite components take no part; rows with a null id neither. Repeated
rows are candidates each, but not for their own id, and ask once. Ties go to the smaller vec_id. Extra columns, clashing
ones too, play no part; an empty table has no hits.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, cut, only

SHARD, LEAF, BLOCK, SCALE = 4096, 128, 256, 256
#: Shards of SHARD vectors at most, vectors of a shard at most, query blocks that meet a tree in one task, bytes of root boxes to broadcast.
MOST, LARGEST, TASK_BLOCKS, ROOTS = 256, 1 << 18, 256, 16 << 20


class Tree:
    def __init__(self, ids: np.ndarray, points: np.ndarray):
        """points: [n, d] whole values, as float64 where all sums are exact in it, else as int64."""
        self.ids, self.points = ids, points
        points = points.astype(np.float64, copy=False)
        order = np.arange(len(ids))
        self.low, self.high, self.least, self.part, self.below = [], [], [], [], []
        todo = [(order, None)]
        while todo:
            mine, parent = todo.pop()
            node = len(self.part)
            if parent is not None:
                self.below[parent].append(node)
            x = points[mine]
            lo, hi = x.min(0), x.max(0)
            self.low.append(lo)
            self.high.append(hi)
            self.least.append(int(ids[mine].min()))
            self.below.append([])
            self.part.append(None)
            wide = int(np.argmax(hi - lo)) if x.shape[1] else 0
            if len(mine) <= LEAF:
                self.part[node] = mine
                continue
            half = len(mine) // 2
            by = np.argpartition(x[:, wide], half) if x.shape[1] else np.arange(len(mine))
            todo += [(mine[by[:half]], node), (mine[by[half:]], node)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def search(self, ids: np.ndarray, queries: np.ndarray, best: list[list[tuple]], k: int) -> None:
        """best: for each query a list of (-score, id) in order, at most k; grows in place."""
        bound = box_reach(queries, self.low, self.high)
        for i, q in enumerate(queries):
            mine, b = best[i], bound[i].tolist()
            heap = [(-b[0], 0)]
            while heap:
                up, node = heapq.heappop(heap)
                if len(mine) == k:
                    if up > mine[-1][0]:
                        break
                    if up == mine[-1][0] and self.least[node] > mine[-1][1]:
                        continue  # could only tie with larger ids
                part = self.part[node]
                if part is None:
                    for c in self.below[node]:
                        heapq.heappush(heap, (-b[c], c))
                    continue
                s = self.points[part] @ q
                own = self.ids[part]
                ok = own != ids[i]
                if len(mine) == k:
                    ok &= s >= -mine[-1][0]
                s, own = s[ok], own[ok]
                if len(s) > k:
                    top = np.lexsort((own, -s))[:k]
                    s, own = s[top], own[top]
                mine += zip((-s.astype(np.int64)).tolist(), own.tolist())
                mine.sort()
                del mine[k:]


def box_reach(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with any point of each box [boxes, d], from above."""
    q = queries.astype(np.float64, copy=False)
    out = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    if queries.dtype != np.float64:  # sums may be rounded
        out += np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T * (4 + q.shape[1]) * 2.0**-52
    return out


_L, _I, _B = T.LongType(), T.IntegerType(), T.BinaryType()
_PACKED = T.StructType([T.StructField("shard", _I), T.StructField("is_query", T.BooleanType()), T.StructField("ids", _B), T.StructField("points", _B), T.StructField("best", _B), T.StructField("box", _B)])
_SENT = T.StructType([T.StructField("to", _I), T.StructField("part", _I), T.StructField("is_query", T.BooleanType()), T.StructField("ids", _B), T.StructField("points", _B), T.StructField("best", _B)])
_HITS = T.StructType([T.StructField("query_id", _L), T.StructField("vec_id", _L), T.StructField("score", _L)])


def _rows_of(b, d: int) -> np.ndarray:
    """The list column v as [rows, d], padded with zeros."""
    lists = b.column("v")
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), d), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = lists.flatten().to_numpy()
    return out


def _hits(ids: np.ndarray, found: list[list[tuple]]) -> dict:
    rows = [(i, x, -s) for i, m in zip(ids.tolist(), found) for s, x in m]
    return dict(zip(_HITS.names, zip(*rows))) if rows else {}


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by `every`, against all rows."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    v = only(vectors, key, vector).filter(F.col(key).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("id"), whole.alias("v"))
    most_of = F.max(F.greatest(F.lit(0).cast("long"), F.array_max(F.transform("v", lambda x: F.abs(x)))))
    n, d, largest = (int(x or 0) for x in v.agg(F.count(F.lit(1)), F.max(F.size("v")), most_of).first())
    if d * largest * largest >= 1 << 63:
        raise ValueError("scores of these components don't fit 64 bits")
    kind = np.float64 if d * largest * largest < 1 << 53 else np.int64
    stored = np.int32 if largest < 1 << 31 else np.int64
    shards = max(1, min(-(-n // SHARD), MOST), -(-n // LARGEST))
    dealt = v.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartition(shards, "shard")

    def stored_as(x: np.ndarray) -> bytes:
        return x.astype(stored).tobytes()

    def read(ids: bytes, points: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = np.frombuffer(ids, np.int64)
        return own, np.frombuffer(points, stored).reshape(len(own), d).astype(kind)

    def best_as(best: list[list[tuple]]) -> bytes:
        return np.array([y for m in best for hit in (m + [(0, -1)] * (k - len(m))) for y in hit] + [len(m) for m in best], np.int64).tobytes()

    def read_best(data: bytes, n_queries: int) -> list[list[tuple]]:
        a = np.frombuffer(data, np.int64)
        hits, sizes = a[: 2 * k * n_queries].reshape(n_queries, k, 2).tolist(), a[2 * k * n_queries :].tolist()
        return [[tuple(h) for h in m[:size]] for m, size in zip(hits, sizes)]

    def build(batches):
        held: dict[int, list] = {}
        for b in batches:
            shard, ids, x = b.column("shard").to_numpy(), b.column("id").to_numpy(), _rows_of(b, d).astype(stored)
            for s in np.unique(shard).tolist():
                held.setdefault(s, []).append((ids[shard == s], x[shard == s]))
        for s in list(held):
            own, x = map(np.concatenate, zip(*held.pop(s)))
            x = x.astype(kind)
            tree = Tree(own, x)
            yield {"shard": [s], "is_query": [False], "ids": [own.tobytes()], "points": [stored_as(x)], "best": [None], "box": [np.stack((tree.low[0], tree.high[0])).tobytes()]}
            asked = np.flatnonzero(own % every == 0)
            asked = asked[np.sort(np.unique(own[asked], return_index=True)[1])]  # repeated rows ask once
            for a in range(0, len(asked), BLOCK):
                q = asked[a : a + BLOCK]
                best = [[] for _ in q]
                tree.search(own[q], x[q], best, k)
                yield {"shard": [s], "is_query": [True], "ids": [own[q].tobytes()], "points": [stored_as(x[q])], "best": [best_as(best)], "box": [None]}

    packed = cut(arrow_fold(dealt, build, _PACKED))
    queries = packed.filter("is_query")
    n_blocks = queries.count()
    parts = -(-n_blocks // TASK_BLOCKS) or 1
    boxes = None
    if shards * d * 16 <= ROOTS:
        found = packed.filter("NOT is_query").select("shard", "box").collect()  # ROOTS bytes at most
        boxes = {r.shard: np.frombuffer(r.box, np.float64).reshape(2, d) for r in found}

    def own_hits(batches):
        for b in batches:
            for ids, best in zip(b.column("ids").to_pylist(), b.column("best").to_pylist()):
                asked = np.frombuffer(ids, np.int64)
                if out := _hits(asked, read_best(best, len(asked))):
                    yield out

    def send(batches):
        """Each block of queries to the shards that can better its scores: only the queries for which that is so."""
        for b in batches:
            for shard, ids, points, best in zip(*(b.column(c).to_pylist() for c in ("shard", "ids", "points", "best"))):
                asked, x = read(ids, points)
                known = read_best(best, len(asked))
                kth = np.array([-m[-1][0] if len(m) == k else -np.inf for m in known], np.float64)
                part = int(asked[0]) % (1 << 31) * 40503 % parts
                for to in range(shards) if boxes is None else boxes:
                    if to != shard:
                        go = np.arange(len(asked)) if boxes is None else np.flatnonzero(box_reach(x, *(e[None] for e in boxes[to]))[:, 0] >= kth - np.abs(kth) * 2.0**-50)
                        if len(go):
                            yield {"to": [to], "part": [part], "is_query": [True], "ids": [asked[go].tobytes()], "points": [stored_as(x[go])], "best": [best_as([known[i] for i in go])]}

    def visit(batches):
        here, points_of, tree = None, None, None
        for b in batches:
            for to, part, is_query, ids, points, best in zip(*(b.column(c).to_pylist() for c in _SENT.names)):
                own, x = read(ids, points)
                if not is_query:  # comes first in its group
                    here, points_of, tree = (to, part), (own, x), None
                    continue
                if here != (to, part):
                    raise RuntimeError("a block of queries came without its shard")
                tree = tree or Tree(*points_of)
                known = read_best(best, len(own))
                found = [list(m) for m in known]
                tree.search(own, x, found, k)
                if out := _hits(own, [[h for h in m if h not in old] for m, old in zip(found, known)]):
                    yield out

    asked = arrow_fold(queries.repartition(max(1, min(n_blocks, shards))), send, _SENT, rows=1)
    trees = packed.filter("NOT is_query").select(F.col("shard").alias("to"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "is_query", "ids", "points", "best")
    met = asked.unionByName(trees).repartition(shards * parts, "to", "part").sortWithinPartitions("to", "part", "is_query")
    hits = arrow_fold(queries.select("ids", "best"), own_hits, _HITS).unionByName(arrow_fold(met, visit, _HITS, rows=8))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows from each shard at most
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
