"""A quality classifier learnt from weak labels.

Overlapping heuristic labellers (the rules of quality_rules) vote good, bad or abstain on every document. A label model
estimates by expectation-maximisation how accurate each is, over the vote patterns of all documents, and gives every
document a posterior label. A linear model over hashed byte trigrams (2**16 buckets) and a few hashed signs of
repetition is then fitted to the posteriors of a bounded sample and scores all documents. Its weights are one array of
256 KB. The sample, in the order of the digests of the ids: `train` different rows at most, and of these as many
as have `train_features` features together (a very long text has 2**16 at most), which bounds what the driver holds.

Defined results: a null text counts as empty; an empty text scores 0 and is not kept; repeated rows each get a row and
are one row of the sample; rows with a null id are scored but not learnt from; extra columns, clashing ones too, play no
part; very long texts are scored whole; an empty table gives an empty table. No labels are read; labelled rows only test
the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality_rules
from .common import arrow_map, cut, ids_and_texts, only, span_hashes, word_spans

BUCKETS, TRAIN, TRAIN_FEATURES, STEPS = 1 << 16, 4000, 4_000_000, 150
_SIGNS = 16  # buckets at the end, for signs of repetition


def _hashed(text: bytes) -> np.ndarray:
    """Buckets of all features of a text, each as often as it occurs."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if not len(b):
        return np.zeros(0, np.int64)
    b = np.concatenate(([32], b, [32])).astype(np.uint32)
    tri = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) >> np.uint32(16)
    raw = np.frombuffer(text, np.uint8)
    h = span_hashes(raw, *word_spans(raw))
    stutter = int((h[1:] == h[:-1]).sum()) * 8 // max(1, len(h))
    distinct = len(np.unique(h)) * 7 // max(1, len(h))
    signs = np.repeat([BUCKETS - 1 - stutter, BUCKETS - 9 - distinct], max(1, len(tri) // 4))
    return np.concatenate((tri % np.uint32(BUCKETS - _SIGNS), signs)).astype(np.int64)


def _fitted(rows: list, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by gradient steps with a step size for each bucket."""
    doc = np.concatenate([np.full(len(r[1]), i, np.int32) for i, r in enumerate(rows)])
    at = np.concatenate([np.asarray(r[1], np.int32) for r in rows])
    share = np.concatenate([np.asarray(r[2], np.float32) for r in rows])
    y = np.array([r[0] for r in rows])
    common = np.bincount(at, share, BUCKETS) / len(rows)
    scale = 1 / np.sqrt(common + 1e-4)
    x = (share * scale[at]).astype(np.float32)
    del share
    weight = np.where(y >= 0.5, 0.5 / max(1.0, (y >= 0.5).sum()), 0.5 / max(1.0, (y < 0.5).sum()))
    w, bias, grown, grown_b = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(doc, x * w[at], len(rows)) + bias, -30, 30)))
        e = (p - y) * weight
        g = np.bincount(at, x * e[doc], BUCKETS) + 1e-5 * w
        grown += g * g
        grown_b += e.sum() ** 2
        w -= 0.3 * g / np.sqrt(grown)
        bias -= 0.3 * e.sum() / np.sqrt(grown_b)
    return (w * scale).astype(np.float32), float(bias)


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text", train: int = TRAIN, train_features: int = TRAIN_FEATURES, steps: int = STEPS) -> DataFrame:
    """Per row: score (of the linear model), kept (score of 0.5 or more)."""
    spark = docs.sparkSession
    docs = only(docs, key, text)
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h")
    counted = cut(quality_rules.counts(docs, text).select(key, digest, "counts.*"))
    voted = quality_rules.votes(counted)
    posterior = quality_rules.posterior(quality_rules.fit(voted))
    named = voted.select(key, "_h", posterior.alias("p_label")).filter(F.col(key).isNotNull()).withColumn("_o", F.md5(F.col(key).cast("string")))
    chosen = named.dropDuplicates([key, "_h"]).orderBy("_o", key, "_h").limit(train)
    sample = docs.withColumn("_h", digest).join(F.broadcast(chosen), [key, "_h"]).dropDuplicates([key, "_h"])  # train rows at most

    def features(b):
        out = {"order": [], "y": [], "n": [], "at": [], "share": []}
        for o, h, p, t in zip(*(b.column(c).to_pylist() for c in ("_o", "_h", "p_label", text))):
            at, n = np.unique(_hashed((t or "").encode()), return_counts=True)
            if len(at):
                out["order"].append(f"{o}{h}")
                out["y"].append(p)
                out["n"].append(len(at))
                out["at"].append(at.astype(np.int32))
                out["share"].append((n / n.sum()).astype(np.float32))
        yield out

    schema = T.StructType([T.StructField("order", T.StringType()), T.StructField("y", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("share", T.ArrayType(T.FloatType()))])
    found = cut(arrow_map(sample, features, schema))
    first = W.orderBy("order")  # over train rows at most
    fits = found.select("order", F.sum("n").over(first).alias("_n"), F.row_number().over(first).alias("_r")).filter((F.col("_n") <= train_features) | (F.col("_r") == 1)).select("order")
    got = found.join(fits, "order", "left_semi").select("order", "y", "at", "share").toPandas().sort_values("order")
    w, bias = _fitted(list(got[["y", "at", "share"]].itertuples(index=False)), steps) if len(got) else (np.zeros(BUCKETS, np.float32), 0.0)
    model = spark.sparkContext.broadcast((w, bias))  # BUCKETS weights

    def run(b):
        w, bias = model.value
        keys, texts = ids_and_texts(b, key, text)
        score = []
        for t in texts:
            at = _hashed(t.encode())
            score.append(float(1 / (1 + np.exp(-np.clip(w[at].mean(dtype=np.float64) + bias, -30, 30)))) if len(at) else 0.0)
        yield {key: keys, "score": score}

    scored = arrow_map(docs, run, T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType())]))
    return scored.withColumn("kept", F.col("score") >= 0.5)
