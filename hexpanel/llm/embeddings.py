"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors of a label are one class with a weight. Classes are dealt to tiles of bounded size; each pair of tiles is
one task's group. There the quantised product of two unit vectors x = s q + e, whose error norms |e| are known exactly,
misses the cosine by at most |s q||e'| + |e||s' q'| + |e||e'|; only pairs that the bound leaves possible are computed
again in double precision. A group returns the links that each class has in it, summed, and a spanning forest of them,
never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexpanel.llm._util import cut
from hexpanel.llm.components import FEW, components

THRESHOLD = 0.98
TILE = 2048
SLACK = 1e-9  # over the rounding of the double-precision sums


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows x as int8 with a scale each; the norms of s q and of the error x - s q."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    return q, scale, np.sqrt((near * near).sum(1)), np.sqrt(((x - near) ** 2).sum(1))


def links(a: np.ndarray, b: np.ndarray | None, threshold: float = THRESHOLD, stripe: int = 512) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (rows of a, rows of b) of cosine at least threshold, by tile products; b None: pairs i < j within a.
    Also the number of pairs that were computed in full."""
    unit = lambda v: v / np.sqrt((v * v).sum(1))[:, None]
    x = unit(a)
    y = x if b is None else unit(b)
    qx, sx, nx, ex = quantise(x)
    qy, sy, ny, ey = (qx, sx, nx, ex) if b is None else quantise(y)
    right = qy.astype(np.float32).T  # products of int8 are exact in float32 up to 2**24, that is 1040 dimensions a block
    left_rows, right_rows, full = [], [], 0
    for at in range(0, len(x), stripe):
        part = slice(at, at + stripe)
        product = np.zeros((len(qx[part]), right.shape[1]))
        for d in range(0, right.shape[0], 1024):
            product += qx[part, d : d + 1024].astype(np.float32) @ right[d : d + 1024]
        product *= sx[part, None]
        product *= sy
        product += nx[part, None] * ey + ex[part, None] * (ny + ey)
        i, j = np.nonzero(product >= threshold - SLACK)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        for cut_ in range(0, len(i), 1 << 16):
            p, r = i[cut_ : cut_ + (1 << 16)], j[cut_ : cut_ + (1 << 16)]
            u, v = a[p], (a if b is None else b)[r]
            sure = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1))) >= threshold
            full += len(p)
            left_rows.append(p[sure])
            right_rows.append(r[sure])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(left_rows or empty), np.concatenate(right_rows or empty), full


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node of its component, by repeated minima over the links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def dedup(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row of df: key, n_links (other vectors of the label at cosine >= threshold), component_id (least key
    that links reach, itself included), kept (key = component_id).

    Vectors that are null, empty, zero, or hold null or non-finite components, null labels and null keys link with
    nothing; vectors of different lengths don't compare. Repeated rows link with one another like other equal vectors.
    """
    numbers = F.transform(F.col("v"), lambda x: x.cast("double"))
    rows = df.select(df[key].alias("k"), df[vector].alias("v"), df[label].alias("g")).withColumn("v", numbers)
    sound = F.coalesce(F.col("k").isNotNull() & F.col("g").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.select("k", F.when(sound, F.col("v")).alias("v"), "g")
    classes = cut(rows.where("v is not null").groupBy("g", "v").agg(F.min("k").alias("c"), F.count("*").alias("w")), "classes")
    counts = classes.groupBy("g", F.size("v").alias("d")).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    dealt = classes.withColumn("d", F.size("v")).join(counts, ["g", "d"]).withColumn("t", F.pmod(F.xxhash64("c", "w"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = dealt.select("g", "d", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "t", "c", "w", "v")

    def compare(group: pa.Table) -> pa.Table:
        t, c, w = (group.column(x).to_numpy() for x in ("t", "c", "w"))
        v = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1).astype(np.float64)
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        a, b = np.flatnonzero(t == lo), np.flatnonzero(t == hi)
        if lo == hi:
            i, j, _ = links(v, None, threshold)
        elif len(a) and len(b):
            i, j, _ = links(v[a], v[b], threshold)
            i, j = a[i], b[j]
        else:
            i = j = np.empty(0, np.int64)
        n = np.bincount(i, w[j], len(c)) + np.bincount(j, w[i], len(c))
        root = forest(len(c), i, j)
        some = np.flatnonzero(n)
        return pa.table({"c": c[some], "n": n[some].astype(np.int64), "to": c[root[some]]})

    kind = df.schema[key].dataType.simpleString()
    found = cut(pairs.groupBy("g", "d", "lo", "hi").applyInArrow(compare, f"c {kind}, n bigint, to {kind}"), "links")
    joined = components(found, "c", "to", FEW).toDF("c", "component")
    n = found.groupBy("c").agg(F.sum("n").alias("n"))
    members = rows.where("v is not null").join(classes.select("g", "v", "c", "w"), ["g", "v"]).select("k", "c", "w")
    members = members.join(n, "c", "left").join(joined, "c", "left")
    linked = members.select("k", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"), F.coalesce("component", "c").alias("component"))
    out = linked.unionByName(rows.where("v is null").select("k", F.lit(0).cast("long").alias("n"), F.col("k").alias("component")))
    return out.select(F.col("k").alias(key), F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"), F.col("k").eqNullSafe(F.col("component")).alias("kept"))
