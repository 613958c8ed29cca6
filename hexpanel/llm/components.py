"""Connected components by contraction.

Each round every node points at the neighbour (itself included) of lowest hash; edges move to what their ends point at,
loops and repeats go. The node of highest hash in a component is never pointed at, so rounds end, and the hash order
makes the number of nodes fall by a constant factor whatever the order of ids. The pointers of all rounds are then
followed back. Tables between rounds are written to the shared folder. Minima combine before they are shuffled, and
joins on a hub are inner or left joins that adaptive execution can split. All this is DataFrame operations; callers
that may use Arrow code can have the last rounds, on edges of a bounded number, done by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexpanel.llm._util import cut, slim, tidy

FEW = 1 << 17  # edges of which one task holds all: some ten megabytes


@slim
def _solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, p of all edges a, b: p is the least node of u's component (bytes, numbers and text in Spark's order)."""
    root: dict = {}
    kind = pa.binary()

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in it:
        kind = batch.schema.field("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = find(root.setdefault(a, a)), find(root.setdefault(b, b))
            root[max(x, y)] = min(x, y)
    if root:
        yield pa.RecordBatch.from_arrays([pa.array(list(root), kind), pa.array([find(x) for x in root], kind)], ["u", "p"])


@tidy("components")
def components(edges: DataFrame, a: str, b: str, few: int = 0) -> DataFrame:
    """Columns node and component, the least node that links reach, for every node that an edge touches. Null ends and
    loops are ignored; repeated edges count once; no edges give no rows. few: the number of edges, 0 or FEW, from which
    down one task finishes."""
    x, y = F.col(a), F.col(b)
    live = cut(edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct(), "edges")
    pointers = []
    while n := live.count():
        if n <= few:
            kind = live.schema["a"].dataType.simpleString()
            solved = live.coalesce(1).mapInArrow(_solve, f"u {kind}, p {kind}")
            if not pointers:
                return cut(solved.toDF("node", "component"), "components")
            pointers.append(cut(solved, "pointers"))
            break
        both = live.select(F.col("a").alias("u"), F.col("b").alias("v")).union(live.select("b", "a"))
        best = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v"))).alias("m"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v"))
        pointer = cut(best.select("u", F.least(F.col("m"), own)["v"].alias("p")), "pointers")
        pointers.append(pointer)
        moved = live.join(pointer.toDF("a", "pa"), "a").join(pointer.toDF("b", "pb"), "b").where("pa != pb")
        live = cut(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not pointers:
        return cut(live.select(F.col("a").alias("node"), F.col("b").alias("component")), "components")
    roots = pointers[-1]
    for pointer in reversed(pointers[:-1]):
        roots = pointer.join(roots.toDF("p", "r"), "p", "left").select("u", F.coalesce("r", "p").alias("p"))
    if len(pointers) > 1:
        roots = cut(roots, "roots")
    least = roots.groupBy("p").agg(F.min("u").alias("component"))
    return cut(roots.join(least, "p").select(F.col("u").alias("node"), "component"), "components")
