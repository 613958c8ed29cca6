"""MinHash near-dedup by a chosen-path set similarity join.

Documents with one shingle set are one class. In each of several independent trees a class follows paths: a node picks
one or, with the rest of 1/similarity as probability, two of the minwise hash functions, and a class goes to the child
that its minwise token under each names. Nodes with few classes are compared exhaustively on signatures; larger ones
branch again, up to a depth, beyond which a node is compared in pairs of bounded tiles, so none is skipped.

Only components of links are asked for, so what is linked already is compared no more. The classes of a large node are
first tried against a few leaders of it, and what is confirmed on full sets makes components; a node of one component
is done, and of others only pairs across components count. A group of any number of copies of one text thus takes work
in proportion to its size. The pairs that signatures leave possible across components, a spanning forest a node, are
confirmed next. Where one is refuted and its ends stay apart, the components that refuted pairs tie together are compared
again whole: by signatures in pairs of tiles, and on the full sets of those that signatures leave possible there.

Full sets come from whole texts: pairs are confirmed in groups of one class and a bounded number of others, so the text
of a class that many pairs share is sent once a group.

Recall: pairs at the threshold share a child with probability 1 or close to it a level (similarity / similarity), at
least 0.85 by one function. With the roots that SEED gives, and functions taken as independent, a pair just at the
threshold whose nodes all stay large down to a depth is missed with chance under 1e-6 at depth one, under 1e-4 at depth
three, and at DEPTH, four, 3.0e-4 with 8 trees at 85 % and 1.7e-4 with 10 trees at 80 %.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from hexpanel.llm._util import cut, slim, tidy
from hexpanel.llm.components import FEW, components

SIGNATURE, TREES, DEPTH, LEAF, SETS = 64, 8, 4, 384, 1 << 20
LEADERS, STAR = 3, 64  # leaders a large node, and classes that a group of pairs holds beside the one they share
SHINGLE, PERCENT = 3, 85
SEED = 5

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words than `size`, of the whole sequence.
    Words are hashed by differences of a prefix polynomial over mixed bytes, shingles from their words' hashes."""
    raw = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    blank = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=prefix[1:])
    word = _mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))
    n = min(size, len(word))
    m = len(word) - n + 1
    out = np.full(m, np.uint64(n))
    for k in range(n):
        out = _mix(out * np.uint64(_BASE) + word[k : k + m])
    return np.unique(out)


def _functions(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    r = random.Random(seed)
    return np.array([r.getrandbits(64) | 1 for _ in range(n)], np.uint64), np.array([r.getrandbits(64) for _ in range(n)], np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), _MASK, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        np.minimum(low, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_id(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(df: DataFrame, text: str, size: int) -> DataFrame:
    """Adds a struct column sk: n (set size), id (digest of the set, null for none), sig."""
    a, b = _functions(SIGNATURE)

    @F.arrow_udf("struct<n:bigint,id:binary,sig:array<int>>")
    @slim
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n, ids, sig = [], [], [np.empty(0, np.int32)]
            for t in batch:  # one text and its set at a time
                s = shingles(t.as_py() or "", size)
                n.append(len(s))
                ids.append(set_id(s) if len(s) else None)
                sig.append(signature(s, a, b))
            at = pa.array(np.arange(len(n) + 1, dtype=np.int32) * SIGNATURE)
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(at, pa.array(np.concatenate(sig)))], ["n", "id", "sig"])

    return df.withColumn("sk", run(F.col(text)))


def _groups(it: Iterator[pa.RecordBatch], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Calls work on each run of rows of one gkey; rows come sorted by gkey. A group may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        k = batch.column("gkey").to_numpy()
        at = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)] if len(k) else []
        for a, b in zip(at, at[1:], strict=False):
            part = batch.slice(a, b - a)
            if held and held[0].column("gkey")[0].as_py() != k[a]:
                yield from work(pa.Table.from_batches(held))
                held = []
            held.append(part)
    if held:
        yield from work(pa.Table.from_batches(held))


def _alike(sig: np.ndarray, least: int) -> np.ndarray:
    """Which pairs of rows agree in at least `least` places."""
    agree = np.zeros((len(sig), len(sig)), np.uint8)
    for column in sig.T:
        agree += column[:, None] == column[None, :]
    return agree >= least


def _tree(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a breadth-first forest: near(i, open) tells which of the open nodes are linked to i."""
    left = np.ones(n, bool)
    a, b = [], []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            some = np.flatnonzero(left)
            if not len(some):
                break
            hit = some[near(i, some)]
            left[hit] = False
            queue.extend(hit.tolist())
            a += [i] * len(hit)
            b += hit.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _signatures(t: pa.Table) -> np.ndarray:
    return t.column("sig").combine_chunks().flatten().to_numpy().reshape(t.num_rows, SIGNATURE)


def _numbered(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().dictionary_encode().indices.to_numpy()


def _pairs(t: pa.Table, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        ids = t.column("id").combine_chunks()
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], ["a", "b"])


def _by_group(df: DataFrame, *then: str) -> DataFrame:
    return df.repartition("gkey").sortWithinPartitions("gkey", *then)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _dealt(df: DataFrame, key: str, leaf: int, weight: str | None = None) -> DataFrame:
    """Adds gkey, under which the rows of a key that have different comp meet. A key of up to `leaf` rows is one group.
    Others are dealt to tiles, those of the key's largest comp to tiles of their own, and each tile goes to its pairs of
    tiles; pairs within the largest comp are left out."""
    units = F.greatest(F.count("*") / F.lit(leaf), F.sum(weight) / F.lit(SETS) if weight else F.lit(0.0)).alias("units")
    by = df.groupBy(key, "comp").agg(units)
    sums = cut(by.groupBy(key).agg(F.sum("units").alias("all"), F.max(F.struct("units", "comp")).alias("big")), "tiles")
    rest = F.greatest(F.ceil(F.col("all") - F.col("big.units")), F.lit(1)).cast("int")
    spread = df.join(sums, key).withColumn("_in", F.col("comp") == F.col("big.comp")).withColumns({"_r": rest, "_h": F.ceil("big.units").cast("int")})
    own = F.pmod(F.xxhash64("id", F.lit(11)), F.when(F.col("_in"), F.col("_h")).otherwise(F.col("_r"))).cast("int")
    spread = spread.withColumn("_t", own)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    across = lambda r, h: F.xxhash64(key, F.lit(1), r, h)
    of_big = F.transform(upto(F.col("_r")), lambda r: across(r, F.col("_t")))
    of_rest = F.concat(F.transform(upto(F.col("_r")), lambda r: F.xxhash64(key, F.lit(0), F.least(r, F.col("_t")), F.greatest(r, F.col("_t")))), F.transform(upto(F.col("_h")), lambda h: across(F.col("_t"), h)))
    groups = F.when(F.col("all") <= 1, F.array(F.xxhash64(key, F.lit(2)))).when(F.col("_in"), of_big).otherwise(of_rest)
    return spread.withColumn("gkey", F.explode(groups)).drop("all", "big", "_in", "_r", "_h", "_t")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b, ok: whether the full sets of two classes are linked. Pairs that share a are dealt to groups of STAR; a group
    gets the text of a once and then those of its b, of which a task holds one set at a time."""
    # written, so that adaptive execution can split the join at a class that many pairs share
    counts = cut(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR)).alias("parts")), "counts")
    dealt = pairs.join(counts, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b", F.lit(5)), F.col("parts"))).alias("gkey"), "a", "b")
    needed = dealt.select("gkey", F.col("a").alias("id"), F.lit(0).alias("role")).distinct().union(dealt.select("gkey", "b", F.lit(1)))
    named = needed.join(classes.select("id", "rep"), "id")
    whole = docs.select(F.col("k").alias("rep"), "t")  # a repeated key may come with another text

    @slim
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead, known = None, None, np.empty(0, np.uint64)
        for batch in it:
            a, b, ok = [], [], []
            text = batch.column("t")
            for i, (g, x, role) in enumerate(zip(batch.column("gkey").to_pylist(), batch.column("id").to_pylist(), batch.column("role").to_pylist(), strict=True)):
                if g != group:
                    group, lead = g, None
                if role and lead is None:
                    continue
                s = shingles(text[i].as_py(), size)
                if set_id(s) != x:
                    continue
                if not role:
                    lead, known = x, s
                    continue
                both = _shared(known, s)
                a.append(lead)
                b.append(x)
                ok.append(100 * both >= percent * (len(known) + len(s) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    rows = _by_group(named.join(whole, "rep").select("gkey", "role", "id", "t"), "role", "id")
    return cut(rows.mapInArrow(run, "a binary, b binary, ok boolean").distinct(), "confirmed")


def _grown(edges: list[DataFrame]) -> DataFrame:
    """id, comp: the least id that the edges reach, of every id that an edge touches."""
    every = edges[0]
    for e in edges[1:]:
        every = every.union(e)
    return components(every, "a", "b", FEW).toDF("id", "comp")


def _placed(df: DataFrame, comps: DataFrame | None) -> DataFrame:
    """df with the comp of each id, itself where no edge touches it."""
    if comps is None:
        return df.withColumn("comp", F.col("id"))
    return df.join(comps.toDF("id", "_c"), "id", "left").withColumn("comp", F.coalesce("_c", "id")).drop("_c")


@tidy("classes", "components")
def _components(rows: DataFrame, docs: DataFrame, size: int, percent: int, trees: int, depth: int, leaf: int) -> DataFrame:
    """id, rep, comp of every class of rows."""
    classes = cut(rows.where("k is not null and id is not null").groupBy("id").agg(F.min("k").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    least = next(m for m in range(SIGNATURE) if _tail(m, percent / 100) > 2e-5)
    r = random.Random(SEED)
    second = 100.0 / percent - 1
    roots = []
    for t in range(trees):
        some = r.sample(range(SIGNATURE), 2 if r.random() < second else 1)
        roots += [F.xxhash64(F.lit(t), F.lit(c), F.element_at("sig", c + 1)) for c in some]
    level = cut(classes.select("id", F.explode(F.array_distinct(F.array(*roots))).alias("node")), "paths")
    leader = lambda s: F.min(F.struct(F.xxhash64("id", F.lit(s)).alias("h"), F.col("id")))["id"]
    # written, so that adaptive execution can split the join at a node that many classes come to
    sizes = cut(level.groupBy("node").agg(F.count("*").alias("size"), F.array(*map(leader, range(LEADERS))).alias("leaders")).where("size > 1"), "sizes")
    sized = cut(level.join(sizes, "node"), "nodes")
    ready = sized.where(F.col("size") <= leaf).select("node", "id")
    large = sized.where(F.col("size") > leaf).select("node", "id", "leaders")
    edges: list[DataFrame] = []
    comps = None
    if not large.isEmpty():
        tried = cut(large.select(F.explode("leaders").alias("a"), F.col("id").alias("b")).where("a != b").distinct(), "tried")
        signed = tried.join(classes.select(F.col("id").alias("a"), F.col("sig").alias("x")), "a").join(classes.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b")
        agree = F.aggregate(F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)
        edges.append(confirm(cut(signed.where(agree >= least).select("a", "b"), "alike"), classes, docs, size, percent).where("ok").select("a", "b"))
        comps = _grown(edges)
    met = ready.withColumn("gkey", F.xxhash64("node")).select("gkey", "id")
    level, at = large.select("node", "id"), 1
    while not level.isEmpty():
        level = cut(_placed(level, comps), "paths")
        sizes = cut(level.groupBy("node").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("node", "size"), "sizes")
        sized = cut(level.join(sizes, "node"), "nodes")
        if at == depth:
            met = met.union(_dealt(sized.select("node", "id", "comp"), "node", leaf).select("gkey", "id"))
            break
        met = met.union(sized.where(F.col("size") <= leaf).select(F.xxhash64("node").alias("gkey"), "id"))
        place = lambda salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(SIGNATURE)).cast("int")
        child = lambda salt: F.xxhash64("node", place(salt), F.element_at("sig", place(salt) + 1))
        both = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(10000)) < F.lit(int(second * 10000))
        branched = sized.where(F.col("size") > leaf).select("id", "node").join(classes.select("id", "sig"), "id")
        level = branched.select("id", F.explode(F.array_distinct(F.when(both, F.array(child(1), child(2))).otherwise(F.array(child(1))))).alias("node"))
        at += 1

    @slim
    def possible(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            comp = _numbered(t, "comp")
            if t.num_rows > 1 and comp.max():
                near = _alike(_signatures(t), least) | (comp[:, None] == comp)
                a, b = _tree(t.num_rows, lambda i, some: near[i, some])
                across = comp[a] != comp[b]
                yield from _pairs(t, a[across], b[across])

        return _groups(it, work)

    met = _placed(met.join(classes.select("id", "sig"), "id"), comps)
    found = cut(_by_group(met).mapInArrow(possible, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "possible")
    told = confirm(found, classes, docs, size, percent)
    edges.append(told.where("ok").select("a", "b"))
    comps = _grown(edges)

    # what refuted pairs tie together, though it is not linked yet, is compared whole
    comp = lambda end: comps.toDF(end, f"c{end}")
    ends = told.where("not ok").join(comp("a"), "a", "left").join(comp("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    clusters = components(ends, "a", "b", FEW).toDF("comp", "cluster")
    if clusters.isEmpty():
        return _placed(classes.select("id", "rep"), comps)
    members = cut(_dealt(_placed(classes, comps).join(clusters, "comp"), "cluster", leaf, "n").select("gkey", "id", "rep", "comp", "sig"), "members")

    @slim
    def across(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            comp = _numbered(t, "comp")
            if t.num_rows > 1 and comp.max():
                some = (_alike(_signatures(t), least) & (comp[:, None] != comp)).any(1)
                if some.any():
                    yield t.select(["gkey", "id"]).filter(pa.array(some)).combine_chunks().to_batches()[0]

        return _groups(it, work)

    @slim
    def on_sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            ids, text = t.column("id").to_pylist(), t.column("t")
            sets = [shingles(text[i].as_py(), size) for i in range(t.num_rows)]
            mine = [i for i, s in enumerate(sets) if set_id(s) == ids[i]]
            sets = [sets[i] for i in mine]
            t = t.select(["id", "comp", "sig"]).take(mine)
            if len(mine) < 2:
                return
            comp = _numbered(t, "comp")
            same = comp[:, None] == comp
            near, count = _alike(_signatures(t), least) & ~same, np.array([len(s) for s in sets])

            def linked(i: int, some: np.ndarray) -> np.ndarray:
                out = same[i, some].copy()
                at = np.flatnonzero(near[i, some])
                if len(at):
                    other = np.concatenate([sets[j] for j in some[at]])
                    place = np.minimum(np.searchsorted(sets[i], other), count[i] - 1)
                    ends = np.cumsum(count[some[at]])
                    both = np.add.reduceat(sets[i][place] == other, ends - count[some[at]], dtype=np.int64)
                    out[at] = 100 * both >= percent * (count[i] + count[some[at]] - both)
                return out

            a, b = _tree(len(mine), linked)
            yield from _pairs(t, a, b)

        return _groups(it, work)

    tight = _by_group(members.select("gkey", "id", "comp", "sig")).mapInArrow(across, "gkey bigint, id binary").distinct()
    whole = docs.select(F.col("k").alias("rep"), "t")
    texts = tight.join(members, ["gkey", "id"]).join(whole, "rep").select("gkey", "id", "comp", "sig", "t")
    edges.append(cut(_by_group(texts).mapInArrow(on_sets, "a binary, b binary"), "linked"))
    return _placed(classes.select("id", "rep"), _grown(edges))


def link(df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, detail: bool = False) -> DataFrame:
    """One row per row of df: key, n_shingles, component_id (least key that links reach, itself included), kept
    (key = component_id).

    Links join documents with 100 * intersection >= percent * union of their sets of `size`-word shingles (A-Z
    lower-cased; fewer words make one shingle). Null texts and texts without words have size 0 and link with nothing, nor
    do null keys. Equal sets link whatever the number of rows; rows that repeat a key get that key's verdict by their own
    text. Texts are read whole whatever their length; an empty table gives no rows. key: an integer column, else a
    ValueError. percent: 50 or more. detail: also text_sha256, and group, which rows of one component share and no others
    (null for those that link with nothing): where a key repeats, component_id alone doesn't tell components apart.
    """
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise ValueError(f"{key} must be an integer column")
    docs = df.select(df[key].cast("bigint").alias("k"), F.coalesce(df[text].cast("string"), F.lit("")).alias("t"))
    more = [F.sha2("t", 256).alias("sha")] if detail else []
    rows = cut(sketch(docs, "t", size).select("k", "sk.n", "sk.id", F.when(F.col("sk.n") > 0, F.col("sk.sig")).alias("sig"), *more), "sketches")
    classes = _components(rows, docs, size, percent, trees, depth, leaf)
    roots = classes.groupBy("comp").agg(F.min("rep").alias("component"))
    ids = classes.select("id", "comp").join(roots, "comp")
    out = rows.select("k", "n", F.when(F.col("k").isNotNull(), F.col("id")).alias("id"), *(["sha"] if detail else [])).join(ids, "id", "left")
    root = F.coalesce("component", "k")
    more = [F.col("comp").alias("group"), F.col("sha").alias("text_sha256")] if detail else []
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), root.alias("component_id"), F.col("k").eqNullSafe(root).alias("kept"), *more)


def _tail(m: int, p: float, n: int = SIGNATURE) -> float:
    """Chance that a pair of similarity p agrees in at most m of n places."""
    from math import comb

    return sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(m + 1))
