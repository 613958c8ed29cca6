"""Mixing sources to target weights by hash-threshold histograms.

A document is taken whole as many times as its source's ratio has whole copies, and once more if its hash lies below
the source's threshold. The threshold is found without sorting: words are summed by source and hash bucket, the bucket
in which the budget ends is refined by the next bits of the hash, and only its documents take part in that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexpanel.llm._util import cut, fresh, tidy

CAP = 3
CYCLE = (1, 2, 3)
DIGITS, LEVELS = 3, 5  # hexadecimal digits of the hash a level: 4096 buckets, 60 bits in all


def targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """sizes: source, source_size, one row a source. Adds target: all words shared by weight, no source above cap times
    its own, the excess shared by weight among the rest until none is above. Sources are ordered by code point, null
    last, and weigh as CYCLE says. This is water filling: in order of room per weight, sources are full as long as the
    level of the rest exceeds their room. One row a source is all that a task sees."""
    everything = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, CYCLE)), (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(CYCLE) + 1))
    ranked = ranked.withColumn("room", F.lit(cap) * F.col("source_size"))
    by_room = everything.orderBy(F.col("room") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "place": F.row_number().over(by_room),
        "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0))).cast("double") / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))),
    })
    settled = F.min(F.when(F.col("level") * F.col("w") <= F.col("room"), F.struct("place", "level"))).over(everything)
    ranked = ranked.withColumn("settled", settled["level"])
    return ranked.select("source", "source_size", F.least(F.col("room").cast("double"), F.coalesce(F.col("settled") * F.col("w"), F.col("room").cast("double"))).alias("target"))


def words(text: Column) -> Column:
    r"""Number of runs of characters other than \x20 and \x09 to \x0D."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _hash(key: Column, seed: int) -> Column:
    return F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))), 1, DIGITS * LEVELS)


@tidy("bounds")
def thresholds(rows: DataFrame, cap: int = CAP) -> DataFrame:
    """rows: source, size, h. One row a source: source_size, target, whole copies of all its documents, and the hash
    below which documents are taken once more (prefix; nearer: at which, too; more: all, where no hash ends the budget)."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = cut(sources.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "sources")
    # below: words of the buckets before the boundary at all levels so far; prefix: the boundary bucket itself
    found = sources.select("source", "budget", F.lit(0).cast("long").alias("below"))
    inside = rows.select("source", "size", "h")
    for n in range(DIGITS, DIGITS * LEVELS + 1, DIGITS):
        sums = inside.groupBy("source", F.substring("h", 1, n).alias("bucket")).agg(F.sum("size").alias("s"))
        near = found.join(sums.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        near = near.withColumn("upto", F.col("below") + F.coalesce(F.sum("s").over(before), F.lit(0)))
        ended = near.where(F.col("upto") + F.col("s") > F.col("budget")).groupBy("source").agg(F.min(F.struct("bucket", "upto", "s")).alias("e"))
        found = sources.join(ended.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
        found = cut(found.select("source", "source_size", "target", "whole", "budget", F.col("e.bucket").alias("prefix"), F.coalesce("e.upto", F.lit(0)).alias("below"), F.col("e.s").alias("last")), "bounds" if n == DIGITS * LEVELS else "level")
        at = found.where("prefix is not null").select(F.col("source").alias("at"), "prefix")
        inside = inside.join(at, F.col("source").eqNullSafe(F.col("at")) & (F.substring("h", 1, n) == F.col("prefix"))).select("source", "size", "h")
    nearer = F.coalesce(F.col("below") + F.col("last") - F.col("budget") < F.col("budget") - F.col("below"), F.lit(False))
    return found.select(F.col("source").alias("of"), "source_size", "target", "whole", "prefix", nearer.alias("nearer"), (F.col("prefix").isNull() & (F.col("budget") > 0)).alias("more"))


def _copies(bound: Column, h: Column, cap: int) -> Column:
    """How often a document of a hash is taken; bound: a struct of what `thresholds` tells of its source."""
    once = bound["more"] | F.coalesce((h < bound["prefix"]) | (h == bound["prefix"]) & bound["nearer"], F.lit(False))
    return F.least(bound["whole"] + F.when(once, 1).otherwise(0), F.lit(cap)).cast("long")


def _sizes(df: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return cut(df.select(df[key].alias("k"), df[source].cast("string").alias("source"), words(df[text]).alias("size"), _hash(df[key], seed).alias("h")), "sizes")


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, cap: int = CAP) -> DataFrame:
    """One row per row of df: key, source, size, source_size, target, copies, taken (size times copies).

    Null texts and texts without words have size 0 and are taken as their hash falls. Null is a source like others. The
    hash is of key and seed, so reruns agree; rows with one hash (repeated keys, null keys) go together. The last
    document, in which the budget ends, is taken if that brings the source nearer to its target. No row is taken more
    than cap times. An empty table gives no rows.
    """
    rows = _sizes(df, key, text, source, seed)
    bounds = thresholds(rows, cap).select(F.struct("*").alias("b"))
    out = rows.join(bounds, F.col("source").eqNullSafe(F.col("b.of"))).withColumn("copies", _copies(F.col("b"), F.col("h"), cap))
    return out.select(F.col("k").alias(key), "source", "size", F.col("b.source_size").cast("long").alias("source_size"), "b.target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def take(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, cap: int = CAP) -> DataFrame:
    """The mix itself: df's rows and columns, whatever their names, each row as often as the mix takes it. The texts are
    not shuffled: only the thresholds, one row a source, meet them. Nulls, empty texts, ties and repeated rows are taken
    as in `mix`; an empty table gives no rows."""
    b, h, n = fresh(df, "bound", "hash", "copy")
    bounds = thresholds(_sizes(df, key, text, source, seed), cap).select(F.struct("*").alias(b))
    joined = df.withColumn(h, _hash(df[key], seed)).join(bounds, df[source].cast("string").eqNullSafe(F.col(f"{b}.of")))
    copies = _copies(F.col(b), F.col(h), cap)
    return joined.where(copies > 0).withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*(df[c] for c in df.columns))
