"""Ranks and running sums over a whole table, in two levels.

Approximate quantiles, as many as there are shuffle partitions, deal the rows to buckets of consecutive values. Each
bucket is one group of a window; what lies before it comes from the buckets' totals, a table of that many rows, which is
broadcast. So no task orders the table, whatever its size; equal values share a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, BEFORE = "_rank_bucket", "_rank_before"


def _dealt(df: DataFrame, order: Column) -> DataFrame:
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    value = order.cast("double")
    found = df.agg(F.percentile_approx(value, [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    bounds = F.array(*map(F.lit, sorted(set(found)))).cast("array<double>")
    return df.withColumn(BUCKET, F.when(value.isNull(), -1).otherwise(F.size(F.filter(bounds, lambda x: x < value))))


def running(df: DataFrame, order: Column, sums: dict[str, Column]) -> DataFrame:
    """df with, under each name, the sum of a column over the rows up to a row's place in ascending order, equals included."""
    dealt = _dealt(df, order)
    totals = dealt.groupBy(BUCKET).agg(*(F.sum(c).alias(f"{BEFORE}_{n}") for n, c in sums.items()))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = totals.select(BUCKET, *(F.coalesce(F.sum(f"{BEFORE}_{n}").over(before), F.lit(0)).alias(f"{BEFORE}_{n}") for n in sums))
    inside = Window.partitionBy(BUCKET).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.join(F.broadcast(offsets), BUCKET)
    return out.withColumns({n: F.sum(c).over(inside) + F.col(f"{BEFORE}_{n}") for n, c in sums.items()}).drop(BUCKET, *(f"{BEFORE}_{n}" for n in sums))


def numbered(df: DataFrame, order: Column, *then: Column | str, out: str) -> DataFrame:
    """df with the number of each row, from 1, in ascending order (nulls first), and then by other columns."""
    dealt = _dealt(df, order)
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = dealt.groupBy(BUCKET).agg(F.count("*").alias(BEFORE)).select(BUCKET, F.coalesce(F.sum(BEFORE).over(before), F.lit(0)).alias(BEFORE))
    inside = F.row_number().over(Window.partitionBy(BUCKET).orderBy(order, *then))
    return dealt.join(F.broadcast(offsets), BUCKET).withColumn(out, inside + F.col(BEFORE)).drop(BUCKET, BEFORE)


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """df with the rank of a column among its filled values, ties averaged; null where it is missing."""
    dealt = _dealt(df, F.col(column))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = dealt.groupBy(BUCKET).agg(F.count(column).alias(BEFORE)).select(BUCKET, F.coalesce(F.sum(BEFORE).over(before), F.lit(0)).alias(BEFORE))
    part = Window.partitionBy(BUCKET)
    rank = F.rank().over(part.orderBy(column)) + F.col(BEFORE) + (F.count("*").over(Window.partitionBy(BUCKET, column)) - 1) / 2
    return dealt.join(F.broadcast(offsets), BUCKET).withColumn(out, F.when(F.col(column).isNotNull(), rank).cast("double")).drop(BUCKET, BEFORE)


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float]:
    """Exact quantiles of a column by linear interpolation between the order statistics around each; none of no values."""
    filled = df.where(F.col(column).isNotNull()).select(column)
    n = filled.count()
    if not n:
        return []
    places = [q * (n - 1) for q in shares]
    wanted = sorted({int(p) + d for p in places for d in (1, 2)})
    found = {r["n"]: float(r["v"]) for r in numbered(filled, F.col(column), out="n").where(F.col("n").isin(*wanted)).select("n", F.col(column).alias("v")).collect()}
    return [found[int(p) + 1] if p == int(p) else found[int(p) + 1] + (found[int(p) + 2] - found[int(p) + 1]) * (p - int(p)) for p in places]
