"""Joins with stated clash and duplicate rules, and deduplication by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """df; raises ValueError where a key repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{what}: keys {list(keys)} repeat")
    return df


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keys and not c.startswith(prefix)})


def dedupe(df: DataFrame, keys: Sequence[str], strategy: str = "first", *, order_by: Sequence[str] | str = (), reduce_map: dict[str, str] | None = None) -> DataFrame:
    """One row a key. "first" and "last" by an order (which makes them reproducible); "reduce": the mapped function of a
    column, else the mean of numbers and the first value by order of the rest that isn't missing."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if strategy in ("first", "last"):
        by = [F.col(c).asc_nulls_last() if strategy == "first" else F.col(c).desc_nulls_last() for c in order or [c for c in df.columns if c not in keys] or keys]
        return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")
    if strategy != "reduce":
        raise ValueError(f"unknown strategy {strategy}")
    place = F.struct(*order) if order else F.lit(0)
    known = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg, "count": F.count}
    aggs = []
    for f in df.schema.fields:
        if f.name in keys:
            continue
        how = (reduce_map or {}).get(f.name)
        numeric = isinstance(f.dataType, NumericType)
        value = known[how](f.name) if how else F.avg(f.name) if numeric else F.min_by(f.name, F.when(F.col(f.name).isNotNull(), F.struct(place.alias("a"), F.col(f.name).alias("b"))))
        aggs.append(value.alias(f.name))
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def join_prefixed(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], *, prefix: str = "", how: str = "left", null_safe: bool = False) -> DataFrame:
    """Equi join of differently named keys. The right side's columns get a prefix; its keys stay where their names differ
    from the left's. null_safe: missing keys match missing keys."""
    right = prefix_columns(right, prefix, right_on) if prefix else right
    renamed = right.toDF(*(f"_r_{c}" if c in right_on else c for c in right.columns))
    equal = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    on = reduce(lambda x, y: x & y, (equal(left[a], renamed[f"_r_{b}"]) for a, b in zip(left_on, right_on, strict=True)))
    out = left.join(renamed, on, how)
    for a, b in zip(left_on, right_on, strict=True):
        out = out.drop(f"_r_{b}") if a == b else out.withColumnRenamed(f"_r_{b}", b)
    return out


def merge_sequential(tables: dict[str, DataFrame], keys: Sequence[str] = ("hex_id", "year"), *, base: str | None = None, unify: Sequence[str] = (), geometry: str = "geometry", check: bool = True) -> DataFrame:
    """Left joins of tables on common keys, in order. Columns to unify take the first value that isn't missing, left
    before right; other clashes get a suffix __<table>; the base keeps its geometry alone. Keys must be unique."""
    base = base or next(iter(tables))
    out = tables[base]
    if check:
        assert_unique(out, keys, base)
    for name, t in tables.items():
        if name == base:
            continue
        if check:
            assert_unique(t, keys, name)
        t = t.drop(geometry)
        shared = [c for c in t.columns if c in out.columns and c not in keys]
        t = t.withColumnsRenamed({c: f"_{c}" if c in unify else f"{c}__{name}" for c in shared})
        out = out.join(t, list(keys), "left")
        both = [c for c in shared if c in unify]
        out = out.withColumns({c: F.coalesce(c, f"_{c}") for c in both}).drop(*(f"_{c}" for c in both))
    return out


def attach_labels(df: DataFrame, labels: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("hex_id", "year")) -> DataFrame:
    """Left join of label columns, labels made unique by key first; without the keys on either side they are null."""
    if not set(keys) <= set(df.columns) or not set(keys) <= set(labels.columns):
        return df.withColumns({c: F.lit(None).cast("boolean") for c in columns})
    return df.drop(*columns).join(dedupe(labels.select(*keys, *columns), keys), list(keys), "left")


def lookup(df: DataFrame, mapping: DataFrame, column: str, key: str, value: str, *, normalise, out: str, fallback: str = "Brak", ordinal: str | None = None) -> DataFrame:
    """Dictionary lookup with both keys normalised; the first row of a repeated key wins, what isn't found gets the
    fallback."""
    rows = mapping.select(normalise(F.col(key)).alias("_k"), F.col(value).alias("_v"), (F.col(ordinal) if ordinal else F.monotonically_increasing_id()).alias("_o")).where("_k is not null")
    first = rows.groupBy("_k").agg(F.min_by("_v", "_o").alias("_v"))
    joined = df.withColumn("_n", normalise(F.col(column))).join(first, F.col("_n") == F.col("_k"), "left")
    return joined.withColumn(out, F.coalesce("_v", F.lit(fallback))).drop("_n", "_k", "_v")
