"""Profiles of columns, and pruning of those that carry nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hexpanel.operators import ranks

REPORT = "column string, reason string, detail string"


def missing_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, share of missing values, largest first; one pass over df."""
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))
    return one.unpivot([], list(columns), "column", "missing")


def unique_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, distinct, filled, ratio of distinct to filled values."""
    one = df.agg(*(F.struct(F.count_distinct(c).alias("distinct"), F.count(c).alias("filled")).alias(c) for c in columns))
    long_ = one.unpivot([], list(columns), "column", "v")
    return long_.select("column", F.col("v.distinct").alias("distinct"), F.col("v.filled").alias("filled"), F.try_divide(F.col("v.distinct"), F.col("v.filled")).alias("ratio"))


def correlations(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """a, b, corr of every pair of columns over the rows where both are filled; ranks average ties for spearman."""
    if method == "spearman":
        for c in columns:
            df = ranks.average_rank(df, c, c)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    both = lambda a, b: F.corr(F.when(F.col(b).isNotNull(), F.col(a).cast("double")), F.when(F.col(a).isNotNull(), F.col(b).cast("double")))
    rows = df.agg(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), both(a, b).alias("corr")) for a, b in pairs)).alias("x"))
    return rows.select(F.inline("x"))


def duplicate_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> dict[str, str]:
    """Column -> the first column with the same values in all rows (missing equals missing). Hashes keyed by row are
    summed in one pass; columns that agree are then compared value by value."""
    one = df.agg(*(F.sum(F.xxhash64(*keys, F.col(c).cast("string"), F.col(c).isNull()).cast("decimal(38,0)")).alias(c) for c in columns)).first()
    first: dict = {}
    out = {}
    for c in columns:
        if one[c] in first and df.where(~F.col(c).eqNullSafe(F.col(first[one[c]]))).isEmpty():
            out[c] = first[one[c]]
        else:
            first.setdefault(one[c], c)
    return out


def prune(df: DataFrame, *, protect: Sequence[str] = (), keys: Sequence[str] = ("hex_id", "year"), missing: float | None = 0.7, constant: bool = True, quasi_ratio: float | None = 0.05, duplicates: bool = True, corr: float | None = 0.99, method: str = "pearson") -> tuple[DataFrame, DataFrame]:
    """df without useless columns, and a report of column, reason, detail (empty if none goes).

    In this order: too many missing values; one value, or few for the filled rows; copies of an earlier column; of two
    columns correlated at corr or more, in order of correlation, the one with more missing, fewer rows, the longer name,
    the later one. What is protected always stays.
    """
    spark, gone = df.sparkSession, []
    live = [c for c in df.columns if c not in protect and c not in keys]

    def drop(names: dict[str, str], reason: str) -> None:
        gone.extend((c, reason, d) for c, d in names.items())
        live[:] = [c for c in live if c not in names]

    shares = {r["column"]: r["missing"] or 0.0 for r in missing_shares(df, live).collect()} if live else {}
    if missing is not None:
        drop({c: f"{shares[c]:.4f}" for c in live if shares[c] > missing}, "missing")
    if live and (constant or quasi_ratio is not None):
        ratios = {r["column"]: r for r in unique_ratios(df, live).collect()}
        if constant:
            drop({c: str(ratios[c]["distinct"]) for c in live if ratios[c]["distinct"] <= 1 and (ratios[c]["filled"] or missing is None)}, "constant")
        if quasi_ratio is not None:
            drop({c: f"{ratios[c]['ratio']:.6f}" for c in live if ratios[c]["ratio"] is not None and ratios[c]["ratio"] <= quasi_ratio}, "quasi-constant")
    if live and duplicates:
        drop(duplicate_columns(df, live, keys), "duplicate")
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys and (f.name in live or f.name in protect)]
    if corr is not None and len(numbers) > 1:
        filled = df.agg(*(F.count(c).alias(c) for c in numbers)).first().asDict()
        pairs = sorted(((abs(r["corr"]), r["a"], r["b"]) for r in correlations(df, numbers, method).collect() if r["corr"] is not None and abs(r["corr"]) >= corr), key=lambda x: (-x[0], x[1], x[2]))
        out: dict[str, str] = {}
        for value, a, b in pairs:
            if a in out or b in out or a in protect and b in protect:
                continue
            worse = b if a in protect else a if b in protect else max((a, b), key=lambda c: (-filled[c], len(c), c))
            out[worse] = f"{value:.6f} with {a if worse == b else b}"
        drop(out, "correlated")
    return df.drop(*(c for c, _, _ in gone)), spark.createDataFrame(sorted(gone), REPORT)


def profile(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """column, rows, filled, missing, mean, low, high and a quantile for each share (p50, p90) of number columns."""
    spark, out = df.sparkSession, []
    one = df.agg(F.count("*").alias("_rows"), *(F.struct(F.count(c).alias("filled"), F.avg(c).alias("mean"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in columns)).first()
    for c in columns:
        s, n = one[c], one["_rows"]
        out.append((c, n, s["filled"], (n - s["filled"]) / n if n else None, s["mean"], s["low"], s["high"], *(ranks.quantiles(df, c, list(shares)) or [None] * len(shares))))
    names = ", ".join(f"p{round(q * 100)} double" for q in shares)
    return spark.createDataFrame(out, f"column string, rows bigint, filled bigint, missing double, mean double, low double, high double, {names}")


def key_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """side, the keys as trimmed text, n: keys that repeat on either side of a join, missing ones among them."""
    out = None
    for side, df in (("left", left), ("right", right)):
        rows = df.groupBy(*(F.trim(F.col(k).cast("string")).alias(k) for k in keys)).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(side).alias("side"), *keys, "n")
        out = rows if out is None else out.unionByName(rows)
    return out
