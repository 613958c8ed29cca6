"""Model metrics over (score, label) tables, computed where the rows are; ties in scores count as one step."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexpanel.operators import ranks


def _steps(df: DataFrame, score: str, label: str) -> DataFrame:
    """A row per distinct score, with its positives and rows and those at or above it."""
    by = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum(F.col(label).cast("double")).alias("p"), F.count("*").cast("double").alias("n"))
    return ranks.running(by, -F.col("s"), {"tp": F.col("p"), "seen": F.col("n")})


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum over distinct scores, from the highest, of the gain in recall times the precision there."""
    return _steps(df, score, label).agg((F.sum(F.col("p") * F.col("tp") / F.col("seen")) / F.nullif(F.sum("p"), F.lit(0.0))).alias("average_precision"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties counting half: all pairs less those in which the negative is
    at or above, and half of the ties."""
    q = F.col("n") - F.col("p")
    all_ = F.sum("p") * F.sum(q)
    return _steps(df, score, label).agg(F.try_divide(all_ - F.sum(F.col("p") * (F.col("seen") - F.col("tp") - q / 2)), all_).alias("roc_auc"))


def brier(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label).cast("double"), 2)).alias("brier"))


def top_fraction(df: DataFrame, score: str, key: str, fraction: float) -> DataFrame:
    """The max(1, floor(fraction * n)) rows of highest score, ties by key."""
    n = max(1, int(fraction * df.count()))
    return ranks.numbered(df, -F.col(score).cast("double"), key, out="_place").where(F.col("_place") <= n).drop("_place")


def lift_at_k(df: DataFrame, score: str, label: str, key: str, fraction: float = 0.1) -> DataFrame:
    """hits, precision, base_rate, lift, capture of the best-scored fraction."""
    top = top_fraction(df, score, key, fraction).agg(F.sum(F.col(label).cast("double")).alias("hits"), F.count("*").alias("k"))
    base = df.agg(F.avg(F.col(label).cast("double")).alias("base_rate"), F.sum(F.col(label).cast("double")).alias("positives"))
    out = top.crossJoin(base)  # one row each
    precision = F.col("hits") / F.col("k")
    return out.select(F.col("k"), "hits", precision.alias("precision"), "base_rate", F.try_divide(precision, F.col("base_rate")).alias("lift"), F.try_divide(F.col("hits"), F.col("positives")).alias("capture"))


def calibration_bins(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and mean label of bins between linear quantiles, closed on the right, equal edges dropped."""
    edges = F.array(*map(F.lit, dict.fromkeys(ranks.quantiles(df, score, [i / bins for i in range(bins + 1)])))).cast("array<double>")
    bin_ = F.greatest(F.size(F.filter(edges, lambda x: x < F.col(score))) - 1, F.lit(0)).cast("long")
    return df.groupBy(bin_.alias("bin")).agg(F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("mean_label"), F.count("*").alias("n"))


def benjamini_hochberg(df: DataFrame, p: str, key: str, alpha: float = 0.05) -> DataFrame:
    """df with significant: p at or under the largest p that is at most alpha * rank / n."""
    m = df.count()
    ranked = ranks.numbered(df, F.col(p), key, out="_place")
    cutoff = ranked.agg(F.max(F.when(F.col(p) <= alpha * F.col("_place") / m, F.col("_place")))).first()[0] if m else None
    return ranked.withColumn("significant", F.col("_place") <= (cutoff or 0)).drop("_place")


def permutation_significance(score_of, df: DataFrame, columns: Sequence[str], key: str, *, repeats: int = 20, seed: int = 42) -> list[dict]:
    """For each column, the fall of score_of(df) when the column is dealt anew by a hash of the key, `repeats` times:
    mean, 95 % interval and p = (1 + falls that are no falls) / (repeats + 1)."""
    base, out = score_of(df), []
    for c in columns:
        falls = []
        for i in range(repeats):
            values = ranks.numbered(df.select(key, F.col(c).alias("_v")), F.xxhash64(key, F.lit(seed + i)), key, out="_n").select("_n", "_v")
            rows = ranks.numbered(df, F.xxhash64(key, F.lit(seed - 1)), key, out="_n")
            falls.append(base - score_of(rows.join(values, "_n").drop(c, "_n").withColumnRenamed("_v", c)))
        at = lambda q, falls=falls: float(np.percentile(falls, 100 * q))
        out.append({"feature": c, "mean": sum(falls) / repeats, "low": at(0.025), "high": at(0.975), "p": (1 + sum(x <= 0 for x in falls)) / (repeats + 1)})
    return out


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same each time."""
    return ranks.numbered(df, F.xxhash64(key, F.lit(seed)), key, out="_place").where(F.col("_place") <= n).drop("_place")
