"""Area-weighted aggregation of polygon fragments to a (cell, year) panel.

A fragment is one polygon's part in one cell. Layers share the kernel and differ in denominator and coverage filter.
All sums of a layer run in one aggregation, so a layer costs one shuffle; only the dominant category needs a second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("hex_id", "year")
MOST_CLASSES = 1000


def half_even(x: Column, decimals: int) -> Column:
    """x to a number of decimals, ties of the scaled double to the even neighbour: rint(x * 10^n) / 10^n."""
    return F.rint(x * 10.0**decimals) / 10.0**decimals


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def mean_non_null(x: str, weight: str) -> Column:
    """Weighted mean over the fragments that have a value."""
    v = F.col(x)
    return _ratio(F.sum(v * F.col(weight)), F.sum(F.when(v.isNotNull(), F.col(weight))))


def mean_diluted(x: str, weight: str, zero_as_null: bool = False) -> Column:
    """Weighted sum over the weight of all fragments: missing values count as none of it, and pull towards zero."""
    v = F.nullif(F.col(x), F.lit(0)) if zero_as_null else F.col(x)
    return _ratio(F.sum(F.coalesce(v, F.lit(0)) * F.col(weight)), F.sum(weight))


def mean_non_zero(x: str, weight: str) -> Column:
    """Weighted mean over the fragments whose value is neither missing nor zero; null where there is none."""
    v = F.nullif(F.col(x), F.lit(0))
    return _ratio(F.sum(v * F.col(weight)), F.sum(F.when(v.isNotNull(), F.col(weight))))


def weighted_means(fragments: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEYS, area: str = "area", hex_area: str | None = None, denominator: str = "non_null", zero_as_null: Sequence[str] = (), non_zero: Sequence[str] = ()) -> DataFrame:
    """<column>_mean for each column, and <column>_mean_nz for those in non_zero. denominator: "non_null" or "all"."""
    weight = "_w"
    weighted = fragments.withColumn(weight, _ratio(F.col(area), F.col(hex_area)) if hex_area else F.col(area))
    one = {"non_null": lambda c: mean_non_null(c, weight), "all": lambda c: mean_diluted(c, weight, c in zero_as_null)}[denominator]
    means = [one(c).alias(f"{c}_mean") for c in columns] + [mean_non_zero(c, weight).alias(f"{c}_mean_nz") for c in non_zero]
    return weighted.groupBy(*keys).agg(*means)


def coverage(fragments: DataFrame, *, keys: Sequence[str] = KEYS, area: str = "area", hex_area: str = "hex_area", unique: str | None = None) -> DataFrame:
    """coverage_area and hex_area of each cell and year, n_parcel where an id is named; cells without area are left out."""
    aggs = [F.sum(area).alias("coverage_area"), F.max(hex_area).alias("hex_area")]
    if unique:
        aggs.append(F.count_distinct(unique).alias("n_parcel"))
    return fragments.groupBy(*keys).agg(*aggs).where("coverage_area > 0")


def filter_groups(df: DataFrame, least: float, decimals: int | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keeps cells whose summed coverage is at least a share of their area, adds it as coverage_frac, then rounds."""
    out = df.where("hex_area > 0").withColumn("coverage_frac", F.col("coverage_area") / F.col("hex_area")).where(F.col("coverage_frac") >= least)
    return out if decimals is None else round_floats(out, decimals, keys)


def filter_fragments(df: DataFrame, least: float, area: str = "area", hex_area: str = "hex_area") -> DataFrame:
    """Drops every fragment that covers less than a share of its cell, before any aggregation."""
    return df.where(_ratio(F.col(area), F.col(hex_area)) >= least)


def round_floats(df: DataFrame, decimals: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Half-even rounding of all floating columns but the keys."""
    floats = [c for c, t in df.dtypes if t in ("double", "float") and c not in keys]
    return df.withColumns({c: half_even(F.col(c), decimals) for c in floats})


def dominant(fragments: DataFrame, category: str, *, keys: Sequence[str] = KEYS, area: str = "area", out: str = "jednostka") -> DataFrame:
    """Category of largest summed area in each cell and year; the smallest of equals. Missing categories don't count."""
    sums = fragments.where(F.col(category).isNotNull()).groupBy(*keys, category).agg(F.sum(area).alias("_a"))
    return sums.groupBy(*keys).agg(F.min_by(category, F.struct(-F.col("_a"), F.col(category))).alias(out))


def class_shares(fragments: DataFrame, category: str, classes: Sequence[str] | None = None, *, keys: Sequence[str] = KEYS, area: str = "area", hex_area: str = "hex_area", prefix: str = "", decimals: int | None = None) -> DataFrame:
    """<prefix><class>_share: summed area of a class over the cell's area, at most 1. Classes that a cell lacks are 0,
    those not listed are left out, and a cell with missing classes only has no row. classes None: all, in order; more
    than MOST_CLASSES fail."""
    known = fragments.where(F.col(category).isNotNull())
    if classes is None:
        classes = [r[0] for r in known.select(category).distinct().orderBy(category).limit(MOST_CLASSES + 1).collect()]
        if len(classes) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes to make columns of")
    share = lambda c: F.least(F.greatest(F.coalesce(_ratio(F.sum(F.when(F.col(category) == c, F.col(area))), F.max(hex_area)), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    rounded = (lambda x: half_even(x, decimals)) if decimals is not None else (lambda x: x)
    return known.groupBy(*keys).agg(*(rounded(share(c)).alias(f"{prefix}{c}_share") for c in classes))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns, missing values as 0."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total
