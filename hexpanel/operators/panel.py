"""Change labels over a (cell, year) panel: one window per cell, ordered by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexpanel.operators import ranks
from hexpanel.operators.overlay import half_even


def relative_change(now: Column, before: Column) -> Column:
    """0 for 0 to 0; null where the base is 0, which no tolerance admits."""
    return F.when((now == 0) & (before == 0), F.lit(0.0)).otherwise(F.try_divide(now - before, before))


def _labels(df: DataFrame, proxy: str, hex_col: str, year_col: str, horizon: int, censored: bool, guard_leads: bool) -> DataFrame:
    """onset, y_next, y_next_onset, y_next_2, y_next_3 and y_next_<h> of a proxy column. censored: labels beyond the
    last year are null instead of False; guard_leads: leads over a gap of years are null."""
    w = Window.partitionBy(hex_col).orderBy(year_col)
    missing = F.lit(None).cast("boolean") if censored else F.lit(False)

    def ahead(h: int) -> Column:
        y = F.coalesce(F.lead(proxy, h).over(w), missing)
        if guard_leads:
            y = F.when(F.coalesce(F.lead(year_col, h).over(w) - F.col(year_col) == h, F.lit(True)), y)
        return y

    horizons = [1, 2, 3] + ([horizon] if horizon > 3 else [])
    out = df.withColumns({"onset": F.col(proxy) & ~F.lag(proxy, 1, False).over(w)} | {f"y_next{'' if h == 1 else f'_{h}'}": ahead(h) for h in horizons})
    return out.withColumn("y_next_onset", F.col("y_next") & ~F.coalesce(F.lag("y_next").over(w), F.lit(False)))


def _steps(df: DataFrame, hex_col: str, year_col: str, named: dict[str, str]) -> DataFrame:
    """valid_transition, and d_<name> of each column; total_change of the one called total."""
    w = Window.partitionBy(hex_col).orderBy(year_col)
    cols = {"valid_transition": F.coalesce(F.col(year_col) - F.lag(year_col).over(w) == 1, F.lit(False))}
    for name, c in named.items():
        before = F.lag(c).over(w)
        cols["total_change" if name == "total" else f"d_{name}"] = relative_change(F.col(c), before) if name == "total" else F.col(c) - before
    return df.withColumns(cols)


def split_labels(df: DataFrame, *, hex_col: str = "hex_id", year_col: str = "year", mean_col: str = "shape_area_mean", total_col: str = "coverage_area", count_col: str | None = "n_parcel", tolerance: float = 0.005, least_drop: float = 0.01, horizon: int = 0, censored: bool = False, guard_leads: bool = False) -> DataFrame:
    """split_proxy: from the year before, the mean area falls by more than least_drop, the total changes by no more than
    the tolerance, and the count, where there is one, grows; with the labels of `_labels`."""
    named = {"mean": mean_col, "total": total_col} | ({"count": count_col} if count_col else {})
    out = _steps(df, hex_col, year_col, named)
    proxy = (F.col("d_mean") < -least_drop) & (F.abs("total_change") <= tolerance) & F.col("valid_transition")
    if count_col:
        proxy = proxy & (F.col("d_count") > 0)
    return _labels(out.withColumn("split_proxy", F.coalesce(proxy, F.lit(False))), "split_proxy", hex_col, year_col, horizon, censored, guard_leads)


def conversion_labels(df: DataFrame, *, hex_col: str = "hex_id", year_col: str = "year", share_r: str = "uzg_R_share", share_b: str = "uzg_B_share", total_col: str = "sum_uzg", tolerance: float = 0.01, horizon: int = 0, censored: bool = False, guard_leads: bool = False) -> DataFrame:
    """convert_proxy: from the year before, the first share falls, the second grows and the total keeps within the
    tolerance; with the labels of `_labels`."""
    out = _steps(df, hex_col, year_col, {"r": share_r, "b": share_b, "total": total_col})
    proxy = (F.col("d_r") < 0) & (F.col("d_b") > 0) & (F.abs("total_change") <= tolerance) & F.col("valid_transition")
    return _labels(out.withColumn("convert_proxy", F.coalesce(proxy, F.lit(False))), "convert_proxy", hex_col, year_col, horizon, censored, guard_leads)


def carry_forward(df: DataFrame, column: str, *, by: str, order: str | list[str]) -> DataFrame:
    """Fills missing values with the last one before, within a key; missing keys are one group."""
    order = [order] if isinstance(order, str) else order
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def percentile_rank(column: str, by: list[str] | None = None) -> Column:
    """Share of the rows of a group up to a value, ties averaged, in per cent with one decimal. A group is one task's: for
    whole tables, with_percentile_rank."""
    part = Window.partitionBy(*(by or [F.lit(1)]))
    rank = F.rank().over(part.orderBy(column))
    ties = F.count("*").over(Window.partitionBy(*(by or []), column))
    return half_even((rank + (ties - 1) / 2) / F.count(column).over(part) * 100, 1)


def with_percentile_rank(df: DataFrame, column: str, out: str = "percentile") -> DataFrame:
    """df with the share of filled values up to a value, ties averaged, in per cent with one decimal; no task orders the
    whole table."""
    n = df.agg(F.count(column)).first()[0]
    return ranks.average_rank(df, column, out).withColumn(out, half_even(F.col(out) / F.lit(n) * 100, 1))
