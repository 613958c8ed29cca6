"""Neighbourhood features on an axial hexagon grid.

Edges come from offsets by arithmetic, tagged with their distance, so one join and one aggregation serve all radii.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType


def distance(q: int, r: int) -> int:
    return max(abs(q), abs(r), abs(q + r))


def offsets(radius: int, exact: bool = False) -> list[tuple[int, int, int]]:
    """(dq, dr, distance) around a cell, itself left out: 6, 18, 36 of them within 1, 2, 3; exact: on the ring alone."""
    span = range(-radius, radius + 1)
    found = [(q, r, distance(q, r)) for q in span for r in span]
    return [x for x in found if 1 <= x[2] <= radius and (not exact or x[2] == radius)]


def cell_id(q, r) -> F.Column:
    return F.concat_ws("_", q.cast("long").cast("string"), r.cast("long").cast("string"))


def tagged_edges(cells: DataFrame, radius: int, hex_col: str = "hex_id") -> DataFrame:
    """cell, neighbor, distance between known cells; ids are axial coordinates q_r."""
    known = cells.select(F.col(hex_col).alias("cell")).where("cell is not null").distinct()
    q, r = (F.split_part("cell", F.lit("_"), F.lit(i)).cast("long") for i in (1, 2))
    around = F.array(*(F.struct(F.lit(a).alias("q"), F.lit(b).alias("r"), F.lit(d).alias("d")) for a, b, d in offsets(radius)))
    out = known.select("cell", q.alias("q"), r.alias("r"), F.explode(around).alias("o"))
    out = out.select("cell", cell_id(F.col("q") + F.col("o.q"), F.col("r") + F.col("o.r")).alias("neighbor"), F.col("o.d").alias("distance"))
    return out.join(known.select(F.col("cell").alias("neighbor")), "neighbor", "left_semi").select("cell", "neighbor", "distance")


def edges(cells: DataFrame, radii: Sequence[int], *, rolling: bool = True, hex_col: str = "hex_id") -> DataFrame:
    """cell, neighbor, R for each radius: disks (rolling) or exact rings. Radii under 1 are left out."""
    radii = sorted({r for r in radii if r >= 1})
    if not radii:
        return cells.sparkSession.createDataFrame([], "cell string, neighbor string, R int")
    tagged = tagged_edges(cells, max(radii), hex_col)
    fits = F.array(*(F.when(F.col("distance") <= r if rolling else F.col("distance") == r, F.lit(r)) for r in radii))
    return tagged.select("cell", "neighbor", F.explode(F.filter(fits, lambda x: x.isNotNull())).alias("R"))


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType) and f.name not in without]


def aggregates(df: DataFrame, radii: Sequence[int] = (1, 2, 3), *, rolling: bool = True, min_neighbors: int = 4, categorical: Sequence[str] = (), hex_col: str = "hex_id", year_col: str = "year", prefix: str = "nbr", count_mode: str = "edges", statistics: Sequence[str] = ("mean", "median")) -> DataFrame:
    """df with <prefix>_r<R>_n and, for each numeric column (booleans are none), the mean and median over the cells
    within R in the same year, and the most frequent value of each categorical one, the smallest of equals. They are
    null where n is under min_neighbors.

    count_mode "edges" counts a cell's neighbours in any year, 1 for an isolated cell; "present" counts those that have
    a row in the same year.
    """
    radii = sorted({r for r in radii if r >= 1})
    values = numeric_columns(df, (hex_col, year_col))
    if not radii:
        return df
    links = tagged_edges(df, max(radii), hex_col)
    right = df.select(F.col(hex_col).alias("neighbor"), F.col(year_col).alias("_year"), F.lit(True).alias("_here"), *(F.col(c).alias(f"_{c}") for c in [*values, *categorical]))
    fan = df.select(F.col(hex_col).alias("cell"), F.col(year_col).alias("_year")).join(links, "cell", "left").join(right, ["neighbor", "_year"], "left")
    aggs = []
    for r in radii:
        inside = F.col("distance") <= r if rolling else F.col("distance") == r
        counted = F.greatest(F.count(F.when(inside, F.col("neighbor"))), F.lit(1)) if count_mode == "edges" else F.count(F.when(inside, F.col("_here")))
        aggs.append(counted.alias(f"{prefix}_r{r}_n"))
        gate = lambda v, n=counted: F.when(n >= min_neighbors, v)
        for c in values:
            own = F.when(inside, F.col(f"_{c}"))
            aggs += [gate({"mean": F.avg, "median": F.median}[s](own)).alias(f"{prefix}_r{r}_{c}_{s}") for s in statistics]
        aggs += [gate(F.mode(F.when(inside, F.col(f"_{c}")), True)).alias(f"{prefix}_r{r}_{c}_mode") for c in categorical]
    found = fan.groupBy("cell", "_year").agg(*aggs)
    return df.join(found, (df[hex_col] == found["cell"]) & (df[year_col] == found["_year"]), "left").drop("cell", "_year")
