"""A planar hexagon grid and spatial joins as equi joins on grid cells.

Candidates come from bounding boxes: each is exploded to the cells it may touch, so neither the overlay nor the joins
compare everything with everything, and a large polygon is spread over many rows instead of one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexpanel.functions import geometry as G
from hexpanel.operators.neighbors import cell_id

ROOT3 = math.sqrt(3)
BAND = 64  # rows of cells


class HexGrid:
    """Pointy-top hexagons of a side in metres; ids are axial coordinates q_r."""

    def __init__(self, side: float):
        self.side = side

    @property
    def cell_area(self) -> float:
        return 1.5 * ROOT3 * self.side**2

    def center(self, q: Column, r: Column) -> tuple[Column, Column]:
        return self.side * ROOT3 * (q + r / 2), self.side * 1.5 * r

    def axial(self, cell: Column) -> tuple[Column, Column]:
        return tuple(F.split_part(cell, F.lit("_"), F.lit(i)).cast("long") for i in (1, 2))

    def cell_of(self, x: Column, y: Column) -> Column:
        """The cell of a point, by rounding cube coordinates."""
        q, r = (x * ROOT3 / 3 - y / 3) / self.side, (y * 2 / 3) / self.side
        s = -q - r
        rq, rr, rs = (F.floor(v + 0.5) for v in (q, r, s))
        dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
        return cell_id(F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq), F.when((dr >= dq) & (dr > ds), -rq - rs).otherwise(rr))

    def boundary(self, cell: Column) -> Column:
        """The open ring of a cell's corners, counter-clockwise."""
        x, y = self.center(*self.axial(cell))
        return F.array(*(G.point(x + self.side * math.cos(math.radians(60 * i - 30)), y + self.side * math.sin(math.radians(60 * i - 30))) for i in range(6)))

    def candidates(self, box: Column, margin: float) -> Column:
        """Cells whose centre is in a box widened by a margin in sides."""
        m = margin * self.side
        low, high = (F.ceil((box["y0"] - m) / (1.5 * self.side)), F.floor((box["y1"] + m) / (1.5 * self.side)))

        def row(r: Column) -> Column:
            first, last = (f((v / (ROOT3 * self.side)) - r / 2) for f, v in ((F.ceil, box["x0"] - m), (F.floor, box["x1"] + m)))
            return F.when(first <= last, F.transform(F.sequence(first, last), lambda q: cell_id(q, r))).otherwise(F.array().cast("array<string>"))

        return F.when(low <= high, F.flatten(F.transform(F.sequence(low, high), row))).otherwise(F.array().cast("array<string>"))

    def polyfill(self, df: DataFrame, geometry: str = "geometry") -> DataFrame:
        """hex_id of the cells whose centre is inside any of the polygons; a centre on a border that two share is in one."""
        cells = df.select(geometry, F.explode(self.candidates(G.bounds(F.col(geometry)), 0.0)).alias("hex_id"))
        x, y = self.center(*self.axial(F.col("hex_id")))
        return cells.where(G.contains_point(F.col(geometry), x, y)).select("hex_id").distinct()

    def overlay(self, df: DataFrame, geometry: str = "geometry", cells: DataFrame | None = None) -> DataFrame:
        """df's rows by cell: hex_id, area (of the row's polygon in it), hex_area; parts without area are left out. A
        polygon goes once to each band of BAND rows of cells, so a large one is spread over tasks, and its cells in a band
        are cut together. cells: those to keep (hex_id)."""
        box, tall = G.bounds(F.col(geometry)), 1.5 * self.side
        low, high = F.floor((box["y0"] - self.side) / tall / BAND), F.floor((box["y1"] + self.side) / tall / BAND)
        banded = df.withColumn("_band", F.explode(F.sequence(low, high)))
        parts = G.overlay_parts(F.col(geometry), F.col("_band") * BAND, F.col("_band") * BAND + BAND - 1, self.side)
        out = banded.withColumn("_part", F.explode(parts)).withColumns({"hex_id": cell_id(F.col("_part.q"), F.col("_part.r")), "area": F.col("_part.area")}).drop("_band", "_part")
        if cells is not None:
            out = out.join(cells.select("hex_id"), "hex_id", "left_semi")
        return out.withColumn("hex_area", F.lit(self.cell_area))


def spatial_join(left: DataFrame, right: DataFrame, kind: str = "intersects", *, how: str = "inner", cell: float = 1000.0, left_geometry: str = "geometry", right_geometry: str = "geometry", left_key: Sequence[str] = ("id",)) -> DataFrame:
    """Pairs of rows whose polygons fulfil "intersects" or "within" (left inside right); how "left" keeps left rows
    without a match. Both sides are dealt to square cells of their boxes and meet by equality; of the cells that a pair
    shares only the one with the lower left corner of their common box counts, so no pair comes twice."""
    buckets = lambda b: F.flatten(F.transform(F.sequence(F.floor(b["x0"] / cell), F.floor(b["x1"] / cell)), lambda i: F.transform(F.sequence(F.floor(b["y0"] / cell), F.floor(b["y1"] / cell)), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    ours = left.withColumn("_lb", G.bounds(F.col(left_geometry)))
    theirs = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns if c in left.columns}).withColumn("_rb", G.bounds(F.col(f"_r_{right_geometry}" if right_geometry in left.columns else right_geometry)))
    rg = f"_r_{right_geometry}" if right_geometry in left.columns else right_geometry
    pairs = ours.withColumn("_c", F.explode(buckets(F.col("_lb")))).join(theirs.withColumn("_c", F.explode(buckets(F.col("_rb")))), "_c")
    x, y = F.greatest("_lb.x0", "_rb.x0"), F.greatest("_lb.y0", "_rb.y0")
    boxes = (x <= F.least("_lb.x1", "_rb.x1")) & (y <= F.least("_lb.y1", "_rb.y1"))
    once = (F.floor(x / cell) == F.col("_c.i")) & (F.floor(y / cell) == F.col("_c.j"))
    found = pairs.where(boxes & once).where(G.predicate(kind)(F.col(left_geometry), F.col(rg))).drop("_c", "_lb", "_rb")
    if how == "inner":
        return found
    rest = left.join(found.select(*left_key).distinct(), list(left_key), "left_anti")
    return found.unionByName(rest, allowMissingColumns=True)


def join_chain(left: DataFrame, layers: Sequence[tuple[DataFrame, str]], *, cell: float = 1000.0, geometry: str = "geometry", key: Sequence[str] = ("id",)) -> DataFrame:
    """left with the columns of one layer after another (table, its geometry column) whose polygons meet its own; a row
    comes once for every combination, and once with nulls where a layer has none. key: what identifies a row of left."""
    out, keys = left, list(key)
    for n, (table, name) in enumerate(layers):
        found = spatial_join(left.select(*key, geometry), table, "intersects", how="left", cell=cell, left_geometry=geometry, right_geometry=name, left_key=list(key))
        out = out.join(found.drop(geometry, name), keys, "left")
    return out


def dissolve(df: DataFrame, keys: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """One row a key with the parts of all its polygons, in order; shared borders stay. A key's parts are one value: meant
    for fragments of a cell."""
    parts = F.flatten(F.array_sort(F.collect_list(F.when(F.col(geometry).isNotNull(), F.col(geometry)))))
    return df.groupBy(*keys).agg(parts.alias(geometry))


def reattach(values: DataFrame, cells: DataFrame, key: str = "hex_id", geometry: str = "geometry") -> DataFrame:
    """values with the geometry of their cells; cells without values keep a row of nulls, values without a cell go."""
    return values.drop(geometry).join(cells.select(key, geometry), key, "right")


def grid_of_year(df: DataFrame, year: int, sides: Sequence[float], *, srid: int | None, geometry: str = "geometry", column: str = "year") -> DataFrame:
    """hex_id, side, geometry of the cells, for each side, whose centre is in a polygon of a year. Coordinates that are no
    metres are a ValueError, as is a year without rows; a table without a year is a KeyError."""
    G.metric_srid(srid)
    if column not in df.columns:
        raise KeyError(column)
    rows = df.where(F.col(column) == year)
    if rows.isEmpty():
        raise ValueError(f"no rows of {year}")
    out = None
    for side in sides:
        grid = HexGrid(side)
        ring = grid.boundary(F.col("hex_id"))
        closed = F.concat(ring, F.slice(ring, 1, 1))
        shape = F.array(F.struct(closed.alias("exterior"), F.array().cast(f"array<array<{G.POINT}>>").alias("holes")))
        cells = grid.polyfill(rows, geometry).select("hex_id", F.lit(float(side)).alias("side"), shape.alias("geometry"))
        out = cells if out is None else out.unionByName(cells)
    return out
