"""Flat-text cadastral exchange files (.swd, .swde) as polygon layers.

A file is one sequence of records and can't be split, so each is read whole by one task and turned into typed rows
there; joining of points, choice of tables and enrichment are DataFrame operations over the rows of all files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexpanel.functions.geometry import POINT

ENCODING = "iso-8859-2"
#: Names of tables, fields and layers in the format.
PARCEL_TABLES, POINT_TABLE, ATTRIBUTE_TABLES, CONTOUR_TABLES = ("G5G_DZE", "G5DZE"), "G5PZG", ("G5DZE", "G5O_DZE"), ("G5KKL", "G5G_KKL")
ID_FIELD, CONTOUR_FIELDS = "G5IDD", ("G5IDK", "G5OZU", "G5OZK", "G5PEW")
PARCELS, LAND_USE, CLASSIFICATION = "DzialkaEwidencyjna", "KonturUzytkuGruntowego", "KonturKlasyfikacyjny"

RECORD = "table string,n bigint,id string,alt_id string,xy " + POINT + ",rings array<struct<sign:string,pts:array<struct<ref:string,x:double,y:double>>>>,attrs map<string,string>"
_XY = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_RINGS = pa.list_(pa.struct([("sign", pa.string()), ("pts", pa.list_(pa.struct([("ref", pa.string()), ("x", pa.float64()), ("y", pa.float64())])))]))
_ARROW = pa.schema([("table", pa.string()), ("n", pa.int64()), ("id", pa.string()), ("alt_id", pa.string()), ("xy", _XY), ("rings", _RINGS), ("attrs", pa.map_(pa.string(), pa.string()))])


def declared_type(text: str) -> str | None:
    """The type that a file's head declares; it says nothing reliable about the content."""
    for line in text.split("\n", 30)[:30]:
        if (line := line.strip()).startswith("NS,ZN,"):
            return line[6:].rstrip(";").strip()
    return None


class _Reader:
    """One record at a time; a line's mark names the method that takes its fields."""

    def __init__(self) -> None:
        self.open = False
        self.rows: list[dict] = []
        self.record: dict | None = None
        self.ring: dict | None = None

    def line(self, text: str) -> None:
        if not self.open:
            self.open = text in ("SO;", "ST;")
            return
        fields = text.split(",")
        mark = fields[0].rstrip(";")
        if len(mark) == 2 and mark[0] == "R" and mark[1] in "ODCLP" and len(fields) > 1:
            self.begin([f.rstrip(";") for f in fields[2:5]] + [None] * 3)
        elif self.record is None:
            return
        elif mark == "D" and len(fields) > 1:
            self.record["attrs"][fields[1]] = text.split(",", 3)[3] if len(fields) > 3 else ""
        elif mark == "P" and len(fields) > 1:
            self.point(fields)
        elif mark == "GL":
            self.record["rings"] = []
        elif mark == "K" and len(fields) > 1:
            self.ring = {"sign": fields[1].rstrip(";"), "pts": []}
        elif mark == "PZ":
            if self.ring is not None and self.record["rings"] is not None:
                self.record["rings"].append(self.ring)
            self.ring = None
        elif mark == "X" or mark == "XC" and len(fields) > 1:
            if self.record["table"] is not None:
                self.rows.append(self.record | {"n": len(self.rows)})
            self.record = None

    def begin(self, head: list) -> None:
        self.record = {"table": head[0], "id": head[1], "alt_id": head[2], "xy": None, "rings": None, "attrs": {}}

    def point(self, fields: list[str]) -> None:
        if fields[1] == "G":
            try:
                x, y = float(fields[2]), float(fields[3].rstrip(";"))
            except (IndexError, ValueError):
                return
            if self.ring is not None:
                self.ring["pts"].append({"ref": None, "x": x, "y": y})
            else:
                self.record["xy"] = {"x": x, "y": y}
        elif fields[1] in ("P", "K") and self.ring is not None:
            self.ring["pts"].append({"ref": fields[-1].rstrip(";"), "x": None, "y": None})


def parse(text: str) -> list[dict]:
    reader = _Reader()
    for line in text.split("\n"):
        if line := line.strip():
            reader.line(line)
    return reader.rows


def records(spark: SparkSession, path: str) -> DataFrame:
    """path, and the fields of RECORD for every record of every file under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{swd,SWD,swde,SWDE}").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = parse(content.decode(ENCODING))
                for at in range(0, len(rows), 5000):
                    part = pa.Table.from_pylist([{**r, "attrs": list(r["attrs"].items())} for r in rows[at : at + 5000]], _ARROW)
                    yield from part.add_column(0, "path", pa.array([name] * part.num_rows, pa.string())).to_batches()

    return files.mapInArrow(run, f"path string,{RECORD}")


def _first_table(rows: DataFrame, tables: tuple[str, ...]) -> DataFrame:
    """Of each file, the records of the first of the tables that it has."""
    rank = F.array_position(F.array(*map(F.lit, tables)), F.col("table"))
    some = rows.where(F.col("table").isin(*tables)).withColumn("_rank", rank)
    return some.withColumn("_best", F.min("_rank").over(Window.partitionBy("path"))).where("_rank = _best").drop("_rank", "_best")


def _polygons(rows: DataFrame) -> DataFrame:
    """geometry of records whose rings are resolved: the first positive ring is the exterior, every other a hole; rings of
    under three points don't count, and records without an exterior go."""
    close = lambda pts: F.when(F.element_at(pts, 1) == F.element_at(pts, -1), pts).otherwise(F.concat(pts, F.slice(pts, 1, 1)))
    solid = F.filter("rings", lambda r: F.size(r["pts"]) >= 3)
    at = F.array_position(F.transform("solid", lambda r: r["sign"]), F.lit("+")).cast("int")
    out = rows.withColumn("solid", solid).withColumn("at", at).where(F.col("at") > 0)
    xy = lambda r: close(F.transform(r["pts"], lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    holes = F.transform(F.filter("solid", lambda r, i: i != F.col("at") - 1), xy)
    return out.withColumn("geometry", F.array(F.struct(xy(F.element_at("solid", F.col("at"))).alias("exterior"), holes.alias("holes")))).drop("solid", "at", "rings")


def layers(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Layer name -> DataFrame with path and geometry. Parcels have idDzialki and the attributes of both attribute tables
    (a map a table: the names of fields differ from delivery to delivery); contours, of files that have parcels, their
    four fields, and are one table under two names."""
    rows = records(spark, path)
    named = rows.where((F.col("table") == POINT_TABLE) & F.col("xy").isNotNull())
    points = named.select("path", F.explode(F.array_compact(F.array("id", "alt_id"))).alias("ref"), "xy", "n").groupBy("path", "ref").agg(F.max_by("xy", "n").alias("xy"))
    geometry = _first_table(rows, PARCEL_TABLES).where(F.size("rings") > 0)
    flat = geometry.select("path", "n", "id", F.element_at("attrs", F.lit(ID_FIELD)).alias("idDzialki"), F.posexplode("rings").alias("ring", "r")).select("path", "n", "id", "idDzialki", "ring", F.col("r.sign").alias("sign"), F.posexplode_outer("r.pts").alias("place", "p"))
    joined = flat.join(points, (flat["path"] == points["path"]) & (F.col("p.ref") == points["ref"]), "left").drop(points["path"])
    found = joined.withColumn("q", F.when(F.col("p.ref").isNull(), F.struct("p.x", "p.y")).otherwise(F.struct("xy.x", "xy.y"))).where("q.x is not null")
    ring = found.groupBy("path", "n", "id", "idDzialki", "ring", "sign").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "q"))), lambda s: s["q"]).alias("pts"))
    whole = ring.groupBy("path", "n", "id", "idDzialki").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "sign", "pts"))), lambda s: F.struct(s["sign"].alias("sign"), s["pts"].alias("pts"))).alias("rings"))
    parcels = _polygons(whole).select("path", "idDzialki", F.col("id").alias("_geom_id"), "geometry")
    for table in ATTRIBUTE_TABLES:
        attrs = rows.where(F.col("table") == table).withColumn("k", F.element_at("attrs", F.lit(ID_FIELD))).where("k is not null")
        first = attrs.groupBy(F.col("path").alias("p"), "k").agg(F.min_by("attrs", "n").alias(f"attrs_{table}"))
        parcels = parcels.join(first, (parcels["path"] == F.col("p")) & (parcels["idDzialki"] == F.col("k")), "left").drop("p", "k")
    inline = _first_table(rows, CONTOUR_TABLES).withColumn("rings", F.transform("rings", lambda r: F.struct(r["sign"].alias("sign"), F.filter(r["pts"], lambda p: p["ref"].isNull()).alias("pts"))))
    contours = _polygons(inline).join(parcels.select("path").distinct(), "path", "left_semi").select("path", *(F.element_at("attrs", F.lit(c)).alias(c) for c in CONTOUR_FIELDS), "geometry")
    return {PARCELS: parcels, LAND_USE: contours, CLASSIFICATION: contours}
