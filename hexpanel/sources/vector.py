"""GML and shapefile sources, GeoParquet, and the address of a feature service."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from urllib.parse import urlencode

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.functions import geometry as G

#: List-valued attributes of parcels and contours in GML.
LIST_COLUMNS = ("numerKW", "OFU", "powierzchnia", "powierzchnia_uom", "OZU", "OZK")


def flatten_first(df: DataFrame, columns=LIST_COLUMNS) -> DataFrame:
    """List columns become their first element; empty lists become null."""
    lists = [c for c, t in df.dtypes if c in columns and t.startswith("array")]
    return df.withColumns({c: F.get(c, 0) for c in lists})


def ring_of_poslist(c: Column, swap: bool = False) -> Column:
    """Points of a GML posList: numbers in pairs, northing first where swap."""
    n = F.transform(F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != ""), lambda x: x.try_cast("double"))
    at = F.when(F.size(n) > 1, F.sequence(F.lit(1), F.size(n) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    first, second = (lambda i: F.element_at(n, i.cast("int"))), (lambda i: F.element_at(n, (i + 1).cast("int")))
    return F.transform(at, lambda i: G.point(second(i), first(i)) if swap else G.point(first(i), second(i)))


def read_gml(spark: SparkSession, path: str, tag: str, schema: str, *, exterior: str, interior: str | None = None, swap: bool = False) -> DataFrame:
    """Features of a GML file by their element name. exterior: column with the outer posList; interior: array of inner."""
    df = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").schema(schema).load(path)
    holes = F.transform(F.col(interior), lambda r: ring_of_poslist(r, swap)) if interior else F.array().cast(f"array<array<{G.POINT}>>")
    part = F.struct(ring_of_poslist(F.col(exterior), swap).alias("exterior"), F.coalesce(holes, F.array().cast(f"array<array<{G.POINT}>>")).alias("holes"))
    return flatten_first(df.withColumn("geometry", F.when(F.col(exterior).isNotNull(), F.array(part))))


def parse_shp(data: bytes) -> list:
    """Polygons of a .shp file, record by record; None for what is no polygon. Clockwise rings are exteriors, the others
    holes of the exterior before that contains their first point, or of the last."""
    out, at = [], 100
    while at + 8 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        body, at = data[at + 8 : at + 8 + size], at + 8 + size
        if len(body) < 44 or struct.unpack_from("<i", body)[0] not in (5, 15, 25):
            out.append(None)
            continue
        parts, n = struct.unpack_from("<2i", body, 36)
        first = [*struct.unpack_from(f"<{parts}i", body, 44), n]
        xy = np.frombuffer(body, "<f8", 2 * n, 44 + 4 * parts).reshape(n, 2)
        polygons: list = []
        for a, b in zip(first, first[1:], strict=False):
            ring = xy[a:b]
            if not polygons or G.shoelace(ring[:-1]) < 0:
                polygons.append((ring, []))
            else:
                home = next((p for p in reversed(polygons) if G._inside(ring[:1], [(p[0], [])])[0]), polygons[-1])
                home[1].append(ring)
        out.append(polygons)
    return out


def parse_dbf(data: bytes, encoding: str = "utf-8") -> list[dict[str, str | None]]:
    """Rows of a .dbf file as text; blanks are None; deleted rows keep their place."""
    n, head, width = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), data[at + 16]))
        at += 32
    rows = []
    for i in range(n):
        p, row = head + i * width + 1, {}
        for name, size in fields:
            row[name] = data[p : p + size].decode(encoding, "replace").strip(" \0") or None
            p += size
        rows.append(row)
    return rows


def alias_index(layer_map: dict[str, list[str]]) -> dict[str, list[str]]:
    """Upper-case alias -> canonical layers; one alias may feed several."""
    out: dict[str, list[str]] = {}
    for layer, aliases in layer_map.items():
        for a in [layer, *aliases]:
            if layer not in out.setdefault(a.upper(), []):
                out[a.upper()].append(layer)
    return out


def read_shapefiles(spark: SparkSession, path: str, layer_map: dict[str, list[str]], encoding: str = "utf-8") -> DataFrame:
    """layer, path, n, attrs (map of text), geometry of all known .shp files under a path with the .dbf beside them. A
    file whose name is an alias of several layers feeds each; where two files feed one, the later path replaces it."""
    index = alias_index(layer_map)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{shp,dbf,SHP,DBF}").load(path)
    stem = F.regexp_replace("path", r"(?i)\.(shp|dbf)$", "")
    both = files.groupBy(stem.alias("stem")).agg(*(F.max(F.when(F.lower("path").endswith(f".{k}"), F.col("content"))).alias(k) for k in ("shp", "dbf"))).where("shp is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("n", pa.int64()), ("attrs", pa.map_(pa.string(), pa.string())), ("geometry", G.ARROW)])
        for batch in batches:
            for row in batch.to_pylist():
                shapes = parse_shp(row["shp"])
                attrs = parse_dbf(row["dbf"], encoding) if row["dbf"] else []
                rows = [{"path": row["stem"], "n": i, "attrs": list(attrs[i].items()) if i < len(attrs) else [], "geometry": G.to_rows(G.repair(s))} for i, s in enumerate(shapes) if s]
                yield from pa.Table.from_pylist(rows, kind).to_batches()

    found = both.mapInArrow(run, f"path string,n bigint,attrs map<string,string>,geometry {G.GEOMETRY}")
    named = [(a, layer) for a, layers in index.items() for layer in layers]
    pairs = spark.createDataFrame(named, "alias string, layer string")
    name = F.upper(F.element_at(F.split("path", "/"), -1))
    out = found.withColumn("alias", name).join(F.broadcast(pairs), "alias").drop("alias")  # one row an alias of the configuration
    last = out.groupBy("layer").agg(F.max("path").alias("path"))
    return out.join(last, ["layer", "path"], "left_semi").select("layer", "path", "n", "attrs", "geometry")


def geometry_column(footer: bytes | str | None, columns: list[str]) -> str:
    """Primary geometry column by the geo footer, else geometry, GEOMETRY, geom, else the last."""
    if footer:
        primary = json.loads(footer).get("primary_column")
        if primary in columns:
            return primary
    return next((c for c in ("geometry", "GEOMETRY", "geom") if c in columns), columns[-1])


def geo_footer(spark: SparkSession, path: str) -> str | None:
    """What the footer of a table's first file says under `geo`, read by the JVM's own Parquet reader from any store."""
    file = spark.read.parquet(path).select("_metadata.file_path").first()
    if file is None:
        return None
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file[0]))
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getKeyValueMetaData().get("geo")
    finally:
        reader.close()


def footer_srid(footer: str, column: str) -> int | None:
    """EPSG code of a geometry column: without a system degrees (4326), with one that names no number None."""
    told = json.loads(footer)
    about = told.get("columns", {}).get(column, {})
    if "srid" in told:
        return told["srid"]
    if "crs" not in about:
        return 4326
    code = ((about["crs"] or {}).get("id") or {}).get("code")
    return int(code) if str(code).isdecimal() else None


def read_geoparquet(spark: SparkSession, path: str, geometry: str | None = None, srid: int | None = None) -> DataFrame:
    """A GeoParquet table with its geometry parsed; the srid is metadata of the column. What isn't named here comes from
    the files' footer, else from the sidecar that `sinks.write_geoparquet` leaves."""
    df = spark.read.parquet(path)
    told = None
    if geometry is None or srid is None:
        told = geo_footer(spark, path)
        if told is None and _exists(spark, side := f"{path.rstrip('/')}_geo.json"):
            told = spark.read.text(side, wholetext=True).first()[0]
    named = geometry or geometry_column(told, df.columns)
    found = srid or (footer_srid(told, named) if told else None)
    return df.withColumn(named, G.parse_wkb(F.col(named))).withMetadata(named, {"srid": found} if found else {})


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def srid_of(df: DataFrame, geometry: str = "geometry", fallback: int | None = 2180) -> int | None:
    return df.schema[geometry].metadata.get("srid", fallback)


def feature_url(base: str, layer: str, version: str, srs: str, bbox: tuple[float, float, float, float] | None = None) -> str:
    """Address of a GetFeature request; the name of the layer's parameter follows the version, the box names its system."""
    query = {"service": "WFS", "request": "GetFeature", "version": version, "typeNames" if version.startswith("2") else "typeName": layer, "srsName": srs}
    if bbox:
        query["bbox"] = ",".join(map(str, bbox)) + f",{srs}"
    return f"{base}{'&' if '?' in base else '?'}{urlencode(query)}"
