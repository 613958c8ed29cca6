"""Contours of land use and of soil classes: names of today, and early years from the other layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexpanel.functions import codes
from hexpanel.functions import geometry as G
from hexpanel.schema import LEGACY

#: Column names of older deliveries -> names of today, for both layers.
BOTH = {"ID": "GML_ID", "IDR": "IDENTIFIER", "G5PEW": "PRZESTRZENNAZW", "G5DTU": "STARTOBIEKT", "G5DTW": "STARTWERSJAOBIEKT", "GEOMETRY": "geometry", "Shape_Area": "SHAPE_AREA", "SHAPE_Area": "SHAPE_AREA", "Shape_Length": "SHAPE_LENGTH", "SHAPE_Length": "SHAPE_LENGTH"}
#: Those of soil classes alone.
CLASSIFICATION = {"G5OZU": "OZU", "G5OZK": "OZK", "G5IDK": "IDKONTURU"}
#: Columns of land use that are the first filled one of several.
LAND_USE = {"OZU": ["OZU", "G5OZU", "G5OFU", "OFU"], "IDUZYTKU": ["IDUZYTKU", "G5IDT"]}
#: Columns that are text, whatever a delivery has.
TEXT = ("GML_ID", "IDENTIFIER", "LOKALNYID", "PRZESTRZENNAZW", "WERSJAID", "STARTOBIEKT", "STARTWERSJAOBIEKT", "IDKONTURU", "IDUZYTKU", "OZU", "OZK", "OZNACZENIETYPUGLEBY")


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """df by a map of names. Where several columns come to one name, or one comes to a name that is there, their first
    filled value counts, the column of today's name before the others."""
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(names.get(c, c), []).append(c)
    order = lambda new, old: sorted(old, key=lambda c: c != new)
    return df.select(*(F.coalesce(*(F.col(f"`{c}`") for c in order(new, old))).alias(new) for new, old in sources.items()))


def legacy(df: DataFrame) -> DataFrame:
    """Names of the oldest deliveries by today's."""
    return renamed(df, LEGACY)


def normalise(df: DataFrame, kind: str, *, source: int | None = None, target: int | None = None) -> DataFrame:
    """A contour layer, "land_use" or "classification", under today's names: version from ST_OBJ where there is none, ids
    and codes as text, geometry in the target's coordinates. Another kind is a ValueError."""
    if kind not in ("land_use", "classification"):
        raise ValueError(f"unknown layer {kind}")
    if kind == "land_use":
        df = codes.coalesce_groups(df, LAND_USE)
    df = renamed(df, BOTH | (CLASSIFICATION if kind == "classification" else {}))
    if "WERSJAID" not in df.columns and "ST_OBJ" in df.columns:
        df = df.withColumn("WERSJAID", F.col("ST_OBJ"))
    df = df.withColumns({c: F.col(c).cast("string") for c in TEXT if c in df.columns})
    if target is not None and "geometry" in df.columns:
        df = df.withColumn("geometry", G.reproject(source, target)(F.col("geometry"))).withMetadata("geometry", {"srid": target})
    return df


def append_early(base: DataFrame, other: DataFrame, *, year: str = "year", copy: tuple[str, str] | None = ("IDKONTURU", "IDUZYTKU")) -> DataFrame:
    """base and the other layer's rows of years before its first, with the columns of both. copy: a column of the appended
    rows, as text, under another name. Without a year in base nothing is appended."""
    first = base.agg(F.min(year).alias("_first"))
    early = other.crossJoin(F.broadcast(first)).where(F.col(year) < F.col("_first")).drop("_first")  # one row
    if copy and copy[0] in other.columns:
        early = early.withColumn(copy[1], F.col(copy[0]).cast("string"))
    return base.unionByName(early, allowMissingColumns=True)
