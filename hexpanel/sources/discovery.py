"""Finding yearly deliveries, and names of layers, as tables of paths; no file's content is read here.

A listing has a row per file: path, name, format, unit, year. What several units share is settled by joins on the codes
found in files, and which file a layer is read from by ranks, so any number of deliveries is one plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexpanel.functions.codes import unit_code as unit_column
from hexpanel.functions.codes import unit_of_text as unit_code

#: Formats in the order in which they are preferred, and their suffixes; geometry types in layer names.
FORMATS = ("gdb", "gml", "shp", "swde")
SUFFIXES = {"gdb": ("gdb",), "gml": ("gml",), "shp": ("shp",), "swde": ("swd", "swde")}
GEOMETRY_TYPES = ("point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon")
#: Formats whose files are looked into for units where their path names none, and what such a delivery is called.
SHARED_FORMATS, SHARED = ("gdb", "gml"), "_wspolny"


def year_column(path: Column) -> Column:
    """Year of the first year=YYYY or rok_YYYY folder; null where there is none."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)(?:year=|rok_)(\d{4})(?:/|$)", 1), F.lit("")).cast("int")


def year_of(path: str) -> int | None:
    found = (p.removeprefix("year=").removeprefix("rok_") for p in PurePosixPath(path).parts if p.startswith(("year=", "rok_")))
    return next((int(y) for y in found if len(y) == 4 and y.isdecimal()), None)


def listing(files: DataFrame, path: str = "path") -> DataFrame:
    """path, name, format, unit, year of every file of a known format. A geodatabase is a folder: its files are one row
    with the folder's path. The name decides on the unit before the folders do."""
    whole = F.regexp_replace(path, r"(?i)(\.gdb)/.*$", "$1")
    rows = files.select(whole.alias("path")).distinct().withColumn("name", F.element_at(F.split("path", "/"), -1))
    suffix = F.lower(F.element_at(F.split("name", r"\."), -1))
    kinds = F.create_map(*(F.lit(x) for kind, ends in SUFFIXES.items() for end in ends for x in (end, kind)))
    rows = rows.withColumn("format", F.try_element_at(kinds, suffix)).where("format is not null")
    return rows.withColumns({"unit": F.coalesce(unit_column(F.col("name")), unit_column(F.col("path"))), "year": year_column(F.col("path"))})


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """The listing of all files under a root; Spark's reader lists them, and contents are pruned."""
    return listing(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path"))


def shared_deliveries(listed: DataFrame, codes: DataFrame) -> DataFrame:
    """path, unit of the files that serve several units. codes: path, code found in files; only codes that are units count.
    Two or more units with one four-digit prefix make it <prefix>_wspolny, if one of them has no file of its own."""
    nameless = listed.where(F.col("unit").isNull() & F.col("format").isin(*SHARED_FORMATS)).select("path")
    valid = codes.where(unit_column(F.col("code")) == F.col("code")).select("path", "code").distinct().join(nameless, "path")
    served = listed.where("unit is not null").select(F.col("unit").alias("code"), F.lit(True).alias("served")).distinct()
    told = valid.join(served, "code", "left").groupBy("path").agg(F.count("*").alias("units"), F.count("served").alias("served"), F.min(F.left("code", F.lit(4))).alias("lo"), F.max(F.left("code", F.lit(4))).alias("hi"))
    return told.where("units > 1 and lo = hi and served < units").select("path", F.concat("lo", F.lit(SHARED)).alias("unit"))


def deliveries(listed: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """unit, format, path: the files of each unit, and those that serve several where codes tell."""
    own = listed.where("unit is not null").select("unit", "format", "path")
    if codes is None:
        return own
    return own.unionByName(listed.drop("unit").join(shared_deliveries(listed, codes), "path").select("unit", "format", "path"))


def chosen_layers(found: DataFrame) -> DataFrame:
    """Of what files hold (unit, format, path, layer), what is read: a unit's first format by FORMATS that has any layer;
    there each layer from the first path that has it, in the exchange format from the unit's first path alone."""
    place = F.array_position(F.array(*map(F.lit, FORMATS)), F.col("format"))
    unit = Window.partitionBy("unit")
    rows = found.where("layer is not null").withColumn("_f", place).where("_f > 0").withColumn("_best", F.min("_f").over(unit)).where("_f = _best")
    rows = rows.withColumn("_path", F.min("path").over(unit)).where((F.col("format") != "swde") | (F.col("path") == F.col("_path")))
    return rows.groupBy("unit", "format", "layer").agg(F.min("path").alias("path"))


def layer_pattern(target: str, aliases: Iterable[str]) -> str:
    """Regular expression of the names that mean a layer: an alias, one with a year behind in any case, or anything that
    ends with _egb_<target>, a number and a geometry type, the last two optional, in any case."""
    known = "|".join(map(re.escape, sorted(aliases))) or "(?!)"
    return f"^(?:(?:{known})|(?i:(?:{known})_[0-9]{{4}}|.*_egb_{re.escape(target)}(?:_[0-9]+)?(?:_(?:{'|'.join(GEOMETRY_TYPES)}))?))$"


def is_layer(name: str, target: str, aliases: Iterable[str]) -> bool:
    return re.match(layer_pattern(target, aliases), name) is not None


def canonical(name: str, layer_map: dict[str, list[str]]) -> str | None:
    """The first layer of a map that a name means."""
    return next((target for target, aliases in layer_map.items() if name == target or is_layer(name, target, aliases)), None)


def canonical_column(name: Column, layer_map: dict[str, list[str]]) -> Column:
    """The same of a column; one comparison a layer of the configuration."""
    return F.coalesce(F.lit(None).cast("string"), *(F.when((name == t) | name.rlike(layer_pattern(t, a)), F.lit(t)) for t, a in layer_map.items()))
