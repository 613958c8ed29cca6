"""Scans of yearly deliveries and of catalogue tables, each one read with the columns that are asked for."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel import schema
from hexpanel.functions import codes
from hexpanel.functions import geometry as G
from hexpanel.operators import joins
from hexpanel.operators.overlay import half_even
from hexpanel.sources.discovery import year_column


def first_rows(df: DataFrame, n: int | None) -> DataFrame:
    """At most n rows where n is positive, else df."""
    return df.limit(n) if n and n > 0 else df


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Casts of the columns that df has; what can't be cast is null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})


def tree(spark: SparkSession, root: str, file: str = "*.parquet", year: str = "year", srid: int | None = None, geometry: str = "geometry") -> DataFrame:
    """All files of a name below a root in one scan, with the union of their columns. Rows without a year get that of
    their path (year=YYYY or rok_YYYY). srid: noted with the geometry where it isn't yet."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", file).parquet(root)
    of_path = year_column(F.col("_metadata.file_path"))
    df = df.withColumn(year, F.coalesce(codes.cast_year(F.col(year)), of_path) if year in df.columns else of_path.cast("bigint"))
    if srid is not None and geometry in df.columns and "srid" not in df.schema[geometry].metadata:
        df = df.withMetadata(geometry, {"srid": srid})
    return df


def union_files(spark: SparkSession, paths: Sequence[str], casts: dict[str, str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Files of different schemas as one table by column names; each is read with the named columns that it has, cast
    before the union, so that files may disagree on a type."""
    tables = [cast_columns(spark.read.parquet(p), casts or {}) for p in paths]
    if columns is not None:
        tables = [t.select(*(c for c in t.columns if c in columns)) for t in tables]
    return schema.union_all(tables)


def plain(df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """A table without its geometry columns; of the named ones those that it has, in its order."""
    return first_rows(schema.without_geometry(df, columns), limit)


def dataset(df: DataFrame, geometry: str = "geometry", with_geometry: bool = False) -> DataFrame:
    return df if with_geometry else df.drop(geometry)


def layer(df: DataFrame, columns: Sequence[str], geometry: str = "geometry", limit: int | None = None) -> DataFrame:
    """Named columns of a layer and its geometry; those that it lacks are a ValueError."""
    schema.require(df, [*columns, geometry], "layer")
    return first_rows(df.select(*columns, geometry), limit)


def parcels(df: DataFrame, columns: Iterable[str], right: DataFrame | None = None, *, on: Sequence[str] = ("iddzialki", "year"), right_on: Sequence[str] | None = None, prefix: str = "gf_", geometry: str = "geometry") -> DataFrame:
    """Keys, geometry and those of the listed columns that the parcels have; beside them the right table's columns under
    a prefix, by a left join."""
    columns = set(columns) | {*on, geometry}
    left = df.select(*(c for c in df.columns if c in columns))
    return left if right is None else joins.join_prefixed(left, right, list(on), list(right_on or on), prefix=prefix)


def hexagons(df: DataFrame, geometry: str = "geometry", decimals: int | None = None, limit: int | None = None) -> DataFrame:
    """hex_id, geometry and hex_area of a grid's table, the area rounded where decimals are named."""
    size = G.area(F.col(geometry))
    return first_rows(df.select("hex_id", F.col(geometry).alias("geometry"), (size if decimals is None else half_even(size, decimals)).alias("hex_area")), limit)


def transactions(df: DataFrame, date: str, year: str = "tx_year", between: tuple[int, int] | None = None) -> DataFrame:
    """df with the year of a date, null where it is none. between: first and last sane year; rows of other years go, those
    without a year stay."""
    out = df.withColumn(year, codes.event_year(F.col(date).cast("string")).cast("long"))
    return out if between is None else out.where(F.col(year).isNull() | F.col(year).between(*between))


def labelled(tables: dict[str, DataFrame], labels: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = ("hex_id", "year")) -> dict[str, DataFrame]:
    """Every table with the columns of every label table, joined by key."""
    out = {}
    for name, df in tables.items():
        for found, columns in labels:
            df = joins.attach_labels(df, found, columns, keys)
        out[name] = df
    return out


def mapping(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV dictionary with the place of each row in `ordinal`, for lookups in which the first of a repeated key wins."""
    return spark.read.csv(path, header=True, sep=sep).withColumn("ordinal", F.monotonically_increasing_id())


def geographic(df: DataFrame, geometry: str = "geometry", srid: int | None = None, fallback: int = 2180) -> DataFrame:
    """df with its geometry in degrees. The srid is the argument, else what the column notes, else the fallback."""
    source = srid or df.schema[geometry].metadata.get("srid", fallback)
    return df.withColumn(geometry, G.reproject(source, 4326)(F.col(geometry))).withMetadata(geometry, {"srid": 4326})
