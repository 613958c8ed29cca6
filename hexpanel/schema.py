"""Column normalisation at the edges of the engine."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Old column names -> names of today.
LEGACY = {"G5IDD": "idDzialki", "G5IDO": "idObrebu", "G5IDK": "idKonturu"}


def _suffixed(names: Sequence[str]) -> list[str]:
    seen: Counter = Counter()
    out = []
    for n in names:
        seen[n] += 1
        out.append(n if seen[n] == 1 else f"{n}__{seen[n]}")
    return out


def uppercase(df: DataFrame, keep: Iterable[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """Upper-case names; a name that repeats gets __2, __3; those to keep stay. Also old -> new."""
    keep = set(keep)
    names = _suffixed([c if c in keep else c.upper() for c in df.columns])
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def lowercase(df: DataFrame, geometry: str | None = None) -> DataFrame:
    return df.toDF(*(c if c == geometry else c.lower() for c in df.columns))


def first_of_repeated(df: DataFrame) -> DataFrame:
    """Of columns with one name, the first."""
    places = [df.columns.index(c) for c in dict.fromkeys(df.columns)]
    unique = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return unique.select(*(F.col(f"_{i}").alias(df.columns[i]) for i in places))


def standard_geometry(df: DataFrame, active: str, name: str = "geometry") -> DataFrame:
    """The active geometry under one name; another column of that name goes."""
    return df if active == name else df.drop(name).withColumnRenamed(active, name)


def require(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in df.dtypes if t in ("double", "float")})


def align(df: DataFrame, reference: Sequence[str]) -> DataFrame:
    """The reference's columns in its order: missing ones are 0.0, others go."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in reference))


def without_geometry(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """df without geometry-like columns, of the named ones those that exist."""
    named = {"geometry", "geom", "wkb_geometry", "shape"}
    return df.select(*(c for c, t in df.dtypes if c.lower() not in named and t != "binary" and not t.startswith("array<struct<exterior") and (columns is None or c in columns)))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables with the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_year(df: DataFrame, year: int | None, column: str = "year") -> DataFrame:
    return df if column in df.columns or year is None else df.withColumn(column, F.lit(year).cast("int"))


def coerce_text(df: DataFrame, columns: Sequence[str], *, prefer_categories: Sequence[str] = (), most_lost: float = 0.01, most_categories: int = 50) -> tuple[DataFrame, list[str]]:
    """Text columns become numbers where that loses no more than a share of the values; else they are categories if
    preferred or of 2 to most_categories values; else they go. Also the categories. One pass over df."""
    text = [c for c in columns if dict(df.dtypes)[c] == "string"]
    if not text:
        return df, []
    stats = df.agg(*(F.struct(F.avg(F.col(c).isNull().cast("double")).alias("null"), F.avg(F.col(c).try_cast("double").isNull().cast("double")).alias("bad"), F.approx_count_distinct(c).alias("n")).alias(c) for c in text)).first()
    categories, gone = [], []
    for c in text:
        s = stats[c]
        if c not in prefer_categories and (s["bad"] or 0.0) - (s["null"] or 0.0) <= most_lost:
            df = df.withColumn(c, F.col(c).try_cast("double"))
        elif c in prefer_categories or 1 < s["n"] <= most_categories:
            categories.append(c)
        else:
            gone.append(c)
    return df.drop(*gone), categories
