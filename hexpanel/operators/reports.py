"""Yearly tabulations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexpanel.operators.overlay import half_even


def per_year(df: DataFrame, labels: DataFrame, *, share: str, flag: str, keys: tuple[str, str] = ("hex_id", "year"), year: str = "year", decimals: int = 4) -> DataFrame:
    """rok, mean share, number of flagged cells, cells; and the change of the rounded share in percentage points."""
    joined = df.join(labels.select(*keys, flag), list(keys), "left")
    rows = joined.groupBy(F.col(year).alias("rok")).agg(F.round(F.avg(share), decimals).alias("mean_share"), F.sum(F.col(flag).cast("long")).alias("flagged"), F.count("*").alias("cells"))
    return rows.withColumn("yoy_pp", half_even((F.col("mean_share") - F.lag("mean_share").over(Window.orderBy("rok"))) * 100, 2))


def per_unit_year(df: DataFrame, labels: DataFrame, *, unit: str, value: str, flag: str, keys: tuple[str, str] = ("hex_id", "year"), year: str = "year", decimals: int = 4) -> DataFrame:
    joined = df.join(labels.select(*keys, flag), list(keys), "left")
    return joined.groupBy(F.col(unit).alias("unit"), F.col(year).alias("rok")).agg(F.round(F.avg(value), decimals).alias("mean_value"), F.sum(F.col(flag).cast("long")).alias("flagged"), F.count("*").alias("cells"))


def family_of(column, families: dict[str, str]):
    """Family of a feature by the prefix of its name."""
    out = F.lit("other")
    for prefix, family in reversed(families.items()):
        out = F.when(column.startswith(prefix), F.lit(family)).otherwise(out)
    return out


#: Prefix -> feature family.
FAMILIES = {"nbr_": "neighbourhood", "gf_": "shape", "uzg_": "land use", "mpzp_": "zoning", "tx_": "transactions"}


def importance_by_family(df: DataFrame, feature: str = "feature", importance: str = "importance") -> DataFrame:
    return df.groupBy(family_of(F.col(feature), FAMILIES).alias("family")).agg(F.sum(importance).alias("importance"))
