"""Tables, GeoParquet, upserts and reports."""

from __future__ import annotations

import json
import logging
import os
import shutil
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.functions import geometry as G

MODES = {"replace": "overwrite", "append": "append", "create": "append"}

MOST_LAYERS = 10_000


def quote(name: str) -> str:
    """A possibly qualified name with every part in backticks."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def save_table(df: DataFrame, table: str, mode: str = "replace", casts: dict[str, str] | None = None, schema_policy: str = "union") -> int:
    """Writes a catalogue table and returns its number of rows. "replace", "append", "create" (append makes what is
    missing), "skip" (nothing, where the table exists); anything else is a ValueError. schema_policy of an append:
    "union" adds new columns, "first_wins" keeps those the table has."""
    spark = df.sparkSession
    if mode == "skip" and spark.catalog.tableExists(table):
        return spark.table(table).count()
    if mode not in (*MODES, "skip"):
        raise ValueError(f"unknown write mode {mode}")
    for c, kind in (casts or {}).items():
        df = df.withColumn(c, F.col(c).cast(kind))
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(table.rpartition('.')[0])}")
    there = MODES.get(mode) == "append" and spark.catalog.tableExists(table)
    if there:
        known = spark.table(table)
        new = [c for c in df.columns if c not in known.columns]
        if new and schema_policy == "union":
            spark.sql(f"ALTER TABLE {quote(table)} ADD COLUMNS ({', '.join(f'{quote(c)} {df.schema[c].dataType.simpleString()}' for c in new)})")
            known = spark.table(table)
        df = df.select(*(F.col(quote(c)) if c in df.columns else F.lit(None).cast(known.schema[c].dataType).alias(c) for c in known.columns))
        df.write.insertInto(table)
    else:
        df.write.mode("overwrite").saveAsTable(table)
    return spark.table(table).count()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file by Spark's own file system, so any store will do."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_geoparquet(df: DataFrame, path: str, geometry: str = "geometry", srid: int = 2180, partition_by: Iterable[str] = ()) -> None:
    """Parquet with the geometry as WKB and, beside it, <path>_geo.json with what a GeoParquet footer says."""
    df.withColumn(geometry, G.write_wkb()(F.col(geometry))).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    meta = {"version": "1.0.0", "primary_column": geometry, "srid": srid, "columns": {geometry: {"encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"], "crs": {"id": {"authority": "EPSG", "code": srid}}}}}
    write_text(df.sparkSession, f"{path.rstrip('/')}_geo.json", json.dumps(meta))


def upsert_by_task(new: DataFrame, path: str, key: str = "task") -> None:
    """Replaces the rows of the tasks that `new` has, by partition; other tasks' files are not touched."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_maps(df: DataFrame, path: str, horizon: str = "horizon") -> None:
    df.write.mode("overwrite").partitionBy(horizon).parquet(path)


def write_report(df: DataFrame, path: str, limit: int = 100_000) -> int:
    """One CSV file of a tabulation; a table of more than `limit` rows is no report and fails."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"a report of more than {limit} rows")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    rows.to_csv(path, index=False)
    return len(rows)


def merged_layers(df: DataFrame, layer_map: dict[str, list[str]], column: str = "layer") -> DataFrame:
    """Rows under their canonical layer's name: a view over what is there; no file is moved or removed."""
    from hexpanel.sources.discovery import canonical

    names = [r[0] for r in df.select(column).distinct().limit(MOST_LAYERS + 1).collect()]
    if len(names) > MOST_LAYERS:
        raise ValueError(f"more than {MOST_LAYERS} layer names")
    known = {n: c for n in names if n and (c := canonical(n, layer_map))}
    if not known:
        return df.limit(0)
    return df.withColumn(column, F.element_at(F.create_map(*(F.lit(x) for kv in known.items() for x in kv)), F.col(column))).where(F.col(column).isNotNull())


def purge_directories(base: str, names: Iterable[str], *, confirm: bool = False) -> int:
    """Number of folders below base with one of the names, in any case; they are removed only where confirm is True."""
    low, found = {n.lower() for n in names}, 0
    for root, dirs, _ in os.walk(base):
        for d in [d for d in dirs if d.lower() in low]:
            dirs.remove(d)
            found += 1
            if confirm:
                shutil.rmtree(os.path.join(root, d))
    return found


def setup_logging(directory: str | None = None, run: str = "run", level: str = "INFO") -> logging.Logger:
    log = logging.getLogger("hexpanel")
    log.setLevel(level)
    log.handlers.clear()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if directory:
        os.makedirs(directory, exist_ok=True)
        handlers.append(logging.FileHandler(os.path.join(directory, f"{run}.log")))
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        log.addHandler(h)
    return log
