"""Sources, sinks, schemas and configuration on small files made here."""

from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from hexpanel import config, schema, sinks
from hexpanel.sources import exchange_text, vector

SQUARE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]  # clockwise: an exterior ring
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]


def _shp(records: list[list | None]) -> bytes:
    out = b"\0" * 100
    for n, rings in enumerate(records, 1):
        if rings is None:
            body = struct.pack("<i", 1) + struct.pack("<2d", 5.0, 5.0)
        else:
            starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
            points = [c for ring in rings for xy in ring for c in xy]
            body = struct.pack("<i4d2i", 5, 0, 0, 4, 4, len(rings), len(points) // 2) + struct.pack(f"<{len(starts)}i", *starts) + struct.pack(f"<{len(points)}d", *points)
        out += struct.pack(">2i", n, len(body) // 2) + body
    return out


def _dbf(name: str, values: list[str]) -> bytes:
    width = 8
    head = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(values), 32 + 32 + 1, width + 1)
    field = name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width, 0]) + b"\0" * 14
    return head + field + b"\x0d" + b"".join(b" " + v.encode().ljust(width) for v in values)


def _swde(parcels: bool = True) -> str:
    point = lambda i, alias, x, y: f"RO,,G5PZG,{i},{alias}\nP,G,{x},{y}\nX;\n"
    lines = "NS,ZN,SWDE\nRO,,G5DZE,early,\nX;\nSO;\n"
    lines += point("p1", "a1", 0, 0) + point("p2", "a2", 0, 4) + point("p3", "a3", 4, 4) + point("p4", "a4", 4, 0)
    if parcels:
        lines += "RO,,G5DZE,z1,\nD,G5IDD,C,281701_1.0001.7\nD,G5PEW,N,1,6\nGL;\nK,+;\nP,P,x,p1\nP,P,x,a2\nP,P,x,p3\nP,P,x,nobody\nP,K,x,p4\nPZ;\nK,-;\nP,P,x,p1\nP,P,x,p2\nPZ;\nGX;\nX;\n"
    lines += "RO,,G5KKL,k1,\nD,G5IDK,C,k-1\nD,G5OZU,C,R\nGL;\nK,+;\nP,G,0,0\nP,G,0,2\nP,G,2,2\nPZ;\nX;\n"
    return lines


def test_shapefile_rings_and_rows(spark, tmp_path):
    (tmp_path / "dzialki.shp").write_bytes(_shp([[SQUARE, HOLE], None, [SQUARE]]))
    (tmp_path / "dzialki.dbf").write_bytes(_dbf("ID", ["one", "point", ""]))
    (tmp_path / "unknown.shp").write_bytes(_shp([[SQUARE]]))
    rows = vector.read_shapefiles(spark, str(tmp_path), {"Parcels": ["DZIALKI"], "Copies": ["dzialki"]}).collect()
    assert {(r["layer"], r["n"]) for r in rows} == {(x, n) for x in ("Parcels", "Copies") for n in (0, 2)}
    first = next(r for r in rows if r["n"] == 0)
    assert first["attrs"] == {"ID": "one"} and len(first["geometry"]) == 1
    assert len(first["geometry"][0]["holes"]) == 1
    assert next(r for r in rows if r["n"] == 2)["attrs"] == {"ID": None}


def test_gml_lists_and_rings(spark, tmp_path):
    file = tmp_path / "x.gml"
    file.write_text("""<c><m><id>1</id><OZU>R</OZU><OZU>B</OZU><outer>0 0 0 4 4 4 4 0 0 0</outer></m><m><id>2</id></m></c>""")
    df = vector.read_gml(spark, str(file), "m", "id string, OZU array<string>, outer string", exterior="outer", swap=True)
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"]["OZU"] == "R" and rows["2"]["OZU"] is None and rows["2"]["geometry"] is None
    assert [(p["x"], p["y"]) for p in rows["1"]["geometry"][0]["exterior"]] == [(y, x) for x, y in SQUARE]


def test_exchange_text_layers(spark, tmp_path):
    (tmp_path / "a.swde").write_bytes(_swde().encode("iso-8859-2"))
    (tmp_path / "b.swd").write_bytes(_swde(parcels=False).encode("iso-8859-2"))
    found = exchange_text.layers(spark, str(tmp_path))
    [parcel] = found[exchange_text.PARCELS].collect()
    assert parcel["idDzialki"] == "281701_1.0001.7" and parcel["attrs_G5DZE"]["G5PEW"] == "1,6"
    assert [(p["x"], p["y"]) for p in parcel["geometry"][0]["exterior"]] == SQUARE and parcel["geometry"][0]["holes"] == []
    [contour] = found[exchange_text.LAND_USE].collect()  # the file without parcels has none
    assert (contour["G5IDK"], contour["G5OZU"], contour["G5OZK"]) == ("k-1", "R", None) and contour["path"].endswith("a.swde")
    assert found[exchange_text.CLASSIFICATION].count() == 1
    assert exchange_text.declared_type(_swde()) == "SWDE" and exchange_text.declared_type("") is None


def test_geoparquet_round_trip(spark, tmp_path):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in SQUARE))
    hole = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in HOLE))
    df = spark.range(3).withColumn("geometry", F.array(F.struct(ring.alias("exterior"), F.array(hole).alias("holes"))))
    sinks.write_geoparquet(df, str(tmp_path / "g"), srid=2178)
    back = vector.read_geoparquet(spark, str(tmp_path / "g"))
    assert vector.srid_of(back) == 2178 and back.count() == 3
    [part] = back.first()["geometry"]  # rings may be turned and begin elsewhere
    assert {(p["x"], p["y"]) for p in part["exterior"]} == set(SQUARE) and [{(p["x"], p["y"]) for p in h} for h in part["holes"]] == [set(HOLE)]
    sinks.write_geoparquet(df.limit(0), str(tmp_path / "none"))
    assert vector.read_geoparquet(spark, str(tmp_path / "none")).count() == 0


def test_geometry_column_and_feature_url():
    assert vector.geometry_column('{"primary_column": "g"}', ["a", "g", "geometry"]) == "g"
    assert vector.geometry_column(None, ["a", "geom", "b"]) == "geom" and vector.geometry_column(None, ["a", "b"]) == "b"
    assert "typeNames=x" in vector.feature_url("http://h/w", "x", "2.0.0", "EPSG:2180")
    assert "typeName=x" in vector.feature_url("http://h/w?map=1", "x", "1.1.0", "EPSG:2180", (0, 0, 1, 1))


def test_save_table_modes(spark, tmp_path):
    table = f"saved_{tmp_path.name}".replace("-", "_")
    a, b = spark.range(2).toDF("id"), spark.range(3).selectExpr("id", "'x' AS more")
    try:
        assert sinks.save_table(a, table) == 2
        assert sinks.save_table(b, table, "skip") == 2
        assert sinks.save_table(b, table, "append", schema_policy="first_wins") == 5 and spark.table(table).columns == ["id"]
        assert sinks.save_table(b, table, "create") == 8 and spark.table(table).columns == ["id", "more"]
        assert sinks.save_table(b, table, "replace") == 3
        with pytest.raises(ValueError):
            sinks.save_table(b, table, "other")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_upsert_keeps_other_tasks(spark, tmp_path):
    path = str(tmp_path / "forecast")
    sinks.upsert_by_task(spark.createDataFrame([("split", 1), ("conversion", 2)], "task string, v int"), path)
    sinks.upsert_by_task(spark.createDataFrame([("split", 3)], "task string, v int"), path)
    assert {(r["task"], r["v"]) for r in spark.read.parquet(path).collect()} == {("split", 3), ("conversion", 2)}


def test_report_and_directories(spark, tmp_path):
    assert sinks.write_report(spark.range(4), str(tmp_path / "r" / "x.csv")) == 4
    with pytest.raises(ValueError):
        sinks.write_report(spark.range(4), str(tmp_path / "y.csv"), limit=3)
    (tmp_path / "a" / "Raster").mkdir(parents=True)
    assert sinks.purge_directories(str(tmp_path), ["raster"]) == 1 and (tmp_path / "a" / "Raster").exists()
    assert sinks.purge_directories(str(tmp_path), ["raster"], confirm=True) == 1 and not (tmp_path / "a" / "Raster").exists()


def test_merged_layers(spark):
    df = spark.createDataFrame([("dzialki_2020", 1), ("x_egb_parcels_1_polygon", 2), ("other", 3)], "layer string, n int")
    rows = sinks.merged_layers(df, {"Parcels": ["dzialki"]}).collect()
    assert {(r["layer"], r["n"]) for r in rows} == {("Parcels", 1), ("Parcels", 2)}
    assert sinks.merged_layers(df.where("n = 3"), {"Parcels": ["dzialki"]}).count() == 0


def test_schema_names(spark):
    df = spark.range(1).selectExpr("1 AS a", "2 AS b", "3 AS A")
    upper, names = schema.uppercase(df)
    assert upper.columns == ["A", "B", "A__2"] and names["b"] == "B"
    assert schema.uppercase(df.select("b"), keep=["b"])[0].columns == ["b"]
    assert schema.first_of_repeated(spark.range(1).selectExpr("1 AS x", "2 AS x")).first()["x"] == 1
    assert schema.align(spark.range(1).selectExpr("1 AS p", "2 AS q"), ["r", "q"]).first().asDict() == {"r": 0.0, "q": 2}
    with pytest.raises(ValueError):
        schema.require(df, ["nothing"])


def test_text_becomes_numbers_or_categories(spark):
    df = spark.createDataFrame([("1", "u", f"id{i}") for i in range(60)] + [("2", "v", "id60")], "num string, cat string, id string")
    out, categories = schema.coerce_text(df, df.columns)
    assert dict(out.dtypes) == {"num": "double", "cat": "string"} and categories == ["cat"]
    assert schema.nan_to_null(spark.sql("SELECT double('NaN') AS x")).first()["x"] is None


def test_configuration(tmp_path, monkeypatch):
    (tmp_path / "panel.yaml").write_text("horizon: 3\nout: ${root}/panel\n")
    (tmp_path / "main.yaml").write_text("includes:\n  panel: panel.yaml\nroot: ${oc.env:HEX_ROOT,/data}\npanel:\n  years: [1, 2]\n")
    cfg = config.load(tmp_path / "main.yaml", ["panel.horizon=5", "extra.deep=true"])
    assert config.resolve(cfg) == {"panel": {"horizon": 5, "out": "/data/panel", "years": [1, 2]}, "root": "/data", "extra": {"deep": True}}
    monkeypatch.setenv("HEX_ROOT", "/else")
    assert config.resolve(cfg)["panel"]["out"] == "/else/panel"
    assert config.unknown_keys(cfg, ["panel.horizon", "panel.out", "root"]) == ["panel.years", "extra"]
    with pytest.raises(KeyError):
        config.resolve({"a": "${b.c}"})
    config.snapshot(cfg, str(tmp_path / "s" / "config.yaml"))
    assert config.load(tmp_path / "s" / "config.yaml") == cfg
