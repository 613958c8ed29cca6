"""Yearly scans, contours, grids, stages, bundles and coordinates on small inputs with known results."""

from __future__ import annotations

import json
import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexpanel import runner
from hexpanel.functions import geometry as G
from hexpanel.operators import contours, models, prune, spatial
from hexpanel.sources import scans
from hexpanel.sources.vector import read_geoparquet


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def square(side: float, x: float = 0.0):
    return G.rectangle(F.lit(x), F.lit(0.0), F.lit(x + side), F.lit(side))


# ---- coordinates


def test_northing_on_the_meridian_is_its_arc():
    phi = np.radians(np.linspace(0, 52, 200_001))
    e2 = G._FLAT * (2 - G._FLAT)
    radius = 6378137.0 * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5
    x, y = G.project(19.0, 52.0, 2180)
    assert x == pytest.approx(500000.0, abs=1e-6)
    assert y == pytest.approx(0.9993 * np.trapezoid(radius, phi) - 5300000.0, abs=1e-3)


@pytest.mark.parametrize("srid", sorted(G.SYSTEMS))
def test_coordinates_there_and_back(srid):
    lon, lat = (v.ravel() for v in np.meshgrid(np.linspace(14, 25, 23), np.linspace(-60, 60, 25)))
    back = G.unproject(*G.project(lon, lat, srid), srid)
    assert np.allclose(back[0], lon, atol=1e-8) and np.allclose(back[1], lat, atol=1e-8)
    assert np.all(np.isfinite(back))


# ---- scans


def test_tree_takes_years_from_paths_and_unites_columns(spark, tmp_path):
    spark.range(2).selectExpr("id", "'a' as x").write.parquet(f"{tmp_path}/u/rok_2015/input_data.parquet")
    spark.range(1).selectExpr("id", "2 as z", "2021 as year").write.parquet(f"{tmp_path}/u/year=2020/input_data.parquet")
    spark.range(1).write.parquet(f"{tmp_path}/u/other")
    out = scans.tree(spark, str(tmp_path))
    assert rows(out, "id", "x", "z", "year") == sorted([(0, "a", None, 2015), (1, "a", None, 2015), (0, None, 2, 2021), (0, None, None, None)], key=str)


def test_limits_and_missing_columns(spark):
    df = spark.range(5).withColumn("geometry", square(1.0))
    assert [scans.first_rows(df, n).count() for n in (None, 0, -1, 2)] == [5, 5, 5, 2]
    assert scans.layer(df, ["id"], limit=3).columns == ["id", "geometry"]
    with pytest.raises(ValueError, match="lacks"):
        scans.layer(df, ["none"])
    assert scans.dataset(df).columns == ["id"] and scans.dataset(df, with_geometry=True).columns == ["id", "geometry"]


def test_mapping_keeps_the_order_of_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("k;v\nb;1\na;2\nb;3\n")
    assert [r["v"] for r in scans.mapping(spark, str(tmp_path / "m.csv"), ";").orderBy("ordinal").collect()] == ["1", "2", "3"]


def test_hexagons_round_only_where_asked(spark):
    df = spark.range(1).select(F.lit("0_0").alias("hex_id"), square(1.2345).alias("geometry"))
    assert rows(scans.hexagons(df), "hex_area") == [(pytest.approx(1.2345**2),)]
    assert rows(scans.hexagons(df, decimals=2), "hex_area") == [(1.52,)]


def test_foreign_geoparquet_is_read_by_its_footer(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    wkb = G.to_wkb([(np.array([[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], float), [])])
    told = {"version": "1.0.0", "primary_column": "shape", "columns": {"shape": {"encoding": "WKB", "crs": {"id": {"authority": "EPSG", "code": 2178}}}}}
    t = pa.table({"id": [1], "geom": ["no"], "shape": pa.array([wkb], pa.binary())}).replace_schema_metadata({"geo": json.dumps(told)})
    pq.write_table(t, tmp_path / "a.parquet")
    df = read_geoparquet(spark, str(tmp_path / "a.parquet"))
    assert df.schema["shape"].metadata == {"srid": 2178}
    assert rows(df, "id", G.area(F.col("shape")).alias("a")) == [(1, 4.0)]


# ---- contours


def test_land_use_names_and_version(spark):
    df = spark.createDataFrame([("", "R", 5, "r1", 7)], "OZU string, OFU string, G5IDT int, IDR string, ST_OBJ int")
    out = contours.normalise(df, "land_use")
    assert rows(out, "OZU", "IDUZYTKU", "IDENTIFIER", "WERSJAID") == [("R", "5", "r1", "7")]
    assert not {"OFU", "G5IDT", "IDR"} & set(out.columns)
    with pytest.raises(ValueError, match="unknown layer"):
        contours.normalise(df, "roads")


def test_two_old_names_for_one_column(spark):
    df = spark.createDataFrame([(None, 2.0, "v"), (1.0, 3.0, "w")], "Shape_Area double, OLD double, WERSJAID string").withColumnRenamed("OLD", "SHAPE_LENGTH")
    out = contours.renamed(df, {"Shape_Area": "A", "SHAPE_LENGTH": "A"})
    assert rows(out, "A", "WERSJAID") == [(1.0, "w"), (2.0, "v")]


def test_contours_come_in_the_coordinates_asked_for(spark):
    df = spark.range(1).withColumn("geometry", G.rectangle(F.lit(500000.0), F.lit(500000.0), F.lit(500010.0), F.lit(500010.0)))
    out = contours.normalise(df, "classification", source=2180, target=2178)
    x, y = G.transform_xy(500000.0, 500000.0, 2180, 2178)
    b = out.select(G.bounds(F.col("geometry")).alias("b")).first()["b"]
    assert out.schema["geometry"].metadata == {"srid": 2178}
    assert abs(b["x0"] - x) < 1 and abs(b["y0"] - y) < 1


def test_early_years_of_the_other_layer(spark):
    base = spark.createDataFrame([("u", 2020)], "IDUZYTKU string, year int")
    other = lambda *years: spark.createDataFrame([(i, y, "RIVb") for i, y in enumerate(years)], "IDKONTURU int, year int, OZK string")
    assert rows(contours.append_early(base, other(2015, 2021)), "IDUZYTKU", "year", "OZK") == [("0", 2015, "RIVb"), ("u", 2020, None)]
    assert contours.append_early(base, other(2020, 2022)).count() == 1
    assert contours.append_early(base.where("false"), other(2015)).count() == 0


# ---- grids


def test_grid_of_a_year(spark):
    df = spark.createDataFrame([(2023,), (2024,)], "year int").withColumn("geometry", F.when(F.col("year") == 2024, square(1000.0)).otherwise(square(1000.0, 9000.0)))
    out = spatial.grid_of_year(df, 2024, [100.0, 200.0], srid=2180)
    counts = {r["side"]: r["n"] for r in out.groupBy("side").agg(F.count("*").alias("n")).collect()}
    for side, n in counts.items():
        r = np.arange(-100, 100)[:, None]
        x, y = side * np.sqrt(3) * (np.arange(-100, 100)[None, :] + r / 2), 1.5 * side * r
        assert n == ((x >= 0) & (x < 1000) & (y >= 0) & (y < 1000)).sum()
    assert out.select(G.area(F.col("geometry")).alias("a"), "side").where("abs(a - 1.5 * sqrt(3) * side * side) > 1e-3").isEmpty()
    with pytest.raises(ValueError, match="no rows"):
        spatial.grid_of_year(df, 1999, [100.0], srid=2180)
    with pytest.raises(ValueError, match="metric"):
        spatial.grid_of_year(df, 2024, [100.0], srid=4326)
    with pytest.raises(KeyError):
        spatial.grid_of_year(df.drop("year"), 2024, [100.0], srid=2180)


def test_chain_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([(1, 0.0), (2, 900.0)], "id int, x double").withColumn("geometry", G.rectangle(F.col("x"), F.lit(0.0), F.col("x") + 1, F.lit(1.0)))
    near = spark.createDataFrame([("a", 0.5), ("b", 0.2)], "n string, x double").withColumn("g", G.rectangle(F.col("x"), F.lit(0.0), F.col("x") + 1, F.lit(1.0))).drop("x")
    far = spark.createDataFrame([("z",)], "m string").withColumn("h", square(1.0, 900.5))
    out = spatial.join_chain(left, [(near, "g"), (far, "h")])
    assert rows(out, "id", "n", "m") == [(1, "a", None), (1, "b", None), (2, None, "z")]


# ---- stages and models


def test_stages_run_by_their_switches_and_stop_at_a_failure(spark, tmp_path, caplog):
    ran = []
    stages = [runner.Stage("a", lambda s, c: ran.append("a") or 1, ("x.on",)), runner.Stage("b", lambda s, c: ran.append("b"), ("x.on", "x.off")), runner.Stage("c", lambda s, c: 1 / 0), runner.Stage("d", lambda s, c: ran.append("d"))]
    cfg = {"x": {"on": True}}
    assert runner.run_stages(spark, cfg, stages[:2]) == {"a": 1} and ran == ["a"]
    with pytest.raises(ZeroDivisionError), caplog.at_level(logging.ERROR, "hexpanel"):
        runner.run_stages(spark, cfg, stages)
    assert ran == ["a", "a"]
    assert json.loads(runner.report({"m": {"ap": 0.5}}, str(tmp_path / "r.json"))) == json.loads((tmp_path / "r.json").read_text())


def _first(spark, cfg):
    return (cfg["task"], cfg["base_year"], spark.range(cfg["n"]).count(), spark.catalog.databaseExists("runner_db"))


STAGES = [runner.Stage("first", _first)]


def test_command_line(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("n: 1\nspark:\n  databases: [runner_db]\n")
    out = runner.main(["--config", str(tmp_path / "c.yaml"), "--stages", "tests.test_scans:STAGES" if __name__.startswith("tests.") else f"{__name__}:STAGES", "--task", "split", "--base-year", "2024", "n=3"])
    assert out == {"first": ("split", 2024, 3, True)}
    spark.sql("DROP DATABASE runner_db")
    logging.getLogger("hexpanel").handlers.clear()


def _labelled(spark):
    return spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("a"), ((F.col("id") * 7) % 11).cast("double").alias("b")).withColumn("y", (F.col("a") + F.col("b") / 20 > 10).cast("int"))


def test_bundle_round_trip_and_missing_features(spark, tmp_path):
    df = _labelled(spark)
    model = models.logistic_baseline(["a", "b"]).fit(models.weighted(df, "y", models.balanced_weights(df, "y")))
    models.save_bundle(f"file://{tmp_path}/m", model, ["a", "b"], [], {"ap": 1.0})
    again, meta = models.load_bundle(f"file://{tmp_path}/m")
    assert meta == {"features": ["a", "b"], "categoricals": [], "metrics": {"ap": 1.0}}
    assert rows(models.score(again, df), "id", "p_hat") == rows(models.score(model, df), "id", "p_hat")
    with pytest.raises(KeyError, match="lacks"):
        models.require_features(df, ["a", "zz"])


def test_logistic_forecast_ranks_like_the_rule(spark):
    df = _labelled(spark)
    c, ap = models.tune_logistic(df.where("id % 2 = 0"), df.where("id % 2 = 1"), "y", ["a", "b"])
    assert c in (0.01, 0.1, 1.0, 10.0) and ap > 0.95
    lift = models.compare_lift(models.persistence(df, "y").withColumn("p_hat_cal", -F.col("p_hat")), "y", "id")
    by = {r["score"]: r["precision"] for r in lift.collect()}
    assert by == {"p_hat": 1.0, "p_hat_cal": 0.0}


def test_predictions_carry_calibrated_values_where_there_are_any(spark):
    df = spark.createDataFrame([("a", 0.12345, 0.5), ("b", 0.2, 0.6)], "hex_id string, p_hat double, p_hat_cal double")
    out = models.predictions(df, base_year=2024, horizon=3, task="split")
    assert rows(out, "hex_id", "target_year", "probability", "prob_calibrated", "risk_percentile") == [("a", 2027, 0.1234, 0.5, 50.0), ("b", 2027, 0.2, 0.6, 100.0)]
    assert rows(models.predictions(df.drop("p_hat_cal"), base_year=2024, horizon=1, task="x"), "prob_calibrated") == [(0.1234,), (0.2,)]


def test_text_is_a_number_or_a_category(spark):
    df = spark.createDataFrame([(str(i), "x" if i else None, i > 2, 1.0) for i in range(200)], "n string, c string, t boolean, d double")
    out, categories = models.numbers_or_categories(df, ["n", "c", "t", "d"])
    assert categories == ["c"] and dict(out.dtypes) == {"n": "double", "c": "string", "t": "int", "d": "double"}


def test_profile_of_an_empty_table(spark):
    out = prune.profile(spark.range(3).where("id > 5"), ["id"]).first()
    assert (out["rows"], out["filled"], out["missing"], out["p50"]) == (0, 0, None, None)
