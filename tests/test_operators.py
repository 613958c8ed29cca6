"""Small hand-made inputs with known results."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from hexpanel.functions import codes, geometry
from hexpanel.operators import joins, metrics, neighbors, overlay, panel, prune, shapes
from hexpanel.sources import discovery

PANEL = "hex_id string, year int, shape_area_mean double, coverage_area double, n_parcel int"
FRAGMENT = "hex_id string, year int, area double, hex_area double, x double, unit string, id string"


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.mark.parametrize(
    "rows, last",
    [
        ([(2020, 1000, 500, 1), (2021, 1000, 500, 1), (2022, 100, 500, 2)], True),
        ([(2020, 1000, 500, 1), (2022, 100, 500, 2)], False),
        ([(2020, 1000, 500, 1), (2021, 100, 50, 2)], False),
    ],
)
def test_split_labels(spark, rows, last):
    df = spark.createDataFrame([("h", y, float(m), float(c), n) for y, m, c, n in rows], PANEL)
    out = by(panel.split_labels(df, tolerance=0.05, least_drop=100), "year")
    years = sorted(out)
    assert out[years[-1]]["split_proxy"] is last
    assert out[years[-2]]["y_next"] is last
    assert out[years[-1]]["y_next"] is False


@pytest.mark.parametrize("year, expected", [(2021, True), (2023, False)])
def test_conversion_labels(spark, year, expected):
    df = spark.createDataFrame([("h", 2020, 0.8, 0.1, 1.0), ("h", year, 0.2, 0.7, 1.0)], "hex_id string, year int, uzg_R_share double, uzg_B_share double, sum_uzg double")
    assert by(panel.conversion_labels(df), "year")[year]["convert_proxy"] is expected


def test_censored_labels_are_null_beyond_the_last_year(spark):
    df = spark.createDataFrame([("h", 2020, 1.0, 1.0, 1)], PANEL)
    assert panel.split_labels(df, censored=True, horizon=5).first()["y_next_5"] is None
    assert panel.split_labels(df, horizon=5).first()["y_next_5"] is False


def test_weighted_overlay(spark):
    df = spark.createDataFrame([("h", 2020, 60.0, 100.0, 10.0, "X", "a"), ("h", 2020, 40.0, 100.0, 20.0, "Y", "b")], FRAGMENT)
    assert overlay.weighted_means(df, ["x"], hex_area="hex_area").first()["x_mean"] == pytest.approx(14.0)
    covered = overlay.coverage(df, unique="id").first()
    assert (covered["n_parcel"], covered["hex_area"], covered["coverage_area"]) == (2, 100.0, 100.0)
    assert overlay.dominant(df, "unit").first()["jednostka"] == "X"


def test_denominators(spark):
    df = spark.createDataFrame([("h", 2020, 60.0, 100.0, 0.0, "X", "a"), ("h", 2020, 40.0, 100.0, 20.0, "Y", "b")], FRAGMENT)
    out = overlay.weighted_means(df, ["x"], denominator="all", zero_as_null=["x"], non_zero=["x"]).first()
    assert (out["x_mean"], out["x_mean_nz"]) == (pytest.approx(8.0), pytest.approx(20.0))


def test_coverage_filters(spark):
    df = spark.createDataFrame([("a", 2020, 50.0, 100.0, 14.123456), ("b", 2020, 5.0, 100.0, 1.0), ("c", 2020, 5.0, 0.0, 1.0)], "hex_id string, year int, coverage_area double, hex_area double, x double")
    out = overlay.filter_groups(df, 0.5, 2).collect()
    assert [(r["hex_id"], r["coverage_frac"], r["x"]) for r in out] == [("a", 0.5, 14.12)]


def test_class_shares(spark):
    df = spark.createDataFrame([("h", 2020, 50.0, 100.0, "R"), ("h", 2020, 150.0, 100.0, "B"), ("n", 2020, 50.0, 100.0, None)], "hex_id string, year int, area double, hex_area double, c string")
    out = overlay.class_shares(df, "c", ["R", "B", "N"]).collect()
    assert [(r["hex_id"], r["R_share"], r["B_share"], r["N_share"]) for r in out] == [("h", 0.5, 1.0, 0.0)]


def test_neighbourhood(spark):
    around = [(q, r) for q, r, _ in neighbors.offsets(1)]
    assert [len(neighbors.offsets(n)) for n in (1, 2)] == [6, 18]
    assert len(neighbors.offsets(2, exact=True)) == 12
    rows = [("0_0", 2020, 100.0, "B")] + [(f"{q}_{r}", 2020, float(i + 1), "A" if i < 4 else "B") for i, (q, r) in enumerate(around)]
    df = spark.createDataFrame(rows, "hex_id string, year int, feat double, cat string")
    centre = by(neighbors.aggregates(df, (1,), categorical=["cat"]), "hex_id")["0_0"]
    assert (centre["nbr_r1_n"], centre["nbr_r1_feat_mean"], centre["nbr_r1_feat_median"], centre["nbr_r1_cat_mode"]) == (6, 3.5, 3.5, "A")
    rim = by(neighbors.aggregates(df, (1,)), "hex_id")[f"{around[0][0]}_{around[0][1]}"]
    assert (rim["nbr_r1_n"], rim["nbr_r1_feat_mean"]) == (3, None)  # fewer than four neighbours


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0, "x", 5), (1, 30.0, 4.0, "y", 9), (2, 1.0, 1.0, None, 1)], "k int, cena double, area double, name string, ord int")
    out = by(joins.dedupe(df, ["k"], "reduce", order_by="ord", reduce_map={"cena": "max"}), "k")[1]
    assert (out["cena"], out["area"], out["name"]) == (30.0, 3.0, "x")
    assert by(joins.dedupe(df, ["k"], "first", order_by="ord"), "k")[1]["name"] == "x"
    assert by(joins.dedupe(df, ["k"], "last", order_by="ord"), "k")[1]["name"] == "y"
    with pytest.raises(ValueError):
        joins.assert_unique(df, ["k"])
    assert joins.prefix_columns(df.select("k", "ord"), "tx_", ["k"]).columns == ["k", "tx_ord"]


CODES = [
    (codes.land_use, {"Bp": "B", "RIVa": "R", "Lz-RIVb": "L", "W": "W", "Ps": "Ps", "dr": "dr", "Ł": "Ł", None: None}),
    (codes.soil_score, {"IIIa": 4.0, "III b": 3.5, "ivB": 2.5, "VI": 1.0, "I": 6.0, "ZZ": None, None: None}),
    (codes.clean_label, {" MN,U ": "MN_U", None: "Brak"}),
    (codes.zoning_symbol, {"10MN": "MN", "A102MN": "MN", "1-KDW": "KDW", "IV/ZL": "ZL", "ML1": "ML", "D3": "D", "MU4": "MU", "KD10/1X5/": "KD", "KD 10": "KD", "R": "R", "MN-U": "MN-U"}),
    (codes.unit_code, {"x_281701_1.gml": "281701_1", "2814014": "281401_4", "2862011": "286201_1", "2814019": None}),
]


@pytest.mark.parametrize("f, pairs", CODES, ids=lambda x: getattr(x, "__name__", ""))
def test_codes(spark, f, pairs):
    df = spark.createDataFrame([(k,) for k in pairs], "c string")
    assert {r[0]: r[1] for r in df.select("c", f(F.col("c"))).collect()} == pairs


def test_parcel_id(spark):
    out = codes.parse_parcel_id(spark.createDataFrame([("281501_2.0003.123/4",), ("odd",)], "iddzialki string")).collect()
    assert [tuple(r)[1:] for r in out] == [("281501_2", "0003", "123/4"), (None, None, None)]


def test_discovery():
    assert [discovery.unit_code(x) for x in ("281701_1", "2814014", "2862011", "20170303_2802_1", "BDOT_4000003", "2814019")] == ["281701_1", "281401_4", "286201_1", None, None, None]


def test_unit_codes_of_texts_and_columns_agree(spark):
    names = ["281701_1", "x281501_2y", "100201_3", "2814014", "2862011", "20170303_2802_1", "BDOT_4000003", "2814019", "281701_12", "9281701_1", "a_281701_1_b_2814014", "2814014_281701_1", "281701-1", "", "_", "28140141"]
    got = spark.createDataFrame([(x,) for x in names], "c string").select("c", codes.unit_code(F.col("c")).alias("u")).collect()
    assert {r["c"]: r["u"] for r in got} == {x: discovery.unit_code(x) for x in names}
    assert [discovery.unit_code(x) for x in ("281701_12", "9281701_1", "a_281701_1_b", "28140141")] == [None, None, "281701_1", None]


def test_deliveries(spark):
    paths = ["/d/rok_2020/281701_1.gml", "/d/rok_2020/281701_1.shp", "/d/year=2021/u_2814014/x.GDB/a0001.gdbtable", "/d/year=2021/u_2814014/x.GDB/a0002.gdbtable", "/d/rok_2020/all.gml", "/d/rok_2020/known.gml", "/d/rok_2020/notes.txt", "/d/rok_2020/281701_2.swd"]
    listed = discovery.listing(spark.createDataFrame([(p,) for p in paths], "path string"))
    got = {r["path"]: (r["format"], r["unit"], r["year"]) for r in listed.collect()}
    assert got == {"/d/rok_2020/281701_1.gml": ("gml", "281701_1", 2020), "/d/rok_2020/281701_1.shp": ("shp", "281701_1", 2020), "/d/year=2021/u_2814014/x.GDB": ("gdb", "281401_4", 2021), "/d/rok_2020/all.gml": ("gml", None, 2020), "/d/rok_2020/known.gml": ("gml", None, 2020), "/d/rok_2020/281701_2.swd": ("swde", "281701_2", 2020)}
    inside = spark.createDataFrame([("/d/rok_2020/all.gml", c) for c in ("281701_1", "281799_1", "junk", "2814014")] + [("/d/rok_2020/known.gml", c) for c in ("281701_1", "281701_2")], "path string, code string")
    assert {(r["unit"], r["path"]) for r in discovery.deliveries(listed, inside).where("unit like '%wspolny'").collect()} == {("2817_wspolny", "/d/rok_2020/all.gml")}
    held = [("u", "gml", "b", "L1"), ("u", "gml", "a", "L1"), ("u", "gml", "b", "L2"), ("u", "shp", "c", "L3"), ("v", "gml", "d", None), ("v", "swde", "f", "L1"), ("v", "swde", "e", "L2")]
    out = discovery.chosen_layers(spark.createDataFrame(held, "unit string, format string, path string, layer string"))
    assert {tuple(r) for r in out.collect()} == {("u", "gml", "L1", "a"), ("u", "gml", "L2", "b"), ("v", "swde", "L2", "e")}


def test_layer_names(spark):
    known = {"dzialki": ["DZE", "parcels"], "uzytki": ["KKL"]}
    names = {"dzialki": "dzialki", "DZE": "dzialki", "dze": None, "dze_2024": "dzialki", "x_EGB_Dzialki": "dzialki", "x_egb_dzialki_3": "dzialki", "x_egb_dzialki_MultiPolygon": "dzialki", "x_egb_dzialki_3_polygon": "dzialki", "x_egb_dzialki_polygon_x": None, "egb_uzytki": None, "a_egb_uzytki": "uzytki", "KKL_20245": None, "": None}
    assert {n: discovery.canonical(n, known) for n in names} == names
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", discovery.canonical_column(F.col("n"), known).alias("c")).collect()
    assert {r["n"]: r["c"] for r in got} == names


def test_halves_round_as_scaled_doubles(spark):
    values = [30.549999999999997, 0.125, 2.5, -2.5, 1.005, None]
    out = spark.createDataFrame([(v,) for v in values], "v double").select(overlay.half_even(F.col("v"), 1).alias("a"), overlay.half_even(F.col("v"), 0).alias("b")).collect()
    assert [r["a"] for r in out] == [30.6, 0.1, 2.5, -2.5, 1.0, None] and [r["b"] for r in out] == [31.0, 0.0, 2.0, -2.0, 1.0, None]


def test_shapes(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    rows = spark.range(1).select(F.lit("a").alias("iddzialki"), F.lit(2020).alias("year"))
    square = shapes.features(rows.withColumn("geometry", geometry.rectangle(*lit(0, 0, 10, 10)))).first()
    expected = {"area_ha": 0.01, "perimeter_m": 40, "log_area": math.log(100), "mean_width": 5, "ipq": math.pi / 4, "rectangularity": 1, "solidity": 1, "complexity_index": 40 / (2 * math.sqrt(100 * math.pi)), "vertex_density": 5 / 40}
    assert {k: square[k] for k in expected} == pytest.approx(expected)
    assert shapes.features(rows.withColumn("geometry", geometry.rectangle(*lit(0, 0, 20, 10)))).first()["elongation_mrr"] == pytest.approx(2)
    corner = geometry.polygon(*(tuple(lit(x, y)) for x, y in [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10), (0, 0)]))
    assert shapes.features(rows.withColumn("geometry", corner)).first()["solidity"] == pytest.approx(64 / 82)


def test_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "p double, y int")
    assert metrics.roc_auc(df, "p", "y").first()[0] == pytest.approx(0.875)
    assert metrics.average_precision(df, "p", "y").first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    ranked = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.3,)], "v double")
    assert sorted(r[0] for r in ranked.select(panel.percentile_rank("v")).collect()) == [25.0, 62.5, 62.5, 100.0]
    tested = spark.createDataFrame([("a", 0.001), ("b", 0.01), ("c", 0.5), ("d", 0.8)], "k string, p double")
    out = metrics.benjamini_hochberg(tested, "p", "k")
    flag = [c for c, t in out.dtypes if t == "boolean"][0]
    assert {r["k"]: r[flag] for r in out.collect()} == {"a": True, "b": True, "c": False, "d": False}


def test_prune(spark):
    df = spark.createDataFrame([(str(i), 2020, float(i), 2.0 * i, 7.0, None, float(i * i % 7)) for i in range(40)], "hex_id string, year int, a double, twice double, same double, gone double, other double")
    kept, _ = prune.prune(df, quasi_ratio=None)
    assert "gone" not in kept.columns and "same" not in kept.columns
    assert len({"a", "twice"} & set(kept.columns)) == 1 and "other" in kept.columns


def test_carry_forward(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None), ("b", 1, None)], "k string, t int, v string")
    out = by(panel.carry_forward(df, "v", by="k", order="t"), "k", "t")
    assert [out[k]["v"] for k in [("a", 1), ("a", 2), ("a", 3), ("b", 1)]] == [None, "x", "x", None]


def test_too_many_classes_or_layers_fail(spark):
    from hexpanel import sinks

    many = spark.range(10_001).selectExpr("1 AS hex_id", "2020 AS year", "1.0D AS area", "1.0D AS hex_area", "concat('c', id) AS c")
    with pytest.raises(ValueError, match="classes"):
        overlay.class_shares(many, "c")
    assert len(overlay.class_shares(many.limit(50), "c").columns) == 52
    with pytest.raises(ValueError, match="layer"):
        sinks.merged_layers(many, {"x": ["c"]}, "c")


def test_ranks_over_buckets(spark):
    """Row numbers, running sums, average ranks and quantiles against plain sorting, with ties and missing values."""
    import random

    import numpy as np

    from hexpanel.operators import ranks

    r = random.Random(3)
    rows = [(i, r.choice([None, float(r.randrange(40)), r.random() * 40])) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(6)
    ordered = sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0.0, x[0]))
    assert {x["k"]: x["n"] for x in ranks.numbered(df, F.col("v"), "k", out="n").collect()} == {k: i for i, (k, _) in enumerate(ordered, 1)}
    filled = [v for _, v in rows if v is not None]
    assert {x["k"]: x["a"] for x in ranks.average_rank(df, "v", "a").collect()} == {k: None if v is None else sum(w < v for w in filled) + (sum(w == v for w in filled) + 1) / 2 for k, v in rows}
    assert {x["k"]: x["s"] for x in ranks.running(df.where("v is not null"), F.col("v"), {"s": F.lit(1)}).collect()} == {k: sum(w <= v for w in filled) for k, v in rows if v is not None}
    assert ranks.quantiles(df, "v", [0, 0.1, 0.33, 0.5, 1]) == pytest.approx(np.percentile(filled, [0, 10, 33, 50, 100]))
    assert ranks.quantiles(df.limit(0), "v", [0.5]) == [] and ranks.numbered(df.limit(0), F.col("v"), out="n").count() == 0
    sample = metrics.sample_exact(df, "k", 7)
    assert sample.count() == 7 and sorted(sample.collect()) == sorted(metrics.sample_exact(df.repartition(2), "k", 7).collect())


def test_overlay_of_concave_polygons_with_holes_cell_by_cell(spark):
    """Areas of each cell against points on a fine grid, for a polygon with a notch and a hole, and their sum exactly."""
    import numpy as np

    from hexpanel.functions.geometry import _inside
    from hexpanel.operators.spatial import HexGrid

    grid = HexGrid(10.0)
    outer = [(0, 0), (95, 5), (90, 80), (55, 82), (50, 20), (40, 78), (3, 70)]
    hole = [(10, 20), (30, 22), (28, 45), (12, 40)]
    ring = lambda c: [{"x": float(x), "y": float(y)} for x, y in [*c, c[0]]]
    df = spark.createDataFrame([(1, [{"exterior": ring(outer), "holes": [ring(hole)]}])], f"id long, geometry {geometry.GEOMETRY}")
    got = {r["hex_id"]: r["area"] for r in grid.overlay(df).collect()}
    closed = lambda c: np.array([*c, c[0]], float)
    parts = [(closed(outer), [closed(hole)])]
    area = abs(geometry.shoelace(closed(outer)[:-1])) - abs(geometry.shoelace(closed(hole)[:-1]))
    assert sum(got.values()) == pytest.approx(area, rel=1e-9) and max(got.values()) <= grid.cell_area + 1e-6
    step = 0.25
    xy = np.stack(np.meshgrid(np.arange(-20, 120, step), np.arange(-20, 100, step)), -1).reshape(-1, 2) + step / 2
    xy = xy[_inside(xy, parts)]
    points = spark.createDataFrame(xy.tolist(), "x double, y double").groupBy(grid.cell_of(F.col("x"), F.col("y")).alias("c")).count().collect()
    sampled = {r["c"]: r["count"] * step * step for r in points}
    assert set(sampled) - set(got) == set() and all(a == pytest.approx(sampled.get(c, 0.0), abs=4.0) for c, a in got.items())
    few = spark.createDataFrame([(c,) for c in list(got)[:3]], "hex_id string")
    assert grid.overlay(df, cells=few).count() == 3


def test_overlay_cells_far_from_all_sides(monkeypatch):
    """Finding whole and empty cells first gives what cutting all of them gives."""
    import numpy as np

    turn = np.linspace(0, 2 * np.pi, 61)
    circle = np.column_stack([200 * np.cos(turn), 150 * np.sin(turn)])
    hole = np.array([(-60, -50), (70, -40), (50, 60), (-60, -50)], float)
    found = []
    for few in (0, 1000):
        monkeypatch.setattr(geometry, "FEW_POINTS", few)
        found.append({(x["q"], x["r"]): x["area"] for x in geometry.hexagon_parts([(circle, [hole])], 12.0, -64, 63)})
    assert found[0].keys() == found[1].keys() and all(found[0][k] == pytest.approx(found[1][k], abs=1e-6) for k in found[0])
    assert sum(found[0].values()) == pytest.approx(abs(geometry.shoelace(circle[:-1])) - abs(geometry.shoelace(hole[:-1])))
