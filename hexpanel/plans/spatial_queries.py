"""Queries on polygons built by arithmetic from keys and sizes, and on the learners."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexpanel.functions import geometry as G
from hexpanel.operators import metrics, models, shapes, spatial
from hexpanel.plans.panel_queries import SCORED, _scored
from hexpanel.plans.registry import register
from hexpanel.session import table

BOXES = "boxes AS (SELECT p_partkey AS id, (p_partkey % 40) * 130.0::DOUBLE AS x0, (p_partkey // 40) * 130.0::DOUBLE AS y0, (p_partkey % 40) * 130.0::DOUBLE + p_size * 4 AS x1, (p_partkey // 40) * 130.0::DOUBLE + p_retailprice / 10 AS y1 FROM part)"
ZONES = "zones AS (SELECT s_suppkey AS zone, (s_suppkey % 10) * 500.0::DOUBLE AS x0, (s_suppkey // 10) * 600.0::DOUBLE AS y0, (s_suppkey % 10) * 500.0::DOUBLE + 300 + s_nationkey * 10 AS x1, (s_suppkey // 10) * 600.0::DOUBLE + 420 AS y1 FROM supplier)"
SIDE = 60.0


def _box(x0, y0, x1, y1):
    return G.rectangle(*(F.expr(e) for e in (x0, y0, x1, y1)))


def boxes(spark, sf):
    x, y = "(p_partkey % 40) * 130.0D", "floor(p_partkey / 40) * 130.0D"
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), _box(x, y, f"{x} + p_size * 4", f"{y} + p_retailprice / 10").alias("geometry"))


def zones(spark, sf):
    x, y = "(s_suppkey % 10) * 500.0D", "floor(s_suppkey / 10) * 600.0D"
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("zone"), _box(x, y, f"{x} + 300 + s_nationkey * 10", f"{y} + 420").alias("zone_geometry"))


def _six(df, *keys):
    return df.select(*keys, *(F.round(c, 6).alias(c) for c in df.columns if c not in keys))


@register("shape_rect", """WITH r AS (SELECT p_partkey AS iddzialki, CAST(p_size AS DOUBLE) AS w, p_retailprice / 100 AS h FROM part)
, m AS (SELECT *, w * h AS a, w + h + w + h AS p, greatest(w, h) AS hi, least(w, h) AS lo, sqrt(w * w + h * h) / 2 AS r FROM r)
SELECT iddzialki, round_even(a / 1e4, 4) AS area_ha, round_even(p, 1) AS perimeter_m, round(ln(a), 6) AS log_area, round(ln(p), 6) AS log_perimeter, round(2 * a / p, 6) AS mean_width,
 round(hi / lo, 6) AS elongation_mrr, CAST(CASE WHEN w >= h THEN 0 ELSE 90 END AS DOUBLE) AS orientation_deg, round(w / h, 6) AS aspect_ratio_bbox, round(4 * pi() * a / (p * p), 6) AS ipq, 1.0::DOUBLE AS rectangularity, 1.0::DOUBLE AS solidity,
 round(p / (2 * sqrt(pi() * a)), 6) AS complexity_index, round(5 / p, 6) AS vertex_density, round(r, 6) AS min_circle_radius, round(a / (pi() * r * r), 6) AS area_to_circle_ratio, round(pi() * r * r - a, 4) AS circle_area_excess FROM m""")
def shape_rect(spark, sf):
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("iddzialki"), _box("0D", "0D", "double(p_size)", "p_retailprice / 100").alias("geometry"))
    out = shapes.features(df, keys=("iddzialki",), makers=["SizeScaleFeatures", "ElongationOrientationFeatures", "CompactnessCircularityFeatures", "EdgeComplexityFeatures", "ExtremeEnvelopeFeatures"])
    six = _six(out, "iddzialki", "area_ha", "perimeter_m", "circle_area_excess")
    return six.withColumn("circle_area_excess", F.round("circle_area_excess", 4))


@register("shape_lshape", """WITH l AS (SELECT p_partkey AS iddzialki, CAST(p_size AS DOUBLE) AS s FROM part)
SELECT iddzialki, round((28 + 6 * sqrt(2) - 40) * s, 6) AS convexity_deficit_len, round(18 * s * s, 6) AS convexity_deficit_area, round(18.0 / 82, 6) AS convexity_deficit_ratio, round(64.0 / 82, 6) AS solidity FROM l""")
def shape_lshape(spark, sf):
    s = F.col("p_size").cast("double")
    corner = [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)]
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("iddzialki"), G.polygon(*((s * x, s * y) for x, y in corner)).alias("geometry"))
    out = shapes.features(df, keys=("iddzialki",), makers=["EdgeContextFeatures", "CompactnessCircularityFeatures"])
    return _six(out.select("iddzialki", "convexity_deficit_len", "convexity_deficit_area", "convexity_deficit_ratio", "solidity"), "iddzialki")


@register("shape_inertia", """WITH r AS (SELECT p_partkey AS iddzialki, CAST(p_size AS DOUBLE) AS w, p_retailprice / 100 AS h FROM part)
, m AS (SELECT iddzialki, (w * w * w / 6 + w * w * h / 2) / (2 * (w + h)) AS xx, (h * h * h / 6 + h * h * w / 2) / (2 * (w + h)) AS yy FROM r)
SELECT iddzialki, round(greatest(xx, yy), 6) AS inertia_major, round(least(xx, yy), 6) AS inertia_minor, round(greatest(xx, yy) / least(xx, yy), 6) AS inertia_ratio FROM m""")
def shape_inertia(spark, sf):
    w, h = F.col("p_size").cast("double"), F.col("p_retailprice") / 100
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("iddzialki"), G.rectangle(-w / 2, -h / 2, w / 2, h / 2).alias("geometry"))
    return _six(shapes.features(df, keys=("iddzialki",), makers=["MomentInertiaFeatures"]), "iddzialki")


@register("overlay_boxes_grid", f"WITH {BOXES} SELECT id, round((x1 - x0) * (y1 - y0), 4) AS area FROM boxes")
def overlay_boxes_grid(spark, sf):
    parts = spatial.HexGrid(SIDE).overlay(boxes(spark, sf))
    return parts.groupBy("id").agg(F.round(F.sum("area"), 4).alias("area"))


@register("polyfill_boxes", f"""WITH {BOXES}, cells AS (SELECT q, r, {SIDE} * sqrt(3) * (q + r / 2.0::DOUBLE) AS x, {SIDE} * 1.5::DOUBLE * r AS y FROM range(-1200, 120) a(q), range(-2, 1200) b(r))
SELECT DISTINCT q || '_' || r AS hex_id FROM boxes JOIN cells ON x >= x0 AND x < x1 AND y >= y0 AND y < y1""")
def polyfill_boxes(spark, sf):
    return spatial.HexGrid(SIDE).polyfill(boxes(spark, sf))


@register("sjoin_intersects", f"WITH {BOXES}, {ZONES} SELECT id, zone FROM boxes b JOIN zones z ON b.x0 <= z.x1 AND z.x0 <= b.x1 AND b.y0 <= z.y1 AND z.y0 <= b.y1")
def sjoin_intersects(spark, sf):
    return spatial.spatial_join(boxes(spark, sf), zones(spark, sf), "intersects", right_geometry="zone_geometry", cell=400.0).select("id", "zone")


@register("sjoin_within", f"WITH {BOXES}, {ZONES} SELECT id, zone FROM boxes b LEFT JOIN zones z ON b.x0 >= z.x0 AND b.x1 <= z.x1 AND b.y0 >= z.y0 AND b.y1 <= z.y1")
def sjoin_within(spark, sf):
    return spatial.spatial_join(boxes(spark, sf), zones(spark, sf), "within", how="left", right_geometry="zone_geometry", cell=400.0).select("id", "zone")


@register("bounding_box", f"WITH {BOXES} SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxes")
def bounding_box(spark, sf):
    b = boxes(spark, sf).select(G.bounds(F.col("geometry")).alias("b"))
    return b.agg(F.min("b.x0").alias("x0"), F.min("b.y0").alias("y0"), F.max("b.x1").alias("x1"), F.max("b.y1").alias("y1"))


#: Pool adjacent violators in closed form: the largest, over starts at or before a score, of the least mean up to an end at or after it.
ISOTONIC = f"""WITH {SCORED}, g AS (SELECT s, sum(y)::DOUBLE AS p, count(*)::DOUBLE AS n, row_number() OVER (ORDER BY s) AS i FROM scored GROUP BY s), c AS (SELECT i, s, p, n, sum(p) OVER (ORDER BY i) AS tp, sum(n) OVER (ORDER BY i) AS seen FROM g)
, m AS (SELECT a.i AS a, b.i AS b, min((b.tp - a.tp + a.p) / (b.seen - a.seen + a.n)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS low FROM c a JOIN c b ON b.i >= a.i), f AS (SELECT b AS i, max(low) AS fit FROM m GROUP BY b)
SELECT doc_id, round(fit, 6) AS p_hat_cal FROM scored JOIN g USING (s) JOIN f USING (i)"""


@register("isotonic", ISOTONIC)
def isotonic(spark, sf):
    df = _scored(spark, sf)
    return models.apply_calibration(models.calibrate(df, "s", "y"), df, "s").select("doc_id", F.round("p_hat_cal", 6).alias("p_hat_cal"))


def _training(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.avg("l_extendedprice").alias("a"), F.avg("l_discount").alias("b"), F.avg("l_quantity").alias("c"), F.count("*").alias("n"))
    return li.withColumn("y_next", F.pmod(F.xxhash64("l_suppkey", "year"), F.lit(3)) + (F.col("c") > 25).cast("int") > 1).withColumnRenamed("l_suppkey", "hex_id")


def _forecast(spark, sf, pipeline):
    df = _training(spark, sf)
    train, valid = models.temporal_split(df, "year", 1999, (2000, 2001))
    ready = models.weighted(train, "y_next", models.balanced_weights(train, "y_next"))
    return models.score(pipeline(["a", "b", "c", "n"]).fit(ready), valid).select("hex_id", "year", "p_hat")


@register("logreg_baseline")
def logreg_baseline(spark, sf):
    return _forecast(spark, sf, models.logistic_baseline)


@register("gbt_forecast")
def gbt_forecast(spark, sf):
    return _forecast(spark, sf, lambda c: models.boosted_trees(c, maxIter=10))


@register("top_fraction", f"WITH {SCORED}, r AS (SELECT doc_id, row_number() OVER (ORDER BY s DESC, doc_id) AS r, count(*) OVER () AS n FROM scored) SELECT doc_id FROM r WHERE r <= greatest(1, floor(0.05 * n))")
def top_fraction(spark, sf):
    return metrics.top_fraction(_scored(spark, sf), "s", "doc_id", 0.05).select("doc_id")
