"""Queries on scans, contours, forecasts and profiles, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexpanel import schema
from hexpanel.functions import codes
from hexpanel.functions import geometry as G
from hexpanel.operators import contours, metrics, models, neighbors, panel, prune, spatial
from hexpanel.plans.panel_queries import SCORED, SPLIT, TX, _case, _scored, _split, _tx, small_panel
from hexpanel.plans.registry import register
from hexpanel.plans.spatial_queries import BOXES, SIDE, ZONES, _box, boxes, zones
from hexpanel.session import table
from hexpanel.sources import scans

# ---- scans


@register("scan_union_files", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, NULL::BIGINT AS l_orderkey, NULL::DOUBLE AS l_quantity FROM orders
UNION ALL SELECT NULL, NULL, l_orderkey, CAST(l_quantity AS DOUBLE) FROM lineitem""")
def scan_union_files(spark, sf):
    return scans.union_files(spark, [f"{sf}/orders.parquet", f"{sf}/lineitem.parquet"], {"o_orderkey": "string", "l_quantity": "double"}, ["o_orderkey", "o_totalprice", "l_orderkey", "l_quantity"])


@register("scan_transactions", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS tx_year FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1997")
def scan_transactions(spark, sf):
    return scans.transactions(table(spark, sf, "orders"), "o_orderdate", between=(1993, 1997)).select("o_orderkey", "tx_year")


@register("scan_plain", "SELECT p_partkey, p_brand, p_size FROM part")
def scan_plain(spark, sf):
    shaped = table(spark, sf, "part").withColumn("geometry", F.lit(b"\x01"))
    return scans.plain(shaped, ["p_partkey", "p_brand", "p_size", "geometry", "not_there"])


@register("scan_hexagons", f"SELECT DISTINCT CAST(s_suppkey % 10 AS VARCHAR) || '_' || CAST(s_suppkey // 10 AS VARCHAR) AS hex_id, round_even(1.5::DOUBLE * sqrt(3) * {SIDE} * {SIDE}, 2) AS hex_area FROM supplier")
def scan_hexagons(spark, sf):
    return scans.hexagons(_cells(spark, sf), decimals=2).select("hex_id", "hex_area")


def _cells(spark, sf):
    ring = spatial.HexGrid(SIDE).boundary(F.col("hex_id"))
    shape = F.array(F.struct(F.concat(ring, F.slice(ring, 1, 1)).alias("exterior"), F.array().cast(f"array<array<{G.POINT}>>").alias("holes")))
    cells = table(spark, sf, "supplier").select(neighbors.cell_id(F.col("s_suppkey") % 10, F.floor(F.col("s_suppkey") / 10)).alias("hex_id"))
    return cells.withColumn("geometry", shape)


@register("scan_parcels", "SELECT p_partkey AS iddzialki, 2024 AS year, p_size AS area, CAST(p_retailprice AS DOUBLE) AS gf_price FROM part")
def scan_parcels(spark, sf):
    part = table(spark, sf, "part")
    left = part.select(F.col("p_partkey").alias("iddzialki"), F.lit(2024).alias("year"), F.col("p_size").alias("area"), "p_comment" if "p_comment" in part.columns else "p_type")
    right = part.select(F.col("p_partkey").alias("iddzialki"), F.lit(2024).alias("year"), F.col("p_retailprice").cast("double").alias("price"))
    return scans.parcels(left, ["area", "not_there"], right)


@register("scan_labelled", f"""WITH {TX}, a AS (SELECT k, year, max(price) > 200000 AS dear FROM tx GROUP BY ALL), b AS (SELECT k, year, count(*) > 1 AS often FROM tx GROUP BY ALL)
, c AS (SELECT c_custkey AS k, CAST(1992 + c_custkey % 7 AS BIGINT) AS year FROM customer), u AS (SELECT 'customer' AS name, * FROM c UNION ALL SELECT 'later', k, year + 1 FROM c)
SELECT name, k, year, dear, often FROM u LEFT JOIN a USING (k, year) LEFT JOIN b USING (k, year)""")
def scan_labelled(spark, sf):
    tx = _tx(spark, sf)
    dear, often = tx.groupBy("k", "year").agg((F.max("price") > 200000).alias("dear")), tx.groupBy("k", "year").agg((F.count("*") > 1).alias("often"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.lit(1992) + F.col("c_custkey") % 7).cast("long").alias("year"))
    out = scans.labelled({"customer": c, "later": c.withColumn("year", F.col("year") + 1)}, [(dear, ["dear"]), (often, ["often"])], ("k", "year"))
    return out["customer"].withColumn("name", F.lit("customer")).unionByName(out["later"].withColumn("name", F.lit("later")))


@register("key_report", f"WITH {TX} SELECT 'left' AS side, trim(CAST(k AS VARCHAR)) AS k, CAST(year AS VARCHAR) AS year, count(*) AS n FROM tx GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'right', CAST(c_custkey % 50 AS VARCHAR), CAST(1995 + c_custkey % 3 AS VARCHAR), count(*) FROM customer GROUP BY ALL HAVING count(*) > 1")
def key_report(spark, sf):
    right = table(spark, sf, "customer").select(F.concat(F.lit(" "), F.col("c_custkey") % 50).alias("k"), (F.lit(1995) + F.col("c_custkey") % 3).alias("year"))
    return prune.key_report(_tx(spark, sf), right, ["k", "year"])


# ---- contours

USE = "CASE p_partkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN ' ' WHEN 3 THEN 'Ps' END"


@register("contours_land_use", f"""WITH p AS (SELECT *, {USE} AS u FROM part)
SELECT coalesce(nullif(trim(u), ''), p_type) AS "OZU", CAST(p_partkey AS VARCHAR) AS "IDUZYTKU", p_brand AS "IDENTIFIER", CAST(p_size AS VARCHAR) AS "WERSJAID", p_size AS "ST_OBJ" FROM p""")
def contours_land_use(spark, sf):
    part = table(spark, sf, "part")
    return contours.normalise(part.select(F.expr(USE).alias("G5OZU"), F.col("p_type").alias("OFU"), F.col("p_partkey").alias("G5IDT"), F.col("p_brand").alias("IDR"), F.col("p_size").alias("ST_OBJ")), "land_use")


@register("contours_classification", f"""SELECT CAST(p_partkey AS VARCHAR) AS "IDKONTURU", {USE} AS "OZU", p_brand AS "OZK", p_type AS "WERSJAID", p_size AS "SHAPE_AREA", p_name AS "IDOBREBU" FROM part""")
def contours_classification(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("G5IDK"), F.expr(USE).alias("G5OZU"), F.col("p_brand").alias("G5OZK"), F.col("p_type").alias("WERSJAID"), F.col("p_size").alias("Shape_Area"), F.col("p_name").alias("G5IDO"))
    return contours.normalise(schema.uppercase(contours.legacy(p))[0], "classification")


@register("contours_append_early", """WITH kug AS (SELECT CAST(o_orderkey AS VARCHAR) AS "IDUZYTKU", CAST(year(o_orderdate) AS BIGINT) AS year FROM orders WHERE year(o_orderdate) >= 1995)
, kkl AS (SELECT l_orderkey * 10 + l_linenumber AS "IDKONTURU", CAST(year(l_shipdate) AS BIGINT) AS year, l_returnflag AS "OZK" FROM lineitem)
SELECT "IDUZYTKU", year, NULL::BIGINT AS "IDKONTURU", NULL AS "OZK" FROM kug UNION ALL SELECT CAST("IDKONTURU" AS VARCHAR), year, "IDKONTURU", "OZK" FROM kkl WHERE year < (SELECT min(year) FROM kug)""")
def contours_append_early(spark, sf):
    kug = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("IDUZYTKU"), F.year("o_orderdate").cast("long").alias("year")).where("year >= 1995")
    kkl = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("IDKONTURU"), F.year("l_shipdate").cast("long").alias("year"), F.col("l_returnflag").alias("OZK"))
    return contours.append_early(kug, kkl)


ZONE_NAMES = ["ETRS89 / Poland CS2000 / PAS_7", "PAS 6", "pas8", "PUWG 1992"]


@register("zone_of", f"SELECT p_partkey, CAST(2171 + try_cast(nullif(regexp_extract(upper({_case(ZONE_NAMES, 'p_partkey')}), 'PAS[_ ]?([5-8])', 1), '') AS INTEGER) AS INTEGER) AS epsg FROM part")
def zone_of(spark, sf):
    return table(spark, sf, "part").select("p_partkey", codes.zone_of(F.expr(_case(ZONE_NAMES, "p_partkey"))).alias("epsg"))


# ---- geometry

SHIFT = 500000.0


@register("reproject_round_trip", f"WITH {BOXES} SELECT id, round(x0 + {SHIFT}, 3) AS x0, round(y0 + {SHIFT}, 3) AS y0, round(x1 + {SHIFT}, 3) AS x1, round(y1 + {SHIFT}, 3) AS y1 FROM boxes")
def reproject_round_trip(spark, sf):
    """Degrees and back, by another zone on the way; millimetres are kept."""
    x, y = f"(p_partkey % 40) * 130.0D + {SHIFT}D", f"floor(p_partkey / 40) * 130.0D + {SHIFT}D"
    there = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), _box(x, y, f"{x} + p_size * 4", f"{y} + p_retailprice / 10").alias("geometry"))
    zone = scans.geographic(there, srid=2180).withColumn("geometry", G.reproject(4326, 2178)(F.col("geometry")))
    back = zone.withColumn("geometry", G.reproject(2178, 2180)(F.col("geometry"))).select("id", G.bounds(F.col("geometry")).alias("b"))
    return back.select("id", *(F.round(f"b.{c}", 3).alias(c) for c in ("x0", "y0", "x1", "y1")))


PLANS = "plans AS (SELECT n_nationkey AS plan, (n_nationkey % 5) * 1100.0::DOUBLE AS x0, (n_nationkey // 5) * 1500.0::DOUBLE AS y0, (n_nationkey % 5) * 1100.0::DOUBLE + 900 AS x1, (n_nationkey // 5) * 1500.0::DOUBLE + 1300 AS y1 FROM nation)"
MEET = "b.x0 <= {0}.x1 AND {0}.x0 <= b.x1 AND b.y0 <= {0}.y1 AND {0}.y0 <= b.y1"


@register("sjoin_chain", f"WITH {BOXES}, {ZONES}, {PLANS} SELECT id, zone, plan FROM boxes b LEFT JOIN zones z ON {MEET.format('z')} LEFT JOIN plans p ON {MEET.format('p')}")
def sjoin_chain(spark, sf):
    x, y = "(n_nationkey % 5) * 1100.0D", "floor(n_nationkey / 5) * 1500.0D"
    plans = table(spark, sf, "nation").select(F.col("n_nationkey").alias("plan"), _box(x, y, f"{x} + 900", f"{y} + 1300").alias("plan_geometry"))
    return spatial.join_chain(boxes(spark, sf), [(zones(spark, sf), "zone_geometry"), (plans, "plan_geometry")], cell=400.0).select("id", "zone", "plan")


@register("reattach_cells", "SELECT CAST(s_suppkey % 10 AS VARCHAR) || '_' || CAST(s_suppkey // 10 AS VARCHAR) AS hex_id, n, 7::BIGINT AS corners FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_suppkey = s_suppkey")
def reattach_cells(spark, sf):
    cell = neighbors.cell_id(F.col("l_suppkey") % 10, F.floor(F.col("l_suppkey") / 10))
    n = table(spark, sf, "lineitem").where("l_quantity > 45").groupBy(cell.alias("hex_id")).agg(F.count("*").alias("n"))
    return spatial.reattach(n, _cells(spark, sf)).select("hex_id", "n", F.size(F.col("geometry")[0]["exterior"]).cast("long").alias("corners"))


@register("dissolve_by_size", f"WITH {BOXES}, s AS (SELECT p_partkey AS id, p_size FROM part) SELECT p_size, count(*) AS parts, round(sum((x1 - x0) * (y1 - y0)), 4) AS area FROM boxes JOIN s USING (id) GROUP BY p_size")
def dissolve_by_size(spark, sf):
    b = boxes(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size"), "id")
    return spatial.dissolve(b, ["p_size"]).select("p_size", F.size("geometry").cast("long").alias("parts"), F.round(G.area(F.col("geometry")), 4).alias("area"))


@register("overlay_cells", f"""WITH {BOXES}, n AS (SELECT *, (x1 - x0) * (y1 - y0) AS a FROM boxes)
SELECT id, true AS inside, round(a, 4) AS area FROM n""")
def overlay_cells(spark, sf):
    """Each cell's share is held against clipping the cell's own box: no share exceeds the cell or the overlap of boxes."""
    grid = spatial.HexGrid(SIDE)
    parts = grid.overlay(boxes(spark, sf))
    box, (x, y) = G.bounds(F.col("geometry")), grid.center(*grid.axial(F.col("hex_id")))
    half = spatial.ROOT3 / 2 * SIDE
    wide = F.least(box["x1"], x + half) - F.greatest(box["x0"], x - half)
    tall = F.least(box["y1"], y + SIDE) - F.greatest(box["y0"], y - SIDE)
    inner = F.greatest(F.least(box["x1"], x + half) - F.greatest(box["x0"], x - half), F.lit(0.0)) * F.greatest(F.least(box["y1"], y + SIDE / 2) - F.greatest(box["y0"], y - SIDE / 2), F.lit(0.0))
    sane = (F.col("area") <= wide * tall + 1e-6) & (F.col("area") <= F.col("hex_area") + 1e-6) & (F.col("area") >= inner - 1e-6)
    return parts.withColumn("_sane", sane).groupBy("id").agg(F.every("_sane").alias("inside"), F.round(F.sum("area"), 4).alias("area"))


# ---- forecasts and profiles


@register("persistence_ap", "WITH " + SPLIT + """
, y AS (SELECT split_proxy, coalesce(lead(split_proxy) OVER (PARTITION BY hex_id ORDER BY year), false) AS y_next FROM proxied), s AS (SELECT CAST(split_proxy AS INT) AS s, sum(CAST(y_next AS INT))::DOUBLE AS p, count(*)::DOUBLE AS n FROM y GROUP BY 1)
, c AS (SELECT p, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS seen FROM s) SELECT round(sum(p * tp / seen) / nullif(sum(p), 0), 9) AS average_precision FROM c""")
def persistence_ap(spark, sf):
    held = models.persistence(_split(spark, sf), "split_proxy")
    return metrics.average_precision(held, "p_hat", "y_next").select(F.round("average_precision", 9).alias("average_precision"))


@register("horizon_windows", "WITH " + SPLIT + " SELECT CAST(h AS BIGINT) AS horizon, count(*) FILTER (year <= 1997 - h) AS train, count(*) FILTER (year = 1998 - h) AS valid, count(*) FILTER (year = 1999 - h) AS test FROM panel, range(1, 4) r(h) GROUP BY h")
def horizon_windows(spark, sf):
    p = small_panel(spark, sf).select("year")
    row = lambda h, train, valid, test: F.struct(F.lit(h).cast("long").alias("horizon"), F.count_if(F.col("year") <= train).alias("train"), F.count_if(F.col("year") == valid).alias("valid"), F.count_if(F.col("year") == test).alias("test"))
    return p.agg(F.array(*(row(h, *models.horizon_window(h, 1996)) for h in (1, 2, 3))).alias("x")).select(F.inline("x"))


PERCENTILE = "round_even((rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0) / count(*) OVER () * 100, 1)"


@register("predictions", f"WITH {SCORED}, r AS (SELECT doc_id AS hex_id, round_even(s, 4) AS p FROM scored) SELECT hex_id, 2024::BIGINT AS base_year, 2026::BIGINT AS target_year, 2::BIGINT AS horizon, 'split' AS task, p AS probability, p AS prob_calibrated, {PERCENTILE} AS risk_percentile FROM r")
def predictions(spark, sf):
    return models.predictions(_scored(spark, sf).withColumnsRenamed({"doc_id": "hex_id", "s": "p_hat"}), base_year=2024, horizon=2, task="split")


@register("column_profile", """WITH c AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS "column", unnest([CAST(l_quantity AS DOUBLE), l_extendedprice, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_discount END]) AS v FROM lineitem)
SELECT "column", count(*) AS rows, count(v) AS filled, round((count(*) - count(v)) / count(*), 9) AS missing, round(avg(v), 6) AS mean, min(v) AS low, max(v) AS high, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90 FROM c GROUP BY 1""")
def column_profile(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", F.when(F.col("l_partkey") % 3 != 0, F.col("l_discount")).alias("l_discount"))
    out = prune.profile(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({"missing": F.round("missing", 9), "mean": F.round("mean", 6), "p50": F.round("p50", 6), "p90": F.round("p90", 6)})


@register("prune_report", """SELECT 'one' AS "column", 'constant' AS reason, '1' AS detail UNION ALL SELECT 'copy', 'duplicate', 'l_tax'
UNION ALL SELECT 'seldom', 'missing', printf('%.4f', avg(CASE WHEN l_linenumber = 7 THEN 0.0 ELSE 1.0 END)) FROM lineitem""")
def prune_report(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", F.lit(5).alias("one"), F.col("l_tax").alias("copy"), F.when(F.col("l_linenumber") == 7, F.col("l_discount")).alias("seldom"))
    return prune.prune(li, keys=("l_orderkey", "l_linenumber"), quasi_ratio=None, corr=0.99)[1]


@register("prune_kept", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem")
def prune_kept(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", F.lit(5).alias("one"), F.col("l_tax").alias("copy"), F.when(F.col("l_linenumber") == 7, F.col("l_discount")).alias("seldom"))
    return prune.prune(li, keys=("l_orderkey", "l_linenumber"), quasi_ratio=None)[0]


@register("sample_exact", "SELECT count(*) AS drawn, count(*) AS known, count(DISTINCT doc_id) AS distinct_ids FROM (SELECT doc_id FROM documents LIMIT 150)")
def sample_exact(spark, sf):
    """150 rows exactly, each once, all of them rows of the table."""
    d = table(spark, sf, "documents").select("doc_id")
    drawn = metrics.sample_exact(d, "doc_id", 150).withColumnRenamed("doc_id", "drawn")
    ids = d.distinct()
    return drawn.join(ids, drawn["drawn"] == ids["doc_id"], "left").agg(F.count("drawn").alias("drawn"), F.count("doc_id").alias("known"), F.count_distinct("drawn").alias("distinct_ids"))


@register("carry_labels_forward", "WITH " + SPLIT + " SELECT hex_id, year, last_value(CASE WHEN n_parcel % 3 = 0 THEN n_parcel END IGNORE NULLS) OVER (PARTITION BY hex_id ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_parcel FROM panel")
def carry_labels_forward(spark, sf):
    masked = small_panel(spark, sf).withColumn("n_parcel", F.when(F.col("n_parcel") % 3 == 0, F.col("n_parcel")))
    return panel.carry_forward(masked, "n_parcel", by="hex_id", order=["year"]).select("hex_id", "year", "n_parcel")
