"""Queries over the star-schema tables as stand-ins for fragments, transactions and panels.

Fragments: cell = supplier, year of shipping, area = quantity, parcel = part, class = return flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.functions import codes
from hexpanel.operators import joins, metrics, neighbors, overlay, panel, prune, reports
from hexpanel.plans.registry import register
from hexpanel.session import table

CLASSES = ["A", "N", "R", "X"]  # X is in no row: its share is 0

FRAG = """frag AS (SELECT l_suppkey AS hex_id, CAST(year(l_shipdate) AS BIGINT) AS year, l_quantity AS area, l_extendedprice AS x,
  CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 2 THEN 0.0 ELSE l_discount END AS z, l_partkey AS parcel, l_returnflag AS class,
  CAST(10000 + l_suppkey % 7 AS DOUBLE) AS hex_area, p_brand AS brand
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""


def fragments(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    z = F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double")).when(F.col("l_linenumber") == 2, 0.0).otherwise(F.col("l_discount"))
    rows = li.select(F.col("l_suppkey").alias("hex_id"), F.year("l_shipdate").cast("long").alias("year"), F.col("l_quantity").alias("area"), F.col("l_extendedprice").alias("x"), z.alias("z"), F.col("l_partkey").alias("parcel"), F.col("l_returnflag").alias("class"), (F.lit(10000.0) + F.col("l_suppkey") % 7).alias("hex_area"))
    return rows.join(part, rows["parcel"] == part["p_partkey"], "left").withColumnRenamed("p_brand", "brand").drop("p_partkey")


def small_panel(spark: SparkSession, sf: str) -> DataFrame:
    """hex_id, year, mean area, total area, number of parcels: one aggregation."""
    f = fragments(spark, sf)
    return f.groupBy("hex_id", "year").agg(F.avg("x").alias("shape_area_mean"), F.sum("area").alias("coverage_area"), F.count_distinct("parcel").alias("n_parcel"))


PANEL = FRAG + ", panel AS (SELECT hex_id, year, avg(x) AS shape_area_mean, sum(area) AS coverage_area, count(DISTINCT parcel) AS n_parcel FROM frag GROUP BY hex_id, year)"


def label_sql(proxy: str, horizon: int) -> str:
    leads = ", ".join(f"coalesce(lead({proxy}, {h}) OVER w, false) AS y_next{'' if h == 1 else f'_{h}'}" for h in [1, 2, 3] + ([horizon] if horizon > 3 else []))
    names = ", ".join(f"y_next{'' if h == 1 else f'_{h}'}" for h in [1, 2, 3] + ([horizon] if horizon > 3 else []))
    return f"""
, labelled AS (SELECT *, {proxy} AND NOT lag({proxy}, 1, false) OVER w AS onset, {leads} FROM proxied WINDOW w AS (PARTITION BY hex_id ORDER BY year))
SELECT hex_id, year, valid_transition, {proxy}, onset, {names}, y_next AND NOT coalesce(lag(y_next) OVER (PARTITION BY hex_id ORDER BY year), false) AS y_next_onset FROM labelled"""


SPLIT = PANEL + """
, stepped AS (SELECT *, coalesce(year - lag(year) OVER w = 1, false) AS valid_transition, shape_area_mean - lag(shape_area_mean) OVER w AS d_mean, n_parcel - lag(n_parcel) OVER w AS d_count,
  CASE WHEN coverage_area = 0 AND lag(coverage_area) OVER w = 0 THEN 0 ELSE (coverage_area - lag(coverage_area) OVER w) / nullif(lag(coverage_area) OVER w, 0) END AS total_change FROM panel WINDOW w AS (PARTITION BY hex_id ORDER BY year))
, proxied AS (SELECT *, coalesce(d_mean < -100.0 AND abs(total_change) <= 0.2 AND d_count > 0 AND valid_transition, false) AS split_proxy FROM stepped)"""
OUT = ["hex_id", "year", "valid_transition", "onset", "y_next", "y_next_2", "y_next_3", "y_next_5", "y_next_onset"]


def _split(spark, sf):
    return panel.split_labels(small_panel(spark, sf), tolerance=0.2, least_drop=100.0, horizon=5)


@register("split_labels", "WITH " + SPLIT + label_sql("split_proxy", 5))
def split_labels(spark, sf):
    return _split(spark, sf).select(*OUT, "split_proxy")


@register("weighted_mean_nullaware", f"WITH {FRAG} SELECT hex_id, year, round(sum(x * (area / hex_area)) / sum(area / hex_area), 3) AS x_mean, round(sum(z * (area / hex_area)) / sum(CASE WHEN z IS NOT NULL THEN area / hex_area END), 8) AS z_mean FROM frag GROUP BY hex_id, year")
def weighted_mean_nullaware(spark, sf):
    out = overlay.weighted_means(fragments(spark, sf), ["x", "z"], hex_area="hex_area")
    return out.select("hex_id", "year", F.round("x_mean", 3).alias("x_mean"), F.round("z_mean", 8).alias("z_mean"))


@register("weighted_mean_fulldenom", f"WITH {FRAG} SELECT hex_id, year, round(sum(coalesce(nullif(z, 0), 0) * area) / sum(area), 8) AS z_mean FROM frag GROUP BY hex_id, year")
def weighted_mean_fulldenom(spark, sf):
    out = overlay.weighted_means(fragments(spark, sf), ["z"], denominator="all", zero_as_null=["z"])
    return out.select("hex_id", "year", F.round("z_mean", 8).alias("z_mean"))


@register("weighted_mean_nonzero", f"WITH {FRAG} SELECT hex_id, year, round(sum(nullif(z, 0) * area) / sum(CASE WHEN nullif(z, 0) IS NOT NULL THEN area END), 8) AS z_mean_nz FROM frag GROUP BY hex_id, year")
def weighted_mean_nonzero(spark, sf):
    return overlay.weighted_means(fragments(spark, sf), [], denominator="all", non_zero=["z"]).select("hex_id", "year", F.round("z_mean_nz", 8).alias("z_mean_nz"))


@register("coverage", f"WITH {FRAG} SELECT hex_id, year, sum(area) AS coverage_area, max(hex_area) AS hex_area, count(DISTINCT parcel) AS n_parcel FROM frag GROUP BY hex_id, year HAVING sum(area) > 0")
def coverage(spark, sf):
    return overlay.coverage(fragments(spark, sf), unique="parcel")


@register("coverage_filter_group", f"WITH {FRAG}, c AS (SELECT hex_id, year, sum(area) AS coverage_area, max(hex_area) AS hex_area FROM frag GROUP BY hex_id, year HAVING sum(area) > 0) SELECT hex_id, year, coverage_area, hex_area, round_even(coverage_area / hex_area, 5) AS coverage_frac FROM c WHERE hex_area > 0 AND coverage_area / hex_area >= 0.2")
def coverage_filter_group(spark, sf):
    return overlay.filter_groups(overlay.coverage(fragments(spark, sf)), 0.2, 5)


@register("coverage_filter_fragment", f"WITH {FRAG} SELECT hex_id, year, sum(area) AS area, count(*) AS n FROM frag WHERE area / hex_area >= 0.003 GROUP BY hex_id, year")
def coverage_filter_fragment(spark, sf):
    return overlay.filter_fragments(fragments(spark, sf), 0.003).groupBy("hex_id", "year").agg(F.sum("area").alias("area"), F.count("*").alias("n"))


@register("dominant_category", f"WITH {FRAG}, s AS (SELECT hex_id, year, brand, sum(area) AS a FROM frag WHERE brand IS NOT NULL GROUP BY ALL) SELECT hex_id, year, brand AS jednostka FROM s QUALIFY row_number() OVER (PARTITION BY hex_id, year ORDER BY a DESC, brand) = 1")
def dominant_category(spark, sf):
    return overlay.dominant(fragments(spark, sf), "brand")


SHARES = FRAG + ", shares AS (SELECT hex_id, year, " + ", ".join(f"least(greatest(coalesce(sum(CASE WHEN class = '{c}' THEN area END) / max(hex_area), 0.0), 0.0), 1.0) AS uzg_{c}_share" for c in CLASSES) + " FROM frag WHERE class IS NOT NULL GROUP BY hex_id, year)"


def _shares(spark, sf):
    return overlay.class_shares(fragments(spark, sf), "class", CLASSES, prefix="uzg_")


@register("class_shares_pivot", f"WITH {SHARES} SELECT hex_id, year, " + ", ".join(f"round_even(uzg_{c}_share, 4) AS uzg_{c}_share" for c in CLASSES) + " FROM shares")
def class_shares_pivot(spark, sf):
    return overlay.class_shares(fragments(spark, sf), "class", CLASSES, prefix="uzg_", decimals=4)


@register("row_sums", f"WITH {SHARES} SELECT hex_id, year, round({' + '.join(f'uzg_{c}_share' for c in CLASSES)}, 8) AS sum_uzg FROM shares")
def row_sums(spark, sf):
    return _shares(spark, sf).select("hex_id", "year", F.round(overlay.row_sum([f"uzg_{c}_share" for c in CLASSES]), 8).alias("sum_uzg"))


CONVERT = SHARES + """
, summed AS (SELECT *, uzg_A_share + uzg_N_share + uzg_R_share + uzg_X_share AS sum_uzg FROM shares)
, stepped AS (SELECT *, coalesce(year - lag(year) OVER w = 1, false) AS valid_transition, uzg_R_share - lag(uzg_R_share) OVER w AS d_r, uzg_N_share - lag(uzg_N_share) OVER w AS d_b,
  CASE WHEN sum_uzg = 0 AND lag(sum_uzg) OVER w = 0 THEN 0 ELSE (sum_uzg - lag(sum_uzg) OVER w) / nullif(lag(sum_uzg) OVER w, 0) END AS total_change FROM summed WINDOW w AS (PARTITION BY hex_id ORDER BY year))
, proxied AS (SELECT *, coalesce(d_r < 0 AND d_b > 0 AND abs(total_change) <= 0.2 AND valid_transition, false) AS convert_proxy FROM stepped)"""


@register("conversion_labels", "WITH " + CONVERT + label_sql("convert_proxy", 5))
def conversion_labels(spark, sf):
    s = _shares(spark, sf)
    s = s.withColumn("sum_uzg", overlay.row_sum([f"uzg_{c}_share" for c in CLASSES]))
    return panel.conversion_labels(s, share_b="uzg_N_share", tolerance=0.2, horizon=5).select(*OUT, "convert_proxy")


@register("locf", """SELECT event_id, user_id, last_value(CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events""")
def locf(spark, sf):
    e = table(spark, sf, "events")
    least = e.agg(F.min("event_type").alias("least"))
    masked = e.crossJoin(F.broadcast(least)).withColumn("value", F.when(F.col("event_type") == F.col("least"), F.col("value")))  # one row
    return panel.carry_forward(masked, "value", by="user_id", order=["ts", "event_id"]).select("event_id", "user_id", "value")


@register("early_append", """WITH base AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders WHERE year(o_orderdate) >= 1997)
SELECT id, year, 'base' AS src FROM base UNION ALL SELECT l_orderkey * 10 + l_linenumber, CAST(year(l_shipdate) AS BIGINT), 'early' FROM lineitem WHERE year(l_shipdate) < (SELECT min(year) FROM base)""")
def early_append(spark, sf):
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").cast("long").alias("year")).where("year >= 1997").withColumn("src", F.lit("base"))
    early = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.year("l_shipdate").cast("long").alias("year")).withColumn("src", F.lit("early"))
    first = base.agg(F.min("year").alias("first"))
    return base.unionByName(early.crossJoin(F.broadcast(first)).where("year < first").drop("first"))  # one row


# ---- neighbourhood: cell q_r from the supplier's key

HEX = """hexes AS (SELECT CAST(s_suppkey % 10 AS VARCHAR) || '_' || CAST(s_suppkey // 10 AS VARCHAR) AS cell, s_suppkey % 10 AS q, s_suppkey // 10 AS r FROM supplier)
, steps AS (SELECT dq, dr, greatest(abs(dq), abs(dr), abs(dq + dr)) AS d FROM range(-3, 4) a(dq), range(-3, 4) b(dr) WHERE greatest(abs(dq), abs(dr), abs(dq + dr)) BETWEEN 1 AND 3)
, tagged AS (SELECT a.cell, b.cell AS neighbor, d FROM hexes a CROSS JOIN steps JOIN hexes b ON b.q = a.q + dq AND b.r = a.r + dr)"""


def _hexes(spark, sf):
    return table(spark, sf, "supplier").select(neighbors.cell_id(F.col("s_suppkey") % 10, F.floor(F.col("s_suppkey") / 10)).alias("hex_id"))


@register("nbr_edges_disk", f"WITH {HEX} SELECT cell, neighbor, CAST(rr AS BIGINT) AS \"R\" FROM tagged JOIN range(1, 4) x(rr) ON d <= rr")
def nbr_edges_disk(spark, sf):
    return neighbors.edges(_hexes(spark, sf), [1, 2, 3]).withColumn("R", F.col("R").cast("long"))


@register("nbr_edges_ring", f"WITH {HEX} SELECT cell, neighbor, CAST(d AS BIGINT) AS \"R\" FROM tagged")
def nbr_edges_ring(spark, sf):
    return neighbors.edges(_hexes(spark, sf), [1, 2, 3], rolling=False).withColumn("R", F.col("R").cast("long"))


NBR = HEX + f""", {FRAG}, vals AS (SELECT CAST(hex_id % 10 AS VARCHAR) || '_' || CAST(hex_id // 10 AS VARCHAR) AS hex_id, year, round(avg(x), 2) AS v, min(brand) AS cat FROM frag GROUP BY ALL)
, known AS (SELECT DISTINCT hex_id FROM vals)
, links AS (SELECT cell, neighbor, d FROM tagged WHERE cell IN (SELECT hex_id FROM known) AND neighbor IN (SELECT hex_id FROM known))
, fan AS (SELECT p.hex_id, p.year, l.neighbor, l.d, n.v, n.cat, n.hex_id IS NOT NULL AS here FROM vals p LEFT JOIN links l ON l.cell = p.hex_id LEFT JOIN vals n ON n.hex_id = l.neighbor AND n.year = p.year)"""


def _nbr_panel(spark, sf):
    f = fragments(spark, sf)
    cell = neighbors.cell_id(F.col("hex_id") % 10, F.floor(F.col("hex_id") / 10))
    return f.groupBy(cell.alias("hex_id"), "year").agg(F.round(F.avg("x"), 2).alias("v"), F.min("brand").alias("cat"))


@register("nbr_mean_median", f"WITH {NBR} SELECT hex_id, year, " + ", ".join(f"CASE WHEN greatest(count(neighbor) FILTER (d <= {r}), 1) >= 4 THEN round({f}(v) FILTER (d <= {r}), 6) END AS nbr_r{r}_v_{s}" for r in (1, 2, 3) for f, s in (("avg", "mean"), ("median", "median"))) + " FROM fan GROUP BY hex_id, year")
def nbr_mean_median(spark, sf):
    out = neighbors.aggregates(_nbr_panel(spark, sf).drop("cat"))
    return out.select("hex_id", "year", *(F.round(f"nbr_r{r}_v_{s}", 6).alias(f"nbr_r{r}_v_{s}") for r in (1, 2, 3) for s in ("mean", "median")))


@register("nbr_mode", f"WITH {NBR}, c AS (SELECT hex_id, year, cat, count(*) AS n FROM fan WHERE d <= 1 AND cat IS NOT NULL GROUP BY ALL), m AS (SELECT hex_id, year, cat FROM c QUALIFY row_number() OVER (PARTITION BY hex_id, year ORDER BY n DESC, cat) = 1), g AS (SELECT hex_id, year, greatest(count(neighbor) FILTER (d <= 1), 1) AS n FROM fan GROUP BY ALL) SELECT g.hex_id, g.year, CASE WHEN g.n >= 4 THEN m.cat END AS nbr_r1_cat_mode FROM g LEFT JOIN m USING (hex_id, year)")
def nbr_mode(spark, sf):
    return neighbors.aggregates(_nbr_panel(spark, sf), [1], categorical=["cat"]).select("hex_id", "year", "nbr_r1_cat_mode")


for _mode, _expr in (("edges", "greatest(count(neighbor) FILTER (d <= {r}), 1)"), ("present", "count(*) FILTER (d <= {r} AND here)")):

    @register(f"nbr_count_{_mode}", f"WITH {NBR} SELECT hex_id, year, " + ", ".join(f"{_expr.format(r=r)} AS nbr_r{r}_n" for r in (1, 2, 3)) + " FROM fan GROUP BY hex_id, year")
    def _count(spark, sf, mode=_mode):
        return neighbors.aggregates(_nbr_panel(spark, sf).select("hex_id", "year"), count_mode=mode)


# ---- joins and deduplication

TX = "tx AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderkey AS id, o_totalprice AS price, o_orderpriority AS prio FROM orders)"


def _tx(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("prio"))


for _s, _o in (("first", "ASC"), ("last", "DESC")):

    @register(f"dedupe_{_s}", f"WITH {TX} SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY k, year ORDER BY id {_o}) = 1")
    def _dedupe(spark, sf, strategy=_s):
        return joins.dedupe(_tx(spark, sf), ["k", "year"], strategy, order_by="id")


@register("dedupe_reduce", f"WITH {TX} SELECT k, year, round(avg(id), 4) AS id, max(price) AS price, arg_min(prio, id) AS prio FROM tx GROUP BY k, year")
def dedupe_reduce(spark, sf):
    return joins.dedupe(_tx(spark, sf), ["k", "year"], "reduce", order_by="id", reduce_map={"price": "max"}).withColumn("id", F.round("id", 4))


@register("join_prefixed", f"WITH {TX}, r AS (SELECT k, year AS tx_year, max(price) AS tx_price FROM tx GROUP BY ALL), l AS (SELECT c_custkey AS k, 1995 + c_custkey % 7 AS year, c_mktsegment AS seg FROM customer) SELECT l.k, l.year, l.seg, r.tx_year, r.tx_price FROM l LEFT JOIN r ON l.k = r.k AND l.year = r.tx_year")
def join_prefixed(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.lit(1995) + F.col("c_custkey") % 7).cast("long").alias("year"), F.col("c_mktsegment").alias("seg"))
    right = joins.dedupe(_tx(spark, sf).select("k", F.col("year").alias("tx_year"), "price"), ["k", "tx_year"], "reduce", reduce_map={"price": "max"})
    return joins.join_prefixed(left, right, ["k", "year"], ["k", "tx_year"], prefix="tx_")


@register("sequential_merge_coalesce", f"WITH {PANEL}, a AS (SELECT hex_id, year, coverage_area, CASE WHEN hex_id % 2 = 0 THEN 'a' END AS unit FROM panel), b AS (SELECT hex_id, year, n_parcel AS coverage_area, CASE WHEN year <> 1997 THEN 'b' END AS unit FROM panel) SELECT a.hex_id, a.year, a.coverage_area, coalesce(a.unit, b.unit) AS unit, b.coverage_area AS coverage_area__b FROM a LEFT JOIN b USING (hex_id, year)")
def sequential_merge_coalesce(spark, sf):
    p = small_panel(spark, sf)
    a = p.select("hex_id", "year", "coverage_area", F.when(F.col("hex_id") % 2 == 0, "a").alias("unit"))
    b = p.select("hex_id", "year", F.col("n_parcel").alias("coverage_area"), F.when(F.col("year") != 1997, "b").alias("unit"))
    return joins.merge_sequential({"a": a, "b": b}, unify=["unit"])


@register("duplicate_keys", f"WITH {TX} SELECT k, year, count(*) AS n FROM tx GROUP BY k, year HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return joins.duplicate_keys(_tx(spark, sf), ["k", "year"])


@register("assert_unique", "SELECT s_suppkey, s_name FROM supplier")
def assert_unique(spark, sf):
    return joins.assert_unique(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])


@register("attach_labels", "WITH " + SPLIT + " SELECT panel.hex_id, panel.year, panel.n_parcel, split_proxy FROM panel LEFT JOIN proxied USING (hex_id, year)")
def attach_labels(spark, sf):
    return joins.attach_labels(small_panel(spark, sf).select("hex_id", "year", "n_parcel"), _split(spark, sf), ["split_proxy"])


@register("anti_join_units", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)")
def anti_join_units(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    busy = o.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 10")
    return c.join(busy, c["c_custkey"] == busy["o_custkey"], "left_anti").select("c_custkey")


@register("mapping_join", """WITH m AS (SELECT upper(trim(p_type)) AS k, arg_min(p_brand, p_partkey) AS v FROM part GROUP BY 1) SELECT p_partkey, coalesce(v, 'Brak') AS grp FROM part LEFT JOIN m ON k = upper(trim(p_type)) AND p_size > 25 OR k = 'none' AND p_size <= 25""")
def mapping_join(spark, sf):
    part = table(spark, sf, "part")
    mapping = part.select("p_type", "p_brand", "p_partkey")
    sized = part.withColumn("code", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("none "))
    return joins.lookup(sized.select("p_partkey", "code"), mapping, "code", "p_type", "p_brand", normalise=lambda c: F.upper(F.trim(c)), out="grp", ordinal="p_partkey").select("p_partkey", "grp")


# ---- codes

SYMBOLS = ["10MN", "A102MN", "1-KDW", "IV/ZL", "ML1", "D3", "MU4", "KD10/1X5/", "KD 10", "R", "MN-U", "5R", "mw,u(2)", "12.ZP", ""]
LAND = ["Bp", "RIVa", "Lz-RIVb", "W", "Ps", "dr", "Ł", "ŁIV", "DR", " Tk ", "S", "N", "Ba-x", "k"]
SOIL = ["IIIa", "III b", "ivB", "VI", "I", "ZZ", "RIVb", "IIZ", " v "]


def _case(values: list[str], key: str) -> str:
    return f"CASE {key} % {len(values) + 1} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _coded(spark, sf, values):
    return table(spark, sf, "part").select("p_partkey", F.expr(_case(values, "p_partkey")).alias("c"))


@register("symbol_normalize", f"""WITH p AS (SELECT p_partkey, replace(upper({_case(SYMBOLS, 'p_partkey')}), ',', '_') AS c FROM part)
, q AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, '/[^/]*/', '', 'g'), '\\([^)]*\\)', '', 'g'), '\\s+', '', 'g'), '^[IVX]+/', '') AS c FROM p)
SELECT p_partkey, trim(regexp_replace(regexp_replace(c, '^[A-Z]{{0,2}}\\d+[-_.\\s]?([A-Z])', '\\1'), '\\d+$', ''), '-_. ') AS symbol FROM q""")
def symbol_normalize(spark, sf):
    return _coded(spark, sf, SYMBOLS).select("p_partkey", codes.zoning_symbol(F.col("c")).alias("symbol"))


@register("landuse_simplify", f"""WITH p AS (SELECT p_partkey, trim(split_part(trim({_case(LAND, 'p_partkey')}), '-', 1)) AS h FROM part)
SELECT p_partkey, CASE WHEN h IS NULL THEN NULL WHEN h = 'dr' THEN 'dr' WHEN left(upper(h), 1) IN ('B', 'L', 'W', 'T', 'K') THEN left(upper(h), 1) WHEN upper(h) LIKE 'P%' THEN 'Ps' WHEN upper(h) LIKE 'R%' THEN 'R' WHEN h IN ('R', 'Ł', 'Ps', 'S') THEN h ELSE upper(h) END AS use FROM p""")
def landuse_simplify(spark, sf):
    return _coded(spark, sf, LAND).select("p_partkey", codes.land_use(F.col("c")).alias("use"))


@register("soil_score", f"""WITH p AS (SELECT p_partkey, replace(upper(trim({_case(SOIL, 'p_partkey')})), ' ', '') AS c FROM part)
, q AS (SELECT p_partkey, regexp_extract(c, '^(VI|IV|III|II|V|I)([ABZ])?$', 1) AS g, regexp_extract(c, '^(VI|IV|III|II|V|I)([ABZ])?$', 2) AS s FROM p)
SELECT p_partkey, CASE g WHEN 'I' THEN 6.0::DOUBLE WHEN 'II' THEN 5.0 WHEN 'III' THEN 4.0 WHEN 'IV' THEN 3.0 WHEN 'V' THEN 2.0 WHEN 'VI' THEN 1.0 END - CASE WHEN s = 'B' THEN 0.5::DOUBLE ELSE 0.0 END AS score FROM q""")
def soil_score(spark, sf):
    return _coded(spark, sf, SOIL).select("p_partkey", codes.soil_score(F.col("c")).alias("score"))


@register("label_sanitize", f"SELECT p_partkey, coalesce(trim(replace({_case([' MN,U ', 'R', ','], 'p_partkey')}, ',', '_')), 'Brak') AS label FROM part")
def label_sanitize(spark, sf):
    return _coded(spark, sf, [" MN,U ", "R", ","]).select("p_partkey", codes.clean_label(F.col("c")).alias("label"))


@register("parse_id", """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '28' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '_1.' || lpad(CAST(c_custkey % 97 AS VARCHAR), 4, '0') || '.' || c_custkey || '/2' END AS id FROM customer)
SELECT c_custkey, nullif(regexp_extract(id, '^(\\d{6}_\\d)\\.(\\d{4})\\.(.+)$', 1), '') AS jednostka, nullif(regexp_extract(id, '^(\\d{6}_\\d)\\.(\\d{4})\\.(.+)$', 2), '') AS obreb, nullif(regexp_extract(id, '^(\\d{6}_\\d)\\.(\\d{4})\\.(.+)$', 3), '') AS nr_dzialki FROM c""")
def parse_id(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat('28', lpad(string(c_custkey % 10000), 4, '0'), '_1.', lpad(string(c_custkey % 97), 4, '0'), '.', c_custkey, '/2') END").alias("iddzialki"))
    return codes.parse_parcel_id(c).drop("iddzialki")


@register("unit_code", """WITH n AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'x_281' || (700 + s_suppkey % 100) || '_1_y' WHEN 1 THEN 'd_2814' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') || '4.gml' WHEN 2 THEN '20170303_2802_' ELSE 'BDOT_4000003' END AS f FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN substr(f, 3, 8) WHEN 1 THEN substr(f, 3, 6) || '_' || substr(f, 9, 1) END AS unit FROM n""")
def unit_code(spark, sf):
    f = F.expr("CASE s_suppkey % 4 WHEN 0 THEN concat('x_281', 700 + s_suppkey % 100, '_1_y') WHEN 1 THEN concat('d_2814', lpad(string(s_suppkey % 100), 2, '0'), '4.gml') WHEN 2 THEN '20170303_2802_' ELSE 'BDOT_4000003' END")
    return table(spark, sf, "supplier").select("s_suppkey", codes.unit_code(f).alias("unit"))


@register("temporal_rule", "SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1995 + o_custkey % 7 THEN 'Brak' ELSE o_orderpriority END AS label FROM orders")
def temporal_rule(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", codes.plan_date_rule(F.col("o_orderpriority"), F.col("o_orderdate"), 1995 + F.col("o_custkey") % 7).alias("label"))


@register("event_year", "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END AS BIGINT) AS tx_year FROM orders")
def event_year(spark, sf):
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", codes.event_year(text).cast("long").alias("tx_year"))


# ---- profiles, metrics, reports

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _holes(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *(F.when(F.col("l_partkey") % (i + 3) != 0, F.col(c)).alias(c) for i, c in enumerate(NUM)))


HOLES = "holes AS (SELECT " + ", ".join(f"CASE WHEN l_partkey % {i + 3} <> 0 THEN {c} END AS {c}" for i, c in enumerate(NUM)) + " FROM lineitem)"


@register("nan_share", f"WITH {HOLES} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS missing FROM holes" for c in NUM))
def nan_share(spark, sf):
    return prune.missing_shares(_holes(spark, sf), NUM).withColumn("missing", F.round("missing", 9))


@register("quasi_constant", f"WITH {HOLES} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\", count({c}) AS filled, round(count(DISTINCT {c}) / count({c}), 9) AS ratio FROM holes" for c in NUM))
def quasi_constant(spark, sf):
    return prune.unique_ratios(_holes(spark, sf), NUM).withColumn("ratio", F.round("ratio", 9))


@register("corr_pairs", f"WITH {HOLES} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM holes" for i, a in enumerate(NUM) for b in NUM[i + 1 :]))
def corr_pairs(spark, sf):
    return prune.correlations(_holes(spark, sf), NUM).withColumn("corr", F.round("corr", 6))


SCORED = "scored AS (SELECT d.doc_id, round(n_chars / 50) / 1000.0 AS s, quality AS y FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"


def _scored(spark, sf):
    d, lab = table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return d.join(lab, "doc_id").select("doc_id", (F.round(F.col("n_chars") / 50) / 1000.0).alias("s"), "y")


CURVE = SCORED + ", g AS (SELECT s, CAST(sum(y) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM scored GROUP BY s), c AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS seen, coalesce(sum(n - p) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)"


@register("average_precision", f"WITH {CURVE} SELECT round(sum(p * tp / seen) / sum(p), 9) AS average_precision FROM c")
def average_precision(spark, sf):
    return metrics.average_precision(_scored(spark, sf), "s", "y").select(F.round("average_precision", 9).alias("average_precision"))


@register("roc_auc", f"WITH {CURVE} SELECT round(sum(p * (below + (n - p) / 2)) / (sum(p) * sum(n - p)), 9) AS roc_auc FROM c")
def roc_auc(spark, sf):
    return metrics.roc_auc(_scored(spark, sf), "s", "y").select(F.round("roc_auc", 9).alias("roc_auc"))


@register("brier", f"WITH {SCORED} SELECT round(avg((s - y) * (s - y)), 9) AS brier FROM scored")
def brier(spark, sf):
    return metrics.brier(_scored(spark, sf), "s", "y").select(F.round("brier", 9).alias("brier"))


@register("lift_at_k", f"WITH {SCORED}, k AS (SELECT greatest(1, CAST(floor(0.1 * count(*)) AS BIGINT)) AS k, avg(CAST(y AS DOUBLE)) AS base, CAST(sum(y) AS DOUBLE) AS pos FROM scored), t AS (SELECT y, row_number() OVER (ORDER BY s DESC, doc_id) AS r FROM scored) SELECT max(k) AS k, CAST(sum(y) AS DOUBLE) AS hits, round(sum(y) / max(k), 9) AS \"precision\", round(max(base), 9) AS base_rate, round(sum(y) / max(k) / max(base), 9) AS lift, round(sum(y) / max(pos), 9) AS capture FROM t, k WHERE r <= k")
def lift_at_k(spark, sf):
    out = metrics.lift_at_k(_scored(spark, sf), "s", "y", "doc_id")
    return out.select("k", "hits", *(F.round(c, 9).alias(c) for c in ("precision", "base_rate", "lift", "capture")))


@register("calibration_bins", f"WITH {SCORED}, e AS (SELECT list_distinct(quantile_cont(s, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])) AS e FROM scored), b AS (SELECT s, y, CAST(greatest(len(list_filter(e, lambda x: x < s)) - 1, 0) AS BIGINT) AS bin FROM scored, e) SELECT bin, round(avg(s), 9) AS mean_score, round(avg(CAST(y AS DOUBLE)), 9) AS mean_label, count(*) AS n FROM b GROUP BY bin")
def calibration_bins(spark, sf):
    out = metrics.calibration_bins(_scored(spark, sf), "s", "y")
    return out.select("bin", F.round("mean_score", 9).alias("mean_score"), F.round("mean_label", 9).alias("mean_label"), "n")


@register("risk_percentile", f"WITH {SCORED} SELECT doc_id, round_even((rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0) / count(*) OVER () * 100, 1) AS percentile FROM scored")
def risk_percentile(spark, sf):
    return panel.with_percentile_rank(_scored(spark, sf), "s").select("doc_id", "percentile")


@register("bh_fdr", "WITH t AS (SELECT p_partkey, (p_partkey * 7919 % 10007) / 10007.0 * (CASE WHEN p_partkey % 4 = 0 THEN 0.001 ELSE 1 END) AS p FROM part), r AS (SELECT *, row_number() OVER (ORDER BY p, p_partkey) AS r, count(*) OVER () AS m FROM t) SELECT p_partkey, r <= coalesce((SELECT max(r) FROM r WHERE p <= 0.05 * r / m), 0) AS significant FROM r")
def bh_fdr(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.expr("(p_partkey * 7919 % 10007) / 10007.0D * (CASE WHEN p_partkey % 4 = 0 THEN 0.001D ELSE 1D END)").alias("p"))
    return metrics.benjamini_hochberg(p, "p", "p_partkey").select("p_partkey", "significant")


@register("yoy_panel", "WITH " + CONVERT + ", y AS (SELECT s.year AS rok, round(avg(s.uzg_R_share), 4) AS mean_share, CAST(sum(CAST(convert_proxy AS INT)) AS BIGINT) AS flagged, count(*) AS cells FROM shares s LEFT JOIN proxied p ON s.hex_id = p.hex_id AND s.year = p.year GROUP BY 1) SELECT rok, mean_share, flagged, cells, round_even((mean_share - lag(mean_share) OVER (ORDER BY rok)) * 100, 2) AS yoy_pp FROM y")
def yoy_panel(spark, sf):
    s = _shares(spark, sf)
    lab = panel.conversion_labels(s.withColumn("sum_uzg", overlay.row_sum([f"uzg_{c}_share" for c in CLASSES])), share_b="uzg_N_share", tolerance=0.2)
    return reports.per_year(s, lab, share="uzg_R_share", flag="convert_proxy")


@register("yoy_by_unit", "WITH " + SPLIT + " SELECT s_nationkey AS unit, p.year AS rok, round(avg(p.shape_area_mean), 2) AS mean_value, CAST(sum(CAST(split_proxy AS INT)) AS BIGINT) AS flagged, count(*) AS cells FROM panel p LEFT JOIN proxied x ON p.hex_id = x.hex_id AND p.year = x.year JOIN supplier ON s_suppkey = p.hex_id GROUP BY 1, 2")
def yoy_by_unit(spark, sf):
    p = small_panel(spark, sf)
    unit = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("hex_id"), "s_nationkey")
    return reports.per_unit_year(p.join(unit, "hex_id"), _split(spark, sf), unit="s_nationkey", value="shape_area_mean", flag="split_proxy", decimals=2)


@register("importance_by_family", "SELECT CASE WHEN p_brand LIKE '%1' THEN 'shape' WHEN p_brand LIKE '%2' THEN 'zoning' ELSE 'other' END AS family, CAST(sum(p_size) AS BIGINT) AS importance FROM (SELECT p_brand, CAST(p_size AS BIGINT) AS p_size FROM part) GROUP BY 1")
def importance_by_family(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.when(F.col("p_brand").endswith("1"), "gf_").when(F.col("p_brand").endswith("2"), "mpzp_").otherwise(""), F.col("p_brand")).alias("feature"), F.col("p_size").cast("long").alias("importance"))
    return reports.importance_by_family(p)
