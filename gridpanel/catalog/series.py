"""Queries for windows along series, neighbours and panel composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpanel.catalog.common import (
    CUSTOMER_PANEL, CUSTOMER_POINTS, POINTS, SUPPLIER_PANEL, customer_panel, customer_points, load, query, rnd,
    sql_edges, sql_miles, sql_rnd, supplier_edges, supplier_panel, supplier_points,
)
from gridpanel.operators import joins, spatial, windows
from gridpanel.plans import cleaning, panel as plans
from gridpanel.session import checkpointed
from gridpanel.sources import readers

# Settings that make a test-sized key count as hot, so that the block-wise path
# is the one compared here. A cluster keeps the defaults.
SMALL_HOT = {"rows": 500}

# --- windows --------------------------------------------------------------------


@query("w1_add_lags", f"""
WITH {SUPPLIER_PANEL} SELECT e, t, qty, lag(qty, 1) OVER w AS qty_lag1, lag(qty, 2) OVER w AS qty_lag2, lag(qty, 3) OVER w AS qty_lag3
FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)""")
def w1(spark, d):
    return windows.add_lags(supplier_panel(spark, d).select("e", "t", "qty"), "e", "t", ["qty"], hot=False)


@query("w1_add_lags_hot", """
SELECT event_id, event_type, lag(value, 1) OVER w AS value_lag1, lag(value, 3) OVER w AS value_lag3
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def w1_hot(spark, d):
    df = load(spark, d, "events").select("event_id", "event_type", "ts", "value")
    return windows.add_lags(df, "event_type", ["ts", "event_id"], ["value"], (1, 3), **SMALL_HOT).drop("ts", "value")


_YOY = "CASE WHEN lag({c}) OVER w = 0 THEN 0 ELSE {c} / nullif(lag({c}) OVER w, 0) - 1 END"


@query("w2_yoy_change", f"""
WITH {SUPPLIER_PANEL} SELECT e, t, {sql_rnd(_YOY.format(c='qty'))} AS qty_yoy_change, {sql_rnd(_YOY.format(c='z'))} AS z_yoy_change
FROM (SELECT *, greatest(qty - 2000, 0) AS z FROM panel) WINDOW w AS (PARTITION BY e ORDER BY t)""")
def w2(spark, d):
    df = supplier_panel(spark, d).withColumn("z", F.greatest(F.col("qty") - 2000, F.lit(0.0)))
    out = windows.yoy_change(df, "e", "t", ["qty", "z"], hot=False)
    return out.select("e", "t", rnd("qty_yoy_change").alias("qty_yoy_change"), rnd("z_yoy_change").alias("z_yoy_change"))


@query("w2_yoy_change_hot", f"""
WITH o AS (SELECT o_orderstatus AS s, o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice END AS v FROM orders)
SELECT s, k, {sql_rnd(_YOY.format(c='v'))} AS v_yoy_change FROM o WINDOW w AS (PARTITION BY s ORDER BY k)""")
def w2_hot(spark, d):
    df = load(spark, d, "orders").select(
        F.col("o_orderstatus").alias("s"), F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 7 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("v"))
    return windows.yoy_change(df, "s", "k", ["v"], **SMALL_HOT).select("s", "k", rnd("v_yoy_change").alias("v_yoy_change"))


@query("w3_diff_features", f"""
WITH {SUPPLIER_PANEL} SELECT e, t, qty - lag(qty) OVER w AS qty_raw_diff, {sql_rnd('asinh(qty)')} AS qty_asinh,
  {sql_rnd('asinh(qty) - asinh(lag(qty) OVER w)')} AS qty_asinh_growth FROM panel WINDOW w AS (PARTITION BY e ORDER BY t)""")
def w3(spark, d):
    out = windows.diff_features(supplier_panel(spark, d).select("e", "t", "qty"), "e", "t", ["qty"], hot=False).drop("qty")
    return out.withColumns({c: rnd(c) for c in ("qty_asinh", "qty_asinh_growth")})


@query("w4_rank_within", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
FROM orders QUALIFY rank <= 3""")
def w4(spark, d):
    df = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.rank_within(df, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3).drop("o_totalprice")


def _sql_interpolated(value: str, keys: str, order: str, rounded: bool, source: str, more: str = "") -> str:
    x = f"""CASE WHEN {value} IS NOT NULL THEN {value} WHEN lv IS NULL OR nv IS NULL THEN 0
      ELSE lv + (nv - lv) * ((pos - lp)::DOUBLE / (np - lp)) END"""
    x = f"round_even({x}, 0)" if rounded else sql_rnd(x)
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pos FROM {source}),
marked AS (SELECT *, CASE WHEN {value} IS NOT NULL THEN pos END AS vp FROM numbered),
bracketed AS (SELECT *,
  last_value({value} IGNORE NULLS) OVER up AS lv, last_value(vp IGNORE NULLS) OVER up AS lp,
  first_value({value} IGNORE NULLS) OVER dn AS nv, first_value(vp IGNORE NULLS) OVER dn AS np FROM marked
  WINDOW up AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         dn AS (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT {keys}, {order}, CAST({x} AS DOUBLE) AS {value}{more} FROM bracketed"""


_CGRID = f"{CUSTOMER_PANEL}, grid AS (SELECT c_custkey AS e, r.t AS t, cpanel.n_orders_count, cpanel.cents " \
    "FROM customer CROSS JOIN range(1995, 2002) r(t) LEFT JOIN cpanel ON cpanel.e = c_custkey AND cpanel.t = r.t)"


def _cgrid(spark, d):
    grid = joins.panel_grid(load(spark, d, "customer").select(F.col("c_custkey").alias("e")), "t", 1995, 2001)
    return grid.join(customer_panel(spark, d), ["e", "t"], "left")


@query("w5a_interpolate_edges_zero", f"WITH {_CGRID}, " + _sql_interpolated(
    "n_orders_count", "e", "t", True, "grid",
    ", CASE WHEN lv IS NOT NULL OR nv IS NOT NULL THEN n_orders_count IS NULL END AS n_orders_count_was_imputed"))
def w5a(spark, d):
    return windows.interpolate_edges_zero(_cgrid(spark, d).drop("cents"), "e", "t", "n_orders_count", hot=False)


@query("w5b_interpolate_all", f"WITH {_CGRID}, a AS (" + "WITH " + _sql_interpolated("n_orders_count", "e", "t", True, "grid")
       + "), b AS (WITH " + _sql_interpolated("cents", "e", "t", False, "grid") + ") SELECT * FROM a JOIN b USING (e, t)")
def w5b(spark, d):
    out = windows.interpolate_all(_cgrid(spark, d), "e", "t", ["n_orders_count", "cents"], hot=False)
    return out.withColumn("cents", rnd("cents"))


_HOT_GAPS = """src AS (SELECT event_type AS k, event_id AS i, CASE WHEN hash_ THEN value END AS v FROM (
  SELECT event_type, event_id, value, (event_id * 7919) % 13 IN (0, 5) AS hash_ FROM events))"""


@query("w5_interpolate_hot", f"WITH {_HOT_GAPS}, " + _sql_interpolated("v", "k", "i", False, "src"))
def w5_hot(spark, d):
    keep = ((F.col("event_id") * 7919) % 13).isin(0, 5)
    df = load(spark, d, "events").select(
        F.col("event_type").alias("k"), F.col("event_id").alias("i"), F.when(keep, F.col("value")).alias("v"))
    return windows.interpolate(df, "k", "i", ["v"], **SMALL_HOT).withColumn("v", rnd("v"))


@query("w6_event_time", f"""
WITH {CUSTOMER_PANEL}, f AS (SELECT e, min(t) AS first_year FROM cpanel WHERE n_orders_count > 2 GROUP BY 1)
SELECT e, t, coalesce(first_year, 0) AS first_year, CASE WHEN t >= first_year THEN 1 ELSE 0 END AS treated,
       CASE WHEN first_year IS NULL THEN -100 ELSE t - first_year END AS relative_year FROM cpanel LEFT JOIN f USING (e)""")
def w6(spark, d):
    return windows.event_time(customer_panel(spark, d).select("e", "t", "n_orders_count"), "e", "t",
                              F.col("n_orders_count") > 2).drop("n_orders_count")


@query("w7_average_ranks", """
SELECT l_returnflag, l_quantity, count(*) AS n, any_value(r) AS avg_rank FROM (
  SELECT l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
    + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS r FROM lineitem) GROUP BY 1, 2""")
def w7(spark, d):
    return windows.average_ranks(load(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


@query("w7_average_ranks_hot", """
SELECT o_orderstatus, o_totalprice, count(*) AS n, any_value(r) AS avg_rank FROM (
  SELECT o_orderstatus, o_totalprice, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice)
    + (count(*) OVER (PARTITION BY o_orderstatus, o_totalprice) - 1) / 2 AS r FROM orders) GROUP BY 1, 2""")
def w7_hot(spark, d):
    return windows.average_ranks(load(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", **SMALL_HOT)


@query("w7_cumulative_min", """
SELECT o_orderstatus, o_orderkey, min(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) AS lowest FROM orders""")
def w7_min(spark, d):
    df = load(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return windows.cumulative_min(df, ["o_orderstatus"], "o_orderkey", "o_totalprice", "lowest", **SMALL_HOT).drop("o_totalprice")


# --- neighbours and composites ----------------------------------------------------


@query("g1_knn_edges", f"WITH {sql_edges(8)} SELECT e, neighbor, rank, {sql_rnd('distance')} AS distance FROM edges")
def g1(spark, d):
    return supplier_edges(spark, d, 8).withColumn("distance", rnd("distance"))


_WEIGHTED = "sum(qty / distance) / sum(CASE WHEN qty IS NOT NULL THEN 1 / distance END)"
_SPARSE = "sparse AS (SELECT e, t, CASE WHEN (e + t) % 3 = 0 THEN NULL ELSE qty END AS qty, cents FROM panel)"


def _sparse(spark, d):
    hidden = (F.col("e") + F.col("t")) % 3 == 0
    return supplier_panel(spark, d).select("e", "t", F.when(~hidden, F.col("qty")).alias("qty"), "cents")


def _neighbor_query(name, how, expression):
    @query(f"g2_neighbor_{name}", f"""
WITH {sql_edges(5)}, {SUPPLIER_PANEL}, {_SPARSE}
SELECT edges.e, t, {sql_rnd(expression)} AS qty FROM edges JOIN sparse ON sparse.e = neighbor GROUP BY 1, 2""")
    def g2(spark, d):
        out = spatial.neighbor_stat(_sparse(spark, d), supplier_edges(spark, d), "e", "t", ["qty"], 5, how)
        return out.withColumn("qty", rnd("qty"))


_neighbor_query("weighted", "weighted_avg", _WEIGHTED)
_neighbor_query("avg", "avg", "avg(qty)")
_neighbor_query("median", "median", "median(qty)")


def _sql_around(k: int, expression: str) -> str:
    return f"""{sql_edges(k)}, {SUPPLIER_PANEL}, {_SPARSE},
around AS (SELECT edges.e, t, {expression} AS a FROM edges JOIN sparse ON sparse.e = neighbor GROUP BY 1, 2)"""


@query("g3_self_weight", f"""
WITH {_sql_around(5, _WEIGHTED)} SELECT e, t, qty, cents, {sql_rnd('CASE WHEN qty IS NULL THEN a ELSE 0.4 * qty + 0.6 * a END')}
  AS qty_spatial_weighted_avg_5 FROM sparse LEFT JOIN around USING (e, t)""")
def g3(spark, d):
    out = spatial.spatial_fill(checkpointed(_sparse(spark, d)), supplier_edges(spark, d), "e", "t", ["qty"], self_weight=0.4)
    return out.withColumn("qty_spatial_weighted_avg_5", rnd("qty_spatial_weighted_avg_5"))


@query("g4_spatial_fill_new", f"""
WITH {_sql_around(3, 'median(qty)')} SELECT e, t, qty, cents, {sql_rnd('a')} AS qty_spatial_median_3 FROM sparse LEFT JOIN around USING (e, t)""")
def g4_new(spark, d):
    out = spatial.spatial_fill(checkpointed(_sparse(spark, d)), supplier_edges(spark, d, 3), "e", "t", ["qty"], how="median", k=3)
    return out.withColumn("qty_spatial_median_3", rnd("qty_spatial_median_3"))


@query("g4_spatial_fill_na", f"""
WITH {_sql_around(5, _WEIGHTED)} SELECT e, t, {sql_rnd('coalesce(qty, a)')} AS qty, cents FROM sparse LEFT JOIN around USING (e, t)""")
def g4_fill(spark, d):
    out = spatial.spatial_fill(checkpointed(_sparse(spark, d)), supplier_edges(spark, d), "e", "t", ["qty"], mode="fill_na")
    return out.withColumn("qty", rnd("qty"))


@query("g5_spatial_then_yoy", f"""
WITH {sql_edges(5)}, {SUPPLIER_PANEL},
around AS (SELECT edges.e, t, sum(qty / distance) / sum(1 / distance) AS a, sum(cents / distance) / sum(1 / distance) AS b
           FROM edges JOIN panel ON panel.e = neighbor GROUP BY 1, 2)
SELECT e, t, qty, cents, {sql_rnd('a')} AS qty_spatial_weighted_avg_5, {sql_rnd('b', 0)} AS cents_spatial_weighted_avg_5,
  {sql_rnd(_YOY.format(c='qty'))} AS qty_yoy_change, {sql_rnd(_YOY.format(c='cents'))} AS cents_yoy_change
FROM panel LEFT JOIN around USING (e, t) WINDOW w AS (PARTITION BY e ORDER BY t)""")
def g5(spark, d):
    # A supplier has one row per year after the group-by.
    # The panel is read as own and as neighbours' values; the facts behind it once.
    panel = checkpointed(supplier_panel(spark, d).drop("n"))
    out = spatial.spatial_then_yoy(panel, supplier_edges(spark, d), "e", "t", ["qty", "cents"], hot=False)
    return out.withColumns({
        "qty_spatial_weighted_avg_5": rnd("qty_spatial_weighted_avg_5"),
        "cents_spatial_weighted_avg_5": rnd("cents_spatial_weighted_avg_5", 0),
        "qty_yoy_change": rnd("qty_yoy_change"), "cents_yoy_change": rnd("cents_yoy_change")})


# Cells: customers are the area cells of the supplier (c_custkey mod 50).
_CELLS = f"""{CUSTOMER_POINTS}, cells AS (SELECT c % 50 AS e, c, lat, lon, (c % 9 + 1)::DOUBLE AS area, (c % 4 + 1) / 4e0 AS land_share FROM cpts)"""
_OVERLAP = f"""near AS (SELECT DISTINCT a.e, b.e AS neighbor, b.c, b.area, b.land_share FROM cells a JOIN cells b
  ON a.e <> b.e AND {sql_miles('a', 'b')} <= 25),
whole AS (SELECT e AS neighbor, sum(area) AS neighbor_area, sum(area * land_share) AS neighbor_land_area FROM cells GROUP BY 1),
overlap AS (SELECT e, neighbor, sum(area) AS overlap_area, sum(area * land_share) AS effective_land_overlap FROM near GROUP BY 1, 2)"""


def _cells(spark, d):
    c = F.col("c")
    return customer_points(spark, d).select(
        (c % 50).alias("e"), "c", "lat", "lon", (c % 9 + 1).cast("double").alias("area"),
        ((c % 4 + 1) / F.lit(4.0)).alias("land_share"))


@query("g7_radius_overlap", f"""
WITH {_CELLS}, {_OVERLAP} SELECT e, neighbor, neighbor_area, {sql_rnd('neighbor_land_area / neighbor_area')} AS neighbor_land_share,
  neighbor_land_area, overlap_area, effective_land_overlap FROM overlap JOIN whole USING (neighbor)""")
def g7(spark, d):
    out = spatial.radius_overlap(_cells(spark, d), 25.0, "e", "c")
    return out.withColumn("neighbor_land_share", rnd("neighbor_land_share"))


def _corner(a: str, b: str) -> str:
    """Area of a disc of radius 0.6 round the origin left of a and below b."""
    a, b = f"least(greatest({a}, -0.6e0), 0.6e0)", f"least(greatest({b}, -0.6e0), 0.6e0)"
    left = lambda v: f"(0.36e0 * (pi() / 2 + asin({v} / 0.6e0)) + {v} * sqrt(greatest(0.36e0 - {v} * {v}, 0)))"
    return (f"CASE WHEN {a} * {a} + {b} * {b} < 0.36e0 THEN {left(a)} / 2 + {left(b)} / 2 - 0.09e0 * pi() + {a} * {b} "
            f"WHEN {a} <= 0 AND {b} <= 0 THEN 0 WHEN {b} < 0 THEN {left(b)} WHEN {a} < 0 THEN {left(a)} ELSE {left(a)} + {left(b)} - 0.36e0 * pi() END")


def _box_area(w: str, h: str) -> str:
    c = lambda i, j: f"({_corner(f'(dx {i} {w})', f'(dy {j} {h})')})"
    return f"({c('+', '+')} - {c('-', '+')} - {c('+', '-')} + {c('-', '-')})"


# Frames round customers, a quarter of them with a hole, cut by discs round suppliers.
@query("g7_disc_overlap", f"""
WITH {POINTS}, {CUSTOMER_POINTS}, box AS (SELECT c, lat, lon, 0.2e0 + (c % 5) / 10e0 AS w, 0.1e0 + (c % 3) / 10e0 AS h, c % 4 = 0 AS holed FROM cpts),
near AS (SELECT e, c, w, h, holed, b.lon - a.lon AS dx, b.lat - a.lat AS dy FROM pts a JOIN box b
  ON abs(a.lon - b.lon) < 0.6 + w AND abs(a.lat - b.lat) < 0.6 + h),
found AS (SELECT e, c, 4 * w * h - CASE WHEN holed THEN w * h ELSE 0 END AS region_area,
  {_box_area('w', 'h')} - CASE WHEN holed THEN {_box_area('w / 2', 'h / 2')} ELSE 0 END AS overlap_area FROM near)
SELECT e, c, {sql_rnd('region_area')} AS region_area, {sql_rnd('overlap_area')} AS overlap_area FROM found WHERE overlap_area > 1e-4""")
def g7_disc(spark, d):
    c = F.col("c")
    box = customer_points(spark, d).withColumns({"w": F.lit(0.2) + (c % 5) / F.lit(10.0), "h": F.lit(0.1) + (c % 3) / F.lit(10.0)})
    corner = lambda sx, sy, by: F.array(F.col("lon") + F.col("w") * sx / by, F.col("lat") + F.col("h") * sy / by)
    ring = lambda by: F.array(*[corner(sx, sy, by) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])
    rings = F.when(c % 4 == 0, F.array(ring(1.0), ring(2.0))).otherwise(F.array(F.when(c % 2 == 0, ring(1.0)).otherwise(F.reverse(ring(1.0)))))
    shapes = box.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"), c.cast("string").alias("id"),
        F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"))).alias("feature"))
    vertices = readers.explode_features(shapes)
    out = spatial.disc_overlap(supplier_points(spark, d), vertices, 0.6, "e", "id", "lon", "lat").where("overlap_area > 1e-4")
    return out.select("e", F.col("id").cast("long").alias("c"), rnd("region_area").alias("region_area"), rnd("overlap_area").alias("overlap_area"))


@query("g6_nearby_density", f"""
WITH {_CELLS}, {_OVERLAP}, {SUPPLIER_PANEL},
x AS (SELECT o.e, p.t, sum(p.n / w.neighbor_land_area * o.effective_land_overlap) AS nearby_landadj,
  count(DISTINCT o.neighbor) AS contributing_entities, sum(o.overlap_area) AS raw_overlap_sqmi,
  sum(o.effective_land_overlap) AS effective_land_overlap_sqmi
  FROM overlap o JOIN whole w USING (neighbor) JOIN panel p ON p.e = o.neighbor GROUP BY 1, 2)
SELECT g.e, r.t, {sql_rnd('nearby_landadj')} AS nearby_landadj, contributing_entities, raw_overlap_sqmi, effective_land_overlap_sqmi,
  {sql_rnd('nearby_landadj / effective_land_overlap_sqmi')} AS nearby_per_sqmi,
  {sql_rnd('nearby_landadj / effective_land_overlap_sqmi * 100')} AS nearby_per_100_sqmi
FROM (SELECT DISTINCT e FROM cells) g CROSS JOIN range(1995, 2002) r(t) LEFT JOIN x ON x.e = g.e AND x.t = r.t""")
def g6(spark, d):
    cells = _cells(spark, d)
    overlap = spatial.radius_overlap(cells, 25.0, "e", "c")
    out = spatial.nearby_density(overlap, supplier_panel(spark, d), cells, "e", "t", "n", 1995, 2001)
    return out.withColumns({c: rnd(c) for c in ("nearby_landadj", "nearby_per_sqmi", "nearby_per_100_sqmi")})


@query("g8_density_features", f"""
WITH {SUPPLIER_PANEL} SELECT s_suppkey AS e, r.t AS t, n, {sql_rnd('n / (s_suppkey % 37 + 1)')} AS n_per_sqmi,
  {sql_rnd('n / (s_suppkey % 37 + 1) * 100')} AS n_per_100_sqmi
FROM supplier CROSS JOIN range(1995, 2003) r(t) LEFT JOIN panel ON panel.e = s_suppkey AND panel.t = r.t""")
def g8(spark, d):
    entities = load(spark, d, "supplier").select(F.col("s_suppkey").alias("e"), (F.col("s_suppkey") % 37 + 1).alias("area"))
    out = spatial.density_features(supplier_panel(spark, d).select("e", "t", "n"), entities, "e", "t", "n", "area", 1995, 2002)
    return out.withColumns({c: rnd(c) for c in ("n_per_sqmi", "n_per_100_sqmi")})


@query("g9_annualize", f"""
WITH {sql_edges(5)}, daily AS (
  SELECT CASE WHEN l_suppkey % 10 = 9 THEN l_suppkey - 1 ELSE l_suppkey END AS e, year(l_shipdate) AS t,
  CASE WHEN (l_suppkey + year(l_shipdate)) % 4 <> 0 THEN l_quantity END AS q FROM lineitem),
annual AS (SELECT e, t, stddev_samp(q) AS q_sd, avg(q) AS q_daily_avg FROM daily GROUP BY 1, 2),
grid AS (SELECT pts.e, r.t, q_sd, q_daily_avg FROM pts CROSS JOIN range(1995, 2002) r(t) LEFT JOIN annual ON annual.e = pts.e AND annual.t = r.t),
around AS (SELECT edges.e, t, sum(q_sd / distance) / sum(CASE WHEN q_sd IS NOT NULL THEN 1 / distance END) AS a,
  sum(q_daily_avg / distance) / sum(CASE WHEN q_daily_avg IS NOT NULL THEN 1 / distance END) AS b
  FROM edges JOIN grid ON grid.e = neighbor GROUP BY 1, 2)
SELECT e, t, {sql_rnd('coalesce(q_sd, a)')} AS q_sd, {sql_rnd('coalesce(q_daily_avg, b)')} AS q_daily_avg
FROM grid LEFT JOIN around USING (e, t)""")
def g9(spark, d):
    year = F.year("l_shipdate")
    daily = load(spark, d, "lineitem").select(
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("id"), "l_shipdate",
        F.when((F.col("l_suppkey") + year) % 4 != 0, F.col("l_quantity").cast("string")).alias("q"))
    parents = load(spark, d, "supplier").where("s_suppkey % 10 = 9").select("s_suppkey", F.col("s_suppkey") - 1)
    out = cleaning.annualize(
        daily, F.col("id").cast("long"), F.year("l_shipdate"), ["q"], supplier_points(spark, d).select("e"),
        supplier_edges(spark, d), 1995, 2001, parents=parents, entity="e", year="t")
    return out.select("e", "t", rnd("q_sd").alias("q_sd"), rnd("q_daily_avg").alias("q_daily_avg"))


_BUCKETS = [("SMALL", "little"), ("MEDIUM", "little"), ("LARGE", "big"), ("PROMO", "big")]


@query("g10_build_model_panel", f"""
WITH {sql_edges(5)}, {SUPPLIER_PANEL},
f AS (SELECT l_suppkey AS e, year(l_shipdate) AS t, l_quantity AS m, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'little'
  WHEN p_type IN ('LARGE', 'PROMO') THEN 'big' END AS c, CASE WHEN (l_suppkey + year(l_shipdate)) % 5 <> 0 THEN c END AS b
  FROM lineitem JOIN part ON p_partkey = l_partkey),
piv AS (SELECT e, t, sum(m) FILTER (WHERE b = 'little') AS emp_little, sum(m) FILTER (WHERE b = 'big') AS emp_big FROM f WHERE b IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT pts.e AS e, r.t AS t, emp_little, emp_big FROM pts CROSS JOIN range(1995, 2002) r(t) LEFT JOIN piv ON piv.e = pts.e AND piv.t = r.t),
il AS (WITH {_sql_interpolated('emp_little', 'e', 't', False, 'grid')}),
ib AS (WITH {_sql_interpolated('emp_big', 'e', 't', False, 'grid')}),
full_ AS (SELECT * FROM il JOIN ib USING (e, t)),
around AS (SELECT edges.e, t, sum(emp_little / distance) / sum(1 / distance) AS al, sum(emp_big / distance) / sum(1 / distance) AS ab
  FROM edges JOIN full_ ON full_.e = neighbor GROUP BY 1, 2),
joined AS (SELECT full_.e, full_.t, n, qty, emp_little / n AS elp, emp_big / n AS ebp, al / n AS alp, ab / n AS abp, cents / n AS cp
  FROM full_ LEFT JOIN around USING (e, t) LEFT JOIN panel USING (e, t))
SELECT e, t, n, qty AS centres, {sql_rnd('elp', 3)} AS emp_little_per_capita, {sql_rnd('ebp', 3)} AS emp_big_per_capita,
  {sql_rnd('alp', 3)} AS emp_little_spatial_weighted_avg_5_per_capita, {sql_rnd('abp', 3)} AS emp_big_spatial_weighted_avg_5_per_capita,
  {sql_rnd('cp', 3)} AS cents_per_capita, lag(qty, 1) OVER w AS centres_lag1, lag(qty, 2) OVER w AS centres_lag2, lag(qty, 3) OVER w AS centres_lag3
FROM joined WINDOW w AS (PARTITION BY e ORDER BY t)""")
def g10(spark, d):
    facts = joins.lookup_join(load(spark, d, "lineitem"), load(spark, d, "part"), "l_partkey", "p_partkey").select(
        F.col("l_suppkey").alias("e"), F.year("l_shipdate").alias("t"), F.col("l_quantity").alias("emp"),
        F.when((F.col("l_suppkey") + F.year("l_shipdate")) % 5 != 0, F.col("p_type")).alias("p_type"))
    out = plans.build_model_panel(
        supplier_points(spark, d).select("e"), supplier_edges(spark, d), facts,
        spark.createDataFrame(_BUCKETS, "code string, bucket string"), "p_type", ["emp"], ["little", "big"],
        {"totals": supplier_panel(spark, d)}, "e", "t", 1995, 2001, "n", per_capita_of=["cents"],
        names={"qty": "centres"}, lags_of=["centres"])
    return out.withColumns({c: rnd(c, 3) for c in out.columns if c.endswith("_per_capita")})


@query("g11_centre_features", f"""
WITH {sql_edges(5)}, {SUPPLIER_PANEL}, some_ AS (SELECT e, t, CASE WHEN (e + t) % 4 <> 0 THEN n END AS n FROM panel),
full_ AS (SELECT pts.e AS e, r.t AS t, coalesce(n, 0) AS n FROM pts CROSS JOIN range(1995, 2003) r(t) LEFT JOIN some_ ON some_.e = pts.e AND some_.t = r.t),
around AS (SELECT edges.e, t, sum(n / distance) / sum(1 / distance) AS a FROM edges JOIN full_ ON full_.e = neighbor GROUP BY 1, 2)
SELECT e, t, n, {sql_rnd('a')} AS n_spatial_weighted_avg_5, n - lag(n) OVER w AS n_raw_diff, {sql_rnd('asinh(n)')} AS n_asinh,
  {sql_rnd('asinh(n) - asinh(lag(n) OVER w)')} AS n_asinh_growth, {sql_rnd('a - lag(a) OVER w')} AS n_spatial_weighted_avg_5_raw_diff,
  {sql_rnd('asinh(a)')} AS n_spatial_weighted_avg_5_asinh, {sql_rnd('asinh(a) - asinh(lag(a) OVER w)')} AS n_spatial_weighted_avg_5_asinh_growth,
  {sql_rnd('n / (e % 37 + 1)')} AS n_per_sqmi, {sql_rnd('n / (e % 37 + 1) * 100')} AS n_per_100_sqmi
FROM full_ LEFT JOIN around USING (e, t) WINDOW w AS (PARTITION BY e ORDER BY t)""")
def g11(spark, d):
    entities = supplier_points(spark, d).select("e", (F.col("e") % 37 + 1).alias("area"))
    counts = supplier_panel(spark, d).withColumn("n", F.when((F.col("e") + F.col("t")) % 4 != 0, F.col("n")))
    out = plans.centre_features(counts, entities, supplier_edges(spark, d), "e", "t", "n", "area", 1995, 2002)
    return out.withColumns({c: rnd(c) for c in out.columns if c not in ("e", "t", "n", "n_raw_diff")})
