"""Every operator as a query over the synthetic map, with its DuckDB counterpart.

``QUERIES[name](spark, sf_dir)`` and ``ORACLE[name]`` give the same rows. Doubles are rounded to 6 digits, ids cast to
bigint and arrays joined to text on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.map_views import all_layers, layer, remembered, spark_view
from checks.oracle import ALONG, IDS, STREAM_DISTANCE, point_segment_distance, roots_sql, um, with_views
from linecross.operators import classify as rules, filters
from linecross.operators.cluster import cluster_centroids, cluster_within
from linecross.operators.ids import assign_ids, match_archive
from linecross.operators.joins import band_semi_join
from linecross.operators.lines import (explode_parts, explode_segments, locate_along, locate_points, merge_parts,
                                       point_line_distance)
from linecross.operators.merging import merge_many_parts
from linecross.operators.merge import merge_round
from linecross.operators.nearest import buffer_semi_join, nearest_k, nearest_within
from linecross.operators.overlay import exclude_tunnels, intersect_lines, spatial_join
from linecross.plans import crossings as plans, job, reports
from linecross.sources.layers import force_2d, promote_to_multi

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return query
    return add


def _r(*columns: str) -> list[str]:
    return [f"round({c}, 6) AS {c}" for c in columns]


# --- filters and small relational operators ---------------------------------------------------------------

@register("filter_streams", "SELECT linear_feature_id, watershed_group_code, edge_type, stream_order FROM o_streams")
def _(spark, sf):
    return filters.filter_streams(layer(spark, sf, "streams")).select(
        "linear_feature_id", "watershed_group_code", "edge_type", "stream_order")


@register("streams_of_region", "SELECT linear_feature_id, blue_line_key FROM fx_streams WHERE watershed_group_code IN ('W01', 'W04')")
def _(spark, sf):
    return filters.streams_of(layer(spark, sf, "streams"), ["W01", "W04"]).select("linear_feature_id", "blue_line_key")


def _register_filter(name: str, layer_name: str, apply, columns: dict[str, str], view: str) -> None:
    """A filter query: ``columns`` maps output columns to types."""
    @register(name, f"SELECT DISTINCT {', '.join(columns)} FROM {view}")
    def _(spark, sf):
        return apply(layer(spark, sf, layer_name)).selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in columns.items()])


_register_filter("filter_dra", "dra", filters.filter_dra, {
    "transport_line_id": "bigint", "transport_line_type_code": "string", "transport_line_surface_code": "string",
    "transport_line_structure_code": "string"}, "o_dra")
_register_filter("filter_ften", "ften", filters.filter_ften, {"id": "string", "life_cycle_status_code": "string"}, "o_ften")
_register_filter("filter_ogc", "ogc", filters.filter_ogc, {
    "og_road_segment_permit_id": "bigint", "status": "string", "road_type_desc": "string"}, "o_ogc")
_register_filter("filter_ogcpre06", "ogcpre06", filters.filter_ogcpre06, {
    "og_petrlm_dev_rd_pre06_pub_id": "bigint", "petrlm_development_road_type": "string"}, "o_ogcpre06")
_register_filter("filter_rail", "rail", filters.filter_rail, {"railway_track_id": "bigint"}, "fx_rail")


@register("exclude_tunnels", """
    SELECT railway_track_id FROM fx_rail t WHERE NOT EXISTS (SELECT 1 FROM fx_rail_struct s WHERE s.structure_type = 'Tunnel'
      AND s.x1 = t.x1 AND s.y1 <= t.y2 AND s.y2 >= t.y1)""")
def _(spark, sf):
    kept = exclude_tunnels(layer(spark, sf, "rail"), layer(spark, sf, "rail_structures"))
    return kept.selectExpr("CAST(railway_track_id AS bigint) AS railway_track_id")


@register("tolerance_by_class", """
    SELECT transport_line_type_code, CAST(CASE WHEN transport_line_type_code IN ('RF', 'RH1', 'RH2') THEN 30
      WHEN transport_line_type_code IN ('RA1', 'RA2', 'RC1', 'RC2') THEN 20 ELSE 12.5 END AS DOUBLE) AS tolerance, count(*) AS n
    FROM fx_dra GROUP BY ALL""")
def _(spark, sf):
    return filters.with_tolerance(layer(spark, sf, "dra")).groupBy("transport_line_type_code", "tolerance").agg(
        F.count("*").alias("n"))


@register("promote_to_multi", "SELECT railway_track_id, CAST(1 AS BIGINT) AS n_parts, CAST(2 AS BIGINT) AS n_vertices FROM fx_rail")
def _(spark, sf):
    single = layer(spark, sf, "rail").withColumn("geom", F.col("geom")[0])
    return promote_to_multi(single).selectExpr("CAST(railway_track_id AS bigint) AS railway_track_id",
                                               "CAST(size(geom) AS bigint) AS n_parts", "CAST(size(geom[0]) AS bigint) AS n_vertices")


@register("code_label_join", """
    SELECT transport_line_id, transport_line_type_code, concat('class ', lower(transport_line_type_code)) AS type_label FROM fx_dra""")
def _(spark, sf):
    codes = remembered(spark, sf, "type-codes", lambda: spark_view(spark, sf, "fx_type_codes"))
    labelled = filters.code_labels(layer(spark, sf, "dra"), codes, "transport_line_type_code", "description", "type_label")
    return labelled.selectExpr("CAST(transport_line_id AS bigint) AS transport_line_id", "transport_line_type_code", "type_label")


@register("force_2d", """
    SELECT linear_feature_id, round(bx + 100, 6) AS x, round(b_y + 150, 6) AS y, CAST(0 AS BIGINT) AS n_measures FROM fx_streams""")
def _(spark, sf):
    return force_2d(layer(spark, sf, "streams")).selectExpr(
        "linear_feature_id", "round(geom[0][2].x, 6) AS x", "round(geom[0][2].y, 6) AS y",
        "CAST(size(filter(geom[0], v -> v.z IS NOT NULL OR v.m IS NOT NULL)) AS bigint) AS n_measures")


@register("region_list", "SELECT DISTINCT watershed_group_code FROM fx_streams")
def _(spark, sf):
    return filters.region_list(layer(spark, sf, "streams"))


@register("union_sources", f"SELECT {', '.join(IDS)}, count(*) AS n FROM o_found GROUP BY ALL")
def _(spark, sf):
    numbered = numbered_crossings(spark, sf)
    frames = []
    for column in IDS:
        frames.append(numbered.where(F.col(column).isNotNull()).select(column))
    both = filters.union_sources(*frames)
    casts = [f"CAST({c} AS {'string' if 'ften' in c else 'bigint'}) AS {c}" for c in IDS]
    return both.selectExpr(*casts).groupBy(*IDS).agg(F.count("*").alias("n"))


_SOURCE_CASE = f"""CASE {' '.join(f"WHEN {c} IS NOT NULL THEN '{s}'" for s, c in zip(job.LINE_LAYERS, IDS))} END"""


@register("source_of", f"SELECT id AS crossing_id, {_SOURCE_CASE} AS source FROM o_merged3")
def _(spark, sf):
    return filters.source_of(merged_crossings(spark, sf)).selectExpr("CAST(modelled_crossing_id AS bigint) AS crossing_id", "source")


# --- parts, segments, intersections -----------------------------------------------------------------------

@register("explode_parts", "SELECT id, CAST(part_no AS BIGINT) AS part_no, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM fx_ften")
def _(spark, sf):
    return explode_parts(layer(spark, sf, "ften")).selectExpr(
        "id", "CAST(part_no AS bigint) AS part_no", "round(part[0].x, 6) AS x1", "round(part[0].y, 6) AS y1")


_SEG = ("x1", "y1", "z1", "m1", "x2", "y2", "z2", "m2")


@register("explode_segments", f"""
    SELECT linear_feature_id, CAST(seg_no AS BIGINT) AS seg_no, {', '.join(_r(*_SEG))}, CAST(100 AS DOUBLE) AS seg_len,
      CAST(100 * seg_no AS DOUBLE) AS cum_len FROM (SELECT *, m1 / 10 AS z1, m2 / 10 AS z2 FROM fx_stream_segs)""")
def _(spark, sf):
    return explode_segments(layer(spark, sf, "streams")).selectExpr(
        "linear_feature_id", "CAST(seg_no AS bigint) AS seg_no", *_r(*_SEG, "seg_len", "cum_len"))


def _lines(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return plans.transport_lines({name: layer(spark, sf, name) for name in names})


def _streams(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_streams(layer(spark, sf, "streams"))


def _pieces(spark: SparkSession, sf: str, names: tuple[str, ...], pairing: str = "lockstep") -> DataFrame:
    return intersect_lines(_lines(spark, sf, *names), _streams(spark, sf), "line_number", "linear_feature_id",
                           ["source", "line_text", "tolerance"], ["watershed_group_code"], pairing)


def _all_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return remembered(spark, sf, "pieces", lambda: _pieces(spark, sf, tuple(job.LINE_LAYERS)))


@register("spatial_join_pairs", "SELECT DISTINCT num AS transport_line_id, linear_feature_id FROM o_all_pieces WHERE source = 'dra'")
def _(spark, sf):
    roads = filters.filter_dra(layer(spark, sf, "dra"))
    pairs = spatial_join(roads, _streams(spark, sf), "transport_line_id", "linear_feature_id")
    return pairs.selectExpr("CAST(transport_line_id AS bigint) AS transport_line_id", "linear_feature_id")


_PIECE_SQL = ("SELECT source, num AS line_number, txt AS line_text, CAST(part_no AS BIGINT) AS part_no, linear_feature_id, "
              "watershed_group_code, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM ")
_PIECE_COLUMNS = ["source", "line_number", "line_text", "CAST(left_part AS bigint) AS part_no", "linear_feature_id",
                  "watershed_group_code", *_r("x1", "y1", "x2", "y2")]


@register("intersect_lines_lockstep", _PIECE_SQL + "o_pieces")
def _(spark, sf):
    return _pieces(spark, sf, tuple(job.LINE_LAYERS)).selectExpr(*_PIECE_COLUMNS)


@register("intersect_lines_all_pairs", _PIECE_SQL + "o_all_pieces WHERE source = 'ften'")
def _(spark, sf):
    return _pieces(spark, sf, ("ften",), "all_pairs").selectExpr(*_PIECE_COLUMNS)


@register("collinear_overlap", _PIECE_SQL + "o_pieces WHERE source = 'dra' AND (x1 <> x2 OR y1 <> y2)")
def _(spark, sf):
    return _pieces(spark, sf, ("dra",)).where("x1 <> x2 OR y1 <> y2").selectExpr(*_PIECE_COLUMNS)


# --- clusters ---------------------------------------------------------------------------------------------

_ROW_ID = ("concat_ws('|', source, {num}, {txt}, linear_feature_id, CAST(round(x1 * 1000) AS BIGINT), "
           "CAST(round(y1 * 1000) AS BIGINT), CAST(round(x2 * 1000) AS BIGINT), CAST(round(y2 * 1000) AS BIGINT))")


@register("cluster_by_stream", f"""
    SELECT row_id, min(row_id) OVER (PARTITION BY root) AS cluster_id FROM (
      SELECT root, {_ROW_ID.format(num='num', txt='txt')} AS row_id FROM o_rows JOIN o_roots USING (rid))""")
def _(spark, sf):
    rows = _all_pieces(spark, sf).withColumn("row_id", F.expr(_ROW_ID.format(num="line_number", txt="line_text")))
    return cluster_within(rows, ["source", "linear_feature_id"], "tolerance", "row_id").select("row_id", "cluster_id")


_REGION_ROWS = """o_region_rows AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY num, linear_feature_id, x1, y1, x2, y2) AS rid, num, linear_feature_id, watershed_group_code,
        CAST(10 AS DOUBLE) AS tol, x1, y1, x2, y2 FROM o_pieces WHERE source = 'dra')"""


@register("cluster_by_region")
def _(spark, sf):
    rows = _all_pieces(spark, sf).where("source = 'dra'").withColumn(
        "row_id", F.expr(_ROW_ID.format(num="line_number", txt="line_text")))
    return cluster_within(rows, ["watershed_group_code"], 10.0, "row_id").select("row_id", "cluster_id")


_region = with_views("SELECT * FROM o_pieces")
ORACLE["cluster_by_region"] = (
    _region[:_region.rindex(") SELECT * FROM o_pieces")] + f"), {_REGION_ROWS}, o_rr AS MATERIALIZED ("
    + roots_sql("o_region_rows", ["watershed_group_code"], "tol") + ") SELECT row_id, min(row_id) OVER (PARTITION BY root) AS cluster_id "
    f"FROM (SELECT root, {_ROW_ID.format(num='num', txt='NULL').replace('source', repr('dra'))} AS row_id "
    "FROM o_region_rows JOIN o_rr USING (rid))")


def _centroids(spark: SparkSession, sf: str, scope: str) -> DataFrame:
    found = cluster_centroids(_all_pieces(spark, sf), ["source", "watershed_group_code", "linear_feature_id"], "tolerance",
                              ["line_number", "line_text"], scope)
    return found.selectExpr("source", "linear_feature_id", "tolerance", *_r("x", "y"), "n", "line_number", "line_text")


_CENTROID_SQL = "SELECT source, linear_feature_id, tol AS tolerance, round(x, 6) AS x, round(y, 6) AS y"


@register("cluster_centroid", _CENTROID_SQL + ", n FROM o_clusters")
def _(spark, sf):
    return _centroids(spark, sf, "group").drop("line_number", "line_text")


@register("cluster_group_max_id", _CENTROID_SQL + ", n, num AS line_number, txt AS line_text FROM o_clusters")
def _(spark, sf):
    return _centroids(spark, sf, "group")


@register("cluster_own_max_id", _CENTROID_SQL + ", n, own_num AS line_number, own_txt AS line_text FROM o_clusters")
def _(spark, sf):
    return _centroids(spark, sf, "cluster")


@register("cluster_across_streams", "SELECT watershed_group_code, round(x, 6) AS x, round(y, 6) AS y, n FROM o_spots")
def _(spark, sf):
    first = cluster_centroids(_all_pieces(spark, sf).where("source = 'dra'"), ["watershed_group_code", "linear_feature_id"], "tolerance")
    points = first.selectExpr("watershed_group_code", "x AS x1", "y AS y1", "x AS x2", "y AS y2")
    return cluster_centroids(points, ["watershed_group_code"], 10.0).selectExpr("watershed_group_code", *_r("x", "y"), "n")


# --- distances and linear referencing ---------------------------------------------------------------------

def _stray_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points near streams: the bridges, each with the stream of its block's number."""
    mot = layer(spark, sf, "mot")
    streams = layer(spark, sf, "streams").selectExpr("linear_feature_id", "linear_feature_id - 1000 AS k")
    n = layer(spark, sf, "streams").select(F.count("*")).scalar()
    points = mot.selectExpr("CAST(hwy_structure_class_id AS bigint) AS point_id", "geom.x AS x", "geom.y AS y")
    return points.withColumn("k", F.col("point_id") % n).join(streams, "k").select(
        "point_id", "linear_feature_id", "x", "y")


_STRAY = """(SELECT m.hwy_structure_class_id AS point_id, m.x, m.y, s.* EXCLUDE (stream_order) FROM fx_mot m
    JOIN fx_streams s ON s.k = m.hwy_structure_class_id % (SELECT count(*) FROM part))"""
_STRAY_WITH = (f"SELECT p.point_id, p.linear_feature_id, {{}} FROM (SELECT point_id, linear_feature_id, x, y FROM {_STRAY}) p "
               "JOIN fx_streams s USING (linear_feature_id)")


@register("point_line_distance", _STRAY_WITH.format(f"round({STREAM_DISTANCE}, 6) AS distance"))
def _(spark, sf):
    return point_line_distance(_stray_points(spark, sf), layer(spark, sf, "streams"), "linear_feature_id").selectExpr(
        "point_id", "linear_feature_id", *_r("distance"))


@register("locate_points", _STRAY_WITH.format(f"round({ALONG} / 200, 6) AS fraction"))
def _(spark, sf):
    return locate_points(_stray_points(spark, sf), layer(spark, sf, "streams"), "linear_feature_id").selectExpr(
        "point_id", "linear_feature_id", *_r("fraction"))


@register("locate_along", """
    SELECT e.stream_crossing_id, round(s.bx + least(100, e.downstream_route_measure - s.downstream_route_measure), 6) AS x,
      round(s.b_y + 50 + greatest(0, e.downstream_route_measure - s.downstream_route_measure - 100), 6) AS y,
      round(e.downstream_route_measure / 10, 6) AS z, round(e.downstream_route_measure, 6) AS m
    FROM (SELECT stream_crossing_id, linear_feature_id, downstream_route_measure + 25 AS downstream_route_measure FROM fx_pscis_events) e
    JOIN fx_streams s USING (linear_feature_id)
    WHERE e.downstream_route_measure - s.downstream_route_measure <= 200""")
def _(spark, sf):
    events = layer(spark, sf, "pscis_events").selectExpr(
        "CAST(stream_crossing_id AS bigint) AS stream_crossing_id", "linear_feature_id", "downstream_route_measure + 25 AS measure")
    return locate_along(events, layer(spark, sf, "streams"), "linear_feature_id", "measure").selectExpr(
        "stream_crossing_id", *[f"round(point.{axis}, 6) AS {axis}" for axis in "xyzm"])


@register("merge_parts", """
    SELECT linear_feature_id, CAST(3 AS BIGINT) AS n_vertices, round(bx, 6) AS x_start, round(b_y + 150, 6) AS y_end FROM fx_streams""")
def _(spark, sf):
    # the two legs as separate parts, in reverse order
    legs = layer(spark, sf, "streams").withColumn("geom", F.expr("array(slice(geom[0], 2, 2), slice(geom[0], 1, 2))"))
    return merge_parts(legs).selectExpr("linear_feature_id", "CAST(size(merged) AS bigint) AS n_vertices",
                                        "round(merged[0].x, 6) AS x_start", "round(element_at(merged, -1).y, 6) AS y_end")


_CHAINS = """SELECT l_suppkey, l_orderkey, l_linenumber, l_linenumber % 2 = 0 AS turned,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS pos,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS place,
      count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem"""


@register("merge_many_parts", f"""
    SELECT l_suppkey, IF(simple, n + 1, NULL) AS n_vertices, IF(simple, IF(back, n + 1, 1), NULL) AS x_start, IF(simple, IF(back, 1, n + 1), NULL) AS x_end
    FROM (SELECT l_suppkey, CAST(max(n) AS BIGINT) AS n, max(n) < 3 OR (l_suppkey % 5 <> 0 AND l_suppkey % 7 <> 0) AS simple,
        sum(IF(turned, 2, 0)) > max(n) OR (sum(IF(turned, 2, 0)) = max(n) AND max(IF(place = 1 AND turned, 1, 0)) = 1) AS back
      FROM ({_CHAINS}) GROUP BY l_suppkey)""")
def _(spark, sf):
    """A supplier's order lines as parts of one line: by price along it, shuffled and turned; some with a gap, some with a branch."""
    spark.read.parquet(f"{sf}/lineitem.parquet").createOrReplaceTempView("lineitem")
    part = "array(named_struct('x', {a}, 'y', {y}, 'z', NULL, 'm', NULL), named_struct('x', {b}, 'y', {v}, 'z', NULL, 'm', NULL))"
    way = {"a": "CAST(pos + IF(turned, 1, 0) AS DOUBLE)", "b": "CAST(pos + IF(turned, 0, 1) AS DOUBLE)"}
    spur = part.format(a="CAST(pos AS DOUBLE)", b="CAST(pos AS DOUBLE)", y="0D", v="1D")
    parts = spark.sql(_CHAINS).selectExpr(
        "l_suppkey", "place", f"CASE WHEN n >= 3 AND pos = n DIV 2 + 1 AND l_suppkey % 7 = 0 THEN array() "
        f"WHEN n >= 3 AND pos = n DIV 2 + 1 AND l_suppkey % 5 = 0 THEN array({part.format(**way, y='0D', v='0D')}, {spur}) "
        f"ELSE array({part.format(**way, y='0D', v='0D')}) END AS parts")
    lines = parts.groupBy("l_suppkey").agg(F.expr("flatten(transform(sort_array(collect_list(struct(place, parts))), c -> c.parts))").alias("geom"))
    return merge_many_parts(lines).selectExpr("l_suppkey", "CAST(size(merged) AS BIGINT) AS n_vertices", "CAST(get(merged, 0).x AS BIGINT) AS x_start",
                                              "CAST(element_at(merged, -1).x AS BIGINT) AS x_end")


# --- nearest neighbours -----------------------------------------------------------------------------------

def _dra_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return _all_pieces(spark, sf).where("source = 'dra'")


def _spots(spark: SparkSession, sf: str) -> DataFrame:
    def make() -> DataFrame:
        first = cluster_centroids(_dra_pieces(spark, sf), ["watershed_group_code", "linear_feature_id"], "tolerance")
        points = first.selectExpr("watershed_group_code", "x AS x1", "y AS y1", "x AS x2", "y AS y2")
        return cluster_centroids(points, ["watershed_group_code"], 10.0).select("watershed_group_code", "x", "y")
    return remembered(spark, sf, "spots", make)


def _register_nearest(k: int) -> None:
    @register(f"nearest_{k}", f"""
        SELECT watershed_group_code, round(x, 6) AS x, round(y, 6) AS y, linear_feature_id, num AS line_number, CAST(rn AS BIGINT) AS rank,
          round(d, 6) AS distance FROM o_five WHERE rn <= {k}""")
    def _(spark, sf):
        found = nearest_k(_spots(spark, sf), _dra_pieces(spark, sf), k, ["linear_feature_id", "line_number", "x1", "y1", "x2", "y2"],
                          ["watershed_group_code"])
        return found.selectExpr("watershed_group_code", *_r("x", "y"), "linear_feature_id", "line_number", "CAST(rank AS bigint) AS rank",
                                *_r("distance"))


_register_nearest(5)
_register_nearest(1)


@register("nearest_within", f"""
    SELECT point_id, crossing_id, round(d, 6) AS distance FROM (
      SELECT m.hwy_structure_class_id AS point_id, x.id AS crossing_id, {um('sqrt(pow(m.x - x.x, 2) + pow(m.y - x.y, 2))')} AS d,
        row_number() OVER (PARTITION BY m.hwy_structure_class_id ORDER BY {um('sqrt(pow(m.x - x.x, 2) + pow(m.y - x.y, 2))')}, x.id) AS rn
      FROM fx_mot m JOIN o_numbered x ON x.x BETWEEN m.x - 31 AND m.x + 31 AND x.y BETWEEN m.y - 31 AND m.y + 31)
    WHERE rn = 1 AND d < 30""")
def _(spark, sf):
    points = layer(spark, sf, "mot").selectExpr("CAST(hwy_structure_class_id AS bigint) AS point_id", "geom.x AS x", "geom.y AS y")
    targets = numbered_crossings(spark, sf).selectExpr(
        "CAST(modelled_crossing_id AS bigint) AS crossing_id", "geom.x AS x1", "geom.y AS y1", "geom.x AS x2", "geom.y AS y2")
    return nearest_within(points, targets, 30.0, ["crossing_id"]).selectExpr("point_id", "crossing_id", *_r("distance"))


@register("buffer_semi_join", "SELECT cid AS crossing_id FROM o_rail_near")
def _(spark, sf):
    rail = merged_crossings(spark, sf).where("railway_track_id IS NOT NULL").selectExpr(
        "CAST(modelled_crossing_id AS bigint) AS crossing_id", "geom.x AS x", "geom.y AS y")
    bridges = layer(spark, sf, "rail_structures").where(F.upper("structure_type").startswith("BRIDGE"))
    return buffer_semi_join(rail, explode_segments(bridges), 10.01, "crossing_id").select("crossing_id")


@register("buffer_true_distance", f"""
    SELECT id AS crossing_id FROM o_merged3 x WHERE railway_track_id IS NOT NULL AND EXISTS (SELECT 1 FROM fx_rail_struct r
      WHERE upper(r.structure_type) LIKE 'BRIDGE%' AND r.x1 BETWEEN x.x - 11 AND x.x + 11
        AND {point_segment_distance('x.x', 'x.y', 'r')} <= 10.01)""")
def _(spark, sf):
    rail = merged_crossings(spark, sf).where("railway_track_id IS NOT NULL").selectExpr(
        "CAST(modelled_crossing_id AS bigint) AS crossing_id", "geom.x AS x", "geom.y AS y")
    bridges = layer(spark, sf, "rail_structures").where(F.upper("structure_type").startswith("BRIDGE"))
    return buffer_semi_join(rail, explode_segments(bridges), 10.01, "crossing_id", true_distance=True).select("crossing_id")


# --- equality, band and anti joins ------------------------------------------------------------------------

@register("band_semi_join", """
    SELECT stream_crossing_id, linear_feature_id FROM fx_pscis_events e WHERE EXISTS (
      SELECT 1 FROM o_numbered x WHERE x.linear_feature_id = e.linear_feature_id
        AND abs(x.downstream_route_measure - e.downstream_route_measure) < 15)""")
def _(spark, sf):
    events = layer(spark, sf, "pscis_events").selectExpr(
        "CAST(stream_crossing_id AS bigint) AS stream_crossing_id", "linear_feature_id", "downstream_route_measure")
    near = band_semi_join(events, numbered_crossings(spark, sf), ["linear_feature_id"], "downstream_route_measure", 15.0)
    return near.select("stream_crossing_id", "linear_feature_id")


@register("inner_join_events", """
    SELECT e.stream_crossing_id, e.linear_feature_id, round(e.downstream_route_measure, 6) AS downstream_route_measure
    FROM fx_pscis_events e JOIN fx_pscis_points p USING (stream_crossing_id) WHERE p.current_crossing_type_code = 'OBS'""")
def _(spark, sf):
    found = rules.pscis_open_bottom(layer(spark, sf, "pscis_events"), layer(spark, sf, "pscis_points"))
    return found.selectExpr("CAST(stream_crossing_id AS bigint) AS stream_crossing_id", "linear_feature_id", *_r("downstream_route_measure"))


@register("anti_join_losers", "SELECT id AS crossing_id FROM o_numbered WHERE id NOT IN (SELECT id FROM o_merged3)")
def _(spark, sf):
    key = "modelled_crossing_id"
    gone = numbered_crossings(spark, sf).join(merged_crossings(spark, sf), key, "left_anti")
    return gone.selectExpr(f"CAST({key} AS bigint) AS crossing_id")


@register("first_by_nulls_first", """
    SELECT watershed_group_code, stream_order, linear_feature_id FROM (SELECT *, row_number() OVER (
      PARTITION BY watershed_group_code ORDER BY stream_order DESC NULLS FIRST, linear_feature_id) AS rn FROM fx_streams) WHERE rn = 1""")
def _(spark, sf):
    order = [F.col("stream_order").desc_nulls_first(), F.col("linear_feature_id")]
    return filters.first_by(layer(spark, sf, "streams"), ["watershed_group_code"], order).select(
        "watershed_group_code", "stream_order", "linear_feature_id")


# --- crossings, merging, classification, ids, reports -----------------------------------------------------

def numbered_crossings(spark: SparkSession, sf: str) -> DataFrame:
    return remembered(spark, sf, "numbered", lambda: job.numbered_crossings(all_layers(spark, sf)))


def _merged(spark: SparkSession, sf: str, rounds: int) -> DataFrame:
    if rounds == 0:
        return numbered_crossings(spark, sf)
    order = ("dra", "ften", "ogc", "ogcpre06")
    return remembered(spark, sf, f"merged{rounds}",
                      lambda: merge_round(_merged(spark, sf, rounds - 1), order[rounds], order[:rounds]))


def merged_crossings(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, 3)


def final_crossings(spark: SparkSession, sf: str) -> DataFrame:
    return remembered(spark, sf, "final", lambda: job.classified_crossings(merged_crossings(spark, sf), all_layers(spark, sf)))


_STREAM_COLUMNS = ["linear_feature_id", "CAST(blue_line_key AS bigint) AS blue_line_key", *_r("downstream_route_measure"),
                   "wscode_ltree", "localcode_ltree", "watershed_group_code"]
_STREAM_SQL = ", ".join(_STREAM_COLUMNS) + ", round(x, 6) AS x, round(y, 6) AS y"
_PLACE = ["round(geom.x, 6) AS x", "round(geom.y, 6) AS y"]


def _register_source(source: str, column: str) -> None:
    sql = f"SELECT {column}, {_STREAM_SQL} FROM o_found WHERE {column} IS NOT NULL"

    @register(f"crossings_{source}", sql)
    def _(spark, sf):
        found = plans.find_crossings(layer(spark, sf, "streams"), {source: layer(spark, sf, source)})
        id_type = "string" if source == "ften" else "bigint"
        return found.selectExpr(f"CAST({column} AS {id_type}) AS {column}", *_STREAM_COLUMNS, *_PLACE)


for _source, _column in zip(job.LINE_LAYERS, IDS):
    _register_source(_source, _column)

_ID_COLUMNS = [f"CAST({c} AS {'string' if 'ften' in c else 'bigint'}) AS {c}" for c in IDS]
_ID_SQL = ", ".join(IDS)


@register("assign_ids", f"SELECT id AS crossing_id, {_ID_SQL}, {_STREAM_SQL} FROM o_numbered")
def _(spark, sf):
    unnumbered = numbered_crossings(spark, sf).drop("modelled_crossing_id")
    return assign_ids(unnumbered, job.crossing_order(), "crossing_id").selectExpr(
        "crossing_id", *_ID_COLUMNS, *_STREAM_COLUMNS, *_PLACE)


def _register_merge(name: str, number: int) -> None:
    @register(name, f"SELECT id AS crossing_id, {_ID_SQL}, round(x, 6) AS x, round(y, 6) AS y FROM o_merged{number}")
    def _(spark, sf):
        order = ("dra", "ften", "ogc", "ogcpre06")
        done = merge_round(_merged(spark, sf, number - 1), order[number], order[:number])
        return done.selectExpr("CAST(modelled_crossing_id AS bigint) AS crossing_id", *_ID_COLUMNS, *_PLACE)


for _number, _name in enumerate(("merge_ften", "merge_ogc", "merge_ogcpre06"), 1):
    _register_merge(_name, _number)


def _register_rule(name: str, flag: str, apply: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]) -> None:
    @register(name, f"SELECT id AS crossing_id FROM o_flags WHERE {flag}")
    def _(spark, sf):
        ids = apply(merged_crossings(spark, sf), all_layers(spark, sf))
        return ids.selectExpr("CAST(modelled_crossing_id AS bigint) AS crossing_id")


_register_rule("obs_stream_order", "f1", lambda x, m: rules.obs_stream_order(x, m["streams"]))
_register_rule("obs_edge_type", "f2", lambda x, m: rules.obs_edge_type(x, m["streams"]))
_register_rule("obs_mot", "f3", lambda x, m: rules.obs_mot(x, m["mot"]))
_register_rule("obs_pscis", "f4", lambda x, m: rules.obs_pscis(x, m["pscis_events"], m["pscis_points"]))
_register_rule("obs_dra_structure", "f5", lambda x, m: rules.obs_dra_structure(x, m["dra"]))
_register_rule("obs_rail_bridge", "f6", lambda x, m: rules.obs_rail_bridge(x, m["rail_structures"]))


@register("classify", f"SELECT id AS crossing_id, kind AS modelled_crossing_type, tags, {_ID_SQL} FROM o_final")
def _(spark, sf):
    done = job.classified_crossings(merged_crossings(spark, sf), all_layers(spark, sf))
    return done.selectExpr("CAST(modelled_crossing_id AS bigint) AS crossing_id", "modelled_crossing_type",
                           "array_join(modelled_crossing_type_source, '; ') AS tags", *_ID_COLUMNS)


@register("model_crossings", f"""
    SELECT id AS crossing_id, kind AS modelled_crossing_type, tags, {_ID_SQL}, {_STREAM_SQL} FROM o_final""")
def _(spark, sf):
    done = job.model_crossings(all_layers(spark, sf))
    return done.selectExpr("CAST(modelled_crossing_id AS bigint) AS crossing_id", "modelled_crossing_type",
                           "array_join(modelled_crossing_type_source, '; ') AS tags", *_ID_COLUMNS, *_STREAM_COLUMNS, *_PLACE)


@register("match_archive", """
    SELECT coalesce(n.archive_id, (SELECT max(crossing_id) FROM o_archive)
        + row_number() OVER (PARTITION BY n.archive_id IS NULL ORDER BY x.id)) AS crossing_id,
      x.linear_feature_id, round(x.x, 6) AS x, round(x.y, 6) AS y
    FROM o_numbered x LEFT JOIN o_archive_near n ON n.id = x.id AND n.place = 1""")
def _(spark, sf):
    crossings = numbered_crossings(spark, sf)
    archive = crossings.where("modelled_crossing_id % 3 = 0").selectExpr(
        "modelled_crossing_id + 500 AS crossing_id",
        "named_struct('x', geom.x + modelled_crossing_id % 12, 'y', geom.y, 'z', geom.z, 'm', geom.m) AS geom")
    return match_archive(crossings, archive).selectExpr(
        "CAST(modelled_crossing_id AS bigint) AS crossing_id", "linear_feature_id", *_PLACE)


_SRC = ", ".join(f"count(*) FILTER (source = '{source}') AS {column}" for source, column in (
    ("dra", "src_dra"), ("ften", "src_ften"), ("ogc", "src_ogcpermit"), ("ogcpre06", "src_ogcpre06")))
_WITH_SOURCE = f"(SELECT *, {_SOURCE_CASE} AS source FROM o_final)"


def _register_report(name: str, report: Callable[[DataFrame], DataFrame], sql: str) -> None:
    @register(name, sql)
    def _(spark, sf):
        return report(final_crossings(spark, sf))


_register_report("report_total", reports.report_total, "SELECT kind AS modelled_crossing_type, count(*) AS n FROM o_final GROUP BY ALL")
_register_report("report_source", reports.report_source, f"SELECT {_SRC} FROM {_WITH_SOURCE}")
_register_report("report_region", reports.report_region, f"""
    SELECT watershed_group_code, count(*) AS total, count(*) FILTER (kind = 'CBS') AS xing_type_cbs,
      count(*) FILTER (kind = 'OBS') AS xing_type_obs, {_SRC} FROM {_WITH_SOURCE} GROUP BY watershed_group_code""")
_register_report("report_obs_sources", reports.report_obs_sources, """
    SELECT tags AS modelled_crossing_type_sources, count(*) AS n FROM o_final WHERE kind = 'OBS' GROUP BY ALL""")


@register("rail_crossings_per_region", """
    SELECT watershed_group_code, count(*) AS n FROM o_simple WHERE source = 'rail' GROUP BY watershed_group_code""")
def rail_crossings_per_region(spark: SparkSession, sf: str) -> DataFrame:
    """Railway crossings by region: filter, overlay, clustering, centroids and linear referencing."""
    found = plans.crossings_simple(layer(spark, sf, "streams"), layer(spark, sf, "rail"), "rail")
    return found.groupBy("watershed_group_code").agg(F.count("*").alias("n"))
