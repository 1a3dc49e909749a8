"""The same results in DuckDB SQL, by brute force over the synthetic map.

Every piece of the map where lines meet is axis-parallel, so distances between pieces are distances between boxes, and
positions along a stream are clamped differences. Clusters come from a recursive query, neighbours from joins of whole
regions. Nothing here uses grid cells, segments or any other part of the Spark plans.
"""

from __future__ import annotations

from checks.map_views import VIEWS


def um(distance: str) -> str:
    return f"(round(({distance}) * 1e6) / 1e6)"


def box_distance(a: str, b: str) -> str:
    gap = [f"greatest(0, {a}.{v}1 - {b}.{v}2, {b}.{v}1 - {a}.{v}2)" for v in "xy"]
    return um(f"sqrt({gap[0]} * {gap[0]} + {gap[1]} * {gap[1]})")


def point_box_distance(p: str, b: str) -> str:
    gap = [f"greatest(0, {p}.{v} - {b}.{v}2, {b}.{v}1 - {p}.{v})" for v in "xy"]
    return um(f"sqrt({gap[0]} * {gap[0]} + {gap[1]} * {gap[1]})")


def point_segment_distance(x: str, y: str, s: str) -> str:
    """Distance to any straight segment, through the projection on its carrier."""
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    t = f"greatest(0, least(1, (({x} - {s}.x1) * {dx} + ({y} - {s}.y1) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    return um(f"sqrt(pow({x} - {s}.x1 - {t} * {dx}, 2) + pow({y} - {s}.y1 - {t} * {dy}, 2))")


def pieces_sql(lines: str, pairing: str) -> str:
    """Pieces of ``lines`` (``source, num, txt, tol, part_no, x1…``) with the filtered streams."""
    parts = "WHERE l.part_no = 0" if pairing == "lockstep" else "WHERE true"
    attrs = "l.source, l.num, l.txt, l.tol, l.part_no, s.linear_feature_id, s.watershed_group_code"
    touch = ("greatest(l.x1, l.x2) >= s.x1 AND least(l.x1, l.x2) <= s.x2 AND greatest(l.y1, l.y2) >= s.y1 "
             "AND least(l.y1, l.y2) <= s.y2")
    return f"""
        WITH pair AS (SELECT {attrs}, l.x1 AS lx1, l.y1 AS ly1, l.x2 AS lx2, l.y2 AS ly2, s.x1, s.y1, s.x2, s.y2
          FROM {lines} l JOIN o_segs s ON {touch} {parts}),
        raw AS (
          -- horizontal stream leg, line not horizontal
          SELECT * EXCLUDE (x1, y1, x2, y2), lx1 + (y1 - ly1) * (lx2 - lx1) / (ly2 - ly1) AS x1, y1,
            lx1 + (y1 - ly1) * (lx2 - lx1) / (ly2 - ly1) AS x2, y2
          FROM pair WHERE y1 = y2 AND ly1 <> ly2 AND lx1 + (y1 - ly1) * (lx2 - lx1) / (ly2 - ly1) BETWEEN x1 AND x2
          UNION ALL
          -- vertical stream leg, line not vertical
          SELECT * EXCLUDE (x1, y1, x2, y2), x1, ly1 + (x1 - lx1) * (ly2 - ly1) / (lx2 - lx1), x2,
            ly1 + (x1 - lx1) * (ly2 - ly1) / (lx2 - lx1)
          FROM pair WHERE x1 = x2 AND lx1 <> lx2 AND ly1 + (x1 - lx1) * (ly2 - ly1) / (lx2 - lx1) BETWEEN y1 AND y2
          UNION ALL
          -- line along the leg
          SELECT * EXCLUDE (x1, y1, x2, y2), greatest(x1, least(lx1, lx2)), greatest(y1, least(ly1, ly2)),
            least(x2, greatest(lx1, lx2)), least(y2, greatest(ly1, ly2))
          FROM pair WHERE (y1 = y2 AND ly1 = ly2) OR (x1 = x2 AND lx1 = lx2)),
        piece AS (SELECT DISTINCT * EXCLUDE (lx1, ly1, lx2, ly2) FROM raw)
        SELECT * FROM piece p WHERE x1 <> x2 OR y1 <> y2 OR NOT EXISTS (
          SELECT 1 FROM piece o WHERE o.source = p.source AND o.num IS NOT DISTINCT FROM p.num
            AND o.txt IS NOT DISTINCT FROM p.txt AND o.part_no = p.part_no AND o.linear_feature_id = p.linear_feature_id
            AND (o.x1 <> o.x2 OR o.y1 <> o.y2) AND p.x1 BETWEEN o.x1 AND o.x2 AND p.y1 BETWEEN o.y1 AND o.y2)"""


def roots_sql(rows: str, keys: list[str], tolerance: str) -> str:
    """``rid, root``: smallest row number of each single-linkage cluster of ``rows``."""
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f"""
        WITH RECURSIVE edge AS (SELECT a.rid AS a, b.rid AS b FROM {rows} a JOIN {rows} b
            ON {same} AND {box_distance('a', 'b')} <= a.{tolerance}),
          reach(a, b) AS (SELECT rid, rid FROM {rows} UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b)
        SELECT a AS rid, min(b) AS root FROM reach GROUP BY a"""


CENTRE = """
        CASE WHEN max({len}) > 0 THEN sum({len} * (x1 + x2) / 2) / sum({len}) ELSE avg(x1) END AS x,
        CASE WHEN max({len}) > 0 THEN sum({len} * (y1 + y2) / 2) / sum({len}) ELSE avg(y1) END AS y""".format(
    len="((x2 - x1) + (y2 - y1))")

# distance to and position on the two legs of a block's stream
_D0 = um("sqrt(pow(greatest(0, s.bx - p.x, p.x - s.bx - 100), 2) + pow(p.y - s.b_y - 50, 2))")
_D1 = um("sqrt(pow(p.x - s.bx - 100, 2) + pow(greatest(0, s.b_y + 50 - p.y, p.y - s.b_y - 150), 2))")
_P0, _P1 = "greatest(0, least(100, p.x - s.bx))", "100 + greatest(0, least(100, p.y - s.b_y - 50))"
ALONG = f"(CASE WHEN {_D0} <= {_D1} THEN {_P0} ELSE {_P1} END)"
STREAM_DISTANCE = f"least({_D0}, {_D1})"
PLACE_X, PLACE_Y = "s.bx + least(100, {p})", "s.b_y + 50 + greatest(0, {p} - 100)"

SOURCES = ("dra", "ften", "ogc", "ogcpre06", "rail")
IDS = ("transport_line_id", "ften_road_section_lines_id", "og_road_segment_permit_id", "og_petrlm_dev_rd_pre06_pub_id",
       "railway_track_id")
_RANK = "CASE " + " ".join(f"WHEN {c} IS NOT NULL THEN {i}" for i, c in enumerate(IDS)) + " END"
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    _RANK, "watershed_group_code", "linear_feature_id", "round(downstream_route_measure, 6)", *IDS, "round(x, 6)", "round(y, 6)"))


def _merge_sql(before: str, source: str, column: str, higher: tuple[str, ...]) -> str:
    above = " OR ".join(f"{c} IS NOT NULL" for c in higher)
    return f"""
        WITH pair AS (SELECT l.id, l.{column} AS val, h.id AS keeper,
            {um('sqrt(pow(l.x - h.x, 2) + pow(l.y - h.y, 2))')} AS d
          FROM (SELECT * FROM {before} WHERE {column} IS NOT NULL AND NOT ({above})) l
          JOIN (SELECT * FROM {before} WHERE {above}) h
            ON h.x BETWEEN l.x - 21 AND l.x + 21 AND h.y BETWEEN l.y - 21 AND l.y + 21),
        nearest AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, keeper) AS rn FROM pair WHERE d < 20),
        matched AS (SELECT * FROM nearest WHERE rn = 1),
        winner AS (SELECT keeper, val, row_number() OVER (PARTITION BY keeper ORDER BY d, id) AS rn FROM matched)
        SELECT x.* REPLACE (coalesce(w.val, x.{column}) AS {column}) FROM {before} x
        LEFT JOIN winner w ON w.keeper = x.id AND w.rn = 1 WHERE x.id NOT IN (SELECT id FROM matched)"""


ORACLE_VIEWS = {
    "o_streams": """SELECT * FROM fx_streams WHERE fwa_watershed_code NOT LIKE '999%' AND edge_type NOT IN (1410, 1425)
        AND localcode_ltree IS NOT NULL""",
    "o_segs": "SELECT g.* FROM fx_stream_segs g JOIN o_streams s USING (linear_feature_id)",
    "o_dra": """SELECT * FROM fx_dra WHERE transport_line_type_code NOT IN ('F', 'FP', 'FR', 'T', 'TR', 'TS', 'RP', 'RWA')
        AND transport_line_surface_code <> 'D' AND coalesce(transport_line_structure_code, '') <> 'T'""",
    "o_ften": "SELECT * FROM fx_ften WHERE life_cycle_status_code NOT IN ('RETIRED', 'PENDING')",
    "o_ogc": "SELECT * FROM fx_ogc WHERE status = 'Approved' AND road_type_desc <> 'Snow Ice Road'",
    "o_ogcpre06": "SELECT * FROM fx_ogcpre06 WHERE petrlm_development_road_type <> 'WINT'",
    "o_lines": """
        SELECT 'dra' AS source, transport_line_id AS num, NULL::VARCHAR AS txt, CASE
            WHEN transport_line_type_code IN ('RF', 'RH1', 'RH2') THEN 30.0::DOUBLE
            WHEN transport_line_type_code IN ('RA1', 'RA2', 'RC1', 'RC2') THEN 20.0 ELSE 12.5 END AS tol,
          0 AS part_no, x1, y1, x2, y2 FROM o_dra
        UNION ALL SELECT 'ften', NULL, id, 12.5, part_no, x1, y1, x2, y2 FROM o_ften
        UNION ALL SELECT 'ogc', og_road_segment_permit_id, NULL, 12.5, 0, x1, y1, x2, y2 FROM o_ogc
        UNION ALL SELECT 'ogcpre06', og_petrlm_dev_rd_pre06_pub_id, NULL, 12.5, 0, x1, y1, x2, y2 FROM o_ogcpre06
        UNION ALL SELECT 'rail', railway_track_id, NULL, 20.0, 0, x1, y1, x2, y2 FROM fx_rail""",
    "o_pieces": pieces_sql("o_lines", "lockstep"),
    "o_all_pieces": pieces_sql("o_lines", "all_pairs"),
    "o_rows": """SELECT *, row_number() OVER (ORDER BY source, num, txt, part_no, linear_feature_id, x1, y1, x2, y2) AS rid
        FROM o_pieces""",
    "o_roots": roots_sql("o_rows", ["source", "linear_feature_id", "tol"], "tol"),
    "o_clusters": f"""SELECT source, watershed_group_code, linear_feature_id, tol, root, {CENTRE}, count(*) AS n,
          max(num) AS own_num, max(txt) AS own_txt,
          max(max(num)) OVER (PARTITION BY source, linear_feature_id, tol) AS num,
          max(max(txt)) OVER (PARTITION BY source, linear_feature_id, tol) AS txt
        FROM o_rows JOIN o_roots USING (rid) GROUP BY source, watershed_group_code, linear_feature_id, tol, root""",
    "o_simple": f"""
        SELECT p.source, p.num, p.txt, s.linear_feature_id, s.blue_line_key, s.wscode_ltree, s.localcode_ltree, s.watershed_group_code,
          {ALONG} / 200 * s.length_metre + s.downstream_route_measure AS downstream_route_measure,
          {PLACE_X.format(p=ALONG)} AS x, {PLACE_Y.format(p=ALONG)} AS y
        FROM o_clusters p JOIN o_streams s USING (linear_feature_id) WHERE p.source <> 'dra'""",
    "o_first": """SELECT row_number() OVER (ORDER BY linear_feature_id, tol, root) AS rid, watershed_group_code, 10.0::DOUBLE AS tol,
          x AS x1, y AS y1, x AS x2, y AS y2 FROM o_clusters WHERE source = 'dra'""",
    "o_region_roots": roots_sql("o_first", ["watershed_group_code"], "tol"),
    "o_spots": """SELECT row_number() OVER (ORDER BY min(rid)) AS spot, watershed_group_code, avg(x1) AS x, avg(y1) AS y, count(*) AS n
        FROM o_first JOIN o_region_roots USING (rid) GROUP BY watershed_group_code, root""",
    "o_five": f"""SELECT spot, watershed_group_code, x, y, linear_feature_id, num, d, rn FROM (
          SELECT p.spot, p.watershed_group_code, p.x, p.y, i.linear_feature_id, i.num, {point_box_distance('p', 'i')} AS d,
            row_number() OVER (PARTITION BY p.spot ORDER BY {point_box_distance('p', 'i')}, i.linear_feature_id, i.num, i.x1, i.y1, i.x2, i.y2) AS rn
          FROM o_spots p JOIN o_pieces i ON i.source = 'dra' AND i.watershed_group_code = p.watershed_group_code) WHERE rn <= 5""",
    "o_chosen": f"""SELECT * FROM (
          SELECT p.spot, s.*, {ALONG} AS pos, row_number() OVER (
            PARTITION BY p.spot ORDER BY s.stream_order DESC NULLS FIRST, p.d, s.linear_feature_id) AS choice
          FROM o_five p JOIN o_streams s USING (linear_feature_id) WHERE {STREAM_DISTANCE} < 5.01) WHERE choice = 1""",
    "o_located": f"""SELECT s.*, pos / 200 * length_metre + downstream_route_measure AS measure,
          {PLACE_X.format(p='pos')} AS x, {PLACE_Y.format(p='pos')} AS y FROM o_chosen s""",
    "o_one": f"""SELECT spot, watershed_group_code, x, y, num, d FROM (
          SELECT p.spot, p.watershed_group_code, p.x, p.y, i.num, {point_box_distance('p', 'i')} AS d, row_number() OVER (
            PARTITION BY p.spot ORDER BY {point_box_distance('p', 'i')}, i.num, i.linear_feature_id, i.x1, i.y1, i.x2, i.y2) AS rn
          FROM o_located p JOIN o_pieces i ON i.source = 'dra' AND i.watershed_group_code = p.watershed_group_code) WHERE rn = 1""",
    "o_dra_found": f"""
        SELECT 'dra' AS source, n.num, NULL::VARCHAR AS txt, p.linear_feature_id, p.blue_line_key, p.wscode_ltree, p.localcode_ltree,
          p.watershed_group_code, p.measure AS downstream_route_measure, p.x, p.y
        FROM o_located p JOIN o_one n USING (spot) JOIN o_dra r ON r.transport_line_id = n.num
        WHERE {point_segment_distance('p.x', 'p.y', 'r')} < 16""",
    "o_found": "SELECT " + ", ".join(
        f"CASE WHEN source = '{s}' THEN {'txt' if s == 'ften' else 'num'} END AS {c}" for s, c in zip(SOURCES, IDS)) +
        ", * EXCLUDE (source, num, txt) FROM (SELECT * FROM o_simple UNION ALL BY NAME SELECT * FROM o_dra_found)",
    "o_numbered": f"SELECT row_number() OVER (ORDER BY {_ORDER}) AS id, * FROM o_found",
    "o_merged1": _merge_sql("o_numbered", "ften", IDS[1], IDS[:1]),
    "o_merged2": _merge_sql("o_merged1", "ogc", IDS[2], IDS[:2]),
    "o_merged3": _merge_sql("o_merged2", "ogcpre06", IDS[3], IDS[:3]),
    "o_mot_near": f"""SELECT id AS bridge, cid FROM (
          SELECT m.hwy_structure_class_id AS id, x.id AS cid, {um('sqrt(pow(x.x - m.x, 2) + pow(x.y - m.y, 2))')} AS d,
            row_number() OVER (PARTITION BY m.hwy_structure_class_id ORDER BY {um('sqrt(pow(x.x - m.x, 2) + pow(x.y - m.y, 2))')}, x.id) AS rn
          FROM fx_mot m JOIN o_merged3 x ON x.x BETWEEN m.x - 16 AND m.x + 16 AND x.y BETWEEN m.y - 16 AND m.y + 16
          WHERE upper(bmis_structure_type) = 'BRIDGE' AND upper(bmis_struct_status_type_desc) = 'OPEN/IN USE')
        WHERE rn = 1 AND d < 15""",
    # rail bridges are vertical and their crossings lie on a buffer polygon with a corner at every 11.25 degrees: a vertical
    # segment meets it if its x is within reach and its y range overlaps the polygon's chord there
    "o_chord": """SELECT i, 10.01 * cos(radians(11.25 * i)) AS cx, 10.01 * sin(radians(11.25 * i)) AS cy,
          10.01 * cos(radians(11.25 * (i + 1))) AS nx, 10.01 * sin(radians(11.25 * (i + 1))) AS ny FROM range(16) t(i)""",
    "o_rail_near": f"""SELECT DISTINCT x.id AS cid FROM o_merged3 x JOIN fx_rail_struct r
          ON upper(r.structure_type) LIKE 'BRIDGE%' AND abs(r.x1 - x.x) <= 10.01
            AND least(r.y1, r.y2) <= x.y + 10.01 AND greatest(r.y1, r.y2) >= x.y - 10.01
          JOIN o_chord c ON r.x1 - x.x BETWEEN c.nx AND c.cx
        WHERE x.railway_track_id IS NOT NULL AND
          c.cy + (r.x1 - x.x - c.cx) / (c.nx - c.cx) * (c.ny - c.cy) >= greatest(least(r.y1, r.y2) - x.y, x.y - greatest(r.y1, r.y2))""",
    "o_flags": """SELECT x.*,
          EXISTS (SELECT 1 FROM fx_streams s WHERE s.linear_feature_id = x.linear_feature_id AND s.stream_order >= 6
            AND s.linear_feature_id <> 701296585) AS f1,
          EXISTS (SELECT 1 FROM fx_streams s WHERE s.linear_feature_id = x.linear_feature_id
            AND s.edge_type IN (1200, 1250, 1300, 1350, 1400, 1450, 1475)) AS f2,
          EXISTS (SELECT 1 FROM o_mot_near m WHERE m.cid = x.id) AS f3,
          EXISTS (SELECT 1 FROM fx_pscis_events e JOIN fx_pscis_points p USING (stream_crossing_id)
            WHERE p.current_crossing_type_code = 'OBS' AND e.linear_feature_id = x.linear_feature_id
            AND abs(e.downstream_route_measure - x.downstream_route_measure) < 15) AS f4,
          EXISTS (SELECT 1 FROM fx_dra r WHERE r.transport_line_id = x.transport_line_id
            AND r.transport_line_structure_code IN ('B', 'C', 'E', 'F', 'O', 'R', 'V')) AS f5,
          EXISTS (SELECT 1 FROM o_rail_near b WHERE b.cid = x.id) AS f6
        FROM o_merged3 x""",
    "o_final": """SELECT *, CASE WHEN f1 OR f2 OR f3 OR f4 OR f5 OR f6 THEN 'OBS' ELSE 'CBS' END AS kind,
          nullif(concat_ws('; ', CASE WHEN f1 THEN 'FWA_STREAM_ORDER' END, CASE WHEN f2 THEN 'FWA_EDGE_TYPE' END,
            CASE WHEN f3 THEN 'MOT_ROAD_STRUCTURE_SP' END, CASE WHEN f4 THEN 'PSCIS' END,
            CASE WHEN f5 THEN 'TRANSPORT_LINE_STRUCTURE_CODE' END, CASE WHEN f6 THEN 'GBA_RAILWAY_STRUCTURE_LINES_SP' END), '') AS tags
        FROM o_flags""",
    "o_archive": "SELECT CAST(id + 500 AS BIGINT) AS crossing_id, x + id % 12 AS x, y FROM o_numbered WHERE id % 3 = 0",
    "o_archive_near": f"""SELECT id, archive_id, d, row_number() OVER (PARTITION BY archive_id ORDER BY d, id) AS place FROM (
          SELECT x.id, a.crossing_id AS archive_id, {um('sqrt(pow(x.x - a.x, 2) + pow(x.y - a.y, 2))')} AS d, row_number() OVER (
            PARTITION BY x.id ORDER BY {um('sqrt(pow(x.x - a.x, 2) + pow(x.y - a.y, 2))')}, a.crossing_id) AS rn
          FROM o_numbered x JOIN o_archive a ON a.x BETWEEN x.x - 11 AND x.x + 11 AND a.y BETWEEN x.y - 11 AND x.y + 11)
        WHERE rn = 1 AND d < 10""",
}

_ALL = {**VIEWS, **ORACLE_VIEWS}
_PATTERN_ORDER = list(_ALL)


def _needs(sql: str) -> list[str]:
    import re
    words = set(re.findall(r"\b(?:fx|o)_[a-z0-9_]+", sql))
    return [v for v in _PATTERN_ORDER if v in words]


def with_views(body: str) -> str:
    """``body`` preceded by the views it needs."""
    wanted: set[str] = set()

    def add(sql: str) -> None:
        for name in _needs(sql):
            if name not in wanted:
                wanted.add(name)
                add(_ALL[name])
    add(body)
    ctes = [f"{v} AS MATERIALIZED ({_ALL[v]})" for v in _PATTERN_ORDER if v in wanted]
    return f"WITH RECURSIVE {', '.join(ctes)} {body}" if ctes else body
