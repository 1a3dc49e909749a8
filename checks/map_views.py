"""A synthetic map derived from the driver's tables by integer arithmetic.

The views are plain SQL that Spark and DuckDB both run: one 200 m block per row of ``part``, 50 blocks in a row of the
map, an L-shaped stream in each block, roads and railways through the blocks from ``orders``, ``customer``, ``supplier``
and ``events``. Sizes grow with the tables and the density stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linecross import schema
from linecross.staging import stage

TABLES = ("part", "orders", "customer", "supplier", "events")

_N = "(SELECT count(*) FROM part)"
_TURN = f"CAST(floor({{id}} / CAST({_N} AS DOUBLE)) AS BIGINT)"


def _turn(column: str) -> str:
    """How often the ids have gone round all blocks; shifts later lines within their block."""
    return _TURN.format(id=column)


_ALONG = f"(o.o_orderkey * 37 + {_turn('o.o_orderkey')} * 23) % 200"
_UP = f"(o.o_orderkey * 53 + {_turn('o.o_orderkey')} * 31) % 200"
_RAIL_X = f"s.bx + (e.event_id * 29 + {_turn('e.event_id')} * 17) % 100"

VIEWS = {
    "fx_streams": """
        SELECT p_partkey + 1000 AS linear_feature_id, p_partkey AS k,
          concat('W', lpad(CAST(p_partkey % 7 AS STRING), 2, '0')) AS watershed_group_code,
          CASE WHEN p_partkey % 41 = 0 THEN '999-1' WHEN p_partkey % 43 = 0 THEN NULL ELSE '100-2' END AS fwa_watershed_code,
          CASE WHEN p_partkey % 31 = 0 THEN 1425 WHEN p_partkey % 6 = 0 THEN 1250 ELSE 1000 END AS edge_type,
          CASE WHEN p_partkey % 3 = 0 THEN '100.1' ELSE '100' END AS wscode_ltree,
          CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE '100.2' END AS localcode_ltree,
          CAST(p_partkey % 1000 + 360000 AS INT) AS blue_line_key,
          CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_size % 8 + 1 END AS stream_order,
          CAST(200 AS DOUBLE) AS length_metre, (p_partkey % 9) * CAST(100 AS DOUBLE) AS downstream_route_measure,
          (p_partkey % 50) * CAST(200 AS DOUBLE) AS bx, floor(p_partkey / CAST(50 AS DOUBLE)) * CAST(200 AS DOUBLE) AS b_y
        FROM part""",
    "fx_stream_segs": """
        SELECT linear_feature_id, watershed_group_code, 0 AS seg_no, bx AS x1, b_y + 50 AS y1,
          downstream_route_measure AS m1, bx + 100 AS x2, b_y + 50 AS y2, downstream_route_measure + 100 AS m2
        FROM fx_streams
        UNION ALL
        SELECT linear_feature_id, watershed_group_code, 1, bx + 100, b_y + 50, downstream_route_measure + 100,
          bx + 100, b_y + 150, downstream_route_measure + 200
        FROM fx_streams""",
    "fx_dra": f"""
        SELECT o.o_orderkey AS transport_line_id,
          CASE o.o_orderpriority WHEN '1-URGENT' THEN 'RH1' WHEN '2-HIGH' THEN 'RA1' WHEN '3-MEDIUM' THEN 'RLO'
            WHEN '5-LOW' THEN 'RRS' ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'F' ELSE 'RC2' END END AS transport_line_type_code,
          CASE WHEN o.o_orderkey % 17 = 0 THEN 'D' WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE 'P' END AS transport_line_surface_code,
          CASE WHEN o.o_orderkey % 23 = 0 THEN 'T' WHEN o.o_orderkey % 11 = 0 THEN 'B' ELSE NULL END AS transport_line_structure_code,
          CASE WHEN o.o_orderkey % 3 = 0 THEN s.bx ELSE s.bx + {_ALONG} END AS x1,
          CASE WHEN o.o_orderkey % 3 = 0 THEN s.b_y + {_UP} ELSE s.b_y END AS y1,
          CASE WHEN o.o_orderkey % 3 = 0 THEN s.bx + 200 WHEN o.o_orderkey % 3 = 1 THEN s.bx + {_ALONG}
            ELSE s.bx + {_ALONG} - 64 END AS x2,
          CASE WHEN o.o_orderkey % 3 = 0 THEN s.b_y + {_UP} ELSE s.b_y + 200 END AS y2
        FROM orders o JOIN fx_streams s ON s.k = o.o_orderkey % {_N}""",
    "fx_ften_lines": """
        SELECT concat('F', CAST(c.c_custkey AS STRING)) AS id, c.c_custkey AS k,
          CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'RETIRED' WHEN 'FURNITURE' THEN 'PENDING' WHEN 'HOUSEHOLD' THEN NULL
            ELSE 'ACTIVE' END AS life_cycle_status_code,
          d.x1 + c.c_custkey % 40 AS x1, d.y1 AS y1, d.x2 + c.c_custkey % 40 AS x2, d.y2 AS y2
        FROM customer c JOIN fx_dra d ON d.transport_line_id = c.c_custkey * 10 + 1""",
    "fx_ften": """
        SELECT id, life_cycle_status_code, 0 AS part_no, x1, y1, x2, y2 FROM fx_ften_lines
        UNION ALL
        SELECT id, life_cycle_status_code, 1, x1 + 60, y1, x2 + 60, y2 FROM fx_ften_lines WHERE k % 4 = 0""",
    "fx_ogc": """
        SELECT s.s_suppkey AS og_road_segment_permit_id, CASE WHEN s.s_acctbal < 0 THEN 'Cancelled' ELSE 'Approved' END AS status,
          CASE WHEN s.s_suppkey % 9 = 4 THEN 'Snow Ice Road' WHEN s.s_suppkey % 10 = 3 THEN NULL ELSE 'All Season' END AS road_type_desc,
          d.x1 + s.s_suppkey % 40 AS x1, d.y1 AS y1, d.x2 + s.s_suppkey % 40 AS x2, d.y2 AS y2
        FROM supplier s JOIN fx_dra d ON d.transport_line_id = s.s_suppkey * 150 + 2""",
    "fx_ogcpre06": """
        SELECT e.event_id AS og_petrlm_dev_rd_pre06_pub_id,
          CASE WHEN e.event_type = 'error' THEN 'WINT' ELSE 'HIGH' END AS petrlm_development_road_type,
          d.x1 + e.event_id % 37 AS x1, d.y1 AS y1, d.x2 + e.event_id % 37 AS x2, d.y2 AS y2
        FROM events e JOIN fx_dra d ON d.transport_line_id = e.event_id WHERE e.event_id % 25 = 4""",
    "fx_rail": f"""
        SELECT e.event_id AS railway_track_id, {_RAIL_X} AS x1, s.b_y AS y1, {_RAIL_X} AS x2, s.b_y + 200 AS y2
        FROM events e JOIN fx_streams s ON s.k = e.event_id % {_N} WHERE e.event_id % 5 = 2""",
    "fx_rail_struct": """
        SELECT railway_track_id AS structure_id, CASE WHEN railway_track_id % 3 = 0 THEN 'Bridge - Steel'
            WHEN railway_track_id % 3 = 1 THEN 'Tunnel' ELSE 'Snowshed' END AS structure_type,
          x1, y1 + 40 AS y1, x2, y1 + 60 AS y2
        FROM fx_rail WHERE railway_track_id % 2 = 0""",
    "fx_mot": f"""
        SELECT e.event_id AS hwy_structure_class_id, CASE WHEN e.event_type = 'click' THEN 'Bridge' ELSE 'CULVERT' END AS bmis_structure_type,
          CASE WHEN e.event_id % 4 = 1 THEN 'Closed' ELSE 'Open/In Use' END AS bmis_struct_status_type_desc,
          d.x1 + e.event_id % 30 AS x, s.b_y + 50 AS y
        FROM events e JOIN fx_dra d ON d.transport_line_id = e.event_id
          JOIN fx_streams s ON s.k = e.event_id % {_N} WHERE e.event_id % 5 = 3""",
    "fx_pscis_events": f"""
        SELECT e.event_id AS stream_crossing_id, e.event_id % {_N} + 1000 AS linear_feature_id,
          ((e.event_id % {_N}) % 9) * CAST(100 AS DOUBLE)
            + (e.event_id * 7 + {_turn('e.event_id')} * 37) % 200 AS downstream_route_measure
        FROM events e WHERE e.event_id % 5 = 4""",
    "fx_pscis_points": """
        SELECT event_id AS stream_crossing_id, CASE WHEN event_type = 'view' THEN 'OBS' ELSE 'CBS' END AS current_crossing_type_code
        FROM events WHERE event_id % 5 = 4 AND event_id % 3 <> 0""",
    "fx_type_codes": """
        SELECT DISTINCT transport_line_type_code, concat('class ', lower(transport_line_type_code)) AS description FROM fx_dra""",
}

_DEPENDS = {name: [v for v in VIEWS if v != name and v in sql] for name, sql in VIEWS.items()}


def needed_views(names: list[str]) -> list[str]:
    """The views and all they refer to, in order of definition."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _DEPENDS[name]:
                add(other)
    for name in names:
        add(name)
    return [v for v in VIEWS if v in wanted]


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in TABLES]
    views = [f"{v} AS ({VIEWS[v]})" for v in needed_views([name])]
    return spark.sql(f"WITH {', '.join(tables + views)} SELECT * FROM {name}")


def _vertex(x: str, y: str, m: str | None = None) -> str:
    m = f"CAST({m} AS DOUBLE)" if m else "CAST(NULL AS DOUBLE)"
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE), 'z', {m} / 10, 'm', {m})"


def _part(shift: int = 0) -> str:
    return f"array({_vertex(f'x1 + {shift}', 'y1')}, {_vertex(f'x2 + {shift}', 'y2')})"


_M = "downstream_route_measure"
# view and geometry of each layer
_LAYERS = {
    "streams": ("fx_streams", "array(array(" + ", ".join([
        _vertex("bx", "b_y + 50", _M), _vertex("bx + 100", "b_y + 50", f"{_M} + 100"),
        _vertex("bx + 100", "b_y + 150", f"{_M} + 200")]) + "))"),
    "dra": ("fx_dra", f"array({_part()})"),
    "ften": ("fx_ften_lines", f"CASE WHEN k % 4 = 0 THEN array({_part()}, {_part(60)}) ELSE array({_part()}) END"),
    "ogc": ("fx_ogc", f"array({_part()})"),
    "ogcpre06": ("fx_ogcpre06", f"array({_part()})"),
    "rail": ("fx_rail", f"array({_part()})"),
    "rail_structures": ("fx_rail_struct", f"array({_part()})"),
    "mot": ("fx_mot", _vertex("x", "y")),
    "pscis_events": ("fx_pscis_events", None),
    "pscis_points": ("fx_pscis_points", None),
}
_SCHEMAS = {
    "streams": schema.STREAMS, "dra": schema.DRA, "ften": schema.FTEN, "ogc": schema.OGC, "ogcpre06": schema.OGCPRE06,
    "rail": schema.RAIL, "rail_structures": schema.RAIL_STRUCTURES, "mot": schema.MOT,
    "pscis_events": schema.PSCIS_EVENTS, "pscis_points": schema.PSCIS_POINTS,
}
LAYER_NAMES = tuple(_LAYERS)
_staged: dict[tuple[str, str, str], DataFrame] = {}


def remembered(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """Staged result of ``make()``, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        _staged[key] = stage(make(), name)
    return _staged[key]


def forget(name: str | None = None) -> None:
    for key in [k for k in _staged if name is None or k[2] == name]:
        del _staged[key]


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A layer of the map with the library's schema, as a table."""
    def make() -> DataFrame:
        view, geom = _LAYERS[name]
        # a real layer has many files; without this a small one is a single scan task. The shapes are made after it, so they are not shuffled
        df = spark_view(spark, sf_dir, view).repartition(spark.sparkContext.defaultParallelism)
        if geom:
            df = df.withColumn("geom", F.expr(geom))
        if name == "streams":
            df = df.withColumn("waterbody_key", F.lit(None)).withColumn("upstream_route_measure", F.col(_M) + F.col("length_metre"))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _SCHEMAS[name]])
    return remembered(spark, sf_dir, f"layer-{name}", make)


def all_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: layer(spark, sf_dir, name) for name in LAYER_NAMES}
