"""Schemas of the layers and of the crossings table.

A line is an array of parts, a part an array of vertices; a point is one vertex. Coordinates are metres in
one projected reference system, ``m`` is the measure along a stream and NULL on transport lines.
"""

from __future__ import annotations

from pyspark.sql import types as T

SRID = 3005

VERTEX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y", "z", "m")])
POINT = VERTEX
LINE = T.ArrayType(T.ArrayType(VERTEX))


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_str, _int, _long, _dbl = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

STREAMS = _schema(
    linear_feature_id=_long, watershed_group_code=_str, fwa_watershed_code=_str, edge_type=_int,
    wscode_ltree=_str, localcode_ltree=_str, blue_line_key=_int, waterbody_key=_int, length_metre=_dbl,
    downstream_route_measure=_dbl, upstream_route_measure=_dbl, stream_order=_int, geom=LINE,
)
DRA = _schema(
    transport_line_id=_int, transport_line_type_code=_str, transport_line_surface_code=_str,
    transport_line_structure_code=_str, geom=LINE,
)
FTEN = _schema(id=_str, life_cycle_status_code=_str, geom=LINE)
OGC = _schema(og_road_segment_permit_id=_int, status=_str, road_type_desc=_str, geom=LINE)
OGCPRE06 = _schema(og_petrlm_dev_rd_pre06_pub_id=_int, petrlm_development_road_type=_str, geom=LINE)
RAIL = _schema(railway_track_id=_int, geom=LINE)
RAIL_STRUCTURES = _schema(structure_id=_int, structure_type=_str, geom=LINE)
MOT = _schema(
    hwy_structure_class_id=_int, bmis_structure_type=_str, bmis_struct_status_type_desc=_str, geom=POINT,
)
PSCIS_EVENTS = _schema(stream_crossing_id=_int, linear_feature_id=_long, downstream_route_measure=_dbl)
PSCIS_POINTS = _schema(stream_crossing_id=_int, current_crossing_type_code=_str)
ARCHIVE = _schema(crossing_id=_int, geom=POINT)

#: The output table: one row per crossing.
CROSSINGS = T.StructType([
    T.StructField("modelled_crossing_id", _int),
    T.StructField("modelled_crossing_type", _str),
    T.StructField("modelled_crossing_type_source", T.ArrayType(_str)),
    T.StructField("transport_line_id", _int),
    T.StructField("ften_road_section_lines_id", _str),
    T.StructField("og_road_segment_permit_id", _int),
    T.StructField("og_petrlm_dev_rd_pre06_pub_id", _int),
    T.StructField("railway_track_id", _int),
    T.StructField("linear_feature_id", _long),
    T.StructField("blue_line_key", _int),
    T.StructField("downstream_route_measure", _dbl),
    T.StructField("wscode_ltree", _str),
    T.StructField("localcode_ltree", _str),
    T.StructField("watershed_group_code", _str),
    T.StructField("geom", POINT, metadata={"srid": SRID}),
])

#: Id column of each source in the crossings table, highest priority first.
SOURCE_ID_COLUMNS = {
    "dra": "transport_line_id",
    "ften": "ften_road_section_lines_id",
    "ogc": "og_road_segment_permit_id",
    "ogcpre06": "og_petrlm_dev_rd_pre06_pub_id",
    "rail": "railway_track_id",
}
