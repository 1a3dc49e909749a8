"""Sources, sinks and the whole job as queries: layers go through files in each format, results are written and read back."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks.catalog import _ID_COLUMNS, _ID_SQL, _SRC, _WITH_SOURCE, _r, final_crossings, register
from checks.map_views import all_layers, layer
from linecross import schema
from linecross.operators.filters import union_sources
from linecross.operators.lines import explode_parts
from linecross.plans import crossings as plans, job, reports
from linecross.sources.layers import read_layer
from linecross.sources.sinks import write_crossings, write_report
from linecross.staging import new_path

_CATALOGUE = ("streams", "ften", "ogc", "ogcpre06", "rail", "mot")
_SCHEMAS = {"streams": schema.STREAMS, "ften": schema.FTEN, "ogc": schema.OGC, "ogcpre06": schema.OGCPRE06, "rail": schema.RAIL, "mot": schema.MOT}
_paths: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf: str, name: str, write) -> str:
    """Path of what ``write(path)`` has written, once per application and folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _paths:
        path = new_path(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


@register("read_parquet_layer", """
    SELECT linear_feature_id, watershed_group_code, CAST(3 AS BIGINT) AS n_vertices, round(bx, 6) AS x, round(b_y + 50, 6) AS y,
      round(downstream_route_measure, 6) AS m FROM fx_streams WHERE stream_order >= 3""")
def _(spark, sf):
    path = stored(spark, sf, "parquet-streams", lambda p: layer(spark, sf, "streams").write.parquet(p))
    rows = read_layer(spark, path, schema.STREAMS).where("stream_order >= 3")
    return rows.selectExpr("linear_feature_id", "watershed_group_code", "CAST(size(geom[0]) AS BIGINT) AS n_vertices",
                           *[f"round(geom[0][0].{axis}, 6) AS {axis}" for axis in "xym"])


_ENDS = ["round(geom[0][0].x, 6) AS x1", "round(geom[0][0].y, 6) AS y1", "round(geom[0][1].x, 6) AS x2", "round(geom[0][1].y, 6) AS y2"]
_XY = ", ".join(_r("x1", "y1", "x2", "y2"))


def _features(rows: DataFrame, id_col: str) -> DataFrame:
    """GeoJSON features as structs: the id on the feature, the other columns as properties."""
    others = ", ".join(f"'{c}', {c}" for c in rows.columns if c not in (id_col, "geom"))
    coordinates = "transform(geom, p -> transform(p, v -> array(v.x, v.y)))"
    return rows.selectExpr(id_col, f"named_struct('type', 'Feature', 'id', CAST({id_col} AS STRING), 'properties', named_struct({others}), "
                                   f"'geometry', named_struct('type', 'MultiLineString', 'coordinates', {coordinates})) AS feature")


@register("read_geojsonl_layer", f"SELECT transport_line_id, transport_line_type_code, transport_line_structure_code, {_XY} FROM fx_dra")
def _(spark, sf):
    features = _features(layer(spark, sf, "dra"), "transport_line_id").selectExpr("to_json(feature) AS value")
    path = stored(spark, sf, "geojsonl-dra", lambda p: features.write.text(p))
    return read_layer(spark, path, schema.DRA, "transport_line_id", "geojsonl").selectExpr(
        "CAST(transport_line_id AS BIGINT) AS transport_line_id", "transport_line_type_code", "transport_line_structure_code", *_ENDS)


@register("read_geojson_layer", f"SELECT og_road_segment_permit_id, status, {_XY} FROM fx_ogc")
def _(spark, sf):
    """Collections of two thousand features, one per file, each read in ranges of 16 KB by tasks of their own."""
    features = _features(layer(spark, sf, "ogc"), "og_road_segment_permit_id").selectExpr(
        "og_road_segment_permit_id AS id", "og_road_segment_permit_id DIV 2000 AS part", "to_json(feature) AS value")

    def write(path: str) -> None:
        place = Window.partitionBy("part").orderBy("id")
        lines = features.withColumn("at", F.row_number().over(place)).selectExpr("part", "at", "IF(at = 1, value, concat(',', value)) AS value")
        frame = lines.select("part").distinct().select("part", F.inline(F.array(*[F.struct(F.lit(at).alias("at"), F.lit(text).alias("value")) for at, text in (
            (0, '{"type": "FeatureCollection", "features": ['), (1 << 30, "]}"))])))
        lines.unionByName(frame).repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(path)
    path = stored(spark, sf, "geojson-ogc", write)
    return read_layer(spark, f"{path}/*", schema.OGC, "og_road_segment_permit_id", "geojson", range_bytes=1 << 14).selectExpr(
        "CAST(og_road_segment_permit_id AS BIGINT) AS og_road_segment_permit_id", "status", *_ENDS)


def _as_wkb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Multi-lines as WKB, in the byte order that the length of the id chooses."""
    for batch in batches:
        shapes = []
        for name, parts in zip(batch.column("id").to_pylist(), batch.column("geom").to_pylist()):
            order = "<" if len(name) % 2 else ">"
            lines = [struct.pack(f"{order}BII{2 * len(p)}d", order == "<", 2, len(p), *[v[axis] for v in p for axis in "xy"]) for p in parts]
            shapes.append(struct.pack(f"{order}BII", order == "<", 5, len(parts)) + b"".join(lines))
        yield batch.set_column(batch.schema.get_field_index("geom"), "geom", pa.array(shapes, pa.binary()))


@register("read_wkb_layer", f"SELECT id, life_cycle_status_code, CAST(part_no AS BIGINT) AS part_no, {_XY} FROM fx_ften")
def _(spark, sf):
    shapes = layer(spark, sf, "ften").mapInArrow(_as_wkb, "id string, life_cycle_status_code string, geom binary")
    path = stored(spark, sf, "wkb-ften", lambda p: shapes.write.parquet(p))
    rows = read_layer(spark, path, schema.FTEN, fmt="wkb", reject="unread").where("unread IS NULL")
    return explode_parts(rows).selectExpr("id", "life_cycle_status_code", "CAST(part_no AS BIGINT) AS part_no",
                                          *[e.replace("geom[0]", "part") for e in _ENDS])


@register("catalogue_layers", " UNION ALL ".join(
    f"SELECT '{name}' AS layer, count(*) AS n FROM {view}" for name, view in zip(_CATALOGUE, (
        "fx_streams", "fx_ften_lines", "fx_ogc", "fx_ogcpre06", "fx_rail", "fx_mot"))))
def _(spark, sf):
    """The six layers of the catalogue, stored whole and read with their schemas."""
    counts = []
    for name in _CATALOGUE:
        path = stored(spark, sf, f"catalogue-{name}", lambda p: layer(spark, sf, name).write.parquet(p))
        counts.append(read_layer(spark, path, _SCHEMAS[name]).agg(F.lit(name).alias("layer"), F.count("*").alias("n")))
    return union_sources(*counts)


# --- sinks ------------------------------------------------------------------------------------------------

_KEY = "modelled_crossing_id"


@register("write_crossings", f"SELECT id AS crossing_id, watershed_group_code, kind AS modelled_crossing_type, {_ID_SQL} FROM o_final")
def _(spark, sf):
    path = stored(spark, sf, "crossings", lambda p: write_crossings(final_crossings(spark, sf), p))
    return spark.read.schema(schema.CROSSINGS).parquet(path).selectExpr(
        f"CAST({_KEY} AS BIGINT) AS crossing_id", "watershed_group_code", "modelled_crossing_type", *_ID_COLUMNS)


@register("write_single_regions", """
    SELECT CASE WHEN watershed_group_code = 'W01' THEN id + 1000000 ELSE id END AS crossing_id, watershed_group_code FROM o_final""")
def _(spark, sf):
    """One region written again over the whole table: the others stay as they are."""
    def write(path: str) -> None:
        rows = final_crossings(spark, sf)
        write_crossings(rows, path)
        again = rows.where("watershed_group_code = 'W01'").withColumn(_KEY, F.expr(f"CAST({_KEY} + 1000000 AS INT)"))
        write_crossings(again, path, single_regions=True)
    return spark.read.schema(schema.CROSSINGS).parquet(stored(spark, sf, "single-regions", write)).selectExpr(
        f"CAST({_KEY} AS BIGINT) AS crossing_id", "watershed_group_code")


@register("write_report", f"""
    SELECT watershed_group_code, count(*) AS total, count(*) FILTER (kind = 'CBS') AS xing_type_cbs,
      count(*) FILTER (kind = 'OBS') AS xing_type_obs, {_SRC} FROM {_WITH_SOURCE} GROUP BY watershed_group_code""")
def _(spark, sf):
    report = reports.report_region(final_crossings(spark, sf))
    path = stored(spark, sf, "report", lambda p: write_report(report, p))
    return spark.read.schema(report.schema).option("header", True).csv(path)


# --- the job ----------------------------------------------------------------------------------------------

@register("rejected_crossings", f"""
    SELECT source, linear_feature_id, '{plans.REASONS["off_measure"]}' AS reason, count(*) AS n
    FROM o_clusters WHERE source <> 'dra' AND linear_feature_id % 5 = 0 GROUP BY ALL""")
def _(spark, sf):
    """Clusters on streams whose measures lie elsewhere, of all sources without road classes."""
    moved = ("transform(geom, p -> transform(p, v -> named_struct('x', v.x, 'y', v.y, 'z', v.z, "
             "'m', CASE WHEN linear_feature_id % 5 = 0 THEN v.m + 1000000 ELSE v.m END)))")
    streams = layer(spark, sf, "streams").withColumn("geom", F.expr(moved))
    layers = {name: layer(spark, sf, name) for name in job.LINE_LAYERS if name != "dra"}
    path = stored(spark, sf, "rejected", lambda p: plans.find_crossings(streams, layers, rejects=p))
    return spark.read.parquet(path).groupBy("source", "linear_feature_id", "reason").agg(F.count("*").alias("n"))


def _finished(spark: SparkSession, sf: str) -> str:
    return stored(spark, sf, "run", lambda p: job.run(spark, all_layers(spark, sf), p, snapshot=True))


@register("run", f"""
    SELECT {', '.join(f"CAST(0 AS BIGINT) AS {name}" for name in plans.REASONS)}, (SELECT count(*) FROM o_numbered) AS found, count(*) AS kept,
      count(*) FILTER (kind = 'OBS') AS obs, count(*) FILTER (kind = 'CBS') AS cbs, count(*) FILTER (kind = 'OBS') AS tagged,
      (SELECT count(*) FROM o_numbered) - count(*) AS merged FROM o_final""")
def _(spark, sf):
    """The whole job's summary; on this map every cluster gives a crossing."""
    return spark.read.parquet(f"{_finished(spark, sf)}/summary")


@register("snapshot", f"SELECT id AS crossing_id, {_ID_SQL}, watershed_group_code FROM o_numbered")
def _(spark, sf):
    return spark.read.schema(schema.CROSSINGS).parquet(f"{_finished(spark, sf)}/snapshot").selectExpr(
        f"CAST({_KEY} AS BIGINT) AS crossing_id", *_ID_COLUMNS, "watershed_group_code")
