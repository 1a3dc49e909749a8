"""From filtered streams and transport lines to crossing points on the streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F

from linecross.functions import planar
from linecross.operators import filters
from linecross.operators.cluster import cluster_centroids
from linecross.operators.lines import merge_parts
from linecross.operators.nearest import nearest_k
from linecross.operators.overlay import intersect_lines
from linecross.schema import SOURCE_ID_COLUMNS
from linecross.staging import stage

# Fixed distances in metres.
ACROSS_STREAMS_TOLERANCE = 10.0
STREAM_DISTANCE = 5.01
ROAD_DISTANCE = 16.0
NEIGHBOURS = 5

_STREAM = "linear_feature_id"
_REGION = "watershed_group_code"
_LAYER_IDS = {"dra": "transport_line_id", "ften": "id", "ogc": "og_road_segment_permit_id",
              "ogcpre06": "og_petrlm_dev_rd_pre06_pub_id", "rail": "railway_track_id"}
_LAYER_FILTERS = {"dra": filters.filter_dra, "ften": filters.filter_ften, "ogc": filters.filter_ogc,
                  "ogcpre06": filters.filter_ogcpre06, "rail": filters.filter_rail}


def transport_lines(layers: Mapping[str, DataFrame], tolerances: Mapping[str, float] | None = None) -> DataFrame:
    """The filtered layers in one table ``source, line_number, line_text, tolerance, geom``.

    One table lets a single overlay and a single clustering pass serve all sources.
    """
    tolerances = {**filters.SOURCE_TOLERANCES, **(tolerances or {})}

    def one(source: str, df: DataFrame) -> DataFrame:
        line_id, text = F.col(_LAYER_IDS[source]), source == "ften"
        tolerance = F.lit(float(tolerances[source])) if source != "dra" else filters.tolerance_of_class(
            F.col("transport_line_type_code"))
        return _LAYER_FILTERS[source](df).select(
            F.lit(source).alias("source"), (F.lit(None) if text else line_id).cast("long").alias("line_number"),
            (line_id if text else F.lit(None)).cast("string").alias("line_text"), tolerance.alias("tolerance"), "geom")
    return filters.union_sources(*[one(source, df) for source, df in layers.items()])


def overlay(streams: DataFrame, lines: DataFrame, part_pairing: str = "lockstep", cell: float = 100.0) -> DataFrame:
    """Staged intersection pieces of filtered streams and ``transport_lines``."""
    pieces = intersect_lines(lines, streams, "line_number", _STREAM, ["source", "line_text", "tolerance"], [_REGION],
                             part_pairing, cell)
    return stage(pieces.drop("left_part", "right_part"), "pieces")


def _on_streams(points: DataFrame, streams: DataFrame) -> DataFrame:
    """``points`` (``linear_feature_id, x, y``) with the stream's attributes and ``measure`` of the nearest place."""
    wanted = streams.select(_STREAM, _REGION, "blue_line_key", "wscode_ltree", "localcode_ltree", "length_metre",
                            F.col("downstream_route_measure").alias("_offset"), "stream_order", F.col("geom").alias("_line"))
    shared = [c for c in points.columns if c in wanted.columns and c != _STREAM]
    joined = merge_parts(points.drop(*shared).join(wanted, _STREAM), "_line", "_merged")
    measure = f"{planar.fraction_along('_merged', 'x', 'y')} * length_metre + _offset AS measure"
    return joined.selectExpr("* EXCEPT (_merged, _offset)", measure)


def _crossing_columns(df: DataFrame) -> DataFrame:
    """Columns of the crossings table, without id and type, from ``source, line_*`` and the stream columns."""
    types = {"ften": "string"}
    ids = [F.when(F.col("source") == source, F.col("line_text" if source == "ften" else "line_number"))
           .cast(types.get(source, "int")).alias(column) for source, column in SOURCE_ID_COLUMNS.items()]
    return df.select(*ids, _STREAM, F.col("blue_line_key").cast("int").alias("blue_line_key"),
                     F.col("measure").alias("downstream_route_measure"), "wscode_ltree", "localcode_ltree", _REGION, "geom")


_LOST = ("source", _REGION, _STREAM, "x", "y", "reason")
#: Why a cluster gives no crossing.
REASONS = {"unmeasured": "the stream takes no measure", "off_measure": "the measure is not on the stream",
           "off_stream": "no stream close by takes a measure", "off_road": "no road close by"}


def _unplaced(measured: DataFrame) -> DataFrame:
    """Rows of ``_on_streams`` whose measure leads to no place, and why."""
    reason = f"CASE WHEN measure IS NULL THEN '{REASONS['unmeasured']}' ELSE '{REASONS['off_measure']}' END AS reason"
    return measured.where(f"coalesce(size({planar.points_at_measure('_line', 'measure')}), 0) < 1").selectExpr("* EXCEPT (measure)", reason).select(*_LOST)


def _simple_crossings(measured: DataFrame) -> DataFrame:
    """One crossing per cluster: moved along its stream, then placed by the measure."""
    return _crossing_columns(measured.selectExpr("*", f"explode({planar.points_at_measure('_line', 'measure')}) AS geom"))


def _dra_crossings(centroids: DataFrame, pieces: DataFrame, streams: DataFrame, roads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clusters joined across streams, then given a stream and a road again through their nearest pieces; and those that get none."""
    as_points = centroids.select(_REGION, *[F.col(axis).alias(f"{axis}{n}") for n in (1, 2) for axis in "xy"])
    merged = cluster_centroids(as_points, [_REGION], ACROSS_STREAMS_TOLERANCE)
    spots = stage(merged.select(_REGION, "x", "y").distinct(), "dra-spots")

    # the stream: of the five nearest pieces those on a stream close by, and of these the highest order
    neighbours = nearest_k(spots, pieces, NEIGHBOURS, [_STREAM, "line_number", "x1", "y1", "x2", "y2"], [_REGION])
    candidates = neighbours.groupBy(_REGION, "x", "y", _STREAM).agg(F.min("distance").alias("distance"))
    candidates = candidates.withColumnRenamed(_REGION, "_region")
    measured = _on_streams(candidates, streams).where(f"{planar.distance_to_line('_line', 'x', 'y')} < {STREAM_DISTANCE}D")
    order = F.struct(F.coalesce(-F.col("stream_order"), F.lit(-2 ** 31)), "distance", _STREAM)
    carried = [_STREAM, _REGION, "blue_line_key", "wscode_ltree", "localcode_ltree", "measure", "hits"]
    best = measured.withColumn("hits", F.expr(planar.points_at_measure("_line", "measure"))).groupBy("_region", "x", "y").agg(
        F.min_by(F.struct(*carried), order).alias("_best"))
    located = best.select(F.struct("_region", "x", "y").alias("spot"), "_best.*").select(
        "*", F.posexplode("hits").alias("hit", "geom")).drop("hits")
    located = stage(located.withColumns({"x": F.col("geom.x"), "y": F.col("geom.y")}), "dra-located")

    # the road: the nearest piece's, if that road passes close by
    spots_on_stream = located.select("spot", "hit", _REGION, "x", "y")
    ties = ["line_number", "stream", "x1", "y1", "x2", "y2"]
    nearest = nearest_k(spots_on_stream, pieces.withColumnRenamed(_STREAM, "stream"), 1, ties, [_REGION])
    road_lines = roads.select(F.col("line_number"), F.col("geom").alias("_line"))
    near = nearest.select("spot", "hit", "line_number", "x", "y").join(road_lines, "line_number").where(
        f"{planar.distance_to_line('_line', 'x', 'y')} < {ROAD_DISTANCE}D")
    chosen = near.select("spot", "hit", "line_number").distinct()  # a road may have several rows
    rows = located.join(chosen, ["spot", "hit"]).withColumns({"source": F.lit("dra"), "line_text": F.lit(None).cast("string")})
    off_stream = spots.join(located.select("spot.*").withColumnRenamed("_region", _REGION), [_REGION, "x", "y"], "left_anti").withColumns(
        {_STREAM: F.lit(None).cast(streams.schema[_STREAM].dataType), "reason": F.lit(REASONS["off_stream"])})
    off_road = located.join(chosen, ["spot", "hit"], "left_anti").withColumn("reason", F.lit(REASONS["off_road"]))
    lost = [part.withColumn("source", F.lit("dra")).select(*_LOST) for part in (off_stream, off_road)]
    return _crossing_columns(rows), lost[0].unionByName(lost[1])


def find_crossings(streams: DataFrame, layers: Mapping[str, DataFrame], part_pairing: str = "lockstep",
                   id_scope: str = "group", cell: float = 100.0, tolerances: Mapping[str, float] | None = None,
                   rejects: str | None = None, rejected: Observation | None = None) -> DataFrame:
    """Crossings of all given layers (keys of ``SOURCE_ID_COLUMNS``), before ids, merging and classification.

    ``rejects``: a path for the clusters that give no crossing, with the reason (a stream whose parts do not meet, a measure beyond
    it, no stream or no road close by), as Parquet; ``rejected`` observes their number by reason (names of ``REASONS``).
    """
    streams = filters.filter_streams(streams)
    lines = transport_lines(layers, tolerances)
    pieces = overlay(streams, lines, part_pairing, cell)
    centroids = stage(cluster_centroids(
        pieces, ["source", _REGION, _STREAM], "tolerance", ["line_number", "line_text"], id_scope), "centroids")
    found, lost = [], []
    if set(layers) - {"dra"}:
        # both the crossings and the rejects are made of it
        measured = stage(_on_streams(centroids.where(F.col("source") != "dra"), streams), "measured") if rejects else _on_streams(
            centroids.where(F.col("source") != "dra"), streams)
        found.append(_simple_crossings(measured))
        lost.append(_unplaced(measured))
    if "dra" in layers:
        is_dra = F.col("source") == "dra"
        crossings, missing = _dra_crossings(centroids.where(is_dra), pieces.where(is_dra), streams, lines.where(is_dra))
        found.append(crossings)
        lost.append(missing)
    if rejects:
        rows = filters.union_sources(*lost)
        if rejected is not None:
            rows = rows.observe(rejected, *[F.count_if(F.col("reason") == reason).alias(name) for name, reason in REASONS.items()])
        rows.write.mode("overwrite").parquet(rejects)
    return filters.union_sources(*found)


def crossings_simple(streams: DataFrame, lines: DataFrame, source: str, tolerance: float | None = None, **options) -> DataFrame:
    """Crossings of one layer without road classes: ``ften``, ``ogc``, ``ogcpre06`` or ``rail``."""
    return find_crossings(streams, {source: lines}, tolerances=None if tolerance is None else {source: tolerance}, **options)


def crossings_dra(streams: DataFrame, roads: DataFrame, **options) -> DataFrame:
    """Crossings of the classified road layer."""
    return find_crossings(streams, {"dra": roads}, **options)
