"""Telling open-bottom structures (OBS) from closed-bottom ones (CBS) by six pieces of evidence."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from linecross.operators.joins import band_semi_join
from linecross.operators.lines import explode_segments
from linecross.operators.nearest import buffer_semi_join, nearest_within

# Fixed values of the rules.
MIN_STREAM_ORDER = 6
EXCLUDED_STREAM_IDS = (701296585,)
DOUBLE_LINE_EDGE_TYPES = (1200, 1250, 1300, 1350, 1400, 1450, 1475)
BRIDGE_STRUCTURE_CODES = ("B", "C", "E", "F", "O", "R", "V")
MOT_DISTANCE = 15.0
PSCIS_DISTANCE = 15.0
RAIL_BRIDGE_BUFFER = 10.01

_KEY = "modelled_crossing_id"


def obs_stream_order(crossings: DataFrame, streams: DataFrame, exclude_ids: Sequence[int] = EXCLUDED_STREAM_IDS) -> DataFrame:
    """Ids of crossings on streams of order 6 and above."""
    large = streams.where((F.col("stream_order") >= MIN_STREAM_ORDER) & ~F.col("linear_feature_id").isin(*exclude_ids))
    return crossings.join(large.select("linear_feature_id"), "linear_feature_id", "left_semi").select(_KEY)


def obs_edge_type(crossings: DataFrame, streams: DataFrame) -> DataFrame:
    """Ids of crossings on double-line streams."""
    wide = streams.where(F.col("edge_type").isin(*DOUBLE_LINE_EDGE_TYPES))
    return crossings.join(wide.select("linear_feature_id"), "linear_feature_id", "left_semi").select(_KEY)


def obs_mot(crossings: DataFrame, structures: DataFrame, distance: float = MOT_DISTANCE) -> DataFrame:
    """Ids of crossings that are the nearest one of an open bridge, if nearer than ``distance``."""
    bridges = structures.where((F.upper("bmis_structure_type") == "BRIDGE")
                               & (F.upper("bmis_struct_status_type_desc") == "OPEN/IN USE"))
    points = bridges.select("hwy_structure_class_id", F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))
    targets = crossings.where("geom.x IS NOT NULL").select(
        _KEY, *[F.col(f"geom.{axis}").alias(f"{axis}{n}") for n in (1, 2) for axis in "xy"])
    return nearest_within(points, targets, distance, [_KEY]).select(_KEY).distinct()


def pscis_open_bottom(events: DataFrame, points: DataFrame) -> DataFrame:
    """Assessed events whose point is an open-bottom structure."""
    open_bottom = points.where(F.col("current_crossing_type_code") == "OBS").select("stream_crossing_id", "current_crossing_type_code")
    return events.join(open_bottom, "stream_crossing_id")


def obs_pscis(crossings: DataFrame, events: DataFrame, points: DataFrame, distance: float = PSCIS_DISTANCE) -> DataFrame:
    """Ids of crossings with an open-bottom assessment on the same stream, measures less than ``distance`` apart."""
    return band_semi_join(crossings, pscis_open_bottom(events, points), ["linear_feature_id"],
                          "downstream_route_measure", distance).select(_KEY)


def obs_dra_structure(crossings: DataFrame, roads: DataFrame) -> DataFrame:
    """Ids of crossings whose road carries a bridge code."""
    bridges = roads.where(F.col("transport_line_structure_code").isin(*BRIDGE_STRUCTURE_CODES))
    return crossings.join(bridges.select("transport_line_id"), "transport_line_id", "left_semi").select(_KEY)


def obs_rail_bridge(crossings: DataFrame, structures: DataFrame, radius: float = RAIL_BRIDGE_BUFFER,
                    quad_segs: int = 8, true_distance: bool = False) -> DataFrame:
    """Ids of railway crossings whose buffer meets a bridge line."""
    bridges = structures.where(F.upper("structure_type").startswith("BRIDGE")).select("geom")
    rail = crossings.where(F.col("railway_track_id").isNotNull() & F.col("geom.x").isNotNull()).select(
        _KEY, F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))
    return buffer_semi_join(rail, explode_segments(bridges), radius, _KEY, quad_segs, true_distance).select(_KEY)


def tag_crossings(crossings: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """Set type and tags from id tables, one per tag and in tag order.

    The id tables are combined into one row per crossing first, so the crossings are joined once. No evidence gives
    type ``CBS`` and NULL tags.
    """
    if not evidence:
        return crossings.withColumns({"modelled_crossing_type": F.lit("CBS"),
                                      "modelled_crossing_type_source": F.lit(None).cast("array<string>")})
    ids = [df.select(_KEY, F.lit(i).alias("_rule")) for i, df in enumerate(evidence.values())]
    rules = ids[0]
    for more in ids[1:]:
        rules = rules.unionByName(more)
    flags = rules.groupBy(_KEY).agg(*[F.max(F.col("_rule") == i).alias(f"_has{i}") for i in range(len(ids))])
    joined = crossings.drop("modelled_crossing_type", "modelled_crossing_type_source").join(flags, _KEY, "left")
    tags = F.array_compact(F.array(*[F.when(F.col(f"_has{i}"), F.lit(tag)) for i, tag in enumerate(evidence)]))
    found = F.size(tags) > 0
    return joined.withColumns({
        "modelled_crossing_type": F.when(found, F.lit("OBS")).otherwise(F.lit("CBS")),
        "modelled_crossing_type_source": F.when(found, tags),
    }).drop(*[f"_has{i}" for i in range(len(ids))])


def default_rules(streams: DataFrame, mot: DataFrame, pscis_events: DataFrame, pscis_points: DataFrame, dra: DataFrame,
                  rail_structures: DataFrame) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The six rules by tag; each maps crossings to the ids with that evidence."""
    # The tags.
    return {
        "FWA_STREAM_ORDER": lambda x: obs_stream_order(x, streams),
        "FWA_EDGE_TYPE": lambda x: obs_edge_type(x, streams),
        "MOT_ROAD_STRUCTURE_SP": lambda x: obs_mot(x, mot),
        "PSCIS": lambda x: obs_pscis(x, pscis_events, pscis_points),
        "TRANSPORT_LINE_STRUCTURE_CODE": lambda x: obs_dra_structure(x, dra),
        "GBA_RAILWAY_STRUCTURE_LINES_SP": lambda x: obs_rail_bridge(x, rail_structures),
    }


def classify(crossings: DataFrame, rules: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply the rules (any subset or addition) to the crossings."""
    return tag_crossings(crossings, {tag: rule(crossings) for tag, rule in rules.items()})
