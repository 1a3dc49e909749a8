"""Hand-checked cases for the surprising rules."""

import pytest
from pyspark.sql import functions as F

from linecross.operators import classify as rules, filters
from linecross.operators.cluster import cluster_centroids, cluster_within
from linecross.operators.ids import assign_ids, match_archive
from linecross.operators.lines import explode_segments, locate_along, merge_parts
from linecross.operators.merge import merge_by_priority
from linecross.operators.nearest import buffer_semi_join
from linecross.operators.overlay import intersect_lines
from linecross.plans.crossings import crossings_dra, crossings_simple
from tests.helpers import across, crossings, dra, ften, line, pieces, stream, vertex


def measures(df):
    return sorted(round(r.downstream_route_measure, 6) for r in df.collect())


def test_single_crossing(spark):
    row = crossings_simple(stream(spark), ften(spark, ("F1", across(30))), "ften").first()
    assert (row.geom.x, row.geom.y, row.geom.m, row.downstream_route_measure) == (30.0, 0.0, 1030.0, 1030.0)
    assert (row.ften_road_section_lines_id, row.blue_line_key, row.watershed_group_code) == ("F1", 7, "AAAA")


def test_chains_and_inclusive_distance(spark):
    roads = ften(spark, *[(f"F{x}", across(x)) for x in (10, 20, 31, 60)])
    assert measures(crossings_simple(stream(spark), roads, "ften")) == [1020.333333, 1060.0]
    assert measures(crossings_simple(stream(spark), roads, "ften", 10.0)) == [1015.0, 1031.0, 1060.0]


def test_greatest_id_of_the_stream(spark):
    roads = ften(spark, ("FT1", across(10)), ("FT9", across(80)))
    def ids(**options):
        return sorted(r.ften_road_section_lines_id for r in crossings_simple(stream(spark), roads, "ften", **options).collect())
    assert ids() == ["FT9", "FT9"]
    assert ids(id_scope="cluster") == ["FT1", "FT9"]


def test_part_pairing(spark):
    roads = ften(spark, ("F1", line([(30, -10), (30, 10)], [(70, -10), (70, 10)])))
    assert measures(crossings_simple(stream(spark), roads, "ften")) == [1030.0]
    assert measures(crossings_simple(stream(spark), roads, "ften", part_pairing="all_pairs")) == [1030.0, 1070.0]


def test_overlap_beats_points(spark):
    roads = ften(spark, ("F1", line([(40, 0), (60, 0)])), ("F2", across(65)))
    assert measures(crossings_simple(stream(spark), roads, "ften")) == [1050.0]


def test_vertex_hit_counts_once(spark):
    bend = stream(spark, geom=line([(0, 0, 1000), (50, 0, 1050), (100, 0, 1100)]))
    roads = ften(spark, ("F1", line([(50, -10), (50, 0), (50, 10)])))
    found = intersect_lines(roads, bend, "id", "linear_feature_id").collect()
    assert [(r.x1, r.y1, r.x2, r.y2) for r in found] == [(50.0, 0.0, 50.0, 0.0)]


def test_points_on_an_overlap_belong_to_it(spark):
    roads = ften(spark, ("F1", line([(40, -5), (40, 0), (60, 0), (60, 5)])))
    found = intersect_lines(roads, stream(spark), "id", "linear_feature_id").collect()
    assert [(r.x1, r.x2) for r in found] == [(40.0, 60.0)]


def test_null_codes(spark):
    from linecross import schema
    rows = [(1, "RLO", None, None, across(10)), (2, "RLO", "P", None, across(20)), (3, "RLO", "P", "T", across(30)), (4, None, "P", None, across(40))]
    assert [r.transport_line_id for r in filters.filter_dra(spark.createDataFrame(rows, schema.DRA)).collect()] == [2]


def test_stream_with_null_order_comes_first(spark):
    both = stream(spark, [
        {"linear_feature_id": 1, "stream_order": 5},
        {"linear_feature_id": 2, "stream_order": None, "geom": line([(0, 1, 1000), (100, 1, 1100)])}])
    row = crossings_dra(both, dra(spark, (1, "RLO", across(30)))).collect()
    assert [r.linear_feature_id for r in row] == [2]


@pytest.mark.parametrize("limit, kept", [(15.01, 1), (15.0, 0)])
def test_road_must_pass_near_the_located_point(spark, monkeypatch, limit, kept):
    # the cluster of the two roads lies 15 m from both
    monkeypatch.setattr("linecross.plans.crossings.ROAD_DISTANCE", limit)
    found = crossings_dra(stream(spark), dra(spark, (1, "RH1", across(30)), (2, "RH1", across(60)))).collect()
    assert [r.transport_line_id for r in found] == [1] * kept


def test_merge_strict_distance(spark):
    x = crossings(spark, {"modelled_crossing_id": 1, "transport_line_id": 11, "at": (0, 0)},
                  {"modelled_crossing_id": 2, "ften_road_section_lines_id": "P", "at": (19.9, 0)},
                  {"modelled_crossing_id": 3, "ften_road_section_lines_id": "Q", "at": (0, 20)})
    got = {r.modelled_crossing_id: r.ften_road_section_lines_id for r in merge_by_priority(x).collect()}
    assert got == {1: "P", 3: "Q"}


def test_merge_takes_the_nearest_id(spark):
    x = crossings(spark, {"modelled_crossing_id": 1, "transport_line_id": 11, "at": (0, 0)},
                  {"modelled_crossing_id": 2, "ften_road_section_lines_id": "P1", "at": (7, 0)},
                  {"modelled_crossing_id": 3, "ften_road_section_lines_id": "P2", "at": (5, 0)})
    got = {r.modelled_crossing_id: r.ften_road_section_lines_id for r in merge_by_priority(x).collect()}
    assert got == {1: "P2"}


def test_merge_rounds_build_on_each_other_and_leave_rail(spark):
    x = crossings(spark, {"modelled_crossing_id": 1, "transport_line_id": 11, "at": (300, 0)},
                  {"modelled_crossing_id": 2, "ften_road_section_lines_id": "F", "at": (0, 0)},
                  {"modelled_crossing_id": 3, "og_road_segment_permit_id": 5, "at": (10, 0)},
                  {"modelled_crossing_id": 4, "railway_track_id": 9, "at": (303, 0)})
    merged = merge_by_priority(x)
    got = {r.modelled_crossing_id: (r.transport_line_id, r.ften_road_section_lines_id, r.og_road_segment_permit_id, r.railway_track_id)
           for r in merged.collect()}
    assert got == {1: (11, None, None, None), 2: (None, "F", 5, None), 4: (None, None, None, 9)}
    assert sorted(merge_by_priority(merged).collect()) == sorted(merged.collect())


def test_tags_in_rule_order(spark):
    x = crossings(spark, *[{"modelled_crossing_id": i, "linear_feature_id": i, "at": (i, 0)} for i in (1, 2, 3, 701296585)])
    streams = stream(spark, [{"linear_feature_id": 1, "stream_order": 7, "edge_type": 1250}, {"linear_feature_id": 2, "edge_type": 1250},
                             {"linear_feature_id": 3}, {"linear_feature_id": 701296585, "stream_order": 7}])
    done = rules.tag_crossings(x, {"FWA_STREAM_ORDER": rules.obs_stream_order(x, streams), "FWA_EDGE_TYPE": rules.obs_edge_type(x, streams)})
    got = {r.modelled_crossing_id: (r.modelled_crossing_type, r.modelled_crossing_type_source) for r in done.collect()}
    assert got == {1: ("OBS", ["FWA_STREAM_ORDER", "FWA_EDGE_TYPE"]), 2: ("OBS", ["FWA_EDGE_TYPE"]), 3: ("CBS", None), 701296585: ("CBS", None)}


def test_assessment_distance(spark):
    from linecross import schema
    x = crossings(spark, *[{"modelled_crossing_id": i, "linear_feature_id": i, "downstream_route_measure": 100.0, "at": (0, 0)} for i in (1, 2, 3)])
    events = spark.createDataFrame([(1, 1, 114.99), (2, 2, 115.0), (3, 4, 101.0)], schema.PSCIS_EVENTS)
    points = spark.createDataFrame([(i, "OBS") for i in (1, 2, 3)], schema.PSCIS_POINTS)
    assert [r[0] for r in rules.obs_pscis(x, events, points).collect()] == [1]


def test_two_bridges_one_tag(spark):
    from linecross import schema
    x = crossings(spark, {"modelled_crossing_id": 1, "at": (0, 0)}, {"modelled_crossing_id": 2, "at": (100, 0)})
    mot = spark.createDataFrame([(1, "bridge", "Open/In use", vertex(3, 0)), (2, "BRIDGE", "OPEN/IN USE", vertex(0, 4)),
                                 (3, "BRIDGE", "CLOSED", vertex(100, 0)), (4, "BRIDGE", "OPEN/IN USE", vertex(115, 0))], schema.MOT)
    assert [r[0] for r in rules.obs_mot(x, mot).collect()] == [1]


def _near(spark, bridge, **options):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double")
    segments = spark.createDataFrame([tuple(map(float, bridge))], "x1 double, y1 double, x2 double, y2 double")
    return buffer_semi_join(points, segments, 10.01, "id", **options).count()


def test_buffer_is_a_polygon(spark):
    import math
    assert _near(spark, (-5, 10.00, 5, 10.00)) == 1
    assert _near(spark, (-5, 10.02, 5, 10.02)) == 0
    bearing = math.radians(5.625)
    middle, along = (9.99 * math.sin(bearing), 9.99 * math.cos(bearing)), (math.cos(bearing) * 0.05, -math.sin(bearing) * 0.05)
    short = (middle[0] - along[0], middle[1] - along[1], middle[0] + along[0], middle[1] + along[1])
    assert _near(spark, short) == 0
    assert _near(spark, short, true_distance=True) == 1
    assert _near(spark, (-1, 0, 1, 0)) == 1


def test_archive_ids(spark):
    from linecross import schema
    x = crossings(spark, {"modelled_crossing_id": 1, "at": (0, 0)}, {"modelled_crossing_id": 2, "at": (7, 0)},
                  {"modelled_crossing_id": 3, "at": (100, 0)})
    archive = spark.createDataFrame([(10, vertex(2, 0)), (4, vertex(110, 0))], schema.ARCHIVE)
    got = sorted((r.geom.x, r.modelled_crossing_id) for r in match_archive(x, archive).collect())
    assert got == [(0.0, 10), (7.0, 11), (100.0, 12)]


def test_measure_beyond_the_line(spark):
    asked = spark.createDataFrame([(1, 1050.0), (1, 1100.5)], "linear_feature_id long, measure double")
    assert locate_along(asked, stream(spark), "linear_feature_id", "measure").count() == 1
    kept = locate_along(asked, stream(spark), "linear_feature_id", "measure", keep_missing=True)
    assert kept.where("point IS NULL").count() == 1


def test_merge_parts(spark):
    cases = {
        1: line([(0, 0), (1, 0)], [(1, 0), (2, 0)]),
        2: line([(1, 0), (2, 0)], [(0, 0), (1, 0)]),
        3: line([(2, 0), (1, 0)], [(0, 0), (1, 0)], [(2, 0), (3, 0)]),
        4: line([(0, 0), (1, 0)], [(5, 0), (6, 0)]),
        5: line([(0, 0), (1, 0)], [(1, 0), (2, 0)], [(1, 0), (1, 1)]),
    }
    from linecross.schema import LINE
    from pyspark.sql import types as T
    df = spark.createDataFrame(list(cases.items()), T.StructType([T.StructField("id", T.LongType()), T.StructField("geom", LINE)]))
    got = {r.id: r.merged and [v.x for v in r.merged] for r in merge_parts(df).collect()}
    assert got == {1: [0, 1, 2], 2: [0, 1, 2], 3: [0, 1, 2, 3], 4: None, 5: None}


def test_explode_segments_lengths(spark):
    rows = explode_segments(stream(spark, geom=line([(0, 0, 1), (3, 4, 2), (3, 4, 2), (3, 9, 3)]))).collect()
    assert [(r.seg_no, r.seg_len) for r in rows] == [(0, 5.0), (2, 5.0)]


def test_assign_ids_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 16).select((5000 - F.col("id")).alias("v"))
    rows = assign_ids(df, ["v"], "n", 7).agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.max(F.col("n") - F.col("v"))).first()
    assert tuple(rows) == (7, 5006, 5000, 6)


def test_cluster_ids_do_not_depend_on_partitions(spark):
    rows = [(i, "a", (i * 37) % 100, (i * 53) % 90) for i in range(60)]
    first, second = pieces(spark, rows), pieces(spark, rows[::-1]).repartition(5)
    def labels(df):
        return sorted((r.id, r.cluster_id) for r in cluster_within(df, ["g"], 12.0, "id").collect())
    assert labels(first) == labels(second)


def test_id_scope_is_checked(spark):
    with pytest.raises(ValueError):
        cluster_centroids(pieces(spark, [(1, "a", 0, 0)]), ["g"], 1.0, ["id"], "stream")
