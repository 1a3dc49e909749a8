"""Cases at the edge: tiny and zero distances, far apart places, repeated roads, empty rule sets, files per region."""

import os

import pytest
from pyspark.sql import functions as F

from linecross.operators import cluster
from linecross.operators.classify import classify
from linecross.operators.cluster import cluster_within
from linecross.plans.crossings import crossings_dra, crossings_simple
from linecross.sources.sinks import write_crossings
from tests.helpers import across, crossings, dra, ften, line, pieces, stream


def clusters(spark, rows, distance, **options):
    return sorted((r.id, r.cluster_id) for r in cluster_within(pieces(spark, rows), ["g"], distance, "id", **options).collect())


def test_tiny_distance_over_a_wide_area(spark):
    # cell numbers beyond 32 bits
    rows = [(1, "a", 0.0, 0.0), (2, "a", 911_126.0, 0.0), (3, "a", 911_126.0002, 0.0)]
    assert clusters(spark, rows, 0.0003) == [(1, 1), (2, 2), (3, 2)]


def test_zero_distance(spark):
    rows = [(1, "a", 5.0, 0.0), (2, "a", 5.0, 0.0), (3, "a", 5.000001, 0.0), (4, "a", 0.0, 0.0, 10.0, 0.0), (5, "a", 0.0, 1.0, 10.0, 1.0), (6, "a", -3.0, -4.0)]
    assert clusters(spark, rows, 0.0) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 6)]
    assert clusters(spark, rows[:3], 0.0) == [(1, 1), (2, 1), (3, 3)]


def test_zero_tolerance_keeps_crossings_apart(spark):
    roads = ften(spark, ("a", across(30)), ("b", across(35)))
    assert crossings_simple(stream(spark), roads, "ften", tolerance=0.0).count() == 2
    assert crossings_simple(stream(spark), roads, "ften").count() == 1


def test_levels_run_out(spark, monkeypatch):
    # what boxes leave undecided is decided by points, not dropped
    monkeypatch.setattr(cluster, "MAX_LEVEL", 1)
    rows = [(i, "a", -0.01 * i, 2.0) for i in range(60)] + [(100 + i, "a", 9.9 + 0.01 * i, 2.0) for i in range(60)]
    assert {c for _, c in clusters(spark, rows, 10.0, pairs_per_box=5)} == {0}
    rows = rows[:60] + [(i, g, x + 0.2, y) for i, g, x, y in rows[60:]]
    assert {c for _, c in clusters(spark, rows, 10.0, pairs_per_box=5)} == {0, 100}


def test_repeated_road_gives_one_crossing(spark):
    roads = dra(spark, (1, "RR1", across(50)), (1, "RR1", line([(50, -10), (50, 11)])))
    assert crossings_dra(stream(spark), roads).count() == 1


def test_no_rules(spark):
    got = classify(crossings(spark, {"modelled_crossing_id": 1, "at": (1, 2)}), {}).first()
    assert (got.modelled_crossing_type, got.modelled_crossing_type_source) == ("CBS", None)


@pytest.mark.parametrize("tasks", [1, 12])
def test_files_of_a_region(spark, tmp_path, tasks):
    rows = spark.range(600).select(F.col("id"), F.concat(F.lit("R"), F.col("id") % 5).alias("watershed_group_code")).repartition(tasks)
    write_crossings(rows, str(tmp_path / "out"))
    files = {d: [f for f in os.listdir(tmp_path / "out" / d) if f.endswith(".parquet")] for d in os.listdir(tmp_path / "out") if "=" in d}
    assert len(files) == 5 and all(len(f) == 1 for f in files.values())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600


def test_clusters_without_a_crossing_are_reported(spark, tmp_path):
    gapped = stream(spark, [{"geom": line([(0, 0, 1000), (40, 0, 1040)], [(60, 0, 1060), (100, 0, 1100)])}])
    out = str(tmp_path / "lost")
    roads = ften(spark, ("a", across(20)))
    assert crossings_simple(gapped, roads, "ften", rejects=out).count() == 0
    lost = spark.read.parquet(out).collect()
    assert [(r.source, r.linear_feature_id, r.x, r.reason) for r in lost] == [("ften", 1, 20.0, "the stream takes no measure")]
    assert crossings_simple(stream(spark), roads, "ften", rejects=out).count() == 1 and spark.read.parquet(out).count() == 0
    assert crossings_dra(gapped, dra(spark, (1, "RR1", across(20))), rejects=out).count() == 0
    assert [(r.source, r.reason) for r in spark.read.parquet(out).collect()] == [("dra", "no stream close by takes a measure")]
