"""Readers, writers and plan shapes."""

import json
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from linecross import schema
from linecross.operators.filters import streams_of
from linecross.plans.job import run
from linecross.sources.layers import read_codes, read_layer
from linecross.sources.sinks import write_crossings, write_report
from tests.helpers import across, crossings, dra, ften, line, stream


def test_geojson(spark, tmp_path):
    features = [
        {"type": "Feature", "id": 5, "properties": {}, "geometry": {"type": "LineString", "coordinates": [[0, 1], [2, 3]]}},
        {"type": "Feature", "properties": {"railway_track_id": 6}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 1, 9.5], [2, 3, 9]], [[4, 5], [6, 7]]]}},
        {"type": "Feature", "properties": {"railway_track_id": 7}, "geometry": None},
    ]
    (tmp_path / "lines.geojsonl").write_text("\n".join(map(json.dumps, features)))
    (tmp_path / "all.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    for name, fmt in (("lines.geojsonl", "geojsonl"), ("all.geojson", "geojson")):
        got = {r.railway_track_id: r.geom for r in read_layer(spark, str(tmp_path / name), schema.RAIL, "railway_track_id", fmt).collect()}
        assert [(v.x, v.y, v.z) for v in got[5][0]] == [(0.0, 1.0, None), (2.0, 3.0, None)]
        assert [len(p) for p in got[6]] == [2, 2] and got[6][0][0].z == 9.5
        assert got[7] is None


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1000])
def test_collection_ranges(spark, tmp_path, range_bytes, monkeypatch):
    """Whatever byte a range begins at, each feature is read once: escapes, brackets in strings, features inside features, member order."""
    nasty = ['{"type": "Feature"}', '\\', '"', '\\"{[', ']}', 'é\u2028{', ' : {', '\\\\', '']
    features = [{"geometry": {"type": "LineString", "coordinates": [[n, 0], [n, 1]]}, "properties": {
        "railway_track_id": n, "note": text, text: [{"type": "Feature", "id": 99}], "deep": {"type": "Feature", "x": [[{}]]}}, "type": "Feature"}
        for n, text in enumerate(nasty)]
    whole = {"crs": {"properties": {"name": "x"}, "list": [{"type": "Feature", "id": 77}]}, "links": [{"rel": "{"}], "features": features,
             "type": "FeatureCollection"}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.json").write_text(json.dumps(whole, indent=2))
    (tmp_path / "c" / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    (tmp_path / "c" / "c.json").write_text(json.dumps({"features": [{**features[0], "properties": {"railway_track_id": 50}}]}, ensure_ascii=False, separators=(",", ":")))
    (tmp_path / "c" / "empty.json").write_text("")
    if range_bytes < 64:  # the ranges themselves, without a task for each
        from linecross.sources import collections
        found = []
        for name in "abc":
            path = f"file:{tmp_path}/c/{name}.json"
            size, odd, depth = (tmp_path / "c" / f"{name}.json").stat().st_size, 0, 0
            for start in range(0, size, range_bytes):
                end = min(size, start + range_bytes)
                found += collections._features(path, start, end, odd, depth)
                row = next(collections._count([pa.RecordBatch.from_pydict({"path": [path], "start": [start], "end": [end]})])).to_pylist()[0]
                odd, depth = (odd + row["quotes"]) % 2, depth + row["inside" if odd else "outside"]
            assert (odd, depth) == (0, 0)
        found = [json.loads(f) for f in found]
        got = [f["properties"]["railway_track_id"] for f in found if f.get("type") == "Feature"]
    else:
        rows = read_layer(spark, str(tmp_path / "c"), schema.RAIL, "railway_track_id", "geojson", range_bytes=range_bytes)
        assert range_bytes > 64 or rows.rdd.getNumPartitions() > 20
        got = [r.railway_track_id for r in rows.collect()]
    assert sorted(got) == [*range(len(nasty)), 50]


def test_broken_collections(spark, tmp_path):
    import gzip
    feature = {"type": "Feature", "properties": {"railway_track_id": 1}, "geometry": None}
    text = json.dumps({"type": "FeatureCollection", "features": [feature, feature]})
    (tmp_path / "packed.json.gz").write_bytes(gzip.compress(text.encode()))
    assert read_layer(spark, str(tmp_path / "packed.json.gz"), schema.RAIL, fmt="geojson", range_bytes=8).count() == 2
    (tmp_path / "cut.json").write_text(text[:-20])
    with pytest.raises(Exception, match="ends inside a feature"):
        read_layer(spark, str(tmp_path / "cut.json"), schema.RAIL, fmt="geojson", range_bytes=50).count()
    (tmp_path / "bad.json").write_text(text.replace('"railway_track_id"', "railway"))
    with pytest.raises(Exception, match="no JSON"):
        read_layer(spark, str(tmp_path / "bad.json"), schema.RAIL, fmt="geojson").collect()


def test_geojson_points(spark, tmp_path):
    row = {"type": "Feature", "properties": {"hwy_structure_class_id": 1, "bmis_structure_type": "BRIDGE"}, "geometry": {"type": "Point", "coordinates": [1.5, 2.5]}}
    (tmp_path / "p.geojsonl").write_text(json.dumps(row))
    got = read_layer(spark, str(tmp_path / "p.geojsonl"), schema.MOT, fmt="geojsonl").first()
    assert (got.geom.x, got.geom.y, got.bmis_structure_type) == (1.5, 2.5, "BRIDGE")


def test_wkb(spark, tmp_path):
    single = struct.pack("<BII6d", 1, 1002, 2, 0, 1, 5, 2, 3, 6)  # line with z
    multi = struct.pack(">BII", 0, 5, 1) + struct.pack(">BII4d", 0, 2, 2, 7, 8, 9, 10)
    extended = struct.pack("<BIII8d", 1, 2 | 0x80000000 | 0x40000000 | 0x20000000, 3005, 2, 0, 1, 2, 3, 4, 5, 6, 7)
    stored = T.StructType([T.StructField("railway_track_id", T.IntegerType()), T.StructField("geom", T.BinaryType())])
    spark.createDataFrame([(1, single), (2, multi), (3, extended), (4, None)], stored).write.parquet(str(tmp_path / "w"))
    got = {r.railway_track_id: r.geom for r in read_layer(spark, str(tmp_path / "w"), schema.RAIL, fmt="wkb").collect()}
    assert [tuple(v) for v in got[1][0]] == [(0.0, 1.0, 5.0, None), (2.0, 3.0, 6.0, None)]
    assert [tuple(v) for v in got[2][0]] == [(7.0, 8.0, None, None), (9.0, 10.0, None, None)]
    assert [tuple(v) for v in got[3][0]] == [(0.0, 1.0, 2.0, 3.0), (4.0, 5.0, 6.0, 7.0)]
    assert got[4] is None


def test_bad_wkb(spark, tmp_path):
    good = struct.pack("<BII4d", 1, 2, 2, 0, 1, 2, 3)
    bad = [b"", b"\x01", good[:-3], good + b"x", struct.pack("<BII", 1, 3, 0), struct.pack("<BII", 1, 5, 1) + struct.pack("<BII", 1, 3, 0)]
    rows = [(0, good), (1, None), (2, struct.pack("<BII", 1, 5, 0)), *[(10 + n, b) for n, b in enumerate(bad)]]
    stored = T.StructType([T.StructField("railway_track_id", T.IntegerType()), T.StructField("geom", T.BinaryType())])
    spark.createDataFrame(rows, stored).write.parquet(str(tmp_path / "w"))
    got = {r.railway_track_id: r for r in read_layer(spark, str(tmp_path / "w"), schema.RAIL, fmt="wkb", reject="why").collect()}
    assert got[0].geom[0][1].x == 2.0 and got[0].why is None and got[1].geom is None and got[1].why is None and got[2].geom == []
    assert all(got[10 + n].geom is None and got[10 + n].why for n in range(len(bad)))
    with pytest.raises(Exception, match="no line or point in WKB"):
        read_layer(spark, str(tmp_path / "w"), schema.RAIL, fmt="wkb").collect()


def test_region_scan_is_pruned(spark, tmp_path):
    rows = [{"modelled_crossing_id": i, "watershed_group_code": g, "at": (0, 0)} for i, g in enumerate("AABC")]
    write_crossings(crossings(spark, *rows), str(tmp_path / "x"))
    plan = streams_of(spark.read.schema(schema.CROSSINGS).parquet(str(tmp_path / "x")), ["A"])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "watershed_group_code" in filters and "= A" in filters


def test_run_counts_rejects_and_snapshot(spark, tmp_path):
    # a stream without measures, one whose measures lie elsewhere, and a good one; FTEN roads 5 m apart from DRA ones
    far = line([(0, 200, 5000), (100, 200, 5100)])
    streams = stream(spark, [{}, {"linear_feature_id": 2, "geom": far}, {"linear_feature_id": 3, "geom": line([(0, 400, 1000), (40, 400, 1040)], [(60, 400, 1060), (100, 400, 1100)])}])
    shifted = lambda y: line([(50, y - 9), (50, y + 9)])
    inputs = {"streams": streams, "dra": dra(spark, (1, "RLO", across(20))), "ften": ften(spark, ("a", across(25)), ("b", shifted(200)), ("c", line([(20, 391), (20, 409)]))),
              "mot": spark.createDataFrame([], schema.MOT), "pscis_events": spark.createDataFrame([], schema.PSCIS_EVENTS),
              "pscis_points": spark.createDataFrame([], schema.PSCIS_POINTS), "rail_structures": spark.createDataFrame([], schema.RAIL_STRUCTURES)}
    done = run(spark, inputs, str(tmp_path), snapshot=True)
    summary = spark.read.parquet(str(tmp_path / "summary")).first().asDict()
    rejected = {(r.linear_feature_id, r.reason) for r in spark.read.parquet(str(tmp_path / "rejected")).collect()}
    assert rejected == {(2, "the measure is not on the stream"), (3, "the stream takes no measure")}
    assert summary == {"unmeasured": 1, "off_measure": 1, "off_stream": 0, "off_road": 0, "found": 2, "kept": 1, "obs": 0, "cbs": 1, "tagged": 0, "merged": 1}
    assert done.count() == 1 and spark.read.parquet(str(tmp_path / "snapshot")).count() == 2


def test_write_single_regions(spark, tmp_path):
    path = str(tmp_path / "x")
    both = crossings(spark, {"modelled_crossing_id": 1, "watershed_group_code": "A", "at": (0, 0)}, {"modelled_crossing_id": 2, "watershed_group_code": "B", "at": (0, 0)})
    write_crossings(both, path)
    write_crossings(both.where("watershed_group_code = 'B'").withColumn("modelled_crossing_id", F.lit(9)), path, single_regions=True)
    assert sorted(r.modelled_crossing_id for r in spark.read.parquet(path).collect()) == [1, 9]


def test_codes_and_report(spark, tmp_path):
    codes = spark.createDataFrame([("RLO", "local")], "code string, label string")
    write_report(codes, str(tmp_path / "codes"))
    assert read_codes(spark, str(tmp_path / "codes"), codes.schema, "csv").collect() == codes.collect()


def test_whole_run(spark, tmp_path):
    inputs = {
        "streams": stream(spark), "dra": dra(spark, (1, "RLO", across(30))), "ften": ften(spark, ("F1", across(33)), ("F2", across(80))),
        "ogc": spark.createDataFrame([], schema.OGC), "ogcpre06": spark.createDataFrame([], schema.OGCPRE06),
        "rail": spark.createDataFrame([(3, across(32))], schema.RAIL), "mot": spark.createDataFrame([], schema.MOT),
        "rail_structures": spark.createDataFrame([(1, "Bridge", line([(32, -3), (32, 3)]))], schema.RAIL_STRUCTURES),
        "pscis_events": spark.createDataFrame([(1, 1, 1081.0)], schema.PSCIS_EVENTS),
        "pscis_points": spark.createDataFrame([(1, "OBS")], schema.PSCIS_POINTS),
    }
    done = run(spark, inputs, str(tmp_path / "out"))
    assert done.columns == schema.CROSSINGS.fieldNames()
    got = sorted((r.geom.x, r.transport_line_id, r.ften_road_section_lines_id, r.railway_track_id, r.modelled_crossing_type) for r in done.collect())
    # both clusters of the stream carry its greatest id
    assert got == [(30.0, 1, "F2", None, "CBS"), (32.0, None, None, 3, "OBS"), (80.0, None, "F2", None, "OBS")]
    total = spark.read.option("header", True).csv(str(tmp_path / "out/reports/01_total")).collect()
    assert sorted(map(tuple, total)) == [("CBS", "1"), ("OBS", "2")]


def test_no_pair_join_without_keys(spark):
    """No plan of the package may fall back to a nested-loop or cartesian join."""
    from linecross.operators.overlay import intersect_lines
    plan = intersect_lines(ften(spark, ("F1", across(3))), stream(spark), "id", "linear_feature_id")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
