"""Crowded places: the divided paths give what brute force gives."""

import math
import random

import pytest
from pyspark.sql import Observation, functions as F

from linecross.operators import overlay
from linecross.operators.cluster import cluster_centroids, cluster_within
from linecross.operators.components import connected_components
from linecross.operators.joins import band_semi_join
from linecross.operators.nearest import nearest_k, nearest_within
from linecross.operators.overlay import intersect_lines
from tests.helpers import ften, line, pieces, stream


def seg_distance(px, py, x1, y1, x2, y2):
    l2 = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = 0 if l2 == 0 else max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / l2))
    return round(math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1)), 6)


def piece_distance(a, b):
    def side(p, q, x, y):
        return (p[2] - p[0]) * (y - p[1]) - (p[3] - p[1]) * (x - p[0])
    if (side(a, b, b[0], b[1]) * side(a, b, b[2], b[3]) < 0) and (side(b, a, a[0], a[1]) * side(b, a, a[2], a[3]) < 0):
        return 0.0
    return min(seg_distance(*a[:2], *b), seg_distance(*a[2:], *b), seg_distance(*b[:2], *a), seg_distance(*b[2:], *a))


def brute_clusters(rows, d):
    root = {r[0]: r[0] for r in rows}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[1] == b[1] and piece_distance(a[2:], b[2:]) <= d:
                x, y = sorted((find(a[0]), find(b[0])))
                root[y] = x
    return {r[0]: find(r[0]) for r in rows}


def heap(seed, n, spread=60.0, lines=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = round(rng.gauss(0, spread), 3), round(rng.gauss(0, spread), 3)
        if i % 4 == 0:
            x, y = 1.0, 2.0  # a quarter are copies of one place
        rows.append((i, "ab"[i % 2], x, y, x, y))
    for i in range(n, n + lines):
        x, y = round(rng.gauss(0, spread), 3), round(rng.gauss(0, spread), 3)
        rows.append((i, "ab"[i % 2], x, y, x + 25.0, y + 10.0 * (i % 3)))
    return rows


@pytest.mark.parametrize("budget, lines", [(0, 0), (3, 6), (100_000, 6)])
def test_clusters(spark, budget, lines):
    rows = heap(5, 160, 40.0, lines)
    got = cluster_within(pieces(spark, rows), ["g"], 9.0, "id", pairs_per_box=budget)
    assert {r.id: r.cluster_id for r in got.collect()} == brute_clusters(rows, 9.0)


def test_two_heaps_near_the_distance(spark):
    # two dense heaps whose nearest points are 9.9 apart, then 10.1: boxes alone cannot decide
    def rows(gap):
        rng = random.Random(3)
        left = [(i, "a", -round(rng.random() * 4, 6), round(rng.random() * 4, 6)) for i in range(150)] + [(400, "a", 0.0, 2.0)]
        return left + [(500 + i, "a", gap + round(rng.random() * 4, 6) + 0.05, round(rng.random() * 4, 6)) for i in range(150)] + [(900, "a", gap, 2.0)]
    for gap, n in ((9.9, 1), (10.1, 2)):
        got = cluster_centroids(pieces(spark, rows(gap)), ["g"], 10.0, pairs_per_box=20)
        assert got.count() == n


def test_long_chain_is_one_component(spark):
    edges = spark.range(0, 3000).select(F.lit("k").alias("g"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    roots = connected_components(edges, ["g"])
    assert roots.agg(F.count("*"), F.max("root")).first() == (3000, 0)


def test_hub(spark):
    edges = spark.range(1, 5000).select(F.lit(7_000).alias("a"), F.col("id").alias("b"))
    assert connected_components(edges).agg(F.count("*"), F.max("root"), F.min("root")).first() == (4999, 1, 1)


@pytest.mark.parametrize("per_point, k", [(1, 1), (1, 5), (1000, 5)])
def test_nearest(spark, per_point, k):
    rows = heap(11, 120, 300.0, 10)
    rng = random.Random(2)
    points = [(i, "ab"[i % 2], round(rng.gauss(0, 400), 3), round(rng.gauss(0, 400), 3)) for i in range(60)] + [(98, "a", 1.0, 2.0), (99, "c", 0.0, 0.0)]
    frame = spark.createDataFrame([(i, g, float(x), float(y)) for i, g, x, y in points], "pid long, g string, x double, y double")
    got = nearest_k(frame, pieces(spark, rows), k, ["id"], ["g"], cell=4.0, pieces_per_point=per_point)
    want = {}
    for pid, g, x, y in points:
        ranked = sorted((seg_distance(x, y, *r[2:]), r[0]) for r in rows if r[1] == g)[:k]
        want.update({(pid, i): (n, d) for i, (d, n) in enumerate(ranked, 1)})
    assert {(r.pid, r["rank"]): (r.id, r.distance) for r in got.collect()} == want


@pytest.mark.parametrize("per_point", [1, 1000])
def test_nearest_within(spark, per_point):
    rows = [r for r in heap(13, 150, 80.0, 8)]
    points = [(i, float(i * 7 % 200 - 100), float(i * 13 % 190 - 90)) for i in range(80)]
    frame = spark.createDataFrame(points, "pid long, x double, y double")
    got = nearest_within(frame, pieces(spark, rows).drop("g"), 20.0, ["id"], pieces_per_point=per_point)
    want = {}
    for pid, x, y in points:
        d, n = min((seg_distance(x, y, *r[2:]), r[0]) for r in rows)
        if d < 20:
            want[pid] = (n, d)
    assert {r.pid: (r.id, r.distance) for r in got.collect()} == want


def test_points_beside_a_heap_meet_its_rim(spark):
    # points around a dense heap, and pieces far away that keep the points' own cells wide
    rng = random.Random(21)
    points = [(i, 60 * math.cos(i) + rng.random(), 60 * math.sin(i) + rng.random()) for i in range(150)]
    frame = spark.createDataFrame(points, "pid long, x double, y double")

    def heaped(n):
        rows = [(i, "a", round(rng.gauss(0, 6), 6), round(rng.gauss(0, 6), 6)) for i in range(n)]
        return [*rows, *[(n + i, "a", 900.0, 900.0 + i) for i in range(6)], *[(n + 10 + i, "a", 2.0, 1.0, 2.0, 3.0) for i in range(8)]]
    pairs = []
    for n in (3_000, 6_000):
        rows, compared = heaped(n), Observation()
        got = nearest_k(frame, pieces(spark, rows).drop("g"), 5, ["id"], pieces_per_point=64, compared=compared).collect()
        pairs.append(compared.get["pairs"])
        want = {}
        for pid, x, y in points:
            ranked = sorted((seg_distance(x, y, *r[2:4], *r[-2:]), r[0]) for r in rows)[:5]
            want.update({(pid, i): (m, d) for i, (d, m) in enumerate(ranked, 1)})
        assert {(r.pid, r["rank"]): (r.id, r.distance) for r in got} == want
    assert pairs[1] < 1.5 * pairs[0] and pairs[1] < 64 * len(points)


def test_too_few_neighbours(spark):
    points = spark.createDataFrame([(1, "a", -500.0, 3.0)], "pid long, g string, x double, y double")
    found = nearest_k(points, pieces(spark, [(1, "a", 10, 10), (2, "a", 90_000, 5), (3, "b", 0, 0)]), 5, ["id"], ["g"])
    assert [r.id for r in found.orderBy("rank").collect()] == [1, 2]
    assert nearest_k(points, pieces(spark, [(3, "b", 0, 0)]), 5, ["id"], ["g"]).count() == 0


@pytest.mark.parametrize("pairing", ["lockstep", "all_pairs"])
def test_intersections_in_split_cells(spark, pairing):
    rng = random.Random(4)
    def walk(n):
        x, y, out = rng.uniform(0, 200), rng.uniform(0, 200), []
        for _ in range(n):
            out.append((round(x, 2), round(y, 2)))
            x, y = x + rng.uniform(-60, 60), y + rng.uniform(-60, 60)
        return out
    roads = ften(spark, *[(f"F{i}", line(walk(6), walk(3))) for i in range(25)])
    streams = stream(spark, [{"linear_feature_id": i, "geom": line([(x, y, 0) for x, y in walk(8)])} for i in range(20)])
    def found(**options):
        rows = intersect_lines(roads, streams, "id", "linear_feature_id", part_pairing=pairing, **options).collect()
        return sorted((r.id, r.linear_feature_id, r.left_part, round(r.x1, 6), round(r.y1, 6)) for r in rows)
    whole = found()
    assert len(whole) > 100
    assert found(pairs_per_cell=5) == whole
    assert found(cell=13.0) == whole
    swapped = intersect_lines(streams, roads, "linear_feature_id", "id", part_pairing=pairing).collect()
    assert sorted((r.id, r.linear_feature_id, r.right_part, round(r.x1, 6), round(r.y1, 6)) for r in swapped) == whole


@pytest.mark.parametrize("pairing", ["lockstep", "all_pairs"])
def test_coincident_segments(spark, pairing, monkeypatch):
    # 1,500 equal roads over 3 equal streams, and as many crossing ones: no cell size parts them
    roads = ften(spark, *[(f"E{i}", line([(0, 0), (60, 0)])) for i in range(1500)], *[(f"X{i}", line([(30, -5), (30, 5)])) for i in range(1500)])
    streams = stream(spark, [{"linear_feature_id": i, "geom": line([(0, 0, 0), (60, 0, 60)])} for i in range(3)])
    sides = []
    dealt = overlay._dealt
    monkeypatch.setattr(overlay, "_dealt", lambda left, right, keys, budget: sides.append((dealt(left, right, keys, budget), keys)) or sides[-1][0])
    found = intersect_lines(roads, streams, "id", "linear_feature_id", part_pairing=pairing, pairs_per_cell=500)
    got = sorted((r.id, r.linear_feature_id, r.x1, r.y1, r.x2, r.y2) for r in found.collect())
    assert got == sorted([(f"E{i}", n, 0.0, 0.0, 60.0, 0.0) for i in range(1500) for n in range(3)]
                         + [(f"X{i}", n, 30.0, 0.0, 30.0, 0.0) for i in range(1500) for n in range(3)])
    ((left, right), keys), = sides
    keys = list(dict.fromkeys([*keys, "salt"]))
    pairs = left.groupBy(*keys).agg(F.count("*").alias("l")).join(right.groupBy(*keys).agg(F.count("*").alias("r")), keys)
    assert pairs.agg(F.max(F.col("l") * F.col("r"))).first()[0] <= 1.5 * 500


def test_band_semi_join(spark):
    rng = random.Random(9)
    left = [(i, rng.choice("ab"), round(rng.uniform(-100, 100), 1)) for i in range(300)]
    right = [(rng.choice("ab"), round(rng.uniform(-100, 100), 1)) for _ in range(12)] + [("a", 33.3)] * 200
    got = band_semi_join(spark.createDataFrame(left, "i long, k string, v double"), spark.createDataFrame(right, "k string, v double"), ["k"], "v", 5.0)
    want = sorted(i for i, k, v in left if any(k == q and abs(v - w) < 5.0 for q, w in right))
    assert sorted(r.i for r in got.collect()) == want
