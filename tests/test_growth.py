"""Intermediate rows stay near the input's number, whatever the map's density."""

import math
import random

from linecross.operators import cluster, nearest, overlay
from tests.helpers import pieces
from tests.test_density import seg_distance


def test_cells_are_linked_across_blocks_with_few_copies(spark):
    rng = random.Random(5)
    spots = sorted({(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(1500)})
    rows = [(x * 100 + y, x, y, x + 0.5, y + 0.5, x + 0.5, y + 0.5, 1) for x, y in spots]
    nodes = spark.createDataFrame(rows, "node long, cx long, cy long, x_lo double, y_lo double, x_hi double, y_hi double, n long")
    copies = cluster._reaching(nodes).count()
    assert copies < 2.5 * len(rows)
    nodes = nodes.withColumn("g", nodes.node * 0)
    got = cluster._linked_cells(nodes, ["g"], "2.3D").collect()
    want = {(a[0], b[0]) for a in rows for b in rows
            if (b[1] - a[1], b[2] - a[2]) > (0, 0) and b[1] - a[1] <= 2 and abs(b[2] - a[2]) <= 2 and math.dist(a[1:3], b[1:3]) <= 2.3}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def _staged_rows(monkeypatch):
    counts = {}

    def counted(make):
        def staged(df, label, **metrics):
            out = make(df, label, **metrics)
            counts[label] = counts.get(label, 0) + (out[0] if isinstance(out, tuple) else out).count()
            return out
        return staged
    for name in ("stage", "stage_observed"):
        monkeypatch.setattr(nearest, name, counted(getattr(nearest, name)))
    return counts


def test_sparse_pieces_are_not_listed_in_a_cell_of_every_level(spark, monkeypatch):
    counts = _staged_rows(monkeypatch)
    rng = random.Random(7)
    spots = [(rng.uniform(-40_000, 40_000), rng.uniform(-40_000, 40_000)) for _ in range(600)]
    rows = [(i, "a", x, y, x, y) for i, (x, y) in enumerate(spots)]
    asked = [(i, "a", x + rng.uniform(-300, 300), y + 20.0) for i, (x, y) in enumerate(spots[:200])]
    # one that is alone in its group, and one whose group has fewer pieces than are looked for
    rows += [(9000, "b", 0.0, 0.0, 0.0, 0.0)]
    asked += [(9000, "b", 39_000.0, 5.0), (9001, "c", 0.0, 0.0)]
    points = spark.createDataFrame(asked, "p long, g string, x double, y double")
    for k in (1, 5):
        counts.clear()
        got = nearest.nearest_k(points, pieces(spark, rows), k, ["id"], ["g"]).collect()
        want = {(p, n + 1, i) for p, g, x, y in asked for n, (_, i) in enumerate(sorted(
            (seg_distance(x, y, *piece[2:]), piece[0]) for piece in rows if piece[1] == g)[:k])}
        assert {(r.p, r["rank"], r.id) for r in got} == want
        # 16 m cells would be 14 levels of about one cell a piece first
        assert counts["cells"] < 3 * len(rows)


def test_long_segments_are_not_listed_in_many_small_cells(spark):
    rng = random.Random(9)

    def segments(p, n, length):
        rows = []
        for i in range(n):
            x, y, turn = rng.uniform(0, 5000), rng.uniform(0, 5000), rng.uniform(0, 2 * math.pi)
            rows.append((i, x, y, x + length * math.cos(turn), y + length * math.sin(turn)))
        return spark.createDataFrame(rows, ", ".join(f"{p}{c} {kind}" for c, kind in (
            ("id", "long"), ("x1", "double"), ("y1", "double"), ("x2", "double"), ("y2", "double"))))
    long, short = segments("l", 300, 900.0), segments("r", 300, 20.0)
    assert overlay._cell_width(short.toDF(*long.columns), short, 100.0) == 100.0
    assert overlay._cell_width(short.toDF(*long.columns).limit(0), short.limit(0), 100.0) == 100.0
    width = overlay._cell_width(long, long.toDF(*short.columns), 100.0)
    assert overlay._celled(long, "l", width).count() < 3 * 300 < overlay._celled(long, "l", 100.0).count()


def test_pieces_are_listed_on_the_levels_that_points_ask_for(spark):
    rng = random.Random(3)
    rows = [(i, "a", rng.uniform(0, 900), rng.uniform(0, 900)) for i in range(800)]
    points = spark.createDataFrame([(i, "a", rng.uniform(0, 900), rng.uniform(0, 900)) for i in range(50)], "p long, g string, x double, y double")
    found = nearest.nearest_k(points, pieces(spark, rows), 5, ["id"], ["g"])
    assert "explode([0," not in found._jdf.queryExecution().toString()


def test_a_limited_search_writes_no_cells_unless_one_is_crowded(spark, monkeypatch):
    counts = _staged_rows(monkeypatch)
    points = spark.createDataFrame([("a", 1.0, 2.0)], "g string, x double, y double")
    heap = pieces(spark, [(i, "a", 1.5, 2.0 + i / 100) for i in range(30)])
    for per_point, cells in ((1024, False), (2, True)):
        counts.clear()
        got = nearest.nearest_within(points, heap, 3.0, ["id"], ["g"], pieces_per_point=per_point).collect()
        assert [(r.id, r.distance) for r in got] == [(0, 0.5)]
        assert ("cells" in counts) == cells
