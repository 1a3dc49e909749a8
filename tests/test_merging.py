"""Merging of lines with many parts."""

import random

from pyspark.sql import types as T

from linecross.operators import merging
from linecross.operators.lines import merge_parts
from linecross.operators.merging import merge_many_parts
from linecross.schema import LINE
from tests.helpers import line


def _lines(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("id", T.LongType()), T.StructField("geom", LINE)]))


def _walk(rng, n, ring):
    points = [(i, 0) for i in range(n + (not ring))]
    steps = [[points[i], (points[i][0], 1), points[(i + 1) % len(points)]] for i in range(n)]
    rng.shuffle(steps)
    return [s[::-1] if rng.random() < 0.5 else s for s in steps]


def _plain(row):
    return row.merged and [(v.x, v.y) for v in row.merged]


def test_as_the_merge_in_a_row(spark):
    rng = random.Random(5)
    rows = []
    for n in range(120):
        steps = _walk(rng, rng.randint(1, 9), ring=n % 3 == 0)
        if n % 5 == 0 and len(steps) > 1:
            steps.pop(rng.randrange(len(steps)))
        if n % 7 == 0:
            steps.insert(rng.randrange(len(steps) + 1), [steps[0][0], (50, 50)])
        if n % 11 == 0:
            steps.append([(70, 7), (71, 7), (70, 7)])  # a closed part apart from the rest
        if n % 13 == 0:
            steps.append(steps[0])
        rows.append((n, line(*steps)))
    rows += [(200, None), (201, []), (202, line([(0, 0)])), (203, line([(0, 0)], [(0, 0), (1, 0)])), (204, line([(0, 0), (1, 1), (0, 0)])),
             (205, line([(0, 0), (1, 0)], [(0, 0), (1, 0)])), (206, [[(None, None, None, None), (1.0, 0.0, None, None)], [(1.0, 0.0, None, None), (2.0, 0.0, None, None)]]),
             (1, rows[1][1])]
    df = _lines(spark, rows)
    many = sorted(((r.id, _plain(r)) for r in merge_many_parts(df).collect()), key=repr)
    fold = sorted(((r.id, _plain(r)) for r in merge_parts(df.where("id <> 206")).collect()), key=repr)
    assert [r for r in many if r[0] != 206] == fold and len(many) == len(rows)
    assert any(r[1] is None for r in many[:100]) and any(r[1] and r[1][0] == r[1][-1] for r in many)


def test_hundreds_of_parts_and_a_hub(spark):
    rng = random.Random(6)
    chain, ring = _walk(rng, 700, False), _walk(rng, 401, True)
    star = [[(0, 0), (i, 1)] for i in range(1, 4001)]
    two = [[(0, 5), (1, 5)], [(1, 5), (0, 5)], *_walk(rng, 300, True)]
    got = {r.id: _plain(r) for r in merge_many_parts(_lines(spark, [(1, line(*chain)), (2, line(*ring)), (3, line(*star)), (4, line(*two))])).collect()}
    path = [p for p in got[1] if p[1] == 0]
    assert path in ([(i, 0) for i in range(701)], [(i, 0) for i in range(700, -1, -1)]) and len(got[1]) == 1401
    assert got[2][0] == got[2][-1] and len(got[2]) == 803 and got[2][0] in (ring[0][0],)
    assert got[3] is None and got[4] is None


def test_in_the_row_as_by_rounds(spark, monkeypatch):
    """Lines short enough are ranked where they are, without staging their ends or walks; both ways give the same lines."""
    rng = random.Random(8)
    rows = []
    for n in range(150):
        steps = _walk(rng, rng.randint(1, 40), ring=n % 3 == 0)
        if n % 5 == 0 and len(steps) > 1:
            steps.pop(rng.randrange(len(steps)))
        if n % 7 == 0:
            steps += [[(x + 100, y) for x, y in s] for s in _walk(rng, rng.randint(1, 3), ring=True)]
        if n % 11 == 0:
            steps.insert(0, [(70, 7), (71, 7), (70, 7)])
        if n % 13 == 0:
            steps.append([(0, 0), (9, 9)])
        if n % 17 == 0:
            steps.append([(0.0, -0.0), (float("nan"), 5.0)])
        rows.append((n, line(*steps)))
    gap = (None, None, None, None)
    rows += [(500, None), (501, []), (502, [None]), (503, [[gap, gap]]), (504, [[gap, (1.0, 0.0, None, None)]]),
             (505, [[gap, (1.0, 0.0, None, None)], [(1.0, 0.0, None, None), gap]]), (506, [[None, (1.0, 0.0, None, None)], [(2.0, None, None, None), gap]]),
             (507, [[(5.0, None, None, None), (5.0, None, None, None)]]), (None, rows[2][1]), (None, rows[2][1])]
    df, staged, real = _lines(spark, rows), [], merging.stage_observed

    def stage_observed(frame, label, **metrics):
        staged.append(label)
        return real(frame, label, **metrics)
    monkeypatch.setattr(merging, "stage_observed", stage_observed)

    def lines():
        staged.clear()
        return sorted(((r.id, repr(_plain(r))) for r in merge_many_parts(df).collect()), key=repr)
    in_row = lines()
    assert staged == ["lines"]
    for most in (0, 7):
        monkeypatch.setattr(merging, "IN_ROW", most)
        assert lines() == in_row and "walks" in staged
    assert len(in_row) == len(rows) and 40 < sum(p != "None" for _, p in in_row) < 150


def test_no_lines(spark):
    assert merge_many_parts(_lines(spark, [])).count() == 0
