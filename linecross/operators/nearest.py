"""Nearest-neighbour joins of points with pieces (points or segments).

Exact for any density, in rounds. Pieces are listed in the grid cells they run through; a cell knows how many pieces start in it, how
many are listed, and the box they fill. Cells roll up to cells twice as wide. A point starts with the cells around the smallest one
that holds it and ``k`` pieces. Each round measures the boxes: the farthest corners of boxes with ``k`` pieces bound the k-th
distance, and cells beyond the bound are dropped. A point that has few listed pieces left is settled and leaves; the others go on
with the cells their cells are made of, below the grid with cells of a quarter's width made from the pieces of the cells still
asked for. So a point beside a dense heap meets the heap's rim, not all of it. Settled points are then joined with the pieces of their
cells. Order: distance, then the tie columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window, functions as F

from linecross.functions import planar
from linecross.staging import stage, stage_observed

#: A point that could meet more pieces than this goes on to smaller cells.
PIECES_PER_POINT = 1_024
FINEST_CELL = 2.0 ** -20
#: Halvings from round to round, and doublings rolled up in one pass: few at first, while the cells are many.
STEP, ROLL_UP = 2, (2, 2, 6)
#: Widths tried above the given one for the smallest cells, and levels looked up at once for a point's own cell.
DOUBLINGS, LOOK_UP = 8, 4
#: Filled cells may hold as many pieces on average, if that is more than are looked for.
PIECES_PER_CELL = 3

_ENDS = ("x1", "y1", "x2", "y2")
_BOX = ("x_lo", "y_lo", "x_hi", "y_hi")
#: Bounds are compared with this slack (metres), far above rounding.
_SLACK = 1e-5


class _Grid:
    """Square cells of a width at level 0, twice as wide at each level above, half as wide below."""

    def __init__(self, size: float, west: float = 0.0, south: float = 0.0):
        self.size, self.origin = size, {"x": west, "y": south}

    def width(self, level: int = 0) -> str:
        return planar.number(self.size * 2.0 ** level)

    def cell(self, axis: str, value: str, level: int = 0) -> str:
        return planar.cell_of(f"{value} - {planar.number(self.origin[axis])}", self.width(level))

    def crossed(self, level: int = 0) -> str:
        """Cells that a piece runs through."""
        return planar.traversed_cells([f"({c} - {planar.number(self.origin[c[0]])})" for c in _ENDS], self.width(level))

    def nodes(self, listed: DataFrame, keys: list[str], level: int = 0) -> DataFrame:
        """Cells with the number of pieces that start in them (``n``), of listed ones (``m``), and the box that these fill."""
        starts = " AND ".join(f"{self.cell(axis, f'{axis}1', level)} = c{axis}" for axis in "xy")
        filled = listed.groupBy(*keys, "cx", "cy").agg(
            F.expr(f"count_if({starts}) AS n"), F.expr("count(*) AS m"),
            *[F.expr(f"min(least({v}1, {v}2)) AS {v}_lo") for v in "xy"], *[F.expr(f"max(greatest({v}1, {v}2)) AS {v}_hi") for v in "xy"])
        edge = {v: f"{planar.number(self.origin[v])} + c{v} * {self.width(level)}" for v in "xy"}
        slack = planar.number(_SLACK)
        return filled.selectExpr(
            *keys, f"{level} AS level", "cx", "cy", "n", "m", *[f"greatest({v}_lo, {edge[v]} - {slack}) AS {v}_lo" for v in "xy"],
            *[f"least({v}_hi, {edge[v]} + {self.width(level)} + {slack}) AS {v}_hi" for v in "xy"])


def _fullest(listed: DataFrame, keys: list[str]) -> int:
    """The most pieces listed in one cell."""
    return listed.groupBy(*keys, "cx", "cy").agg(F.count("*").alias("m")).agg(F.max("m")).first()[0] or 0


def _rolled_up(nodes: DataFrame, keys: list[str], last: int) -> DataFrame:
    """``nodes`` and the cells of all levels up to ``last``, a few levels at a time from those below."""
    levels, base, high = [nodes], nodes, 0
    while high < last:
        low, high = high, min(high + ROLL_UP[min(len(levels), len(ROLL_UP)) - 1], last)
        wider = base.selectExpr(*keys, f"explode(sequence({low + 1}, {high})) AS level", "cx", "cy", "n", "m", *_BOX).selectExpr(
            *keys, "level", *[f"shiftright({c}, level - {low}) AS {c}" for c in ("cx", "cy")], "n", "m", *_BOX)
        wider = stage(wider.groupBy(*keys, "level", "cx", "cy").agg(
            *[F.sum(c).alias(c) for c in "nm"], *[F.min(c).alias(c) for c in _BOX[:2]], *[F.max(c).alias(c) for c in _BOX[2:]]), "cells")
        levels.append(wider)
        base = wider.where(F.col("level") == high)
    return _union(levels)


def _extent(points: DataFrame, pieces: DataFrame, keys: list[str], cell: float, k: int) -> tuple[float, float, float, float]:
    """West and south edge (whole metres) and width of a square that holds all points and pieces; and the width of cells to begin with.

    That width is ``cell``, doubled as long as the filled cells hold few pieces on average: where pieces are sparse, smaller cells are
    only more of them. It bears on the work alone, so the filled cells are counted by sketches.
    """
    corners = points.selectExpr("px AS w", "px AS e", "py AS s", "py AS n", "0 AS pieces", *[f"CAST(NULL AS BIGINT) AS f{i}" for i in range(DOUBLINGS)])
    cells = [[planar.cell_of(v, planar.number(cell * 2.0 ** (i + 1))) for v in ("x1", "y1")] for i in range(DOUBLINGS)]
    places = [f"xxhash64({', '.join([*keys, *cells[i]])}) AS f{i}" for i in range(DOUBLINGS)]
    corners = corners.unionAll(pieces.selectExpr(
        "least(x1, x2) AS w", "greatest(x1, x2) AS e", "least(y1, y2) AS s", "greatest(y1, y2) AS n", "1 AS pieces", *places))
    box = corners.agg(F.expr("min(w) AS w"), F.expr("max(e) AS e"), F.expr("min(s) AS s"), F.expr("max(n) AS n"), F.sum("pieces").alias("pieces"),
                      *[F.approx_count_distinct(f"f{i}").alias(f"f{i}") for i in range(DOUBLINGS)]).first()
    if box.w is None:
        return 0.0, 0.0, 0.0, cell
    west, south = math.floor(box.w) - 1.0, math.floor(box.s) - 1.0
    for i in range(DOUBLINGS):
        if not box.pieces or box.pieces > max(k, PIECES_PER_CELL) * box[f"f{i}"]:
            break
        cell *= 2.0
    return west, south, max(box.e - west, box.n - south) + 1.0, cell


def _own_levels(spots: DataFrame, nodes: DataFrame, keys: list[str], k: int, last: int) -> DataFrame:
    """``own``, the level of the smallest cell that holds ``k`` pieces, for each cell ``gx, gy`` of a point that has one.

    A few levels at a time: most cells find theirs in the first ones, and only the others go on.
    """
    cell = [*keys, "gx", "gy"]
    rest, seen = stage_observed(spots.select(*cell).distinct(), "point-cells", n="count(*)")
    found, left = [], seen["n"] or 0
    for low in range(0, last + 1, LOOK_UP):
        high = min(low + LOOK_UP - 1, last)
        here, seen = stage_observed(rest.selectExpr("*", f"explode(sequence({low}, {high})) AS level").selectExpr(
            "*", "shiftright(gx, level) AS cx", "shiftright(gy, level) AS cy").join(
            nodes.where((F.col("n") >= k) & F.col("level").between(low, high)), [*keys, "level", "cx", "cy"], "left_semi").groupBy(*cell).agg(
            F.min("level").alias("own")), "own-levels", n="count(*)")
        found.append(here)
        left -= seen["n"] or 0
        if left <= 0:
            break
        rest = rest.join(here, cell, "left_anti")
    return _union(found)


def _k_first(candidates: DataFrame, group: list[str], ties: list[str], carry: list[str], k: int) -> DataFrame:
    """The k nearest candidates of each point. k = 1 is a plain minimum with map-side combine."""
    if k == 1:
        key = F.struct("distance", *ties, *[c for c in carry if c not in ties])
        best = candidates.groupBy(*group).agg(F.min(key).alias("_best"))
        return best.select(*group, "_best.*", F.lit(1).alias("rank"))
    order = Window.partitionBy(*group).orderBy("distance", *ties)
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _bounded(asked: DataFrame, nodes: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Cells that points ask for (``px, py, allowed`` and a cell), as far as they can hold one of the k nearest.

    ``allowed`` becomes the bound of the k-th distance, and ``load`` the number of pieces listed in the point's cells; ``before`` is
    the load of the round before.
    """
    met = asked.hint("merge").join(nodes, [*keys, "level", "cx", "cy"])
    near = [f"greatest(0D, {v}_lo - p{v}, p{v} - {v}_hi)" for v in "xy"]
    far = [f"greatest(p{v} - {v}_lo, {v}_hi - p{v})" for v in "xy"]
    point = Window.partitionBy(*keys, "px", "py")
    so_far = point.orderBy("far", "cx", "cy").rowsBetween(Window.unboundedPreceding, 0)
    met = met.selectExpr(*keys, "px", "py", "allowed", "before", "level", "cx", "cy", "n", "m",
                         *[f"sqrt({a} * {a} + {b} * {b}) AS {name}" for name, (a, b) in (("near", near), ("far", far))]).where(F.col("near") <= F.col("allowed") + _SLACK)
    met = met.withColumn("_n", F.sum("n").over(so_far)).withColumn(
        "allowed", F.least("allowed", F.min(F.when(F.col("_n") >= k, F.col("far") + _SLACK)).over(point)))
    return met.where(F.col("near") <= F.col("allowed") + _SLACK).withColumn("load", F.sum("m").over(point)).select(
        *keys, "px", "py", "allowed", "before", "level", "cx", "cy", "load")


def _inner_cells(active: DataFrame, keys: list[str], halvings: str) -> DataFrame:
    """The cells that the asked ones are made of, ``halvings`` levels below."""
    cells = (f"flatten(transform(sequence(0, shiftleft(1, {halvings}) - 1), i -> transform(sequence(0, shiftleft(1, {halvings}) - 1), "
             f"j -> named_struct('cx', shiftleft(cx, {halvings}) + i, 'cy', shiftleft(cy, {halvings}) + j))))")
    return active.selectExpr(*keys, "px", "py", "allowed", "load AS before", f"level - {halvings} AS level", f"explode({cells}) AS c").selectExpr(
        *keys, "px", "py", "allowed", "before", "level", "c.cx", "c.cy")


def _narrowed(listed: DataFrame, asked: DataFrame, grid: _Grid, keys: list[str], level: int) -> DataFrame:
    """Pieces of the asked cells listed in the cells of ``level``, which is ``STEP`` below."""
    inside = listed.join(asked.select(*keys, "cx", "cy").distinct(), [*keys, "cx", "cy"], "left_semi")
    within = f"filter({grid.crossed(level)}, c -> shiftright(c.cx, {STEP}) = cx AND shiftright(c.cy, {STEP}) = cy)"
    return inside.selectExpr("* EXCEPT (cx, cy)", f"inline({within})")


def _pairs(settled: DataFrame, listed: DataFrame, grid: _Grid, keys: list[str], level: int) -> DataFrame:
    """Settled points with the pieces listed in their cells; ``listed`` has the cell of ``level`` as ``hx, hy`` too."""
    # Merge join: the planner's sizes leave out the exploded cells, so it could broadcast far more than its limit.
    # The join compares boxes; inline keeps the exact distance out of the join condition, where it would be repeated.
    gap = [f"greatest(0D, least({v}1, {v}2) - p{v}, p{v} - greatest({v}1, {v}2))" for v in "xy"]
    slack = planar.number(2 * _SLACK)
    met = settled.select(*keys, "px", "py", "allowed", "level", "cx", "cy").hint("merge").join(listed, [*keys, "level", "cx", "cy"]).where(
        f"{gap[0]} * {gap[0]} + {gap[1]} * {gap[1]} <= (allowed + {slack}) * (allowed + {slack})")

    def step(df: DataFrame, **values: str) -> DataFrame:
        return df.selectExpr("*", "inline(array(named_struct(" + ", ".join(f"'{n}', {v}" for n, v in values.items()) + ")))")
    met = step(met, t=planar.clamped_position("px", "py", *_ENDS))
    met = step(met, sx=planar.between("x1", "x2", "t"), sy=planar.between("y1", "y2", "t"))
    # a segment may be listed in several cells: the nearest spot on it lies in one
    return step(met, distance=planar.point_distance("px", "py", "sx", "sy")).where(
        f"{grid.cell('x', 'sx', level)} = hx AND {grid.cell('y', 'sy', level)} = hy")


def _narrow_rounds(rows: DataFrame, listed: DataFrame, grid: _Grid, keys: list[str], order: list[str], k: int,
                   crowded: str) -> list[tuple[int, DataFrame, DataFrame]]:
    """Rounds below the grid for points whose cells of level 0 are crowded: levels, settled points, and pieces in cells."""
    # Of one place the k first pieces go on; more copies cannot be among the k nearest of any point.
    copies = Window.partitionBy(*keys, "cx", "cy", *_ENDS).orderBy(*order)
    cells = listed.join(rows.select(*keys, "cx", "cy").distinct(), [*keys, "cx", "cy"], "left_semi").withColumn(
        "_n", F.row_number().over(copies)).where(F.col("_n") <= k).drop("_n")
    found, level = [], 0
    while grid.size * 2.0 ** (level - STEP) >= FINEST_CELL:
        level -= STEP
        cells = stage(_narrowed(cells, rows, grid, keys, level), "narrow-cells")
        met, seen = stage_observed(_bounded(_inner_cells(rows, keys, str(STEP)), grid.nodes(cells, keys, level), keys, k), "asked",
                                   crowded=f"count_if({crowded})")
        found.append((level, met.where(f"NOT {crowded}"), cells))
        if not seen["crowded"]:
            return found
        rows = met.where(crowded)
    return [*found, (level, rows, cells)]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def nearest_k(points: DataFrame, pieces: DataFrame, k: int, ties: Sequence[str], keys: Sequence[str] = (),
              cell: float = 16.0, max_distance: float | None = None, x: str = "x", y: str = "y",
              carry: Sequence[str] = (), pieces_per_point: int = PIECES_PER_POINT,
              compared: Observation | None = None) -> DataFrame:
    """For every row of ``points`` its ``k`` nearest ``pieces`` with equal ``keys``.

    ``pieces`` has ``x1 y1 x2 y2``; ``ties`` orders pieces at equal distance and is returned, and so is ``carry``.
    Columns of ``pieces`` must not collide with those of ``points`` except ``keys``. With ``max_distance`` only
    neighbours nearer than that (strictly) are found. Result: columns of ``points``, ``ties``, ``carry``,
    ``distance`` and ``rank`` from 1. Points without a neighbour have no row. ``compared`` observes how many ``pairs`` of points and
    pieces were measured.
    """
    keys, ties = list(keys), list(ties)
    extra = [c for c in carry if c not in ties]
    pieces = pieces.select(*keys, *_ENDS, *ties, *extra)
    places = points.select(*keys, F.col(x).alias("px"), F.col(y).alias("py")).where("px IS NOT NULL AND py IS NOT NULL")
    places = places.distinct()

    # the grid and its cells
    if max_distance is None:
        west, south, width, cell = _extent(places, pieces, keys, float(cell), k)
        grid, last = _Grid(float(cell), west, south), max(0, math.ceil(math.log2(max(width, cell) / cell)))
    else:
        grid, last = _Grid(float(max_distance)), 0
    listed = pieces.selectExpr("*", f"inline({grid.crossed()})")
    loose = max_distance is not None and _fullest(listed, keys) <= pieces_per_point
    nodes = None if loose else _rolled_up(stage(grid.nodes(listed, keys), "cells"), keys, last)

    # the smallest cell that holds a point and k pieces bounds the k-th distance by its diagonal; without a limit the last level has
    # one cell, and a point that is alone with fewer pieces looks at all of them
    limit = "double('Infinity')" if max_distance is None else planar.number(float(max_distance))
    spots = places.selectExpr("*", f"{grid.cell('x', 'px')} AS gx", f"{grid.cell('y', 'py')} AS gy")
    if last:
        own = _own_levels(spots, nodes, keys, k, last)
        diagonal = f"{planar.number(grid.size * math.sqrt(2) * (1 + 1e-9))} * shiftleft(1L, own) + {planar.number(_SLACK)}"
        spots = spots.join(own, [*keys, "gx", "gy"], "left").selectExpr(
            "*", f"coalesce({diagonal}, {limit}) AS allowed", f"coalesce(least(own + 1, {last}), {last}) AS level")
    else:
        spots = spots.selectExpr("*", f"{limit} AS allowed", "0 AS level")

    def reached(axis: str) -> str:
        ends = [planar.cell_of(f"p{axis} - {planar.number(grid.origin[axis])} {sign} r", f"({grid.width()} * shiftleft(1L, level))") for sign in "-+"]
        return f"sequence({', '.join(ends)})"
    around = f"flatten(transform({reached('x')}, i -> transform({reached('y')}, j -> named_struct('cx', i, 'cy', j))))"
    asked = spots.selectExpr("*", "CASE WHEN allowed = double('Infinity') THEN 0D ELSE allowed END AS r").selectExpr(
        *keys, "px", "py", "allowed", f"{2 ** 63 - 1}L AS before", "level", f"inline({around})")

    # rounds: settled points leave, the others go on to smaller cells
    settled, narrow, used = [], [], set()
    if loose:
        settled.append(asked)
        used.add(0)
    else:
        # a long piece is listed more often in smaller cells: once these lists grow, smaller cells no longer help
        crowded, hot = f"(load > {max(int(pieces_per_point), 4 * k)} AND load <= before)", []
        while True:
            met, seen = stage_observed(
                _bounded(asked, nodes, keys, k), "asked", above=f"count_if({crowded} AND level > 0)", below=f"count_if({crowded} AND level = 0)",
                levels=f"bit_or(CASE WHEN NOT {crowded} THEN shiftleft(1L, level) END)")
            settled.append(met.where(f"NOT {crowded}"))
            used |= {level for level in range(last + 1) if (seen["levels"] or 0) >> level & 1}
            if seen["below"]:
                hot.append(met.where(f"{crowded} AND level = 0"))
            if not seen["above"]:
                break
            asked = _inner_cells(met.where(f"{crowded} AND level > 0"), keys, f"least({STEP}, level)")
        if hot:
            narrow = _narrow_rounds(_union(hot), listed, grid, keys, [*ties, *extra], k, crowded)

    spread = listed.withColumnsRenamed({"cx": "hx", "cy": "hy"}).selectExpr(
        "*", f"explode(array({', '.join(map(str, sorted(used or {0})))})) AS level").selectExpr(
        "*", "shiftright(hx, level) AS cx", "shiftright(hy, level) AS cy")
    columns = [*keys, "px", "py", "allowed", *ties, *extra, "distance"]
    candidates = _union([_pairs(_union(settled), spread, grid, keys, 0).select(*columns), *[
        _pairs(rows, cells.selectExpr("*", f"{level} AS level", "cx AS hx", "cy AS hy"), grid, keys, level).select(*columns)
        for level, rows, cells in narrow]])
    if compared is not None:
        candidates = candidates.observe(compared, F.count("*").alias("pairs"))
    candidates = candidates.where(f"distance <= allowed + {planar.number(_SLACK)}")
    if max_distance is not None:
        candidates = candidates.where(f"distance < {limit}")
    best = _k_first(candidates.drop("allowed"), [*keys, "px", "py"], ties, extra, k)
    return points.withColumn("px", F.col(x)).withColumn("py", F.col(y)).join(best, [*keys, "px", "py"]).select(
        *points.columns, *ties, *extra, "distance", "rank")


def nearest_within(points: DataFrame, pieces: DataFrame, distance: float, ties: Sequence[str],
                   keys: Sequence[str] = (), x: str = "x", y: str = "y", carry: Sequence[str] = (),
                   pieces_per_point: int = PIECES_PER_POINT) -> DataFrame:
    """The nearest piece of every point, if it is nearer than ``distance``."""
    return nearest_k(points, pieces, 1, ties, keys, max_distance=distance, x=x, y=y, carry=carry,
                     pieces_per_point=pieces_per_point).drop("rank")


def _clip_hits_polygon(radius: float, quad_segs: int) -> str:
    """True if the segment meets the regular polygon that stands for a buffer around the point (Cyrus-Beck)."""
    sides = 4 * quad_segs
    inner = planar.number(radius * math.cos(math.pi / sides))
    angles = [(i + 0.5) * 2 * math.pi / sides for i in range(sides)]
    normals = ", ".join(f"named_struct('nx', {math.cos(a)!r}D, 'ny', {math.sin(a)!r}D)" for a in angles)
    # a half-plane keeps the part of the segment where start + t * slope <= inner
    halves = (f"transform(array({normals}), n -> named_struct('start', (x1 - px) * n.nx + (y1 - py) * n.ny, "
              "'slope', (x2 - x1) * n.nx + (y2 - y1) * n.ny))")
    cut = (f"CASE WHEN abs(h.slope) < 1e-12D THEN named_struct('low', acc.low, 'high', CASE WHEN h.start > {inner} THEN -1D ELSE acc.high END) "
           f"WHEN h.slope < 0D THEN named_struct('low', greatest(acc.low, ({inner} - h.start) / h.slope), 'high', acc.high) "
           f"ELSE named_struct('low', acc.low, 'high', least(acc.high, ({inner} - h.start) / h.slope)) END")
    return f"aggregate({halves}, named_struct('low', 0D, 'high', 1D), (acc, h) -> {cut}, acc -> acc.low <= acc.high)"


def buffer_semi_join(points: DataFrame, segments: DataFrame, radius: float, point_id: str, quad_segs: int = 8,
                     true_distance: bool = False, x: str = "x", y: str = "y",
                     pieces_per_point: int = PIECES_PER_POINT) -> DataFrame:
    """Points whose buffer meets a segment. The buffer is a polygon with ``quad_segs`` sides per quarter circle.

    Almost all points are decided by the distance of their nearest segment: a hit inside the polygon's inner circle,
    a miss beyond its corners. Only points in the thin ring between the two are clipped against the polygon.
    ``true_distance=True`` tests the distance alone.
    """
    places = points.select(point_id, F.col(x).alias("px"), F.col(y).alias("py"))
    shapes = segments.select(*_ENDS).distinct()
    beyond = radius + 2e-6
    near = nearest_within(places, shapes, beyond, list(_ENDS), x="px", y="py", pieces_per_point=pieces_per_point)
    near = stage(near.where(F.col("distance") <= radius).select(point_id, "px", "py", "distance"), "near")
    if true_distance:
        return points.join(near.select(point_id), point_id, "left_semi")
    inner = radius * math.cos(math.pi / (4 * quad_segs)) - 2e-6
    ring = near.where(F.col("distance") > inner)
    hits = near.where(F.col("distance") <= inner).select(point_id)
    if not ring.isEmpty():
        size = planar.number(float(radius))
        around = planar.cells_around(planar.cell_of("px", size), planar.cell_of("py", size), 2)
        listed = shapes.selectExpr("*", f"inline({planar.traversed_cells(_ENDS, size)})")
        pairs = ring.selectExpr(point_id, "px", "py", f"inline({around})").hint("merge").join(listed, ["cx", "cy"])
        close = f"{planar.segment_point_distance('px', 'py', *_ENDS)} <= {planar.number(float(radius))}"
        hits = hits.unionByName(pairs.where(f"{close} AND {_clip_hits_polygon(radius, quad_segs)}").select(point_id))
    return points.join(hits.distinct(), point_id, "left_semi")
