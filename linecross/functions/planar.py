"""Planar geometry as Spark SQL expressions.

The functions take and return SQL text, which ``F.expr`` turns into native columns: one call parses a whole formula,
and lambda variables name what a formula uses more than once.

Distances are rounded to the micrometre. Two distances that agree to that precision count as equal, so the order in
which Spark sums coordinates cannot change a tie or move a value across a tolerance.
"""

from __future__ import annotations

from collections.abc import Sequence

#: Slack in metres when a segment is listed in grid cells.
CELL_SLACK = 1e-6
#: Two positions closer than this (metres) along a line are the same position.
SNAP = 1e-9
#: A vertex at most this far (metres) from the carrier of a parallel segment lies on it.
ON_LINE = 1e-8

VERTEX_ARRAY = "array<struct<x:double,y:double,z:double,m:double>>"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once per row."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def number(value: float) -> str:
    return f"{value!r}D"


def micrometre(distance: str) -> str:
    return f"(rint(({distance}) * 1e6D) / 1e6D)"


def point_distance(x1: str, y1: str, x2: str, y2: str) -> str:
    dx, dy = f"({x1} - {x2})", f"({y1} - {y2})"
    return micrometre(f"sqrt({dx} * {dx} + {dy} * {dy})")


def clamped_position(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """Fraction in [0, 1] of the place on the segment that is nearest to the point; 0 for a point segment."""
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    length2 = f"({dx} * {dx} + {dy} * {dy})"
    along = f"(({px} - {x1}) * {dx} + ({py} - {y1}) * {dy}) / {length2}"
    return f"(CASE WHEN {length2} > 0D THEN least(greatest({along}, 0D), 1D) ELSE 0D END)"


def between(a: str, b: str, t: str) -> str:
    """Value at fraction ``t`` between ``a`` and ``b``, exactly ``b`` at 1."""
    return f"(CASE WHEN {t} = 1D THEN {b} ELSE {a} + {t} * ({b} - {a}) END)"


def nearest_spot(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """``struct<sx, sy>``: the place on the segment nearest to the point."""
    t = clamped_position(px, py, x1, y1, x2, y2)
    return let("nt", t, f"named_struct('sx', {between(x1, x2, 'nt')}, 'sy', {between(y1, y2, 'nt')})")


def segment_point_distance(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    return let("np", nearest_spot(px, py, x1, y1, x2, y2), point_distance(px, py, "np.sx", "np.sy"))


def segments_cross(a: str, b: str) -> str:
    """True if the open segments with column prefixes ``a`` and ``b`` cross each other."""
    def side(p: str, q: str, v: str) -> str:
        return f"(({p}x2 - {p}x1) * ({q}y{v} - {p}y1) - ({p}y2 - {p}y1) * ({q}x{v} - {p}x1))"
    return f"({side(a, b, '1')} * {side(a, b, '2')} < 0D AND {side(b, a, '1')} * {side(b, a, '2')} < 0D)"


def segment_distance(a: str, b: str) -> str:
    """Distance of two segments with column prefixes ``a`` and ``b`` (``ax1 ay1 ax2 ay2 bx1 …``)."""
    ends = [segment_point_distance(f"{p}x{v}", f"{p}y{v}", f"{q}x1", f"{q}y1", f"{q}x2", f"{q}y2")
            for p, q in ((a, b), (b, a)) for v in "12"]
    return f"(CASE WHEN {segments_cross(a, b)} THEN 0D ELSE least({', '.join(ends)}) END)"


# --- lines as vertex arrays -------------------------------------------------------------------------------


def part_segments(part: str) -> str:
    """Array of ``struct<a: vertex, b: vertex>`` for the consecutive vertices of one part."""
    pairs = f"zip_with(slice({part}, 1, size({part}) - 1), slice({part}, 2, size({part}) - 1), (va, vb) -> named_struct('a', va, 'b', vb))"
    return f"(CASE WHEN size({part}) > 1 THEN {pairs} END)"


def segment_lengths(segments: str) -> str:
    """2D lengths of an array from ``part_segments``."""
    return f"transform({segments}, s -> sqrt((s.b.x - s.a.x) * (s.b.x - s.a.x) + (s.b.y - s.a.y) * (s.b.y - s.a.y)))"


def running_sums(values: str) -> str:
    """Sums of an array of doubles up to each element.

    Each pass adds the value twice as far back as the pass before, so a long array takes a few passes, and none appends to an array.
    """
    passes = f"sequence(0, CAST(ceil(log2(greatest(size({values}), 2))) AS INT) - 1)"
    added = "transform(acc, (v, i) -> v + CASE WHEN i >= shiftleft(1, k) THEN get(acc, i - shiftleft(1, k)) ELSE 0D END)"
    return f"aggregate({passes}, {values}, (acc, k) -> {added})"


def force_2d(geom: str) -> str:
    """Line with z and m removed."""
    flat = "named_struct('x', v.x, 'y', v.y, 'z', CAST(NULL AS DOUBLE), 'm', CAST(NULL AS DOUBLE))"
    return f"transform({geom}, p -> transform(p, v -> {flat}))"


def promote_to_multi(part: str) -> str:
    """Multi-part line from a single vertex array; NULL stays NULL."""
    return f"(CASE WHEN {part} IS NOT NULL THEN array({part}) END)"


def _measured_segments(part: str, px: str, py: str) -> str:
    ends = ("s.a.x", "s.a.y", "s.b.x", "s.b.y")
    length = "sqrt((s.b.x - s.a.x) * (s.b.x - s.a.x) + (s.b.y - s.a.y) * (s.b.y - s.a.y))"
    measured = f"named_struct('a', s.a, 'b', s.b, 'len', {length}, 't', {clamped_position(px, py, *ends)})"
    distance = point_distance(px, py, between("q.a.x", "q.b.x", "q.t"), between("q.a.y", "q.b.y", "q.t"))
    return (f"transform(transform({part_segments(part)}, s -> {measured}), "
            f"q -> named_struct('dist', {distance}, 'along', q.t * q.len, 'len', q.len))")


def distance_to_line(geom: str, px: str, py: str) -> str:
    """Smallest distance from the point to any segment of a multi-part line."""
    return f"array_min(transform(flatten(transform({geom}, part -> {_measured_segments('part', px, py)})), d -> d.dist))"


def fraction_along(part: str, px: str, py: str) -> str:
    """Fraction of the 2D length of a single-part line at its place nearest to the point (first one on ties)."""
    step = ("named_struct('dist', CASE WHEN s.dist < acc.dist THEN s.dist ELSE acc.dist END, "
            "'at', CASE WHEN s.dist < acc.dist THEN acc.run + s.along ELSE acc.at END, 'run', acc.run + s.len)")
    return (f"aggregate({_measured_segments(part, px, py)}, named_struct('dist', double('Infinity'), 'at', 0D, 'run', 0D), "
            f"(acc, s) -> {step}, acc -> CASE WHEN acc.run > 0D THEN acc.at / acc.run ELSE 0D END)")


def points_at_measure(geom: str, measure: str) -> str:
    """All vertices of the line where m equals ``measure``; other ordinates are interpolated.

    Empty when the measure lies outside the line. A vertex shared by two segments is returned once.
    """
    inside = f"{measure} >= least(s.a.m, s.b.m) AND {measure} <= greatest(s.a.m, s.b.m) AND s.a.m IS NOT NULL AND s.b.m IS NOT NULL"
    t = f"CASE WHEN s.a.m = s.b.m THEN 0.5D ELSE ({measure} - s.a.m) / (s.b.m - s.a.m) END"
    axes = ", ".join(f"'{axis}', {between(f's.a.{axis}', f's.b.{axis}', 't')}" for axis in "xyz")
    place = let("t", t, f"named_struct({axes}, 'm', {measure})")
    hits = f"transform(filter({part_segments('part')}, s -> {inside}), s -> {place})"
    unrepeated = let("hits", hits, "filter(hits, (h, i) -> i = 0 OR NOT (h <=> get(hits, i - 1)))")
    return f"flatten(transform({geom}, part -> coalesce({unrepeated}, CAST(array() AS {VERTEX_ARRAY}))))"


# --- grid cells -------------------------------------------------------------------------------------------


def cell_of(value: str, size: str) -> str:
    return f"CAST(floor(({value}) / {size}) AS BIGINT)"


def traversed_cells(ends: Sequence[str], size: str) -> str:
    """Cells (array of ``struct<cx, cy>``) a segment runs through, column by column of the grid.

    ``ends`` names ``x1 y1 x2 y2``. A diagonal of n columns gives about 2n cells, not n squared. Each cell is widened
    by ``CELL_SLACK``.
    """
    x1, y1, x2, y2 = ends
    slack = number(CELL_SLACK)
    left, right = f"least({x1}, {x2})", f"greatest({x1}, {x2})"
    x_lo, x_hi = cell_of(f"{left} - {slack}", size), cell_of(f"{right} + {slack}", size)
    y_lo, y_hi = cell_of(f"least({y1}, {y2}) - {slack}", size), cell_of(f"greatest({y1}, {y2}) + {slack}", size)

    def y_at(x: str) -> str:
        return f"({y1} + ({x} - {x1}) / ({x2} - {x1}) * ({y2} - {y1}))"
    span = (f"named_struct('p', {y_at(f'greatest({left}, col * {size} - {slack})')}, "
            f"'q', {y_at(f'least({right}, (col + 1) * {size} + {slack})')})")
    low = f"greatest({cell_of(f'least(span.p, span.q) - {slack}', size)}, {y_lo})"
    high = f"least({cell_of(f'greatest(span.p, span.q) + {slack}', size)}, {y_hi})"
    rows = f"CASE WHEN {right} - {left} > {slack} THEN {let('span', span, f'sequence({low}, greatest({low}, {high}))')} ELSE sequence({y_lo}, {y_hi}) END"
    cells = f"flatten(transform(sequence({x_lo}, {x_hi}), col -> transform({rows}, r -> named_struct('cx', col, 'cy', r))))"
    return (f"(CASE WHEN {x_lo} = {x_hi} AND {y_lo} = {y_hi} THEN array(named_struct('cx', {x_lo}, 'cy', {y_lo})) "
            f"ELSE {cells} END)")


def cells_around(cx: str, cy: str, reach: int) -> str:
    """The square block of cells at most ``reach`` columns and rows away."""
    steps = f"sequence(-{reach}L, {reach}L)"
    return (f"flatten(transform({steps}, dx -> transform({steps}, dy -> "
            f"named_struct('cx', {cx} + dx, 'cy', {cy} + dy))))")
