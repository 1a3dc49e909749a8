"""Line-on-line spatial join and exact intersection.

Segments are listed in the grid cells they run through and joined on the cell. The place where a pair meets
lies in exactly one cell, and only that cell keeps the pair, so no pair appears twice and none is lost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from linecross.functions import planar
from linecross.operators.lines import explode_parts
from linecross.staging import stage

#: A cell whose two sides could form more pairs than this is split, and what is still beyond it is dealt out by salt.
PAIRS_PER_CELL = 4_000_000
#: Finer cells than this part of a cell no longer part segments; salts do the rest.
MAX_SPLIT = 128
#: Width of the cells counted first, in cells of the given width.
COARSE = 16
#: Cells are as wide as this many segments of usual length, if that is more than the given width, and doubled this often at most.
LENGTHS_PER_CELL, DOUBLINGS = 2.0, 8


def _segments(df: DataFrame, id_col: str, attrs: Sequence[str], prefix: str) -> DataFrame:
    parts = explode_parts(df.select(id_col, *attrs, "geom"))
    named = [f"{id_col} AS {prefix}id", *attrs, f"part_no AS {prefix}part"]
    rows = parts.selectExpr(*named, f"xxhash64(part) AS {prefix}print", f"explode({planar.part_segments('part')}) AS s")
    ends = [f"s.{v}.{axis} AS {prefix}{axis}{n}" for n, v in ((1, "a"), (2, "b")) for axis in ("x", "y")]
    rows = rows.selectExpr(*[c for c in rows.columns if c != "s"], *ends)
    return rows.where(f"{prefix}x1 <> {prefix}x2 OR {prefix}y1 <> {prefix}y2")


def _ends(prefix: str) -> list[str]:
    return [f"{prefix}{n}" for n in ("x1", "y1", "x2", "y2")]


def _celled(segments: DataFrame, prefix: str, size: float) -> DataFrame:
    return segments.selectExpr("*", f"inline({planar.traversed_cells(_ends(prefix), planar.number(size))})")


def _cell_width(left: DataFrame, right: DataFrame, cell: float) -> float:
    """``cell``, doubled as long as a segment of usual length would be listed in many cells; it bears on the work alone."""
    def lengths(df: DataFrame, p: str) -> DataFrame:
        return df.selectExpr(f"ln(greatest(abs({p}x2 - {p}x1), abs({p}y2 - {p}y1))) AS length")
    # the geometric mean: a few very long segments do not widen the cells of all others
    usual = lengths(left, "l").unionAll(lengths(right, "r")).agg(F.avg("length")).first()[0]
    for _ in range(DOUBLINGS if usual is not None else 0):
        if cell >= LENGTHS_PER_CELL * math.exp(min(usual, 700.0)):
            break
        cell *= 2.0
    return cell


def _loads(left: DataFrame, right: DataFrame, budget: int) -> DataFrame:
    """Cells whose two sides could form more than ``budget`` pairs, with that ratio as ``load``."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cx", "cy").agg(F.count("*").alias(name))
    pairs = count(left, "_l").join(count(right, "_r"), ["cx", "cy"])
    load = F.col("_l").cast("double") * F.col("_r") / budget
    return pairs.select("cx", "cy", load.alias("load")).where(F.col("load") > 1)


def _hot_cells(left: DataFrame, right: DataFrame, cell: float, wide: float, budget: int) -> DataFrame | None:
    """Cells to split and the factor by which to divide their sides; None if there are none.

    Cells of the width ``wide``, a multiple of ``cell``, are counted first: they combine on the map side to few rows, and only a
    coarse cell over the budget can hold a hot one.
    """
    coarse = _loads(_celled(left, "l", wide), _celled(right, "r", wide), budget)
    if coarse.isEmpty():
        return None
    inside = stage(coarse.select("cx", "cy"), "coarse-cells")

    def candidates(df: DataFrame, prefix: str) -> DataFrame:
        return _celled(_celled(df, prefix, wide).join(inside, ["cx", "cy"], "left_semi").drop("cx", "cy"), prefix, cell)
    halvings = F.least(F.ceil(F.log2("load") / 2), F.lit(MAX_SPLIT.bit_length() - 1))
    hot = _loads(candidates(left, "l"), candidates(right, "r"), budget)
    return stage(hot.select("cx", "cy", F.pow(F.lit(2.0), halvings).cast("int").alias("_f")), "hot-cells")


def _split(celled: DataFrame, hot: DataFrame, prefix: str, size: float) -> DataFrame:
    """Rows of hot cells repeated for the sub-cells they run through; other rows keep sub-cell (0, 0)."""
    marked = celled.join(hot, ["cx", "cy"], "left").selectExpr("* EXCEPT (_f)", "coalesce(_f, 1) AS _f")
    cells = planar.traversed_cells(_ends(prefix), f"({planar.number(size)} / _f)")
    inside = f"filter({cells}, c -> c.cx >= cx * _f AND c.cx < (cx + 1) * _f AND c.cy >= cy * _f AND c.cy < (cy + 1) * _f)"
    sub = f"CASE WHEN _f = 1 THEN array(named_struct('cx', 0L, 'cy', 0L)) ELSE {inside} END"
    return marked.selectExpr("*", f"explode({sub}) AS _sub").selectExpr("* EXCEPT (_sub)", "_sub.cx AS sx", "_sub.cy AS sy")


def _dealt(left: DataFrame, right: DataFrame, keys: list[str], budget: int) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with a ``salt`` that keeps every join key within the budget; None if all keys are within it.

    Dividing a cell cannot part segments that lie on each other. Of such a key the larger side is dealt out over as many salts as
    it has budgets of pairs, and the smaller side is copied to each.
    """
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.where("_f > 1").groupBy(*keys).agg(F.count("*").alias(name))
    crowded = stage(count(left, "_l").join(count(right, "_r"), keys).where(f"CAST(_l AS DOUBLE) * _r > {budget}").selectExpr(
        *keys, f"CAST(ceil(CAST(_l AS DOUBLE) * _r / {budget}) AS INT) AS _salts", "_l >= _r AS _deal_left"), "crowded-keys")
    if crowded.isEmpty():
        return None

    def salted(df: DataFrame, prefix: str, dealt: str) -> DataFrame:
        row = f"xxhash64({', '.join([f'{prefix}id', f'{prefix}part', *_ends(prefix)])})"
        # null salts: not a crowded key
        salt = (f"CASE WHEN _salts IS NULL THEN array(0) WHEN {dealt} THEN array(CAST(pmod({row}, _salts) AS INT)) "
                "ELSE sequence(0, _salts - 1) END")
        return df.join(crowded, keys, "left").selectExpr("* EXCEPT (_salts, _deal_left)", f"explode({salt}) AS salt")
    return salted(left, "l", "_deal_left"), salted(right, "r", "NOT _deal_left")


def _meeting() -> str:
    """Where segments ``l`` and ``r`` meet: ``struct<x1,y1,x2,y2>``, a point with equal ends, NULL if they do not."""
    eps = planar.number(planar.SNAP)
    shape = ("named_struct('ldx', lx2 - lx1, 'ldy', ly2 - ly1, 'rdx', rx2 - rx1, 'rdy', ry2 - ry1, 'qx', rx1 - lx1, 'qy', ry1 - ly1, "
             "'llen', sqrt((lx2 - lx1) * (lx2 - lx1) + (ly2 - ly1) * (ly2 - ly1)), "
             "'rlen', sqrt((rx2 - rx1) * (rx2 - rx1) + (ry2 - ry1) * (ry2 - ry1)))")
    den = "(g.ldx * g.rdy - g.ldy * g.rdx)"

    def snapped(t: str, length: str) -> str:
        return planar.let("w", t, f"CASE WHEN abs(w) * {length} <= {eps} THEN 0D WHEN abs(w - 1D) * {length} <= {eps} THEN 1D ELSE w END")

    def place(axis: str) -> str:
        return (f"CASE WHEN h.t = 0D THEN l{axis}1 WHEN h.t = 1D THEN l{axis}2 WHEN h.u = 0D THEN r{axis}1 "
                f"WHEN h.u = 1D THEN r{axis}2 ELSE l{axis}1 + h.t * (l{axis}2 - l{axis}1) END")
    hit = (f"named_struct('t', {snapped(f'(g.qx * g.rdy - g.qy * g.rdx) / {den}', 'g.llen')}, "
           f"'u', {snapped(f'(g.qx * g.ldy - g.qy * g.ldx) / {den}', 'g.rlen')})")
    spot = planar.let("e", f"named_struct('x', {place('x')}, 'y', {place('y')})",
                      "named_struct('x1', e.x, 'y1', e.y, 'x2', e.x, 'y2', e.y)")
    at_point = planar.let("h", hit, f"CASE WHEN h.t BETWEEN 0D AND 1D AND h.u BETWEEN 0D AND 1D THEN {spot} END")

    def position(v: str) -> str:
        return snapped(f"((rx{v} - lx1) * g.ldx + (ry{v} - ly1) * g.ldy) / (g.llen * g.llen)", "g.llen")

    def vertex(at: str) -> str:
        ends = [(f"{at} = 0D", "l", 1), (f"{at} = 1D", "l", 2), (f"{at} = p.p1", "r", 1), ("true", "r", 2)]
        return "CASE " + " ".join(f"WHEN {test} THEN named_struct('x', {s}x{v}, 'y', {s}y{v})" for test, s, v in ends) + " END"
    shared = planar.let(
        "c", "named_struct('low', greatest(0D, least(p.p1, p.p2)), 'high', least(1D, greatest(p.p1, p.p2)))",
        "CASE WHEN c.high >= c.low THEN " + planar.let(
            "e", f"array_sort(array({vertex('c.low')}, {vertex('c.high')}))",
            "named_struct('x1', e[0].x, 'y1', e[0].y, 'x2', e[1].x, 'y2', e[1].y)") + " END")
    parallel = planar.let("p", f"named_struct('p1', {position('1')}, 'p2', {position('2')})", shared)
    return planar.let("g", shape, (
        f"CASE WHEN abs({den}) > 1e-12D * g.llen * g.rlen THEN {at_point} "
        f"WHEN abs(g.qx * g.ldy - g.qy * g.ldx) <= {planar.number(planar.ON_LINE)} * g.llen THEN {parallel} END"))


def _whole_pieces(pieces: str) -> str:
    """Distinct pieces of one part pair, without points that lie on an overlap of the same pair."""
    on = planar.segment_point_distance("p.x1", "p.y1", "o.x1", "o.y1", "o.x2", "o.y2")
    return (f"CASE WHEN size({pieces}) = 1 THEN {pieces} ELSE filter({pieces}, p -> p.x1 <> p.x2 OR p.y1 <> p.y2 "
            f"OR NOT exists({pieces}, o -> (o.x1 <> o.x2 OR o.y1 <> o.y2) AND {on} = 0D)) END")


def intersect_lines(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                    left_attrs: Sequence[str] = (), right_attrs: Sequence[str] = (),
                    part_pairing: str = "lockstep", cell: float = 100.0,
                    pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """Intersection pieces of two line layers with a ``geom`` column.

    Each row is a place shared by one part of a left and one part of a right line: the two ids, the attributes,
    part numbers and ``x1 y1 x2 y2``. A point has equal ends; a collinear overlap is one row per segment pair.

    ``part_pairing='lockstep'`` lets part *i* of a line meet part *i* of the other one only;
    ``'all_pairs'`` lets all parts meet. Rows with equal id and equal line count once.
    """
    if part_pairing not in ("lockstep", "all_pairs"):
        raise ValueError(f"part_pairing: {part_pairing!r}")
    l_segments = _segments(left, left_id, left_attrs, "l")
    r_segments = _segments(right, right_id, right_attrs, "r")
    wide, cell = float(cell) * COARSE, _cell_width(l_segments, r_segments, float(cell))
    l_cells, r_cells = _celled(l_segments, "l", cell), _celled(r_segments, "r", cell)

    keys, scale = ["cx", "cy"], planar.number(cell)
    hot = _hot_cells(l_segments, r_segments, cell, max(wide, cell), pairs_per_cell)
    if hot is not None:
        l_cells, r_cells = _split(l_cells, hot, "l", cell), _split(r_cells, hot, "r", cell)
        keys += ["sx", "sy"]
        scale = f"({scale} / _f)"

    if part_pairing == "lockstep":
        l_cells, r_cells = l_cells.withColumn("_p", F.col("lpart")), r_cells.withColumn("_p", F.col("rpart"))
        keys += ["_p"]
    if hot is not None:
        if dealt := _dealt(l_cells, r_cells, keys, pairs_per_cell):
            l_cells, r_cells = dealt
            keys += ["salt"]
        r_cells = r_cells.drop("_f")
    slack = planar.number(planar.CELL_SLACK)
    boxes_touch = " AND ".join(
        f"least({p}{axis}1, {p}{axis}2) <= greatest({q}{axis}1, {q}{axis}2) + {slack}" for axis in "xy" for p, q in ("lr", "rl"))
    # inline evaluates the intersection once; a filter on a projected column would repeat it
    # and the planner's sizes leave out the exploded cells, so the merge join keeps it from broadcasting one side
    met = l_cells.hint("merge").join(r_cells, keys).where(boxes_touch).selectExpr("*", f"inline(array_compact(array({_meeting()})))")
    home_x, home_y = planar.cell_of("x1", scale), planar.cell_of("y1", scale)
    if "sx" in keys:
        here = f"{home_x} = CASE WHEN _f = 1 THEN cx ELSE sx END AND {home_y} = CASE WHEN _f = 1 THEN cy ELSE sy END"
    else:
        here = f"{home_x} = cx AND {home_y} = cy"

    # one group holds the pieces of a single part pair, so two rows' geometry bounds it
    group = ["lid", *left_attrs, "lpart", "lprint", "rid", *right_attrs, "rpart"]
    grouped = met.where(here).groupBy(*group).agg(F.expr("collect_set(struct(x1, y1, x2, y2)) AS pieces"))
    return grouped.selectExpr(
        f"lid AS {left_id}", f"rid AS {right_id}", *left_attrs, *right_attrs, "lpart AS left_part", "rpart AS right_part",
        f"inline({_whole_pieces('pieces')})")


def spatial_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: float = 100.0) -> DataFrame:
    """Distinct id pairs of lines that share at least one point."""
    pieces = intersect_lines(left, right, left_id, right_id, part_pairing="all_pairs", cell=cell)
    return pieces.select(left_id, right_id).distinct()


def exclude_tunnels(tracks: DataFrame, structures: DataFrame, id_col: str = "railway_track_id",
                    structure_id: str = "structure_id", cell: float = 100.0) -> DataFrame:
    """Tracks that do not touch a structure of type ``Tunnel``. Optional: the default run keeps all tracks."""
    tunnels = structures.where(F.col("structure_type") == "Tunnel")
    inside = spatial_join(tracks, tunnels, id_col, structure_id, cell).select(id_col).distinct()
    return tracks.join(inside, id_col, "left_anti")
