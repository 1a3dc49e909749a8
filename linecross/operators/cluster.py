"""Single-linkage clustering of intersection pieces within a distance, and cluster centroids.

Pieces are first combined into square cells whose diagonal is the distance, so that all pieces of a cell are in
one cluster. Only cells are linked: by their bounding boxes where these decide, by their points where they do
not. A heap of pieces in one spot is thus one node, not all of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linecross.functions import planar
from linecross.operators.components import connected_components
from linecross.staging import stage, stage_observed

#: Two boxes with more possible point pairs than this are divided before points are compared.
PAIRS_PER_BOX = 100_000
MAX_LEVEL = 40
#: Line pieces are listed in cells of at least this side, in metres.
LEAST_LINE_CELL = 1.0
#: Cells are linked in blocks of two to the power of this on a side.
BLOCK_BITS = 3

_BOX = ("x_lo", "y_lo", "x_hi", "y_hi")


def _side(tolerance: str, least: float = 3e-7) -> str:
    """Side of a square whose diagonal is the distance; distances below half a micrometre count as 0."""
    return f"greatest({tolerance} * {planar.number(math.sqrt(0.5) * (1 - 1e-9))}, {planar.number(least)})"


def _anchored(pieces: DataFrame, tolerance: str) -> DataFrame:
    """Pieces with the cell of their first end, which places a line in the cluster of that cell."""
    return pieces.selectExpr("*", *[f"{planar.cell_of(axis + '1', _side(tolerance))} AS c{axis}" for axis in "xy"])


def _node(low: tuple[int, int], high: tuple[int, int]) -> str:
    """One number for both cell coordinates: a long where 31 bits hold each, else a decimal for longs of up to 18 digits."""
    if max(h - l for l, h in zip(low, high)) < 1 << 31:
        return f"shiftleft(cx - {low[0]}L, 32) + (cy - {low[1]}L)"
    return "CAST(CAST(cx AS DECIMAL(18, 0)) * 10000000000000000000BD + CAST(cy AS DECIMAL(18, 0)) AS DECIMAL(38, 0))"


_IS_LINE = "(x1 <> x2 OR y1 <> y2)"
_LENGTH = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"


def _aggregates(*expressions: str) -> list[Column]:
    return [F.expr(e) for e in expressions]


_BOX_AGGREGATES = ("min(x1) AS x_lo", "min(y1) AS y_lo", "max(x1) AS x_hi", "max(y1) AS y_hi")


def _box_distances() -> tuple[str, str]:
    """Smallest and largest distance of two boxes given by column prefixes ``a`` and ``b``."""
    gap = [f"greatest(0D, a{v}_lo - b{v}_hi, b{v}_lo - a{v}_hi)" for v in "xy"]
    reach = [f"greatest(a{v}_hi - b{v}_lo, b{v}_hi - a{v}_lo)" for v in "xy"]
    return tuple(planar.micrometre(f"sqrt({x} * {x} + {y} * {y})") for x, y in (gap, reach))


def _prefixed(df: DataFrame, columns: Sequence[str], prefix: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(c).alias(f"{prefix}{c}") for c in columns])


def _reaching(nodes: DataFrame) -> DataFrame:
    """Cells with each block ``bx, by`` of cells that holds one up to two columns ahead and two rows to either side: about two blocks."""
    for axis, low, high in (("x", "cx", "cx + 2"), ("y", "cy - 2", "cy + 2")):
        nodes = nodes.selectExpr("*", f"explode(sequence(shiftright({low}, {BLOCK_BITS}), shiftright({high}, {BLOCK_BITS}))) AS b{axis}")
    return nodes


def _linked_cells(nodes: DataFrame, keys: list[str], tolerance: str) -> DataFrame:
    """Neighbouring cell pairs not farther apart than the distance; ``sure`` if their boxes prove the link."""
    columns, at = [*_BOX, "node", "n", "cx", "cy"], [*keys, "bx", "by"]
    a = _prefixed(_reaching(nodes), columns, "a", at)
    b = _prefixed(nodes.selectExpr("*", *[f"shiftright(c{v}, {BLOCK_BITS}) AS b{v}" for v in "xy"]), columns, "b", at)
    ahead = "bcx - acx BETWEEN 0 AND 2 AND bcy - acy BETWEEN -2 AND 2 AND (bcx > acx OR bcy > acy)"
    near, far = _box_distances()
    return a.hint("merge").join(b, at).where(f"{ahead} AND {near} <= {tolerance}").selectExpr(
        *keys, "anode AS a", "bnode AS b", "an", "bn", f"{far} <= {tolerance} AS sure")


def _linked_by_points(pairs: DataFrame, points: DataFrame, keys: list[str], tolerance: str,
                      parent: Sequence[str] = ()) -> DataFrame:
    """Cell pairs with at least one pair of points within the distance. ``parent``: box columns to match as well."""
    for side in "ab":
        own = _prefixed(points, ["node", *parent, "x1", "y1"], side, keys)
        own = own.withColumnRenamed(f"{side}node", side)
        pairs = pairs.join(own, [*keys, side, *[f"{side}{p}" for p in parent]])
    distance = planar.point_distance("ax1", "ay1", "bx1", "by1")
    return pairs.where(f"{distance} <= {tolerance}").select(*keys, "a", "b").distinct()


def _linked_by_boxes(pairs: DataFrame, points: DataFrame, keys: list[str], tolerance: str, budget: int) -> DataFrame:
    """As ``_linked_by_points`` for crowded cells: compare quarters, quarters of quarters, … until boxes decide."""
    found = []
    points = stage(points.join(pairs.select(*keys, F.explode(F.array("a", "b")).alias("node")).distinct(),
                               [*keys, "node"], "left_semi"), "crowded-points")
    zero = F.lit(0).cast("long")
    open_pairs = stage(pairs.select(*keys, "a", "b", *[zero.alias(f"{s}{c}") for s in "ab" for c in ("bx", "by")]), "boxes")
    side = _side(tolerance)
    for level in range(1, MAX_LEVEL + 1):
        scale = 2 ** level
        placed = points.selectExpr("*", *[
            f"greatest(0L, least(CAST(floor(({v}1 / {side} - c{v}) * {scale}L) AS BIGINT), {scale - 1}L)) AS b{v}" for v in "xy"])
        boxes = placed.groupBy(*keys, "node", "bx", "by").agg(*_aggregates(*_BOX_AGGREGATES, "count(*) AS n"))
        pairs_here = open_pairs
        for s in "ab":
            children = _prefixed(boxes, ["node", "bx", "by", *_BOX, "n"], s, keys).withColumnRenamed(f"{s}node", s)
            children = children.withColumnsRenamed({f"{s}bx": f"{s}cbx", f"{s}by": f"{s}cby"}).withColumn(
                f"{s}bx", F.shiftright(f"{s}cbx", 1)).withColumn(f"{s}by", F.shiftright(f"{s}cby", 1))
            pairs_here = pairs_here.join(children, [*keys, s, f"{s}bx", f"{s}by"])
        near, far = _box_distances()
        pairs_here = stage(pairs_here.where(f"{near} <= {tolerance}").selectExpr(
            *keys, "a", "b", *[f"{s}c{c} AS {s}{c}" for s in "ab" for c in ("bx", "by")],
            "an", "bn", f"{far} <= {tolerance} AS sure"), "boxes")
        sure = pairs_here.where("sure").select(*keys, "a", "b").distinct()
        rest = pairs_here.where(~F.col("sure")).join(sure, [*keys, "a", "b"], "left_anti")
        crowded = F.col("an") * F.col("bn") > budget
        by_points = stage(_linked_by_points(rest.where(~crowded).drop("an", "bn", "sure"), placed, keys, tolerance, ("bx", "by")),
                          "point-links")
        found += [sure, by_points]
        rest = rest.where(crowded).join(by_points, [*keys, "a", "b"], "left_anti")
        open_pairs = stage(rest.drop("an", "bn", "sure"), "boxes")
        if open_pairs.isEmpty():
            break
    else:  # boxes no longer part what is left
        found.append(stage(_linked_by_points(open_pairs, placed, keys, tolerance, ("bx", "by")), "point-links"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _linked_to_lines(pieces: DataFrame, keys: list[str], tolerance: str) -> DataFrame:
    """Cell pairs linked through a line piece: to points near it and to other lines near it."""
    lines = pieces.where(_IS_LINE).select(*keys, "node", "x1", "y1", "x2", "y2").distinct()
    # A grid of its own: a small distance must not cut a line into endless cells.
    side = _side(tolerance, LEAST_LINE_CELL)
    run = planar.traversed_cells(["x1", "y1", "x2", "y2"], side)
    around = f"array_distinct(flatten(transform({run}, c -> {planar.cells_around('c.cx', 'c.cy', 2)})))"
    geometry, at = ["node", "x1", "y1", "x2", "y2"], [*keys, "cx", "cy"]
    a = _prefixed(lines.selectExpr("*", f"inline({around})"), geometry, "a", at)
    b_lines = _prefixed(lines.selectExpr("*", f"inline({run})"), geometry, "b", at)
    # most keys have no line: their points stay out of the shuffles
    beside = pieces.join(lines.select(*keys).distinct(), keys, "left_semi")
    points = beside.select(*keys, "node", "x1", "y1").distinct().selectExpr("*", *[f"{planar.cell_of(v + '1', side)} AS c{v}" for v in "xy"])
    b_points = _prefixed(points, ["node", "x1", "y1"], "b", at)
    near_point = planar.segment_point_distance("bx1", "by1", "ax1", "ay1", "ax2", "ay2")
    to_points = a.hint("merge").join(b_points, at).where(f"anode <> bnode AND {near_point} <= {tolerance}")
    to_lines = a.hint("merge").join(b_lines, at).where(f"anode < bnode AND {planar.segment_distance('a', 'b')} <= {tolerance}")
    nodes = [*keys, "anode AS a", "bnode AS b"]
    return to_points.selectExpr(*nodes).unionByName(to_lines.selectExpr(*nodes)).distinct()


class _Clusters:
    """Cells of the pieces with their component."""

    def __init__(self, pieces: DataFrame, keys: Sequence[str], tolerance: float | str, aggregates: Sequence[Column],
                 pairs_per_box: int):
        self.keys = list(keys)
        by_column = isinstance(tolerance, str)
        if by_column and tolerance not in self.keys:
            self.keys.append(tolerance)
        self.tolerance = tolerance if by_column else planar.number(float(tolerance))
        placed = _anchored(pieces, self.tolerance)
        nodes = placed.groupBy(*self.keys, "cx", "cy").agg(*_aggregates(
            *_BOX_AGGREGATES, "count(*) AS n", f"count_if(NOT {_IS_LINE}) AS points",
            f"sum(CASE WHEN NOT {_IS_LINE} THEN x1 END) AS px", f"sum(CASE WHEN NOT {_IS_LINE} THEN y1 END) AS py",
            f"sum({_LENGTH}) AS length", f"sum({_LENGTH} * (x1 + x2) / 2) AS lx", f"sum({_LENGTH} * (y1 + y2) / 2) AS ly"),
            *aggregates)
        nodes, seen = stage_observed(nodes, "cells", longest="max(length)", west="min(cx)", east="max(cx)", south="min(cy)", north="max(cy)")
        node = _node((seen["west"] or 0, seen["south"] or 0), (seen["east"] or 0, seen["north"] or 0))
        self.nodes, self.pieces = (df.selectExpr("*", f"{node} AS node") for df in (nodes, placed))
        self.has_lines = (seen["longest"] or 0) > 0
        self.roots = self._roots(pairs_per_box)

    def _roots(self, budget: int) -> DataFrame:
        keys, tolerance = self.keys, self.tolerance
        few, many = f"NOT sure AND an * bn <= {budget}", f"NOT sure AND an * bn > {budget}"
        pairs, tally = stage_observed(_linked_cells(self.nodes, keys, tolerance), "cell-pairs",
                                      few=f"count_if({few})", many=f"count_if({many})")
        links = pairs.where("sure").select(*keys, "a", "b")
        if tally["few"] or tally["many"]:
            points = self.pieces.select(*keys, "node", "cx", "cy", "x1", "y1").distinct()
        if tally["few"]:
            links = links.unionByName(
                _linked_by_points(pairs.where(few).select(*keys, "a", "b"), points, keys, tolerance))
        if tally["many"]:
            links = links.unionByName(
                _linked_by_boxes(pairs.where(many).select(*keys, "a", "b"), points, keys, tolerance, budget))
        if self.has_lines:
            links = links.unionByName(_linked_to_lines(self.pieces, keys, tolerance))
        return connected_components(links, keys)

    def rooted(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``root``, the component of their cell."""
        return rows.join(self.roots, [*self.keys, "node"], "left").withColumn("root", F.coalesce("root", "node"))


def cluster_within(pieces: DataFrame, keys: Sequence[str], tolerance: float | str, row_id: str,
                   pairs_per_box: int = PAIRS_PER_BOX) -> DataFrame:
    """``pieces`` with ``cluster_id``, the smallest ``row_id`` of the cluster.

    Pieces of equal ``keys`` whose distance is at most ``tolerance`` (metres, or the name of a column) are in one
    cluster, and so are chains of such pieces.
    """
    found = _Clusters(pieces, keys, tolerance, [F.min(row_id).alias("_first")], pairs_per_box)
    nodes = found.rooted(found.nodes)
    label = nodes.groupBy(*found.keys, "root").agg(F.min("_first").alias("cluster_id"))
    by_node = nodes.select(*found.keys, "node", "root").join(label, [*found.keys, "root"]).drop("root")
    return found.pieces.join(by_node, [*found.keys, "node"]).select(*pieces.columns, "cluster_id")


def cluster_centroids(pieces: DataFrame, keys: Sequence[str], tolerance: float | str, max_of: Sequence[str] = (),
                      id_scope: str = "group", pairs_per_box: int = PAIRS_PER_BOX) -> DataFrame:
    """One row per cluster: ``keys, x, y, n`` and the maximum of the ``max_of`` columns.

    The centroid is the mean of the points; if the cluster holds a line piece, only lines count, by length.
    ``id_scope='group'`` takes the maximum over all pieces with equal ``keys`` and tolerance, so every cluster of a
    stream gets the same one; ``'cluster'`` takes it within the cluster.
    """
    if id_scope not in ("group", "cluster"):
        raise ValueError(f"id_scope: {id_scope!r}")
    found = _Clusters(pieces, keys, tolerance, [F.max(c).alias(c) for c in max_of], pairs_per_box)
    sums = found.rooted(found.nodes).groupBy(*found.keys, "root").agg(
        *[F.sum(c).alias(c) for c in ("n", "points", "px", "py", "length", "lx", "ly")], *[F.max(c).alias(c) for c in max_of])
    centroids = sums.selectExpr(
        *found.keys, "CASE WHEN length > 0D THEN lx / length ELSE px / points END AS x",
        "CASE WHEN length > 0D THEN ly / length ELSE py / points END AS y", "n", *max_of)
    if not max_of or id_scope == "cluster":
        return centroids
    greatest = found.nodes.groupBy(*found.keys).agg(*[F.max(c).alias(c) for c in max_of])
    return centroids.drop(*max_of).join(greatest, found.keys)
