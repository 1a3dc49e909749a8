"""Merging lines of very many parts: a graph of end points, ranked by pointer doubling, inside the row or by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linecross.functions import planar
from linecross.staging import discard, stage, stage_observed

_LINE, _PARTS = "_line_no", "_parts"
#: Parts of a line that is ranked inside its row, which takes some hundred bytes a part; longer ones are spread over all tasks.
IN_ROW = 100_000


def _ends(lines: DataFrame) -> DataFrame:
    """Both ends of every part: ``end`` is twice the part's number, and one more at its tail."""
    parts = lines.select(_LINE, F.posexplode(_PARTS).alias("p", "part"))
    return parts.select(_LINE, F.inline(F.expr("array(named_struct('end', 2L * p, 'x', get(part, 0).x, 'y', get(part, 0).y), "
                                               "named_struct('end', 2L * p + 1, 'x', element_at(part, -1).x, 'y', element_at(part, -1).y))")))


def _steps(ends: DataFrame) -> DataFrame:
    """``dart, next``: where a walk through part ``dart >> 1``, backward if the dart is odd, goes on.

    A dart leaves the end of its own number and arrives at the other one; the end it meets there is the number of the next dart. Points
    are counted and not joined, so a point where a million parts meet is one row. A ring is cut where its first part starts.
    """
    met = ends.where("x IS NOT NULL AND y IS NOT NULL").groupBy(_LINE, "x", "y").agg(
        F.count("*").alias("n"), F.min("end").alias("a"), F.max("end").alias("b"))
    kinds = ends.groupBy(_LINE).agg(F.count("*").alias("ends")).join(
        met.groupBy(_LINE).agg(F.max("n").alias("most"), F.sum(F.expr("IF(n = 2, 2, 0)")).alias("paired")), _LINE)
    simple = kinds.where("most <= 2").selectExpr(_LINE, "paired = ends AS ring")
    pairs = met.where("n = 2").join(simple, _LINE).where("NOT (ring AND a = 0)")
    onward = pairs.select(_LINE, F.inline(F.expr("array(named_struct('dart', a ^ 1L, 'next', b), named_struct('dart', b ^ 1L, 'next', a))")))
    return ends.join(simple, _LINE).select(_LINE, F.col("end").alias("dart")).join(onward, [_LINE, "dart"], "left")


def _ranked(steps: DataFrame, most_parts: int) -> DataFrame:
    """Staged ``dart, last, hops``: the dart at which each walk ends and how far off it is; no row for a walk without an end.

    Each round joins a walk with the one that starts where it stands, so distances double and ``log2`` of the parts is enough. Walks
    that have ended are carried along without a join.
    """
    counts = {"walking": "count_if(next IS NOT NULL)"}
    walks, seen = stage_observed(steps.selectExpr(_LINE, "dart", "next", "coalesce(next, dart) AS last", "IF(next IS NULL, 0L, 1L) AS hops"), "walks", **counts)
    for _ in range(max(1, most_parts).bit_length() + 1):
        if not seen["walking"]:
            break
        ahead = walks.selectExpr(_LINE, "dart AS next", "next AS next_2", "last AS last_2", "hops AS hops_2")
        going = walks.where("next IS NOT NULL").join(ahead, [_LINE, "next"]).selectExpr(
            _LINE, "dart", "next_2 AS next", "last_2 AS last", "hops + hops_2 AS hops")
        done = walks
        walks, seen = stage_observed(walks.where("next IS NULL").unionByName(going), "walks", **counts)
        discard(done)
    return walks


def _way_in_row() -> str:
    """SQL for the darts of ``_steps`` in the order of the merged line, as array positions all along; NULL if there is no such line.

    Ends are sorted by place, so equal ones are neighbours, then by number, so an array holds where each dart goes on. Walks from the first
    part's head and tail, and the array's steps, double in length each round.
    """
    ends = (f"flatten(transform({_PARTS}, (p, i) -> array(named_struct('x', get(p, 0).x, 'y', get(p, 0).y, 'end', 2 * i), "
            "named_struct('x', element_at(p, -1).x, 'y', element_at(p, -1).y, 'end', 2 * i + 1))))")

    def same(at: str) -> str:
        return f"coalesce(get(s, {at}).x = e.x AND get(s, {at}).y = e.y, false)"

    # each end with the one it meets, one more than its number, in the low half; zero: none
    pairs = (f"sort_array(transform(s, (e, i) -> shiftleft(CAST(e.end AS BIGINT), 32) + CASE WHEN {same('i + 1')} THEN get(s, i + 1).end + 1 "
             f"WHEN {same('i - 1')} THEN get(s, i - 1).end + 1 ELSE 0 END))")
    met = f"transform({pairs}, v -> CAST(v & 4294967295 AS INT))"
    # a ring is cut where its first part starts
    jumps = "transform(met, (v, d) -> CASE WHEN ring AND (d = 1 OR get(met, d ^ 1) = 1) THEN -1 ELSE get(met, d ^ 1) - 1 END)"

    def onward(walk: str) -> str:
        return f"concat(acc.{walk}, filter(transform(acc.{walk}, d -> get(acc.jumps, d)), d -> d >= 0))"

    # twice as far as there are parts: a walk without an end becomes too long
    walks = (f"aggregate(sequence(1, length(bin(size({_PARTS})))), named_struct('jumps', {jumps}, 'ahead', array(0), 'back', array(1)), "
             f"(acc, k) -> named_struct('jumps', transform(acc.jumps, d -> IF(d < 0, -1, get(acc.jumps, d))), 'ahead', {onward('ahead')}, 'back', {onward('back')}))")
    way = planar.let("w", walks, "concat(transform(reverse(slice(w.back, 2, size(w.back))), d -> d ^ 1), w.ahead)")
    turned = "IF(2 * size(filter(way, d -> d % 2 = 1)) > size(way), transform(reverse(way), d -> d ^ 1), way)"
    ordered = planar.let("met", met, planar.let("ring", "NOT exists(met, v -> v = 0)", planar.let(
        "way", way, f"CASE WHEN size(way) = size({_PARTS}) THEN {turned} END")))
    simple = (f"exists(s, e -> e.x IS NOT NULL AND e.y IS NOT NULL) AND NOT exists(transform(s, (e, i) -> {same('i + 2')}), most -> most)")
    return planar.let("s", f"sort_array({ends})", f"CASE WHEN {simple} THEN {ordered} END")


def _ways_by_rounds(lines: DataFrame, most_parts: int) -> DataFrame:
    """Staged ``_way`` of each line that has one, found with its parts as rows of their own."""
    ends = stage(_ends(lines), "ends")
    walks = _ranked(_steps(ends), most_parts)
    # the walk that holds the first part as it runs; its mirror holds the rest of the darts
    found = walks.where("next IS NULL").groupBy(_LINE, "last").agg(
        F.expr("sort_array(collect_list(named_struct('hops', hops, 'dart', dart)), false)").alias("way"),
        F.expr("count_if(dart % 2 = 1)").alias("turned"), F.expr("bool_or(dart = 0)").alias("first"))
    found = found.where("first").selectExpr(_LINE, "IF(turned * 2 > size(way), transform(reverse(way), w -> w.dart ^ 1L), "
                                                   "transform(way, w -> w.dart)) AS _way")
    found = stage(found, "ways")
    discard(ends, walks)
    return found


def merge_many_parts(df: DataFrame, geom: str = "geom", merged: str = "merged") -> DataFrame:
    """As ``operators.lines.merge_parts``, with work that grows with n log n of a line's parts instead of their square.

    Parts are ranked inside the line's row, or, of lines of more than ``IN_ROW`` parts, as rows of their own in rounds, so the parts of one line are
    spread over all tasks and only the order found (a number per part) returns to the line's row. Needs the staging folder; the result
    reads a table staged there. NULL where parts leave a gap or branch, for no parts, and for ends without coordinates; parts of fewer
    than two vertices are left out; equal rows stay.
    """
    own = F.expr(f"filter({geom}, p -> size(p) > 1)")
    lines, seen = stage_observed(df.withColumn(_LINE, F.monotonically_increasing_id()), "lines", most=f"max(size(filter({geom}, p -> size(p) > 1)))")
    lines, most = lines.withColumn(_PARTS, own), seen["most"] or 0
    part = planar.let("p", f"get({_PARTS}, CAST(shiftright(d, 1) AS INT))", "IF(d % 2 = 1, reverse(p), p)")
    chain = f"flatten(transform(_way, (d, i) -> {planar.let('q', part, 'IF(i = 0, q, slice(q, 2, size(q)))')}))"

    def finished(rows: DataFrame) -> DataFrame:
        return rows.selectExpr(*[f"`{c}`" for c in df.columns if c != merged], f"CASE WHEN size(_way) = size({_PARTS}) THEN {chain} END AS `{merged}`")

    short = lines if most <= IN_ROW else lines.where(f"coalesce(size({_PARTS}), 0) <= {IN_ROW}")
    done = finished(short.withColumn("_way", F.expr(f"CASE WHEN size({_PARTS}) > 0 THEN {_way_in_row()} END")))
    if most <= IN_ROW:
        return done
    long = lines.where(f"size({_PARTS}) > {IN_ROW}")
    return done.unionByName(finished(long.join(_ways_by_rounds(long.select(_LINE, _PARTS), most), _LINE, "left")))
