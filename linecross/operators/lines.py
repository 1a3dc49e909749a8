"""Lines to parts, segments and positions: exploding, merging and linear referencing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linecross.functions import planar


def explode_parts(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per part (``part_no`` from 0, ``part``); no row for a NULL or empty line."""
    rest = [c for c in df.columns if c != geom]
    return df.select(*rest, F.posexplode(geom).alias("part_no", "part"))


def explode_segments(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per segment of every part: end points with z and m, 2D length, and ``cum_len``, the length of the part before it.

    Zero-length segments are dropped. The running length is made inside the array of a part, so nothing is shuffled.
    """
    parts = explode_parts(df, geom)
    rest = [c for c in parts.columns if c != "part"]
    segments = parts.select(*rest, F.expr(planar.part_segments("part")).alias("_s")).selectExpr(
        *rest, "_s", f"{planar.running_sums(planar.segment_lengths('_s'))} AS _run")
    rows = segments.selectExpr(*rest, "posexplode(arrays_zip(_s, _run)) AS (seg_no, _q)")
    ends = [f"_q._s.{v}.{axis} AS {axis}{n}" for n, v in ((1, "a"), (2, "b")) for axis in "xyzm"]
    length = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    return rows.selectExpr(*rest, "seg_no", *ends, "_q._run AS _end").where("x1 <> x2 OR y1 <> y2").selectExpr(
        "* EXCEPT (_end)", f"{length} AS seg_len", f"_end - {length} AS cum_len")


def _merge(geom: str) -> str:
    """SQL for the parts joined end to end into one vertex array; NULL if they do not form one simple chain."""
    def head(p: str) -> str:
        return f"named_struct('x', get({p}, 0).x, 'y', get({p}, 0).y)"

    def tail(p: str) -> str:
        return f"named_struct('x', element_at({p}, -1).x, 'y', element_at({p}, -1).y)"

    # how a remaining part continues the chain: 1 at its end, 2 there reversed, 3 at its start, 4 there reversed
    how = (f"CASE WHEN {head('p')} = {tail('acc.chain')} THEN 1 WHEN {tail('p')} = {tail('acc.chain')} THEN 2 "
           f"WHEN {tail('p')} = {head('acc.chain')} THEN 3 WHEN {head('p')} = {head('acc.chain')} THEN 4 ELSE 0 END")
    fits = f"filter(transform(acc.rest, (p, i) -> named_struct('how', {how}, 'at', i, 'p', p)), f -> f.how > 0)"
    # the end grows first, so a ring starts where its first part does
    step = planar.let("fits", fits, "coalesce(get(filter(fits, f -> f.how <= 2), 0), get(fits, 0))")
    chain = ("CASE f.how WHEN 1 THEN concat(acc.chain, slice(f.p, 2, size(f.p))) "
             "WHEN 2 THEN concat(acc.chain, slice(reverse(f.p), 2, size(f.p))) "
             "WHEN 3 THEN concat(f.p, slice(acc.chain, 2, size(acc.chain))) "
             "ELSE concat(reverse(f.p), slice(acc.chain, 2, size(acc.chain))) END")
    grown = (f"named_struct('chain', {chain}, 'rest', filter(acc.rest, (r, j) -> j <> f.at), "
             "'turned', acc.turned + CASE WHEN f.how IN (2, 4) THEN 1 ELSE 0 END)")
    attach = planar.let("f", step, f"CASE WHEN f IS NULL THEN acc ELSE {grown} END")
    # the merged line runs the way most of its parts did
    finish = ("CASE WHEN size(acc.rest) = 0 THEN CASE WHEN acc.turned * 2 > size(parts) THEN reverse(acc.chain) "
              "ELSE acc.chain END END")
    start = "named_struct('chain', get(parts, 0), 'rest', slice(parts, 2, size(parts)), 'turned', 0)"
    chained = f"aggregate(sequence(2, size(parts)), {start}, (acc, k) -> {attach}, acc -> {finish})"
    ends = f"flatten(transform(parts, p -> array({head('p')}, {tail('p')})))"
    branches = planar.let("ends", ends, "exists(ends, e -> size(filter(ends, o -> o = e)) > 2)")
    merged = f"CASE WHEN size(parts) = 1 THEN get(parts, 0) WHEN size(parts) > 1 AND NOT {branches} THEN {chained} END"
    return planar.let("parts", f"filter({geom}, p -> size(p) > 1)", merged)


def merge_parts(df: DataFrame, geom: str = "geom", merged: str = "merged") -> DataFrame:
    """Add ``merged``: the parts of each line joined end to end, whatever their order and direction.

    NULL where the parts leave a gap or branch; route such rows to a reject output with ``merged IS NULL``. A ring starts where its first
    part does. Work inside a row grows with the square of its parts: ``operators.merging`` takes lines of hundreds of parts and more.
    """
    simple = f"size({geom}) = 1 AND size({geom}[0]) > 1"
    return df.withColumn(merged, F.expr(f"CASE WHEN {simple} THEN {geom}[0] ELSE {_merge(geom)} END"))


def point_line_distance(points: DataFrame, lines: DataFrame, on: str, geom: str = "geom",
                        x: str = "x", y: str = "y") -> DataFrame:
    """``points`` with ``distance`` to the line of the same ``on`` id (one row per id in ``lines``)."""
    joined = points.join(lines.select(on, F.col(geom).alias("_line")), on)
    return joined.withColumn("distance", F.expr(planar.distance_to_line("_line", x, y))).drop("_line")


def locate_points(points: DataFrame, lines: DataFrame, on: str, geom: str = "geom",
                  x: str = "x", y: str = "y") -> DataFrame:
    """``points`` with ``fraction``: where along the merged line of the same id the nearest place lies."""
    merged = merge_parts(lines.select(on, F.col(geom).alias("_line")), "_line", "_merged").drop("_line")
    joined = points.join(merged, on)
    return joined.withColumn("fraction", F.expr(planar.fraction_along("_merged", x, y))).drop("_merged")


def locate_along(measures: DataFrame, lines: DataFrame, on: str, measure: str, geom: str = "geom",
                 keep_missing: bool = False) -> DataFrame:
    """``measures`` with ``point`` where m equals the measure on the line of the same id.

    A measure beyond the line gives no row, or a NULL point with ``keep_missing``, so that losses can be counted.
    """
    joined = measures.join(lines.select(on, F.col(geom).alias("_line")), on)
    hits = F.expr(planar.points_at_measure("_line", measure))
    explode = F.explode_outer if keep_missing else F.explode
    return joined.select(*measures.columns, explode(hits).alias("point"))
