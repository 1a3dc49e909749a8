"""Small layers for hand-checked cases."""

from __future__ import annotations

from linecross import schema


def vertex(x, y, z=None, m=None):
    return (float(x), float(y), z, m)


def line(*parts):
    """Parts given as lists of (x, y) or (x, y, m)."""
    return [[vertex(p[0], p[1], None, float(p[2]) if len(p) > 2 else None) for p in part] for part in parts]


def stream(spark, rows=None, **changes):
    """Streams table; without rows the base stream from (0, 0) to (100, 0) with m 1000 to 1100."""
    base = dict(linear_feature_id=1, watershed_group_code="AAAA", fwa_watershed_code="100-2", edge_type=1000, wscode_ltree="100",
                localcode_ltree="100.2", blue_line_key=7, waterbody_key=None, length_metre=100.0, downstream_route_measure=1000.0,
                upstream_route_measure=1100.0, stream_order=3, geom=line([(0, 0, 1000), (100, 0, 1100)]))
    data = [{**base, **changes, **row} for row in (rows or [{}])]
    return spark.createDataFrame([tuple(d[f.name] for f in schema.STREAMS) for d in data], schema.STREAMS)


def ften(spark, *roads):
    return spark.createDataFrame([(i, "ACTIVE", g) for i, g in roads], schema.FTEN)


def dra(spark, *roads):
    """Roads as (id, class, line)."""
    return spark.createDataFrame([(i, kind, "P", None, g) for i, kind, g in roads], schema.DRA)


def across(x, half=10):
    """A road across the base stream at x."""
    return line([(x, -half), (x, half)])


def crossings(spark, *rows, **defaults):
    """Crossings table from dicts; ``at`` is the (x, y) place."""
    def row(d):
        d = {**defaults, **d}
        x, y = d.pop("at")
        d["geom"] = vertex(x, y)
        return tuple(d.get(f.name) for f in schema.CROSSINGS)
    return spark.createDataFrame([row(dict(r)) for r in rows], schema.CROSSINGS)


def pieces(spark, rows):
    """Pieces ``id, g, x1, y1, x2, y2`` from (id, key, x, y) or (id, key, x1, y1, x2, y2)."""
    full = [(r[0], r[1], float(r[2]), float(r[3]), float(r[4] if len(r) > 4 else r[2]), float(r[5] if len(r) > 5 else r[3])) for r in rows]
    return spark.createDataFrame(full, "id long, g string, x1 double, y1 double, x2 double, y2 double")
