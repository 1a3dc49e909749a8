"""Merging crossings that several sources report for one place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from linecross.operators.nearest import nearest_within
from linecross.schema import SOURCE_ID_COLUMNS
from linecross.staging import stage

MERGE_TOLERANCE = 20.0
MERGE_ORDER = ("dra", "ften", "ogc", "ogcpre06")
_KEY = "modelled_crossing_id"


def _any_set(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def merge_round(crossings: DataFrame, source: str, higher: Sequence[str], tolerance: float = MERGE_TOLERANCE) -> DataFrame:
    """Give crossings of the ``higher`` sources the id of the ``source`` crossings near them and remove the latter.

    A crossing of ``source`` alone joins its nearest higher crossing if that is nearer than ``tolerance``. If several
    join the same one, the nearest one's id is kept, then that of the smallest crossing id.
    """
    id_column, above = SOURCE_ID_COLUMNS[source], [SOURCE_ID_COLUMNS[s] for s in higher]
    placed = crossings.where("geom.x IS NOT NULL").withColumns({"x": F.col("geom.x"), "y": F.col("geom.y")})
    lower = placed.where(F.col(id_column).isNotNull() & ~_any_set(above)).select(_KEY, id_column, "x", "y")
    upper = placed.where(_any_set(above)).select(
        F.col(_KEY).alias("keeper"), *[F.col(axis).alias(f"{axis}{n}") for n in (1, 2) for axis in "xy"])
    matches = stage(nearest_within(lower, upper, tolerance, ["keeper"]).select(_KEY, id_column, "keeper", "distance"), "matches")
    gained = matches.groupBy(F.col("keeper").alias(_KEY)).agg(
        F.min_by(id_column, F.struct("distance", _KEY)).alias("_gained"), F.lit(False).alias("_gone"))
    gone = matches.select(_KEY, F.lit(None).cast(crossings.schema[id_column].dataType).alias("_gained"), F.lit(True).alias("_gone"))
    changed = crossings.join(gained.unionByName(gone), _KEY, "left").where(~F.coalesce("_gone", F.lit(False)))
    return changed.withColumn(id_column, F.coalesce("_gained", id_column)).select(*crossings.columns)


def merge_by_priority(crossings: DataFrame, order: Sequence[str] = MERGE_ORDER, tolerance: float = MERGE_TOLERANCE) -> DataFrame:
    """One round per source of lower priority, each against the survivors of the round before.

    Sources outside ``order`` (railways) stay as they are.
    """
    for position in range(1, len(order)):
        crossings = stage(merge_round(crossings, order[position], order[:position], tolerance), f"merged-{order[position]}")
    return crossings
