"""Dense surrogate ids and carrying ids over from an archived result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from linecross.operators.filters import first_by
from linecross.operators.nearest import nearest_within
from linecross.staging import stage


def assign_ids(df: DataFrame, order: Sequence[str | Column], id_col: str = "modelled_crossing_id", start: int = 1) -> DataFrame:
    """Add consecutive ids from ``start`` in the given (total) order.

    The rows are range-partitioned and sorted; only the row count of each partition is shared between partitions.
    """
    position = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(rows.withColumn("_position", position), "ordered")
    partition = F.shiftrightunsigned("_position", 33)
    sizes = rows.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    # the offsets are one row per shuffle partition
    joined = rows.withColumn("_partition", partition).join(F.broadcast(offsets), "_partition")
    return joined.withColumn(id_col, within + F.col("_offset") + start).drop("_position", "_partition", "_offset")


def match_archive(crossings: DataFrame, archive: DataFrame, distance: float = 10.0, id_floor: int | None = None) -> DataFrame:
    """Crossings with ids of an archived result where a crossing lies nearer than ``distance``.

    Each crossing looks at its nearest archived point; an archived id goes to the nearest of its crossings, all other
    crossings get new ids above ``id_floor`` (the largest archived id by default). ``archive`` has ``crossing_id, geom``.
    """
    key = "modelled_crossing_id"
    points = crossings.select(key, F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))
    old = archive.where("geom.x IS NOT NULL").select(
        F.col("crossing_id").alias("archive_id"), *[F.col(f"geom.{axis}").alias(f"{axis}{n}") for n in (1, 2) for axis in "xy"])
    near = nearest_within(points, old, distance, ["archive_id"])
    kept = stage(first_by(near, ["archive_id"], [F.col("distance"), F.col(key)]).select(key, "archive_id"), "kept-ids")
    if id_floor is None:
        id_floor = archive.agg(F.max("crossing_id")).first()[0] or 0
    fresh = assign_ids(crossings.join(kept, key, "left_anti").withColumnRenamed(key, "_old"), ["_old"], key, id_floor + 1)
    matched = crossings.join(kept, key).drop(key).withColumnRenamed("archive_id", key)
    id_type = crossings.schema[key].dataType
    both = matched.unionByName(fresh.drop("_old"))
    return both.withColumn(key, F.col(key).cast(id_type)).select(*crossings.columns)
