"""Equality and band joins used as flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def band_semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` of equal keys whose value differs by less than ``tolerance``.

    The values are cut into bands as wide as the tolerance. A band of ``right`` is known by its smallest and largest
    value, as one of the two is the nearest to any value in the next bands and every value of the same band matches.
    So a key costs at most three rows per band of the other side, however many rows it has.
    """
    keys = list(keys)

    def band(column: str):
        return F.floor(F.col(column) / tolerance).cast("long")
    bands = right.where(F.col(value).isNotNull()).withColumn("_band", band(value)).groupBy(*keys, "_band").agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"))
    reach = bands.withColumn("_band", F.explode(F.array(F.col("_band") - 1, F.col("_band"), F.col("_band") + 1)))
    l, r = left.withColumn("_band", band(value)).alias("l"), reach.alias("r")
    near = (F.abs(F.col(f"l.{value}") - F.col("r._low")) < tolerance) | (F.abs(F.col(f"l.{value}") - F.col("r._high")) < tolerance)
    same = F.col("l._band") == F.col("r._band")
    for key in keys:
        same = same & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    return l.join(r, same & near, "left_semi").drop("_band")
