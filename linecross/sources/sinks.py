"""Writing the crossings table and the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_crossings(df: DataFrame, path: str, mode: str = "overwrite", single_regions: bool = False) -> None:
    """Write Parquet partitioned by watershed group.

    ``single_regions`` replaces only the groups present in ``df`` and keeps the others. Rows are dealt out by group first, so a
    small group is one file; adaptive execution gives a large one several tasks.
    """
    writer = df.hint("rebalance", "watershed_group_code").write.mode(mode).partitionBy("watershed_group_code")
    if single_regions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Write one CSV file with a header. Reports have one row per group of their few keys."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
