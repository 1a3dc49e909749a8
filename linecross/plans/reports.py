"""The four summary reports over the crossings table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linecross.operators.filters import source_of

# Report column of each road source.
_SOURCE_COLUMNS = {"dra": "src_dra", "ften": "src_ften", "ogc": "src_ogcpermit", "ogcpre06": "src_ogcpre06"}


def _source_counts() -> list[Column]:
    return [F.count_if(F.col("source") == source).alias(column) for source, column in _SOURCE_COLUMNS.items()]


def report_total(crossings: DataFrame) -> DataFrame:
    """Crossings by type."""
    return crossings.groupBy("modelled_crossing_type").agg(F.count("*").alias("n"))


def report_source(crossings: DataFrame) -> DataFrame:
    """Crossings by highest-priority road source."""
    return source_of(crossings).agg(*_source_counts())


def report_region(crossings: DataFrame) -> DataFrame:
    """Crossings by watershed group, with type and source counts."""
    return source_of(crossings).groupBy("watershed_group_code").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("modelled_crossing_type") == "CBS").alias("xing_type_cbs"),
        F.count_if(F.col("modelled_crossing_type") == "OBS").alias("xing_type_obs"),
        *_source_counts())


def report_obs_sources(crossings: DataFrame) -> DataFrame:
    """Open-bottom structures by their list of evidence tags."""
    obs = crossings.where(F.col("modelled_crossing_type") == "OBS")
    counts = obs.groupBy("modelled_crossing_type_source").agg(F.count("*").alias("n"))
    return counts.select(F.array_join("modelled_crossing_type_source", "; ").alias("modelled_crossing_type_sources"), "n")


REPORTS = {
    "01_total": report_total,
    "02_source": report_source,
    "03_type_source_wsg": report_region,
    "04_obs_sources": report_obs_sources,
}
