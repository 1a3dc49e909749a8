"""Layer filters, the road-class tolerance and small relational helpers.

Negative predicates keep SQL's three-valued logic: a NULL code fails ``!=`` and ``NOT IN``, so the row is
dropped unless the rule replaces NULL first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from linecross.schema import SOURCE_ID_COLUMNS

# Fixed values of the filter rules.
EXCLUDED_WATERSHED_PREFIX = "999"
SUBSURFACE_EDGE_TYPES = (1410, 1425)
EXCLUDED_DRA_TYPES = ("F", "FP", "FR", "T", "TR", "TS", "RP", "RWA")
DECOMMISSIONED_SURFACE = "D"
TUNNEL_STRUCTURE = "T"
INACTIVE_TENURES = ("RETIRED", "PENDING")

# Clustering distance in metres by road class, and by source.
CLASS_TOLERANCES = {
    30.0: ("RF", "RH1", "RH2"),
    20.0: ("RA1", "RA2", "RC1", "RC2"),
}
OTHER_CLASS_TOLERANCE = 12.5
SOURCE_TOLERANCES = {"ften": 12.5, "ogc": 12.5, "ogcpre06": 12.5, "rail": 20.0}


def streams_of(df: DataFrame, groups: str | list[str] | None = None) -> DataFrame:
    """Streams of the given watershed groups; the filter prunes partitions of a table stored by group."""
    if groups is None:
        return df
    return df.where(F.col("watershed_group_code").isin([groups] if isinstance(groups, str) else list(groups)))


def region_list(groups: DataFrame) -> DataFrame:
    return groups.select("watershed_group_code").distinct()


def filter_streams(df: DataFrame) -> DataFrame:
    return df.where(
        ~F.col("fwa_watershed_code").startswith(EXCLUDED_WATERSHED_PREFIX)
        & ~F.col("edge_type").isin(*SUBSURFACE_EDGE_TYPES)
        & F.col("localcode_ltree").isNotNull()
    )


def filter_dra(df: DataFrame) -> DataFrame:
    return df.where(
        ~F.col("transport_line_type_code").isin(*EXCLUDED_DRA_TYPES)
        & (F.col("transport_line_surface_code") != DECOMMISSIONED_SURFACE)
        & (F.coalesce("transport_line_structure_code", F.lit("")) != TUNNEL_STRUCTURE)
    )


def filter_ften(df: DataFrame) -> DataFrame:
    return df.where(~F.col("life_cycle_status_code").isin(*INACTIVE_TENURES))


def filter_ogc(df: DataFrame) -> DataFrame:
    return df.where((F.col("status") == "Approved") & (F.col("road_type_desc") != "Snow Ice Road"))


def filter_ogcpre06(df: DataFrame) -> DataFrame:
    return df.where(F.col("petrlm_development_road_type") != "WINT")


def filter_rail(df: DataFrame) -> DataFrame:
    return df.select("railway_track_id", "geom")


def tolerance_of_class(road_class: Column, rules: dict[float, tuple[str, ...]] | None = None,
                       otherwise: float = OTHER_CLASS_TOLERANCE) -> Column:
    rules = CLASS_TOLERANCES if rules is None else rules
    branches = [(road_class.isin(*classes), F.lit(metres)) for metres, classes in rules.items()]
    first, *rest = branches
    return reduce(lambda chain, b: chain.when(*b), rest, F.when(*first)).otherwise(F.lit(otherwise))


def with_tolerance(df: DataFrame, class_col: str = "transport_line_type_code",
                   rules: dict[float, tuple[str, ...]] | None = None) -> DataFrame:
    """Add ``tolerance``, the clustering distance of the road class."""
    return df.withColumn("tolerance", tolerance_of_class(F.col(class_col), rules))


def source_of(df: DataFrame) -> DataFrame:
    """Add ``source``: the highest-priority source whose id is set."""
    return df.withColumn("source", F.coalesce(
        *[F.when(F.col(column).isNotNull(), F.lit(source)) for source, column in SOURCE_ID_COLUMNS.items()]))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Append crossings of several sources; id columns a source lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def code_labels(df: DataFrame, codes: DataFrame, code_col: str, label_col: str, alias: str) -> DataFrame:
    """Left join of a code table. Spark broadcasts the code table if its size is below the session's limit."""
    lookup = codes.select(F.col(code_col), F.col(label_col).alias(alias))
    return df.join(lookup, code_col, "left")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    Pass a total order. Descending orders put NULL first with ``Column.desc_nulls_first``. The row number is
    limited to 1, which Spark applies on the map side as well, so a hot key sends one row per input task.
    """
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
