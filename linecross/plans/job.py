"""The whole run: overlay, ids, merging, classification, reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from linecross.operators.classify import classify, default_rules
from linecross.operators.ids import assign_ids, match_archive
from linecross.operators.merge import merge_by_priority
from linecross.operators.overlay import exclude_tunnels
from linecross.plans.crossings import REASONS, find_crossings
from linecross.plans.reports import REPORTS
from linecross.schema import CROSSINGS, SOURCE_ID_COLUMNS
from linecross.sources.sinks import write_crossings, write_report
from linecross.staging import stage

LINE_LAYERS = tuple(SOURCE_ID_COLUMNS)


def crossing_order() -> list[Column]:
    """Total order in which crossings get their ids: source, region, stream, measure, line, place."""
    rank = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(i)) for i, c in enumerate(SOURCE_ID_COLUMNS.values())])
    return [rank, F.col("watershed_group_code"), F.col("linear_feature_id"), F.round("downstream_route_measure", 6),
            *[F.col(c) for c in SOURCE_ID_COLUMNS.values()], F.round("geom.x", 6), F.round("geom.y", 6)]


def numbered_crossings(inputs: Mapping[str, DataFrame], found: Observation | None = None, exclude_rail_tunnels: bool = False,
                       **options) -> DataFrame:
    """Crossings of all line layers in ``inputs``, with ids but before merging and classification.

    ``found`` observes their number as ``found``. ``exclude_rail_tunnels`` leaves out tracks that touch a tunnel structure.
    """
    layers = {name: inputs[name] for name in LINE_LAYERS if name in inputs}
    if exclude_rail_tunnels and "rail" in layers:
        layers["rail"] = exclude_tunnels(layers["rail"], inputs["rail_structures"])
    # staged because range partitioning reads its input twice
    raw = stage(find_crossings(inputs["streams"], layers, **options), "found")
    rows = assign_ids(raw, crossing_order())
    typed = rows.withColumns({
        "modelled_crossing_id": F.col("modelled_crossing_id").cast("int"),
        "modelled_crossing_type": F.lit(None).cast("string"),
        "modelled_crossing_type_source": F.lit(None).cast("array<string>"),
    }).select(*CROSSINGS.fieldNames())
    return stage(typed if found is None else typed.observe(found, F.count("*").alias("found")), "numbered")


def classified_crossings(merged: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    rules = default_rules(inputs["streams"], inputs["mot"], inputs["pscis_events"], inputs["pscis_points"], inputs["dra"],
                          inputs["rail_structures"])
    return classify(merged, rules).select(*CROSSINGS.fieldNames())


def model_crossings(inputs: Mapping[str, DataFrame], archive: DataFrame | None = None, tolerance: float = 20.0,
                    snapshot: str | None = None, **options) -> DataFrame:
    """The finished crossings table. ``inputs`` maps layer names to DataFrames with the columns of ``linecross.schema``.

    With ``archive`` ids are carried over from an earlier result. ``snapshot``: a path for the crossings as they are before merging.
    """
    numbered = numbered_crossings(inputs, **options)
    if snapshot:
        write_crossings(numbered, snapshot)
    done = classified_crossings(merge_by_priority(numbered, tolerance=tolerance), inputs)
    return done if archive is None else match_archive(stage(done, "classified"), archive)


def run(spark: SparkSession, inputs: Mapping[str, DataFrame], out: str, archive: DataFrame | None = None, snapshot: bool = False,
        **options) -> DataFrame:
    """Write the crossings table, the four reports, the rejected clusters and a summary below ``out``; return the table read back.

    ``summary`` is one row of counts: clusters that gave no crossing by reason, crossings ``found``, ``merged`` into others, ``kept``,
    of these ``obs``, ``cbs`` and ``tagged``. The writes observe them, so nothing is read again. ``snapshot`` also writes the
    crossings before merging.
    """
    rejected, found, kept = Observation(), Observation(), Observation()
    crossings = model_crossings(inputs, archive, snapshot=f"{out}/snapshot" if snapshot else None, rejects=f"{out}/rejected",
                                rejected=rejected, found=found, **options)
    kind = "modelled_crossing_type"
    write_crossings(crossings.observe(kept, F.count("*").alias("kept"), F.count_if(F.col(kind) == "OBS").alias("obs"), F.count_if(
        F.col(kind) == "CBS").alias("cbs"), F.count(f"{kind}_source").alias("tagged")), f"{out}/crossings")
    counts = {**{name: rejected.get[name] or 0 for name in REASONS}, **found.get, **kept.get}
    counts["merged"] = counts["found"] - counts["kept"]
    spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts)).write.mode("overwrite").parquet(f"{out}/summary")
    # the partition column comes last when read, so the order is restored
    crossings = spark.read.schema(CROSSINGS).parquet(f"{out}/crossings").select(*CROSSINGS.fieldNames())
    for name, report in REPORTS.items():
        write_report(report(crossings), f"{out}/reports/{name}")
    return crossings
