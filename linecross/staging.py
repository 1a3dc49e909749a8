"""Write intermediate tables once, and read them back.

A staged table cuts lineage, gives the planner real file sizes, and outlives the executors that wrote it.
It goes below the folder the session names in ``spark.checkpoint.dir``; ``discard`` deletes it once it is superseded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

#: Used in local mode only, and only if neither the setting nor ``setCheckpointDir`` names a folder.
LOCAL_DEFAULT = "/tmp/linecross-checkpoints"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: one below the session's checkpoint folder, which all executors share."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder which all executors share")
        sc.setCheckpointDir(LOCAL_DEFAULT)
        configured = sc.getCheckpointDir()
    if not sc.master.startswith("local[") and configured.startswith("file:") and not sc.master.startswith("local-cluster"):
        raise ValueError(f"spark.checkpoint.dir is a machine's own folder: {configured}")
    return f"{configured.rstrip('/')}/linecross-{sc.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the staging folder that nothing else uses."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the staging folder and return the table read back.

    Shuffle files of the write go as soon as it ends: nothing reads them again once the table is there.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, label: str, **metrics: str) -> tuple[DataFrame, dict]:
    """As ``stage``, and the values of SQL aggregates over ``df`` that the same job computes on the way."""
    seen = Observation()
    staged = stage(df.observe(seen, *[F.expr(sql).alias(name) for name, sql in metrics.items()]), label)
    return staged, seen.get


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store its scheme names; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        root = staging_root(spark)
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if f"/{root.rsplit('/', 1)[1]}/" in folder:
                delete_path(spark, folder)
