"""Session settings the jobs are designed for, and the shared scratch space."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work: coalescing small partitions, splitting skewed
# join partitions (also when that costs one more shuffle), switching to a
# broadcast only when the measured size of a side allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The given builder with the settings above."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut-lineage tables: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder below an explicit ``spark.sql.warehouse.dir`` (also shared) or,
    for a local master only, below its default; a cluster with neither is refused.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    local = re.fullmatch(r"local(\[.*\])?", sc.master) is not None
    if not local and not sc.getConf().contains("spark.sql.warehouse.dir"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    sc.setCheckpointDir(own)
    return own


def run_dir(spark: SparkSession) -> str:
    """Folder of this application's pinned tables."""
    return f"{scratch_dir(spark)}/run-{spark.sparkContext.applicationId}"


# Spark deletes the shuffle files of a query as soon as it has ended, not when the driver happens to
# collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Later passes see the same rows even if executors are lost, read only the
    columns they need, and do not recompute what led to ``df``. Shuffle files of
    the write are gone when it has ended.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/pinned-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    pinned = spark.read.schema(df.schema).parquet(path)
    pinned.pinned_at = path
    return pinned


def unpin(*pinned: DataFrame) -> None:
    """Delete what ``pin`` has written for these frames, once nothing reads them any more."""
    for df in pinned:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.pinned_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_pins(spark: SparkSession) -> None:
    """Delete every table this application has pinned; frames built on them end to be readable."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
