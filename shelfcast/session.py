"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates and adaptive execution; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(
    cpus: int | str = "*", app_name: str = "shelfcast-local", shared: str | None = None
) -> SparkSession:
    """Single-machine session for tests and the bench; `shared` is its folder for stored tables."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    return build_session(
        app_name,
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cores),
            "spark.driver.memory": os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        }
        | ({"spark.checkpoint.dir": shared} if shared else {}),
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder that all executors share: the one the cluster names, else one beside the warehouse in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shelfcast-scratch"
    return folder


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write once as Parquet to the shared folder and read it back, for tables that several passes read.

    The files outlive lost executors, cut the lineage, and can be pruned by column, row group and `partition_by`.
    They stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tables/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{name}`" for name in df.columns])
