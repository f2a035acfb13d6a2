"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are designed for. All are runtime SQL settings, so a
# cluster may override any of them; none changes a result.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Stack capture per column call; it only slows down building wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "voltseries",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the recommended settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder path for a table that cuts lineage.

    The parent is the folder the cluster names in ``spark.checkpoint.dir``. Only
    a local session, where driver and executors share one disk, may fall back to
    a temporary folder; anywhere else a missing setting is an error, because
    executors could not see the driver's disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="voltseries-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
