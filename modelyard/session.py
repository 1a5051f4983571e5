"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "modelyard", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Where that is unset it is a folder beside the warehouse, which is shared by the
    same right, on any master. Whoever owns the folder clears it when no job runs.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/modelyard/{name}-{uuid.uuid4().hex}"
