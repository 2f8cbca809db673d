"""Folder that all executors share, for tables one job writes and others read."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names.

    There is no other one that every executor is known to see, so without the setting this is an
    error, on a cluster and in local mode alike.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return folder.rstrip("/")
