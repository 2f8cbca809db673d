"""A shared folder for local trial runs, where the session names none."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from riskbook.sources.shared import SETTING, shared_folder


def ensure_folder(spark: SparkSession) -> str:
    """The session's shared folder; in local mode a temporary one, removed when Python ends, if unset."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local and not spark.conf.get(SETTING, None):
        folder = tempfile.mkdtemp(prefix="riskbook-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(SETTING, f"file://{folder}")
    return shared_folder(spark)
