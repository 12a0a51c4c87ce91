"""Folders for tables that a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below that of spark.checkpoint.dir, which all executors share.

    Where the setting is missing, a session on one machine gets a temporary folder; a cluster
    session is refused, as a machine's own folder is not shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or "-cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="work-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
