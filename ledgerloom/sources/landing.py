"""Folder for intermediate tables and landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHARED_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder.

    The place is the one the session names in ``spark.checkpoint.dir``, else the session's warehouse; both are shared by
    all executors. A session with neither is an error: a folder of one machine would lose rows.
    """
    base = spark.conf.get(SHARED_SETTING, None) or spark.conf.get(WAREHOUSE_SETTING, None)
    if not base:
        raise ValueError(f"set {SHARED_SETTING} to a folder that driver and executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
