"""A new folder for intermediate tables, in the place that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below ``spark.checkpoint.dir``.

    Without that setting only a session on one machine gets a local folder; on a cluster, where every
    executor would write to its own disk, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sparkmart-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
