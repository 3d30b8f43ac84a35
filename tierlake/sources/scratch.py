"""A folder every executor can reach, for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder the session names.

    Only a local session without such a folder gets one on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix=f"tierlake-{purpose}-")
    return f"{shared.rstrip('/')}/tierlake/{purpose}-{uuid.uuid4().hex}"
