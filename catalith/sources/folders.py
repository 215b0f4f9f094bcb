"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a session on one machine that has none gets an own one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catalith-"))
        at = spark.sparkContext.getCheckpointDir()
    return at


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder's name below the shared one; what an application writes lies together."""
    return f"{shared(spark)}/catalith-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
