"""Where jobs put intermediate tables: the shared folder the cluster names."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may get a scratch one instead."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    scratch = os.path.join(tempfile.gettempdir(), f"ledgerlens-{spark.sparkContext.applicationId}")
    os.makedirs(scratch, exist_ok=True)
    return scratch


def new_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
