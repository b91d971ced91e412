"""Folders that the driver and all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one if all of Spark is one process (tests), else an error:
    executors elsewhere would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tellurion-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def spread(scan: DataFrame) -> DataFrame:
    """A scan that Spark would read in fewer tasks than the cluster has cores, such as one row group, dealt to all of them before work
    that is dear for each row; larger scans stay as they are. Give it a table as read, since the parts of other plans are only known
    once they run."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
