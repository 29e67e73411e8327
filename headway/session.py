"""What the package needs from a Spark session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Calendar fields are read off the session zone, so pin it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session (tests) gets a folder made for it when none is named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="headway-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named
