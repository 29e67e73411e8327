"""How much of a table goes to Python at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BYTES = 1 << 20  # beyond the first row; 10,000 texts or shingle sets, Spark's own batch, are tens of megabytes
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep_small(spark: SparkSession) -> None:
    """From now on rows go to Python in batches of ``BYTES``; the rows are the same.

    A batch is held several times over: as buffers that double while Spark fills them,
    as Python reads it, as objects and as results, for each task of an executor.
    """
    spark.conf.set(SETTING, BYTES)


@contextmanager
def small(spark: SparkSession) -> Iterator[None]:
    """The same for what is written within; the session's own limit comes back."""
    before = spark.conf.get(SETTING)
    keep_small(spark)
    try:
        yield
    finally:
        spark.conf.set(SETTING, before)
