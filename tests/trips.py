"""Trip rows made by column expressions: learnable, with known coefficients."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.functions.calendar import calendar_columns

CSV_COLUMNS = [
    "RecordedAtTime", "DirectionRef", "PublishedLineName", "OriginName", "OriginLat", "OriginLong",
    "DestinationName", "DestinationLat", "DestinationLong",
    "VehicleLocation.Latitude", "VehicleLocation.Longitude", "NextStopPointName", "DistanceFromStop",
]


def _unit(name: str):
    """Repeatable number in [0, 1) from the row id."""
    return F.pmod(F.xxhash64(F.lit(name), F.col("id")), F.lit(100_000)) / F.lit(100_000.0)


def clean_trips(spark: SparkSession, n: int) -> DataFrame:
    """n trips over a year, no nulls, unique times, names still with dots."""
    seconds = F.lit(365 * 86_400) * F.col("id") / F.lit(n)
    rows = (
        spark.range(n)
        .withColumn("t", F.timestamp_micros((F.lit(1_672_531_200) + F.floor(seconds)) * 1_000_000))
        .withColumns({k: v for k, v in calendar_columns(F.col("t")).items() if k in ("Hour", "IsMorningPeak")})
        .withColumn("lat", F.lit(40.6) + F.lit(0.3) * _unit("lat"))
    )
    label = (
        F.lit(300.0) + F.lit(120.0) * F.col("IsMorningPeak")
        + F.lit(80.0) * F.sin(F.col("Hour") * F.lit(2 * math.pi / 24))
        + F.lit(900.0) * (F.col("lat") - F.lit(40.7)) + F.lit(10.0) * (_unit("noise") - F.lit(0.5))
    )
    return rows.select(
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("RecordedAtTime"),
        (F.col("id") % 2).cast("string").alias("DirectionRef"),
        F.concat(F.lit("M"), F.col("id") % 7).alias("PublishedLineName"),
        F.concat(F.lit("O"), F.col("id") % 5).alias("OriginName"),
        (F.lit(40.6) + F.lit(0.2) * _unit("olat")).cast("string").alias("OriginLat"),
        (F.lit(-74.0) + F.lit(0.2) * _unit("olon")).cast("string").alias("OriginLong"),
        F.concat(F.lit("D"), F.col("id") % 4).alias("DestinationName"),
        (F.lit(40.6) + F.lit(0.2) * _unit("dlat")).cast("string").alias("DestinationLat"),
        (F.lit(-74.0) + F.lit(0.2) * _unit("dlon")).cast("string").alias("DestinationLong"),
        F.col("lat").cast("string").alias("VehicleLocation.Latitude"),
        (F.lit(-74.0) + F.lit(0.2) * _unit("vlon")).cast("string").alias("VehicleLocation.Longitude"),
        F.concat(F.lit("S"), F.col("id") % 11).alias("NextStopPointName"),
        label.cast("string").alias("DistanceFromStop"),
    )


def dirty_trips(spark: SparkSession, n: int) -> DataFrame:
    """The same trips with unreadable numbers and times, empty and missing values."""
    rows = clean_trips(spark, n).withColumn("i", F.monotonically_increasing_id())

    def spoil(column: str, every: int, value):
        name = f"`{column}`"
        return F.when(F.xxhash64(F.lit(column), F.col("RecordedAtTime")) % every == 0, value).otherwise(F.col(name))

    missing = F.lit(None).cast("string")
    return rows.select(
        spoil("RecordedAtTime", 50, F.lit("no time")).alias("RecordedAtTime"),
        "DirectionRef", "PublishedLineName",
        spoil("OriginName", 40, F.lit("")).alias("OriginName"),
        spoil("OriginLat", 10, F.lit("abc")).alias("OriginLat"),
        spoil("OriginLong", 10, missing).alias("OriginLong"),
        "DestinationName", "DestinationLat", "DestinationLong",
        spoil("VehicleLocation.Latitude", 60, F.lit("abc")).alias("VehicleLocation.Latitude"),
        "`VehicleLocation.Longitude`", "NextStopPointName",
        spoil("DistanceFromStop", 45, missing).alias("DistanceFromStop"),
    )
