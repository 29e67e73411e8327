"""Trips from CSV, tables from Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from headway.sources.writing import stage

# Header of the trip CSV, in order; dots are taken out later.
TRIP_COLUMNS = (
    "RecordedAtTime", "DirectionRef", "PublishedLineName",
    "OriginName", "OriginLat", "OriginLong",
    "DestinationName", "DestinationLat", "DestinationLong",
    "VehicleLocation.Latitude", "VehicleLocation.Longitude",
    "NextStopPointName", "DistanceFromStop",
)


def read_trips_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, every column as text; lines with missing or extra fields are skipped.

    Text first, typed later: with a typed schema one unreadable number would drop
    its whole line, and inferring types would read the file twice. Without
    ``columns`` the names are taken from the header line. Lines are always read
    whole, so that a malformed one is skipped whatever columns a query needs.
    """
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("columnPruning", False)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path if isinstance(path, str) else list(path))


@dataclass(frozen=True)
class ParsedTrips:
    """Well-formed rows, the text of the lines that are not, and how many there are of both."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


LINE = "_malformed_line"


def parse_trips_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], header: bool = True, folder: str | None = None) -> ParsedTrips:
    """Like ``read_trips_csv``, but lines with missing or extra fields are handed back instead of skipped.

    The source is read once: every line is parsed, counted and staged under whether
    it was well formed. The named columns are those of the files, in order.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, LINE)])
    parsed = (
        spark.read.schema(schema).option("header", header).option("enforceSchema", True).option("mode", "PERMISSIVE")
        .option("columnPruning", False).option("columnNameOfCorruptRecord", LINE).csv(path if isinstance(path, str) else list(path))
    )
    counts = Observation()
    watched = parsed.withColumn("_malformed", F.col(f"`{LINE}`").isNotNull()).observe(
        counts, F.count(F.lit(1)).alias("lines"), F.count_if("_malformed").alias("rejects")
    )
    staged = stage(watched, "parsed-lines", folder=folder)
    found = counts.get
    rows = staged.filter(~F.col("_malformed")).select(*[f"`{c}`" for c in columns])
    rejects = staged.filter("_malformed").select(F.col(f"`{LINE}`").alias("line"))
    return ParsedTrips(rows, rejects, found["lines"] - found["rejects"], found["rejects"])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table; times stored without a zone are taken as session (UTC) time."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df
