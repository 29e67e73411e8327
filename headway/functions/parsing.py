"""Text to number and text to time; bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number(column: Column) -> Column:
    return column.try_cast("double")


def moment(column: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since 1970; zone-less times count in the session zone (UTC)."""
    return F.unix_seconds(column.cast("timestamp"))
