"""Names, types, missing values and the source report."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from headway.functions.parsing import moment, number


def normalize_names(df: DataFrame) -> DataFrame:
    """Take the dots out of all column names; names may not run together."""
    names = [name.replace(".", "") for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"columns run together without their dots: {clashes}")
    return df.toDF(*names)


def available(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The names that the frame has, in the order given."""
    present = set(df.columns)
    return [name for name in names if name in present]


def cast_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in available(df, columns)})


def parse_time(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """Text or zone-less time to timestamp; unreadable text becomes null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, moment(F.col(column), fmt))
    return df.withColumn(column, F.col(column).cast("timestamp"))


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a null (or NaN) in a required column go."""
    return df.dropna(subset=list(required))


def _per_column(df: DataFrame, fields: dict[str, object]) -> DataFrame:
    """One aggregate over all columns at once, turned to one row per column.

    ``fields`` gives, per output name, a function of the column's struct field.
    """
    rows = [
        F.struct(F.lit(f.name).alias("column"), *[make(f).alias(name) for name, make in fields.items()])
        for f in df.schema.fields
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _nulls(field: T.StructField) -> Column:
    return F.count_if(F.col(f"`{field.name}`").isNull())


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and rows per column: (column, n_null, n_rows)."""
    return _per_column(df, {"n_null": _nulls, "n_rows": lambda _: F.count(F.lit(1))})


def source_report(df: DataFrame) -> DataFrame:
    """Columns, types and row count: (column, type, n_rows).

    The count is taken as nulls plus values of each column, so that every column
    is read: a reader that skips malformed lines only sees them that way.
    """
    return _per_column(
        df,
        {
            "type": lambda f: F.lit(f.dataType.simpleString()),
            "n_rows": lambda f: _nulls(f) + F.count(F.col(f"`{f.name}`")),
        },
    )
