"""Text categories as numbers: a dictionary that is ranked, kept and joined as a table.

A value's code is its place by count, the most frequent first, ties by name. Counting
and ranking are distributed and the dictionary is a staged table, so the number of
distinct values is bounded by nothing; only how many there are comes to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from headway.operators.ordering import global_row_number
from headway.sources.writing import stage

SENT_VALUES, SENT_BYTES = 100_000, 16 << 20  # of a dictionary, that are sent to every executor; the rest is joined by shuffle


@dataclass(frozen=True)
class Dictionary:
    """``table`` holds value, n and code (from 0) of each of ``size`` values of a column."""

    column: str
    table: DataFrame
    size: int

    def frequent(self) -> DataFrame:
        """The most frequent values, as many as may be sent to every executor.

        Their bytes are added up in the order of the codes, so what is sent is bounded
        whatever the length of the values.
        """
        head = self.table.filter(F.col("code") < SENT_VALUES)
        size = head.agg(F.sum(F.octet_length("value") + 16)).first()[0] or 0
        share = min(1.0, SENT_BYTES / size) if size else 1.0
        if share < 1.0:  # long values: only those that cannot fill more than their share each
            head = head.filter(F.octet_length("value") + 16 <= SENT_BYTES // SENT_VALUES)
        return head.select("value", "code")


def fit_dictionaries(df: DataFrame, columns: Sequence[str], folder: str | None = None) -> dict[str, Dictionary]:
    """Dictionaries of some columns from one pass over the rows; nulls are no values."""
    if not columns:
        return {}
    counts = (
        df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("v"))
        .select("v.column", "v.value").filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("less", -F.col("n"))
    )
    ranked = global_row_number(counts, ["column", "less", "value"], "place").drop("less")
    placed = stage(ranked, "categories", folder=folder)
    sizes = {r["column"]: (r["size"], r["first"]) for r in placed.groupBy("column").agg(
        F.count(F.lit(1)).alias("size"), F.min("place").alias("first")).collect()}  # one row per column
    found = {}
    for c in columns:
        size, first = sizes.get(c, (0, 1))
        own = placed.filter(F.col("column") == c).select("value", "n", (F.col("place") - F.lit(first)).alias("code"))
        found[c] = Dictionary(c, own, size)
    return found


def code_name(column: str) -> str:
    return f"{column}_code"


def encode(df: DataFrame, dictionaries: Mapping[str, Dictionary]) -> DataFrame:
    """Add the code of each column; values that the dictionary does not hold, and nulls, get its size.

    Frequent values are looked up in what every executor has, so no row with one is
    shuffled. If the dictionary holds more, the rows left, whose values are rare, are
    joined with its tail.
    """
    for c, dictionary in dictionaries.items():
        name, columns = code_name(c), df.columns
        frequent = dictionary.frequent()
        sent = F.broadcast(frequent.select(F.col("value").alias("__value"), F.col("code").alias("__code")))
        looked = df.join(sent, F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
        if dictionary.size > frequent.count():
            tail = dictionary.table.join(frequent, "value", "left_anti").select(F.col("value").alias("__value"), F.col("code").alias("__more"))
            rare = F.col("__code").isNull() & F.col(c).isNotNull()
            looked = looked.filter(~rare).unionByName(
                looked.filter(rare).drop("__code").join(tail, F.col(c).cast("string") == F.col("__value"), "left")
                .drop("__value").withColumnRenamed("__more", "__code")
            )
        nominal = {"ml_attr": {"type": "nominal", "num_vals": dictionary.size + 1, "name": name}}
        code = F.coalesce("__code", F.lit(dictionary.size)).cast("double")
        df = looked.withColumn("__known", code).select(*[f"`{n}`" for n in columns], F.col("__known").alias(name, metadata=nominal))
    return df
