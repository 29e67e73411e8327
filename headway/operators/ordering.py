"""Exact global order without putting all rows in one task, and the row splits.

A chronological split does not need the rank of every row, only the two rows at
which the parts meet. They are found by counting rows per day, then per second
within the days that matter, and ranking only the rows of the seconds that are
left. The split itself is then a comparison with two constants: no shuffle, no
sort, and the time bounds reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from headway.session import shared_dir

_PLACE, _PART = "__place", "__part"


def global_row_number(df: DataFrame, keys: Sequence[str], out: str = "rn") -> DataFrame:
    """Number all rows 1..n by ``keys``, which should be unique together.

    Rows are range-partitioned and sorted within partitions; a row's number is
    its offset in the partition plus the sizes of the partitions before it. The
    placed rows are checkpointed, so sizes and offsets always come from the same
    placement, also after the loss of an executor.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_PLACE, 33))
        .checkpoint()
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition: small however many rows there are.
    starts = (
        placed.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("__size"))
        .select(_PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    )
    offset = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(starts), _PART)
        .withColumn(out, F.col("__start") + offset + 1)
        .select(*df.columns, out)
    )


@dataclass(frozen=True)
class ChronoSplit:
    """Sizes of the three parts and the row predicates that make them."""

    time: str
    n_train: int
    n_test: int
    n_val: int
    _until_train: Column
    _until_test: Column

    def column(self) -> Column:
        return (
            F.when(self._until_train, "train").when(self._until_test, "test").otherwise("val")
        )

    def apply(self, df: DataFrame, out: str = "split") -> DataFrame:
        """All rows that have a time, with the part they belong to."""
        return df.filter(F.col(self.time).isNotNull()).withColumn(out, self.column())

    def rows(self, df: DataFrame, part: str) -> DataFrame:
        """Rows of one part, as a plain filter that the scan can use."""
        timed = df.filter(F.col(self.time).isNotNull())
        if part == "train":
            return timed.filter(self._until_train)
        if part == "test":
            return timed.filter(~self._until_train & self._until_test)
        if part == "val":
            return timed.filter(~self._until_test)
        raise ValueError(f"unknown part {part!r}")


def _plain(df: DataFrame, key: str) -> Column:
    """Key as a value that comes back from the driver unchanged (times as micros)."""
    if isinstance(df.schema[key].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(key).cast("timestamp")).alias(key)
    return F.col(key)


def _literal(df: DataFrame, key: str, value) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.lit(value)).cast(kind)
    return F.lit(value).cast(kind)


def _up_to(df: DataFrame, keys: Sequence[str], boundary: Row | None) -> Column:
    """Predicate: the row's keys are at or before the boundary, nulls first."""
    if boundary is None:
        return F.lit(False)

    def before(key):
        if boundary[key] is None:
            return F.lit(False)
        return F.col(key).isNull() | (F.col(key) < _literal(df, key, boundary[key]))

    def same(key):
        if boundary[key] is None:
            return F.col(key).isNull()
        return F.col(key).eqNullSafe(_literal(df, key, boundary[key]))

    condition = before(keys[-1]) | same(keys[-1])
    for key in reversed(keys[1:-1]):
        condition = before(key) | (same(key) & condition)
    time = _literal(df, keys[0], boundary[keys[0]])
    if len(keys) == 1:
        return F.col(keys[0]) <= time
    return (F.col(keys[0]) <= time) & ((F.col(keys[0]) < time) | condition)


def _buckets_with_ranks(df: DataFrame, time: str, unit: str, ranks: Column) -> list[Row]:
    """Time buckets that hold one of the ranks, and the last bucket.

    There is one row per bucket before the window, as many as the calendar has
    days (or two days have seconds), however many rows are counted.
    """
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = df.groupBy(F.date_trunc(unit, time).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    marked = (
        counts.withColumn("upto", F.sum("n").over(running))
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
        .withColumn("held", F.exists(ranks, lambda r: (F.col("upto") - F.col("n") < r) & (r <= F.col("upto"))))
    )
    found = marked.filter(F.col("held") | (F.col("upto") == F.col("total"))).select(
        F.unix_micros(F.col("bucket").cast("timestamp")).alias("bucket"), "n", "upto", "total", "held"
    )
    return sorted(found.collect(), key=lambda row: row["bucket"])  # three rows at most


def _narrow(df: DataFrame, time: str, unit: str, kept: list[Row], ranks: list[int]) -> tuple[DataFrame, list[int], int]:
    """Rows of the kept buckets, the ranks counted within them, and their number."""
    days = isinstance(df.schema[time].dataType, T.DateType)
    width = F.expr("INTERVAL 1 DAY" if days or unit == "day" else "INTERVAL 1 SECOND")
    inside, local, taken = F.lit(False), list(ranks), 0
    for bucket in kept:
        start = F.timestamp_micros(F.lit(bucket["bucket"])).cast(df.schema[time].dataType)
        inside = inside | ((F.col(time) >= start) & (F.col(time) < start + width))
        first = bucket["upto"] - bucket["n"]
        for i, rank in enumerate(ranks):
            if first < rank <= bucket["upto"]:
                local[i] = rank - first + taken
        taken += bucket["n"]
    return df.filter(inside), local, taken


def fit_chrono_split(
    df: DataFrame,
    time: str,
    tiebreak: Sequence[str],
    train: float = 0.7,
    test: float = 0.2,
) -> ChronoSplit:
    """Find where train, test and validation meet when rows are in time order.

    Sizes are int(train*n), int(test*n) and the rest, n counting rows with a time.
    ``tiebreak`` columns must make the order unique; rows that cannot be told
    apart at a boundary raise an error rather than give parts of a wrong size.
    """
    keys = [time, *tiebreak]
    rows = df.filter(F.col(time).isNotNull()).select(*keys)
    total = F.col("total").cast("double")
    end_train = F.floor(F.lit(float(train)) * total)
    days = _buckets_with_ranks(
        rows, time, "day", F.array(end_train, end_train + F.floor(F.lit(float(test)) * total))
    )
    n = days[-1]["total"] if days else 0
    n_train, n_test = int(train * n), int(test * n)
    ranks = [n_train, n_train + n_test]

    wanted, local, left = _narrow(rows, time, "day", [d for d in days if d["held"]], ranks)
    if left:
        seconds = _buckets_with_ranks(wanted, time, "second", F.array(*[F.lit(r) for r in local]))
        wanted, local, left = _narrow(wanted, time, "second", [s for s in seconds if s["held"]], local)

    found: dict[int, Row] = {}
    if left:
        plain = wanted.select(*[_plain(wanted, k) for k in keys])
        ranked = global_row_number(plain, keys, "__rn")
        near = sorted({r + step for r in local for step in (0, 1)})
        found = {row["__rn"]: row for row in ranked.filter(F.col("__rn").isin(near)).collect()}

    boundaries = []
    for rank, here in zip(ranks, local):
        row, after = (found.get(here), found.get(here + 1)) if rank else (None, None)
        if row is not None and after is not None and all(row[k] == after[k] for k in keys):
            raise ValueError(f"rows at rank {rank} cannot be told apart by {keys}")
        boundaries.append(row)
    return ChronoSplit(
        time, n_train, n_test, n - n_train - n_test,
        _up_to(df, keys, boundaries[0]), _up_to(df, keys, boundaries[1]),
    )


def chrono_split(
    df: DataFrame, time: str, tiebreak: Sequence[str], train: float = 0.7, test: float = 0.2, out: str = "split"
) -> DataFrame:
    """Rows with a time, marked train, test or val in time order."""
    return fit_chrono_split(df, time, tiebreak, train, test).apply(df, out)


def hash_split(
    df: DataFrame,
    key: str,
    shares: Sequence[float] = (0.7, 0.201, 0.099),
    names: Sequence[str] = ("train", "test", "val"),
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Random split that depends on the key alone, not on how rows are partitioned."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    chain, upto = None, 0.0
    for share, name in list(zip(shares, names))[:-1]:
        upto += share
        chain = F.when(place < upto, name) if chain is None else chain.when(place < upto, name)
    return df.withColumn(out, chain.otherwise(names[-1]))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
