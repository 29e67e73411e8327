"""Training rows by their feature vector, for trees.

A tree sends rows with equal features the same way, so it needs of them only how
many there are and the sum of their labels. Calendar features and columns with few
values have far fewer vectors than rows: trees are then fitted on one weighted row
for each vector, and their time no longer follows the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

GROUP, WEIGHT, MARK = "__group", "__weight", "__mark"

MOST_SLOTS = 512  # longer vectors, as of text categories, are not grouped
FEWEST_ROWS = 100_000  # with fewer, trees are fitted on the rows as they are
LEAST_ROWS = 4  # rows that a vector, or a sum kept for it, stands for at least
GROUPS_A_PART, DRAWS_A_PART = 50_000, 100_000_000
MOST_COPIES = 32  # equal rows that one draw stands for; more are dealt over several
SALTS = 16  # tasks at most among which the rows of one vector are dealt
_BLOCK = 1 << 19  # draws made at once

_U = np.uint64
_STEP, _SALT = _U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Groups:
    """``table``: GROUP, features, label (the mean) and WEIGHT (the rows) of each vector.

    ``cells``: GROUP, label, MARK and copies of every distinct row. Both are persisted.
    """

    table: DataFrame
    cells: DataFrame
    rows: int
    size: int
    label: str
    features: str

    def release(self) -> None:
        self.table.unpersist()
        self.cells.unpersist()


def by_features(train: DataFrame, features: str, label: str) -> Groups | None:
    """The groups, or None where the rows are few or the groups would not be far fewer.

    A vector is known by a 64-bit hash of its slots; it is checked that no two share one.
    """
    first = train.select(features).first()
    if first is None or first[0] is None or len(first[0]) > MOST_SLOTS:
        return None
    slots = vector_to_array(F.col(features))
    rows = train.select(slots.alias("slots"), F.col(label)).select("slots", label, F.xxhash64("slots").alias(GROUP))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(GROUP).alias("groups")).first()
    if seen["n"] < FEWEST_ROWS or seen["groups"] * LEAST_ROWS > seen["n"]:
        return None
    found = rows.groupBy(GROUP, "slots").agg(
        # A missing label stays one, for the model to refuse.
        F.when(F.count(label) == F.count(F.lit(1)), F.avg(label)).alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT)
    )
    table = found.select(GROUP, array_to_vector(F.col("slots")).alias(features), label, WEIGHT)
    table = table.repartition(max(1, ceil(seen["groups"] / GROUPS_A_PART)), GROUP).sortWithinPartitions(GROUP).persist()
    size, names = table.agg(F.count(F.lit(1)), F.countDistinct(GROUP)).first()
    if size != names:
        table.unpersist()
        return None
    cells = rows.withColumn(MARK, F.xxhash64(label, "slots")).groupBy(GROUP, label, MARK).agg(F.count(F.lit(1)).alias("copies")).persist()
    return Groups(table, cells, seen["n"], size, label, features)


def collapsed(rows: DataFrame, features: str, label: str, spread: str) -> DataFrame:
    """Features, label (the mean), WEIGHT and ``spread`` (squares around the mean) of each vector among rows with a label."""
    y = F.col(label).cast("double")
    found = rows.filter(y.isNotNull()).groupBy(vector_to_array(F.col(features)).alias("slots")).agg(
        F.avg(y).alias(label), F.count(F.lit(1)).cast("double").alias(WEIGHT), (F.var_pop(y) * F.count(F.lit(1))).alias(spread)
    )
    return found.select(F.xxhash64("slots").alias(GROUP), array_to_vector(F.col("slots")).alias(features), label, WEIGHT, spread)


# --- bootstrap samples -------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers (the finaliser of a public hash)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def draws(marks: np.ndarray, parts: np.ndarray, copies: np.ndarray, trees: int, rate: float, seed: int) -> np.ndarray:
    """Rows x trees: how often each tree's sample holds these copies of a row.

    Poisson numbers with a mean of ``rate`` for each copy, as in Spark's own forests, by
    inversion of uniforms that follow from the row's hash, the tree and the seed.
    """
    out = np.empty((len(marks), trees))
    order = np.argsort(copies, kind="stable")
    own = _mix(marks.astype(np.int64).view(_U) + _mix(parts.astype(np.int64).view(_U) * _SALT + _U(seed % (1 << 63))))
    tree = np.arange(1, trees + 1, dtype=_U) * _STEP
    block = max(1, _BLOCK // trees)
    for at in range(0, len(order), block):
        some = order[at : at + block]
        u = (_mix(own[some, None] + tree) >> _U(11)) * 2.0**-53
        mean = rate * copies[some, None].astype(float)
        p = np.exp(-mean)
        upto, k, n = p.copy(), 0, np.zeros(u.shape)
        while (more := u > upto).any() and k < 1000:
            n += more
            k += 1
            p = p * mean / k
            upto += p
        out[some] = n
    return out


def _draw_sums(trees: int, rate: float, seed: int):
    """Rows come ordered by group; one row of sums leaves for each group of a batch."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            group, mark, part, copies, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            drawn = draws(mark, part, copies, trees, rate, seed)
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            counts = np.add.reduceat(drawn, starts, axis=0)
            totals = np.add.reduceat(drawn * label[:, None], starts, axis=0)
            yield _sums_batch(group[starts], counts, totals)

    return sums


def _sums_batch(group: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(group) + 1, dtype=np.int32) * counts.shape[1])
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (counts, totals)]
    return pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), *lists], names=[GROUP, "drawn", "total"])


def _add_up(trees: int):
    def add(table: pa.Table) -> pa.Table:
        counts, totals = (
            table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, trees).sum(0, keepdims=True)
            for c in ("drawn", "total")
        )
        return pa.Table.from_batches([_sums_batch(table.column(GROUP).to_numpy()[:1], counts, totals)])

    return add


def bootstrap(groups: Groups, trees: int, rate: float, seed: int) -> DataFrame:
    """GROUP, features, and of each tree's sample the rows (``drawn``) and the label's sum (``total``), as arrays.

    Every row is drawn for every tree; the rows of a vector are dealt over up to
    ``SALTS`` tasks, whose sums are added up.
    """
    label = F.col(groups.label).cast("double")
    rows = groups.cells.select(
        GROUP, MARK, F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / MOST_COPIES).cast("int"))).alias("part"), "copies", label.alias("label")
    ).withColumn("copies", F.least(F.col("copies") - F.col("part") * MOST_COPIES, F.lit(MOST_COPIES)))
    parts = max(8, ceil(groups.rows * trees / DRAWS_A_PART))
    partial = (
        rows.repartition(parts, GROUP, F.pmod(MARK, F.lit(SALTS)))
        .sortWithinPartitions(GROUP, MARK, "part", "label")
        .select(GROUP, MARK, "part", "copies", "label")
        .mapInArrow(_draw_sums(trees, rate, seed), f"{GROUP} bigint, drawn array<double>, total array<double>")
    )
    added = partial.groupBy(GROUP).applyInArrow(_add_up(trees), f"{GROUP} bigint, drawn array<double>, total array<double>")
    return groups.table.select(GROUP, groups.features).join(added, GROUP)
