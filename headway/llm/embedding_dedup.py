"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the table's own vectors. Each
vector is described by its nearest pivots in order, and enters the inverted list
of each of them. A vector looks for others in the list of its nearest pivot:
those that share enough pivots with it are candidates, and their cosine is
computed in double precision. Every row is indexed; equal vectors are one class.

A list is worked off in cells of bounded size, so a pivot with very many vectors
is spread over tasks. A cell returns how many links each vector has there and a
forest of links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.components import connected_components
from headway.sources.writing import stage

PIVOTS = (64, 4096)  # fewest and most; between them 4 times the root of the number of vectors
PREFIX = 8  # nearest pivots that describe a vector
SHARED = 2  # pivots that candidates have in common at least
SIDE = 1024  # vectors on each side of a cell
_BLOCK = 2048  # vectors compared with the pivots at once


def _units(vectors: list) -> np.ndarray:
    rows = np.array(vectors, np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # first, so that no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _describe(pivots: np.ndarray, prefix: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                units = _units(part.column("vector").to_pylist())
                near = units @ pivots.T
                k = min(prefix, near.shape[1])
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                # Nearest first; of equally near ones the first pivot.
                order = np.lexsort((best, -np.take_along_axis(near, best, 1)), axis=1)
                best = np.take_along_axis(best, order, 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"), part.column("n"), pa.array([u.tobytes() for u in units], pa.binary()),
                        pa.array(list(best), pa.list_(pa.int32())),
                    ],
                    names=["rep", "n", "unit", "near"],
                )

    return describe


def _cell(threshold: float, shared: int):
    def test(cell: pd.DataFrame) -> pd.DataFrame:
        homes, posted = cell[cell["home"]], cell[~cell["home"]]
        if not len(homes) or not len(posted):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        unit, near, ids, sizes = {}, {}, {}, {}
        for k, side in (("x", homes), ("y", posted)):
            unit[k] = np.array([np.frombuffer(u, np.float64) for u in side["unit"]])
            near[k] = np.array(list(side["near"]), np.int32)
            ids[k], sizes[k] = side["rep"].to_numpy(np.int64), side["n"].to_numpy(np.int64)
        common = np.zeros((len(homes), len(posted)), np.uint8)
        for i in range(near["x"].shape[1]):
            for j in range(near["y"].shape[1]):
                common += near["x"][:, i, None] == near["y"][None, :, j]
        linked = (common >= min(shared, near["x"].shape[1])) & (ids["x"][:, None] != ids["y"])
        linked &= unit["x"] @ unit["y"].T >= threshold
        # y counts the link here only if it does not find x in its own list.
        back = linked & ~(near["y"][None, :, :1] == near["x"][:, None, :]).any(2)
        counts = [(ids["x"], linked @ sizes["y"]), (ids["y"], sizes["x"] @ back)]
        # The lowest id that each vector reaches within the cell.
        most = np.iinfo(np.int64).max
        low_x = ids["x"].copy()
        while True:
            low_y = np.minimum(ids["y"], np.where(linked, low_x[:, None], most).min(0))
            again = np.minimum(low_x, np.where(linked, low_y, most).min(1))
            if (again == low_x).all():
                break
            low_x = again
        parts = [pd.DataFrame({"a": i, "b": i, "n": n}) for i, n in counts]
        parts += [pd.DataFrame({"a": i, "b": low, "n": 0}) for i, low in ((ids["x"], low_x), (ids["y"], low_y))]
        out = pd.concat(parts)
        return out[(out["n"] > 0) | (out["a"] != out["b"])].astype("int64")

    return test


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
    prefix: int = PREFIX, shared: int = SHARED,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Linked are vectors with a cosine of ``threshold`` or more. Vectors that are
    null, empty or zero, hold a null or a number that is not finite, or have another
    length than most link with nothing. n_links counts the other rows linked
    directly, copies included; component_id is the smallest id that links lead to.
    A row with a null id takes no part and is kept. Extra columns are not read; an
    empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))
    ) & F.exists("vector", lambda v: v != 0)
    good = rows.filter(F.coalesce(usable, F.lit(False)))
    lengths = good.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    alone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if lengths is None:
        return alone
    good = good.filter(F.size("vector") == lengths["length"])
    classes = stage(
        good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes"
    )
    size = classes.count()
    wanted = min(PIVOTS[1], max(PIVOTS[0], math.ceil(4 * math.sqrt(size))))
    pivots = _units([
        r["vector"] for r in classes.select("vector", F.xxhash64("vector").alias("place")).orderBy("place", "vector").limit(wanted).collect()
    ])
    index = stage(
        classes.mapInArrow(_describe(pivots, prefix), "rep bigint, n bigint, unit binary, near array<int>"), "vector-index"
    )
    # One row per pivot: how many cells its list takes.
    lists = index.select("rep", F.posexplode("near").alias("place", "pivot"))
    cells = {
        r["pivot"]: (math.ceil(r["homes"] / SIDE), math.ceil(r["n"] / SIDE))
        for r in lists.groupBy("pivot").agg(F.count_if(F.col("place") == 0).alias("homes"), F.count(F.lit(1)).alias("n")).collect()
    }
    across = vectors.sparkSession.createDataFrame(
        [(p, h, n) for p, (h, n) in cells.items() if h], "pivot int, rows int, columns int"
    )
    block = lambda salt, n: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entered = index.select("*", F.posexplode("near").alias("place", "pivot")).join(F.broadcast(across), "pivot")
    sides = entered.filter("place = 0").select(
        "pivot", "rep", "n", "unit", "near", F.lit(True).alias("home"), block(1, "rows").alias("row"), every("columns").alias("column")
    ).unionByName(entered.select(
        "pivot", "rep", "n", "unit", "near", F.lit(False).alias("home"), every("rows").alias("row"), block(2, "columns").alias("column")
    ))
    found = stage(
        sides.groupBy("pivot", "row", "column").applyInPandas(_cell(threshold, shared), "a bigint, b bigint, n bigint"), "vector-links"
    )
    linked = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    joined = connected_components(found.filter("a <> b"))
    placed = stage(
        classes.join(linked, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .filter("n > 1 OR links IS NOT NULL")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component")),
        "vector-placed",
    )
    return (
        rows.join(placed, (rows["vector"] == placed["vector"]) & rows["vec_id"].isNotNull(), "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
