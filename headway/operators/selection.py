"""Some rows or values out of very many, without sorting them: order statistics and samples."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

from headway.sources.writing import discard, scratch_folder, stage

RANGES, PIECES = 1 << 16, 64  # value ranges counted first, and pieces that a range with a wanted rank is cut into


def order_statistics(df: DataFrame, value: str | Column, ranks: Sequence[int]) -> list[float]:
    """The values at some ranks (from 1) of a number column, without sorting the rows.

    Rows are counted into ranges of values, with the least and greatest value of each.
    A rank at the end of its range is found; the other ranges with a wanted rank are
    cut into pieces and their rows counted again, until every rank is. Nothing but
    counts of ranges is shuffled or comes to the driver, and from the second pass on
    only the rows of ranges that hold a wanted rank are looked at. Nulls and NaN have
    no rank.
    """
    spark, v = df.sparkSession, F.col("v")
    rows = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v")).filter(v.isNotNull() & ~F.isnan(v))
    lo, hi, n = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
    wanted = sorted(set(ranks))
    if wanted and not 1 <= wanted[0] <= wanted[-1] <= n:
        raise ValueError(f"ranks reach from 1 to {n}")
    found: dict[int, float] = {}
    folder = scratch_folder(spark, "ranks")
    # Ranges that hold wanted ranks: least and greatest value, rows before it, the ranks.
    now, open_, pieces, at = rows.withColumn("part", F.lit(0)), {0: (lo, hi, 0, wanted)} if wanted else {}, RANGES, 0
    while open_:
        ends = spark.createDataFrame([(k, a, b) for k, (a, b, _, _) in open_.items()], "part int, a double, b double")
        half = F.col("b") / 2 - F.col("a") / 2  # the whole width may be beyond a double
        place = F.when(half > 0, F.least(F.floor((v / 2 - F.col("a") / 2) / half * pieces), F.lit(pieces - 1)))
        cut = now.join(F.broadcast(ends), "part").select("part", F.coalesce(place, (v > F.col("a")).cast("bigint")).alias("piece"), "v")
        counted = defaultdict(list)
        for r in sorted(cut.groupBy("part", "piece").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("v").alias("n")).collect()):
            counted[r["part"]].append(r)
        held: list[tuple] = []
        for part, (_, _, before, own) in open_.items():
            for r in counted[part]:
                first, last = before + 1, before + r["n"]
                inside = [k for k in own if first <= k <= last]
                found |= {k: r["a"] if k == first or r["a"] == r["b"] else r["b"] for k in inside if k in (first, last) or r["a"] == r["b"]}
                if left := [k for k in inside if k not in found]:
                    held.append((part, r["piece"], r["a"], r["b"], before, left))
                before = last
        if held:
            numbers = spark.createDataFrame([(p, q, i) for i, (p, q, *_) in enumerate(held)], "part int, piece bigint, number int")
            kept = cut.join(F.broadcast(numbers), ["part", "piece"]).select(F.col("number").alias("part"), "v")
            now, at = stage(kept, f"{at}", folder=folder), at + 1
        open_, pieces = {i: tuple(rest) for i, (_, _, *rest) in enumerate(held)}, PIECES
    if at:
        discard(spark, folder)
    return [found[r] for r in ranks]


def spread_ranks(n: int, most: int) -> list[int]:
    """As many ranks as there are, or ``most`` of them from the first to the last, evenly spread."""
    if n <= most:
        return list(range(1, n + 1))
    return [1 + i * (n - 1) // (most - 1) for i in range(most)]


def sample_rows(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (all, if there are fewer): those whose keys hash lowest.

    The sample depends on the keys alone, not on how rows are laid out. The rows are
    counted, then only those whose hash is below what such a sample nearly always
    needs are sorted: about as many as are asked for, however many there are. A key
    that is not unique may leave rows with equal keys in any order.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    n = df.count()
    share = (size + 10 * sqrt(size) + 20) / max(n, 1)
    while True:
        lowest = df.filter(place < share) if share < 1 else df
        if share >= 1 or lowest.count() >= size:
            return lowest.withColumn("__digest", digest).orderBy("__digest", key).limit(size).drop("__digest")
        share *= 2
