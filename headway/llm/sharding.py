"""Shards of near-equal size from sampled splitters.

Records get the order (hash of the text, id). A size-weighted sample of that
order gives quantile boundaries; records are range-partitioned by them, ranges
that turn out overfull are divided by boundaries of their own, and the bytes
before each range place its records in a shard. Copies of a text stand side by
side, so a group of copies is cut only where it is larger than a small part of
a shard. Only column expressions are used; the driver sees a bounded sample, one
row per range and one per shard.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.sources.writing import stage

RANGES = 1024  # key ranges aimed at, whatever the input
SAMPLES_PER_RANGE = 8
OVERFULL = 4  # ranges of so many times the mean size are divided again
ROUNDS = 6  # of dividing; each divides what is left by 8 or more
WHOLE_SHARE = 64  # groups of up to a shard's bytes by this are kept whole

_MIN = -(1 << 63)


def _key() -> Column:
    return F.struct("grp", "id", "row")


def _keys(keys: list, kind: str = "array<struct<grp:bigint,id:bigint,row:bigint>>") -> Column:
    """A constant of many keys; folded to one literal before it is used."""
    named = lambda k: [named(x) for x in k] if isinstance(k, list) else dict(zip(("grp", "id", "row"), k))
    return F.from_json(F.lit(json.dumps([named(k) for k in keys])), kind)


def _longs(values: list[int]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _count_up_to(bounds: list[tuple], value: Column) -> Column:
    """How many of the sorted bounds are at or before the value, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    heads = _keys(bounds[::step])
    blocks = _keys(
        [bounds[i : i + step] for i in range(0, len(bounds), step)],
        "array<array<struct<grp:bigint,id:bigint,row:bigint>>>",
    )
    coarse = F.size(F.filter(heads, lambda b: b <= value))
    inside = F.size(F.filter(F.element_at(blocks, coarse), lambda b: b <= value))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def _sample(rows: DataFrame, chance: Column, salt: int) -> list[tuple]:
    """Keys drawn with a chance that grows with the size; the draw depends on the key alone."""
    place = F.pmod(F.xxhash64("grp", "id", "row", F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sorted(tuple(r) for r in rows.filter(place < chance).select("grp", "id", "row").collect())


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's shard (0 to shards-1) and its slot there, by the law of near-equal bytes.

    A null text has no bytes; every row counts one byte more than its text. Null
    and repeated ids and repeated rows are placed like others. An empty table
    gives no rows. Other columns of the input are not read.
    Returns id, size, text_crc32, law, shard, slot, grown_shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("grp"),
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(_MIN)).alias("id"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0

    # Boundaries: quantiles of a size-weighted sample, then of the overfull ranges again.
    drawn = _sample(rows, F.col("size") * F.lit(RANGES * SAMPLES_PER_RANGE / max(total, 1)), 0)
    bounds = sorted(set(drawn[SAMPLES_PER_RANGE - 1 :: SAMPLES_PER_RANGE]))
    sizes: dict[int, tuple[int, int]] = {}
    for salt in range(1, ROUNDS + 1):
        ranged = rows.withColumn("range", _count_up_to(bounds, _key()))
        sizes = {r[0]: (r[1], r[2]) for r in ranged.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).collect()}
        full = [k for k, (size, n) in sizes.items() if size > OVERFULL * total / RANGES and n > 1]
        if not full or salt == ROUNDS:
            break
        more = _sample(
            ranged.filter(F.col("range").isin(full)),
            F.col("size") * F.lit(RANGES * SAMPLES_PER_RANGE * 4 / max(total, 1)), salt,
        )
        bounds = sorted({*bounds, *more[SAMPLES_PER_RANGE - 1 :: SAMPLES_PER_RANGE]})

    # Bytes and rows before each range; within it by a running sum.
    starts, counts, size_before, rows_before = [], [], 0, 0
    for k in range(len(bounds) + 1):
        starts.append(size_before)
        counts.append(rows_before)
        size, n = sizes.get(k, (0, 0))
        size_before, rows_before = size_before + size, rows_before + n
    here = Window.partitionBy("range").orderBy("grp", "id", "row")
    at = lambda values: F.element_at(_longs(values), F.col("range") + 1)
    placed = stage(
        ranged.withColumn("start", at(starts) + F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("rank", at(counts) + F.row_number().over(here) - 1),
        "shard-placed",
    )

    # Where shards meet: at the first row whose middle is past each part of the bytes, moved to the edge of a small group.
    middle = F.col("start") + F.col("size") / 2
    natural = F.least(F.floor(middle / F.lit(max(total, 1) / shards)), F.lit(shards - 1)).cast("int")
    firsts = placed.groupBy(natural.alias("shard")).agg(F.min(_key()).alias("key")).orderBy("shard").collect()
    firsts = [(r["shard"], tuple(r["key"])) for r in firsts]
    groups = {
        r["grp"]: r
        for r in placed.filter(F.col("grp").isin([key[0] for _, key in firsts]))
        .groupBy("grp").agg(F.min("start").alias("start"), F.sum("size").alias("size")).collect()
    } if firsts else {}
    cuts = []
    for k in range(1, shards):
        key = next((key for at_shard, key in firsts if at_shard >= k), None)
        if key is None:
            key = ((1 << 63) - 1,) * 3
        elif (group := groups[key[0]])["size"] <= total / shards / WHOLE_SHARE:
            first_half = k * total / shards - group["start"] <= group["size"] / 2
            key = (key[0], _MIN, _MIN) if first_half or key[0] == (1 << 63) - 1 else (key[0] + 1, _MIN, _MIN)
        cuts.append(key)
    cuts.sort()
    in_shard = placed.withColumn("shard", F.size(F.filter(_keys(cuts), lambda c: c <= _key())))
    begins = {r[0]: r[1] for r in in_shard.groupBy("shard").agg(F.min("rank")).collect()}
    begin = F.element_at(_longs([begins.get(k, 0) for k in range(shards)]), F.col("shard") + 1)
    return in_shard.select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - begin).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
