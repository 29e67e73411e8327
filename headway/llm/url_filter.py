"""Block or allow urls: rules on host and path, and an exact list in a Bloom cascade.

The cascade encodes a list of keys over the complete universe of keys of the
corpus. Level 1 holds the listed keys, level 2 those keys outside the list that
level 1 lets through, level 3 the listed keys that level 2 lets through, and so
on until none is left. A key's first level without a hit decides: odd levels
mean not listed, even ones listed. That is exact for every key of the universe,
and rows are judged by looking bits up, without a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from headway.sources.writing import scratch_folder, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST_RATE = 1 / 16  # false positives of the first level, for each listed key
LATER_RATE = 1 / 256  # false positives of the others, for each key looked up
MOST_BITS = 1 << 31  # of one level: 256 MB; a longer list is refused, not cut
MOST_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    first = F.pmod(F.xxhash64(F.lit(2 * level), key), F.lit(bits))
    step = F.pmod(F.xxhash64(F.lit(2 * level + 1), key), F.lit(bits))
    return [F.pmod(first + F.lit(i) * step, F.lit(bits)) for i in range(hashes)]


class BloomCascade:
    """Exact membership in a list, for all keys of a universe; see the module."""

    def __init__(self, universe: DataFrame):
        """``universe``: distinct ``key`` string and ``listed`` boolean."""
        self.spark = universe.sparkSession
        self.levels: list[tuple[int, int]] = []  # bits and hashes of each
        self.folder = scratch_folder(self.spark, "cascade")
        known = stage(universe, "cascade-keys")
        n = {r[0]: r[1] for r in known.groupBy("listed").count().collect()}
        listed, others = n.get(True, 0), n.get(False, 0)
        wanted, rest = known.filter("listed"), known.filter(~F.col("listed"))
        size, rate = listed, min(0.5, max(1e-6, listed / max(others, 1) * FIRST_RATE))
        while size:
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("two keys have the same hashes at every level")
            self._add(wanted, size, rate)
            # Those of the other side that hit this level (and so all before it) are encoded next.
            wanted, rest, rate = rest.filter(self._hit(len(self.levels))), wanted, LATER_RATE
            size = wanted.count()

    def _add(self, keys: DataFrame, size: int, rate: float) -> None:
        hashes = max(1, math.ceil(math.log2(1 / rate)))
        bits = 64 * math.ceil(size * 1.4427 * max(1.0, math.log2(1 / rate)) / 64 + 1)
        if bits > MOST_BITS:
            raise ValueError(f"a level of {bits} bits is over the bound of {MOST_BITS}")
        level = len(self.levels) + 1
        spots = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("spot"))
        words = spots.select(
            F.expr("spot div 64").alias("place"), F.expr("shiftleft(1L, cast(spot % 64 as int))").alias("word")
        )
        blank = self.spark.range(bits // 64).select(F.col("id").alias("place"), F.lit(0).cast("bigint").alias("word"))
        filled = words.unionByName(blank).groupBy("place").agg(F.bit_or("word").alias("word"))
        # One row: the level's bits, at most MOST_BITS of them.
        filled.agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("cells")).select(
            F.transform("cells", lambda c: c["word"]).alias("words")
        ).write.parquet(f"{self.folder}/{level}")
        self.levels.append((bits, hashes))

    def _hit(self, level: int, key: Column | None = None) -> Column:
        key = F.col("key") if key is None else key
        bits, hashes = self.levels[level - 1]
        words = self.spark.read.parquet(f"{self.folder}/{level}").scalar()
        hit = F.lit(True)
        for spot in _positions(key, level, bits, hashes):
            word = F.element_at(words, (F.shiftright(spot, 6) + 1).cast("int"))
            hit = hit & (F.getbit(word, (spot % 64).cast("int")) == 1)
        return hit

    def listed(self, key: Column) -> Column:
        """Is the key in the list? Keys outside the universe may be judged wrongly."""
        answer = F.lit(len(self.levels) % 2 == 1)  # hits everywhere: in the last level's set
        for level in range(len(self.levels), 0, -1):
            answer = F.when(self._hit(level, key), answer).otherwise(level % 2 == 0)
        return answer


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    is_listed: Column,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Host, path, fitting rule and verdict of every url.

    ``is_listed`` says of ``host`` and ``path`` whether the list holds the key; it
    is evaluated once per distinct key, and the rows are judged by the cascade.
    A rule's verdict goes before the list's; without either a url is allowed. A
    null url and one without ``://`` have an empty host and path. Ids may be null
    or repeated: every row is judged for itself, and extra columns are not read.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    key = F.concat(F.col("host"), F.col("path"))
    universe = (
        parts.select("host", "path").distinct()
        .select(key.alias("key"), F.coalesce(is_listed, F.lit(False)).alias("listed"))
        .groupBy("key").agg(F.max("listed").alias("listed"))
    )
    cascade = BloomCascade(universe)
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    listed = cascade.listed(key)
    return parts.select(
        "page_id", "host", "path", name.alias("rule"), listed.alias("listed")
    ).select(
        "page_id", "host", "path", "rule",
        F.coalesce(
            matching_rule(F.col("host"), F.col("path"), rules)[1], F.when(F.col("listed"), "block").otherwise("allow")
        ).alias("verdict"),
        "listed",
    )
