"""Mix documents to target weights of domains that are known only softly.

A labelled table gives some documents a domain. A Bayes classifier over hashed
word beginnings, word ends and the share of distinct words predicts posteriors
p(domain) for every document. Nonnegative rates r then solve a least-squares
problem by projected gradient steps: the expected token totals of the domains,
sum of r * tokens * p, shall be the target shares of all tokens. A step moves r
against p * gradient (scaled by the domains' overlap) and projects it onto r >=
0, so r is a short expression of p and one pass over two numeric columns gives
all sums of a step. Only column expressions are used.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from headway.sources.writing import scratch_folder, stage

BUCKETS = 1 << 16  # hashed features
SAMPLE = 20_000  # labelled documents the classifier is fitted on, about; chosen by a hash of the text
LEAST_WEIGHT = 1.0  # log odds below this say nothing about the domain
LEAST_DEVIATION = 5.0  # standard deviations of chance that two domains' shares have to be apart
FLOOR = 0.003  # added to the share of a domain's documents that have a feature
SPREAD = 8  # how many features the share of distinct words counts as
SHAPE = "\x01"  # first character of the feature that is no word
STEPS, SETTLED = 40, 1e-9  # most gradient steps; change of the squared error that ends them


def _words(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")


def _once(rows: DataFrame, name: str) -> DataFrame:
    """The same rows; what is selected from them does not evaluate the column again."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(name)).alias(name))


def features(rows: DataFrame, kept: list[str], text: Column) -> DataFrame:
    """``kept``, tokens, two hashed features and their weight for each distinct word of every row.

    A word's features are its first four and its last two characters. One more
    feature tells the share of distinct words for the number of words.
    """
    split = _once(rows.select(*kept, _words(text).alias("words")), "words")
    tokens = F.when((F.size("words") == 1) & (F.element_at("words", 1) == ""), 0).otherwise(F.size("words"))
    unique = _once(split.select(*kept, tokens.cast("bigint").alias("tokens"), F.array_distinct("words").alias("words")), "words")
    share = F.least(F.floor(10 * F.size("words") / F.greatest("tokens", F.lit(1))), F.lit(9)).cast("string")
    shape = F.concat(F.lit(SHAPE), F.lpad(F.floor(F.log2(F.col("tokens") + 1)).cast("string"), 2, "0"), share)
    word, shaped = F.col("word"), F.startswith(F.col("word"), F.lit(SHAPE))
    bucket = lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")
    return unique.select(*kept, "tokens", F.explode(F.concat("words", F.array(shape))).alias("word")).select(
        *kept, "tokens", bucket(F.lower(F.substring(word, 1, 4))).alias("begin"),
        F.when(~shaped, bucket(F.concat(F.lit("~"), F.right(word, F.lit(2))))).alias("end"),
        F.when(shaped, float(SPREAD)).otherwise(1.0).alias("weight"),
    )


@dataclass
class Classifier:
    """Log odds of every domain against the first one, by feature; one row in the shared folder."""

    domains: tuple[str, ...]
    odds: dict[str, float]  # of the domains themselves
    folder: str | None

    def scores(self, rows: DataFrame, kept: list[str], text: Column) -> DataFrame:
        """Tokens and posteriors p_<domain> of rows told apart by ``kept``."""
        others = self.domains[1:]
        found = features(rows, kept, text)
        sums = [F.lit(0.0).alias(f"s_{d}") for d in others]
        if self.folder:
            table = rows.sparkSession.read.parquet(self.folder)
            sums = []
            for d in others:
                at = lambda c, odds=table.select(d).scalar(): F.element_at(odds, F.col(c) + 1)
                sums.append(F.sum(F.col("weight") * (at("begin") + F.coalesce(at("end"), F.lit(0.0)))).alias(f"s_{d}"))
        summed = found.groupBy(*kept, "tokens").agg(*sums)
        odds = [F.exp(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), self.odds[d] + F.col(f"s_{d}")))) for d in others]
        total = F.lit(1.0)
        for o in odds:
            total = total + o
        return summed.select(
            *kept, "tokens", (1 / total).alias(f"p_{self.domains[0]}"), *[(o / total).alias(f"p_{d}") for d, o in zip(others, odds)]
        )


def fit(docs: DataFrame, labels: DataFrame, domain: Column, domains: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Count features by domain over a bounded sample of labelled documents.

    ``domain`` is a column of ``labels``; a null one says nothing, and an id with
    two domains counts for both. Without labels every domain is as likely.
    """
    known = labels.select(F.col(id_col).alias("id"), domain.alias("domain")).filter(F.col("id").isNotNull() & F.col("domain").isin(*domains)).distinct()
    n = known.count()
    texts = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .join(known, "id")
        .filter(F.pmod(F.xxhash64("text", "id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))))
        .withColumn("row", F.monotonically_increasing_id())
    )
    found = features(texts, ["row", "domain"], F.col("text")).select(
        "row", "domain", F.explode(F.array(F.lit(-1), "begin", "end")).alias("feature")
    )
    counted = stage(
        found.filter(F.col("feature").isNotNull()).distinct().groupBy("feature").agg(*[F.count_if(F.col("domain") == d).alias(d) for d in domains]),
        "mix-counts",
    )
    totals = counted.filter("feature = -1").first()  # documents of each domain
    sizes = {d: (totals[d] if totals else 0) for d in domains}
    odds = {d: math.log((sizes[d] + 1) / (sizes[domains[0]] + 1)) for d in domains}
    if not totals:
        return Classifier(domains, odds, None)

    def share(d: str) -> Column:
        return F.least(F.col(d) / max(sizes[d], 1), F.lit(1.0)) * (1 - 2 * FLOOR) + FLOOR

    def present(d: str) -> Column:
        return F.log(share(d)) - F.log(share(domains[0]))

    def absent(d: str) -> Column:
        return F.log(1 - share(d)) - F.log(1 - share(domains[0]))

    def counts(d: str) -> Column:
        n, m = max(sizes[d], 1), max(sizes[domains[0]], 1)
        both = F.least((F.col(d) + F.col(domains[0])) / (n + m), F.lit(1.0))
        chance = F.sqrt(both * (1 - both) * (1 / n + 1 / m))
        apart = F.abs(F.col(d) / n - F.col(domains[0]) / m) >= LEAST_DEVIATION * chance
        return (F.abs(present(d)) >= LEAST_WEIGHT) & apart

    def weight(d: str) -> Column:
        return F.when(counts(d), present(d) - absent(d)).otherwise(0.0)

    without = counted.filter("feature >= 0").agg(*[F.sum(F.when(counts(d), absent(d))) for d in domains[1:]]).first()
    for d, value in zip(domains[1:], without):
        odds[d] += value or 0.0  # of a document with none of the features

    spark = docs.sparkSession
    blank = spark.range(BUCKETS).select(F.col("id").cast("int").alias("feature"), *[F.lit(0).cast("bigint").alias(d) for d in domains])
    cells = (
        counted.filter("feature >= 0").unionByName(blank).groupBy("feature")
        .agg(*[F.sum(d).alias(d) for d in domains]).select("feature", *[weight(d).alias(d) for d in domains[1:]])
        .agg(F.array_sort(F.collect_list(F.struct("feature", *domains[1:]))).alias("cells"))  # BUCKETS of them
    )
    folder = scratch_folder(spark, "mix-weights")
    cells.select(*[F.col(f"cells.{d}").alias(d) for d in domains[1:]]).write.parquet(folder)
    return Classifier(domains, odds, folder)


def _sums(table: DataFrame, rate: Column, domains: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain, and how much domains overlap where the rate is above 0."""
    p = [F.col(f"p_{d}") for d in domains]
    tokens, k = F.col("tokens").cast("double"), len(domains)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = table.select(tokens.alias("t"), rate.alias("r"), *p).agg(
        *[F.sum(F.col("t") * F.col("r") * p[i]) for i in range(k)],
        *[F.sum(F.when(F.col("r") > 0, F.col("t") * p[i] * p[j]).otherwise(0.0)) for i, j in pairs],
    ).first()
    overlap = np.zeros((k, k))
    for value, (i, j) in zip(row[k:], pairs):
        overlap[i, j] = overlap[j, i] = value or 0.0
    return np.array([v or 0.0 for v in row[:k]]), overlap


def rates(table: DataFrame, targets: Mapping[str, float]) -> Column:
    """The rate of each row of ``tokens`` and p_<domain>, by projected gradient steps from rate 1."""
    domains = tuple(targets)
    share = np.array([targets[d] for d in domains]) / sum(targets.values())
    rate = F.lit(1.0)
    here, overlap = _sums(table, rate, domains)
    total = here.sum()
    if total <= 0:
        return rate
    error, pace = here / total - share, 1.0
    for _ in range(STEPS):
        step = pace * np.linalg.lstsq(overlap / total + 1e-9 * np.eye(len(domains)), error, rcond=None)[0]
        moved = rate
        for d, s in zip(domains, step):
            moved = moved - F.lit(float(s)) * F.col(f"p_{d}")
        moved = F.greatest(F.lit(0.0), moved)
        there, overlap_there = _sums(table, moved, domains)
        next_error = there / total - share
        better = error @ error - next_error @ next_error
        if better < 0:  # too far: take a shorter step from the same place
            pace /= 2
            continue
        rate, error, overlap = moved, next_error, overlap_there
        if better < SETTLED:
            break
    return rate


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of id and text: rows that have both in common are treated alike."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def mix(
    docs: DataFrame, labels: DataFrame, domain: Column, targets: Mapping[str, float],
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, mark, tokens, posteriors, rate and copies of every row.

    Tokens are words split at ASCII white space; a null or empty text has none and
    its rate moves no total. ``copies`` is the rate, rounded up or down by a hash of
    the id and the text, so that totals hold on the whole. Ids may be null or
    repeated: each row is judged for itself; ``mark`` is the hash of its id and text. An empty table gives no rows.
    """
    model = fit(docs, labels, domain, tuple(targets), id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        mark(docs, id_col, text_col).alias("mark"), text.alias("text"),
    )
    table = stage(model.scores(rows, ["row", "doc_id", "mark"], F.col("text")), "mix-posteriors")
    rate = rates(table, targets)
    place = F.pmod(F.col("mark"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return table.select("doc_id", "mark", "tokens", *[f"p_{d}" for d in targets], rate.alias("rate")).withColumn(
        "copies", (F.floor("rate") + (place < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    )
