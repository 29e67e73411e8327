"""Document fingerprints by consistent weighted sampling.

A document is its words with their counts as weights. For each of ``SAMPLES``
places and each word, numbers r and c from a gamma distribution and b, uniform,
are drawn from a hash of the word and the place. With t = floor(ln w / r + b) and
a = c * exp(-r * (t - b + 1)), the place holds (word, t) of the smallest a. Two
documents hold the same at a place with the probability of their generalised
Jaccard similarity, the sum of the smaller weights by that of the larger ones.

A gamma number is -ln(u * v) of two uniform ones, and ln u / ln(u * v) is uniform
and independent of it: so r = -ln(u * v) and b = ln u / ln(u * v) are drawn from
the same two. Then exp(-r * (1 - b)) is v, a is c * v * exp(-r * t), and t is 0
wherever w * v < 1: no logarithm but that of c is needed for most words. A word of
the same weight in both versions of a text is sampled once.

Only column expressions are used. Texts are shuffled once, into runs of
neighbouring ids; words are counted and sampled where the text lies. A sample is
one number, the root of a above and a hash of (word, t) below, so the smallest is
a plain minimum in generated code.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLES, AT_ONCE = 64, 8  # places of a fingerprint; places in one row of minima
RUNS = 1024  # runs of neighbouring ids that texts are shuffled into; each is sorted by itself
NO_ID = -(1 << 63)  # stands for a null id, which comes last
_NONE = (1 << 63) - 1  # no sample: above all
_STEP = float(1 << 28)  # steps that the root of a, below 8, is told apart by


def _uniform(bits: Column, shift: int) -> Column:
    """A number in (0, 1) from 31 bits of a hash."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << 31) - 1)) + F.lit(0.5)) / F.lit(float(1 << 31))


def _sample(place: Column) -> Column:
    """(word, t) of the weight ``w``, whose logarithm is ``log_w``, at a place, as one number to take the minimum of."""
    one, two, word = F.xxhash64("word", place), F.xxhash64(place, F.col("word")), F.col("word")
    u, v = _uniform(one, 32), _uniform(one, 0)
    least = F.log(_uniform(two, 0) * _uniform(two, 32)) * -v  # c * v

    def packed(a: Column, low: Column) -> Column:
        return F.shiftleft(F.floor(F.sqrt(a) * F.lit(_STEP)), 32) + low.bitwiseAND(F.lit((1 << 32) - 1))

    r = -F.log(u * v)
    t = F.floor((F.col("log_w") - F.log(u)) / r)
    # The word is a hash already: t, spread by an odd number, only has to tell its samples apart.
    late = packed(least * F.exp(-r * t), word.bitwiseXOR(t * F.lit(0x9E3779B1)))
    return F.when(F.col("w") * v < 1, packed(least, word)).otherwise(late)


def _runs(docs: DataFrame) -> Column:
    """The run of ``id``: how many of the quantiles are at or before it."""
    shares = [k / RUNS for k in range(1, RUNS)]
    found = docs.agg(F.percentile_approx("id", shares, 10_000)).first()[0] or []
    bounds = sorted(set(found))
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    longs = lambda values, kind: F.from_json(F.lit(json.dumps(values)), kind)
    heads = longs(bounds[::step], "array<bigint>")
    blocks = longs([bounds[i : i + step] for i in range(0, len(bounds), step)], "array<array<bigint>>")
    coarse = F.size(F.filter(heads, lambda b: b <= F.col("id")))
    inside = F.size(F.filter(F.element_at(blocks, coarse), lambda b: b <= F.col("id")))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """run, pos, id, text, next_text and ghost of every row, in descending order of ids.

    Each run of ids gets, behind its last row, a ghost: a copy of the first row of
    the run below it (of the uppermost run, at the end). So the next row always
    lies in the same run. Null ids come last; of equal ids the smaller text first.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    run = _runs(rows)
    rows = rows.withColumn("run", run)
    tops = sorted(rows.groupBy("run").agg(F.max("id").alias("top")).collect(), reverse=True)  # RUNS rows at most
    into = [(tops[(k + 1) % len(tops)]["top"], tops[k]["run"]) for k in range(len(tops))]
    target = docs.sparkSession.createDataFrame(into, "id bigint, target int")
    ghosts = (
        rows.join(F.broadcast(target), "id").groupBy("target").agg(F.min("text").alias("text"), F.first("id").alias("id"))
        .select("id", "text", F.col("target").alias("run"), F.lit(True).alias("ghost"))
    )
    ordered = Window.partitionBy("run").orderBy("ghost", F.desc("id"), "text")
    return rows.withColumn("ghost", F.lit(False)).unionByName(ghosts).select(
        "run", F.row_number().over(ordered).alias("pos"), "id", "text", F.lead("text").over(ordered).alias("next_text"), "ghost"
    )


def sample(versions: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """``keys`` and, for each text column, its fingerprint as an array, of nulls where no word is.

    The rows have to be partitioned by one of the keys: then nothing is shuffled here.
    """
    words = (
        versions.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("v"), F.col(t).alias("t")) for i, t in enumerate(texts)])).alias("x"))
        .select(*keys, F.col("x.v").alias("v"), F.explode(F.split("x.t", r"[\x20\x09-\x0D]+")).alias("word"))
        .select(*keys, F.when(F.col("word") != "", F.col("v")).alias("v"), F.xxhash64("word").alias("word"))
        .groupBy(*keys, "word").agg(*[F.count_if(F.col("v") == i).alias(f"w{i}") for i in range(len(texts))])
    )
    every = [F.col(f"w{i}") for i in range(len(texts))]
    kinds = []
    for i, w in enumerate(every):  # a row for each weight of a word, with a mask over the versions of other weights
        first = ~F.greatest(*every, F.lit(0)).cast("boolean") if i == 0 else F.lit(False)  # a text without words keeps a row
        new = F.lit(True)
        for earlier in every[:i]:
            new = new & (earlier != w)
        masks = [F.when((other == w if j != i else F.lit(True)) & (w > 0), F.lit(0)).otherwise(F.lit(_NONE)).cast("bigint").alias(f"mask{j}") for j, other in enumerate(every)]
        kinds.append(F.struct(F.when(first | ((w > 0) & new), w.cast("double")).alias("w"), *masks))
    rows = (
        words.select(*keys, "word", F.explode(F.array(*kinds)).alias("kind")).filter("kind.w IS NOT NULL")
        .select(*keys, "word", "kind.*", F.log("kind.w").alias("log_w"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // AT_ONCE - 1))).alias("part"))
    )
    drawn = [_sample(F.col("part") * AT_ONCE + k) for k in range(AT_ONCE)]
    versions_of = range(len(texts))
    parts = (
        rows.groupBy(*keys, "part")
        .agg(*[F.min(s.bitwiseOR(F.col(f"mask{i}"))).alias(f"m{i}_{k}") for k, s in enumerate(drawn) for i in versions_of])
        .select(*keys, "part", *[F.array(*[F.nullif(F.col(f"m{i}_{k}"), F.lit(_NONE)) for k in range(AT_ONCE)]).alias(f"m{i}") for i in versions_of])
    )
    return parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", *[f"m{i}" for i in range(len(texts))]))).alias("all")).select(
        *keys, *[F.flatten(F.col(f"all.m{i}")).alias(f"f{i}") for i in range(len(texts))]
    )


def likeness(one: Column, two: Column) -> Column:
    """Share of equal places: 1 for two texts without words, 0 where only one has words."""
    equal = F.aggregate(F.zip_with(one, two, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    empty_one, empty_two = F.coalesce(one[0].isNull(), F.lit(True)), F.coalesce(two[0].isNull(), F.lit(True))
    return F.when(empty_one & empty_two, 1.0).when(empty_one | empty_two, 0.0).otherwise(equal / SAMPLES)


def as_text(fingerprint: Column) -> Column:
    """The samples' hashes as hexadecimal digits; empty without words."""
    digits = F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit((1 << 32) - 1))), 8, "0")))
    return F.when(fingerprint[0].isNull() | fingerprint.isNull(), "").otherwise(F.array_join(digits, ""))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last third replaced by as many first characters of the
    next document in descending order of ids (after the last: the first). Columns:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. A null text is empty; a text without words has the empty
    fingerprint. Null ids come last, repeated ids stand side by side, and every row
    gives one row. Extra columns are not read; an empty table gives no rows.
    """
    third = F.floor(F.char_length("text") / 3).cast("int")
    placed = with_next(docs, id_col, text_col)
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.char_length("text") - third), F.coalesce(F.substring(F.col("next_text"), F.lit(1), third), F.lit(""))
    )
    facts = ["id", "ghost", "n_chars", *[f"sha{k}" for k in range(5)]]
    sha = F.col("sha")
    rows = placed.select("*", edited.alias("edited")).select("*", F.sha2("edited", 256).alias("sha")).select(
        "run", "pos", "id", "ghost", "text", "edited", F.char_length("text").cast("bigint").alias("n_chars"),
        # As numbers: they go through the counting of words as keys.
        *[F.conv(F.substring(sha, 15 * k + 1, 15), 16, 10).cast("bigint").alias(f"sha{k}") for k in range(5)],
    )
    ordered = Window.partitionBy("run").orderBy("pos")
    return (
        sample(rows, ["run", "pos", *facts], ["text", "edited"])
        .withColumn("f_next", F.lead("f0").over(ordered))
        .filter(~F.col("ghost"))
        .select(
            F.when(F.col("id") != NO_ID, F.col("id")).cast(docs.schema[id_col].dataType).alias("doc_id"), "n_chars",
            F.lower(F.concat(*[F.lpad(F.hex(f"sha{k}"), 15 if k < 4 else 4, "0") for k in range(5)])).alias("edited_sha256"),
            as_text(F.col("f0")).alias("fingerprint"), as_text(F.col("f1")).alias("edited_fingerprint"),
            likeness(F.col("f0"), F.col("f1")).alias("near_edited"), likeness(F.col("f0"), F.col("f_next")).alias("near_next"),
        )
    )
