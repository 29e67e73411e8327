"""Registered queries of the operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.llm import (
    embedding_dedup, fingerprints, html_text, mixing, near_dedup, packing, prefix_trie, quality, quality_rules, sharding, spelling,
    substring_dedup, url_filter,
)

URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
# Labels of unwanted hosts: the list's keys are the corpus's urls on such hosts.
UNWANTED = r"(^|[.-])(bets?|casino|pills|adult|spam|ads)([.-]|$)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, F.col("host").rlike(UNWANTED))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def tokenizer() -> tuple[str, str, str]:
    """The public vocabulary that the queries use, and the same one as ranks."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer())


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


# Domains of the labelled table, and the shares of all tokens they are to have.
TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}


def domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels, domain(), TARGETS).drop("mark")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).drop("n_repeats", "longest_repeat")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_minhash, op3_fingerprints, op4_html_extraction, op5_embeddings, op6_substrings, op7_packing, op8_sharding, op9_quality,
        op10_mixing, op11_spelling, op12_prefix_trie, op13_quality_rules,
    )
}



def _repeated_words(name: str, width: int) -> str:
    """Words under windows of some words that a row holds twice or more."""
    return f"""
        {name}_windows AS (
            SELECT doc, unnest(range(1, n - {width - 2})) AS begins, words FROM split WHERE n > {width}),
        {name}_keys AS (
            SELECT doc, begins, count(*) OVER (PARTITION BY doc, array_to_string(words[begins:begins + {width - 1}], ' ')) AS c FROM {name}_windows),
        {name} AS (
            SELECT doc, count(DISTINCT place) AS n
            FROM (SELECT doc, unnest(range(begins, begins + {width})) AS place FROM {name}_keys WHERE c > 1) GROUP BY doc)"""


ORACLES: dict[str, str] = {
    "op1_url_filter": rf"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN instr(coalesce(url, ''), '://') > 0
                        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
                regexp_matches(host, '{UNWANTED}') AS listed
            FROM split)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
        FROM ruled""",
    # The union of the maximal repeats of some words is that of the repeated windows; a repeat
    # over the longest allowed is a repeated window of one word more.
    "op13_quality_rules": rf"""
        WITH split AS (
            SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, len(words) AS n,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        {_repeated_words("base", quality_rules.WINDOW)},
        {_repeated_words("under", quality_rules.REPEAT)},
        {_repeated_words("long", quality_rules.LONGEST + 1)},
        counted AS (
            SELECT doc_id, split.n AS n_words,
                   CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(base.n, 0) AS n_repeat_words, coalesce(under.n, 0) AS n_covered, coalesce(long.n, 0) AS n_over
            FROM split LEFT JOIN base USING (doc) LEFT JOIN under USING (doc) LEFT JOIN long USING (doc))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
               n_words < {quality_rules.FEWEST} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed,
               NOT (base_failed OR n_covered > {quality_rules.FREE} AND 100 * n_covered > {quality_rules.COVERED} * n_words OR n_over > 0) AS kept
        FROM counted""",
}
