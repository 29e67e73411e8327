"""The operators against plain versions, and on awkward tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import (
    batches, components, embedding_dedup, fingerprints, html_text, mixing, near_dedup, packing, quality, queries, sharding,
    substring_dedup, url_filter,
)
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, score double, mark bigint, __spans string"
WORDS = "the of and to in is that it was for on are as with his they at be this from".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[a]}{b}" for a, b in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 50, n)))


def awkward() -> list[tuple]:
    """Null and empty texts, null and repeated ids, copies, near copies, a very long text, odd white space."""
    base = prose(1, 120)
    passage = prose(2, 60)
    texts = [
        None, "", "   \n\t ", "one", "Two words", base, base, base.upper(), base.replace("the", "The", 3),
        base + " end", base[:-20], prose(3, 50) + "\n" + passage + "\n" + prose(4, 50), prose(5, 40) + "\n" + passage,
        "é😀" * 300, "é😀" * 300 + "x", "a" * 1000, prose(6, 20_000), "In In In " * 200, "\x00 null byte", "don't  stop   now \n\n x",
    ]
    rows = [(i, t, "en", 1.0, 7, "s") for i, t in enumerate(texts)]
    rows += [(None, base, None, None, None, None), (None, None, None, None, None, None), (5, base, "en", 1.0, 7, "s"), (3, "another", "", 0.0, 1, "")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def plain(spark):
    """Unique ids: what the plain versions are compared on."""
    rows = [r for r in awkward()[:20]] + [(100 + i, prose(50 + i % 7, 90) + " " + prose(90 + i, 8), "en", 0.0, 0, "") for i in range(30)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- url filter

RULES = queries.URL_RULES


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("http://A.Example.NET/en/x?q=/de/", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/fr/", "example.net", "/fr/", "net/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("http://example.com/de/1#t", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://x.org/fr/y", "x.org", "/fr/y", "org/fr/", "allow"),
    ("http://net", "net", "", None, "allow"),
    ("http://x.net?a=/b", "x.net", "", None, "allow"),
    ("ftp://a://b/c", "a:", "//b/c", None, "allow"),
    ("http://free-bets.com/", "free-bets.com", "/", None, "block"),
])
def test_url(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x"), (None, "http://other.com/", "y")], "page_id bigint, url string, key string")
    found = {r["page_id"]: r for r in url_filter.filter_urls(pages, RULES, F.col("host").rlike(queries.UNWANTED)).collect()}
    assert tuple(found[1])[1:5] == (host, path, rule, verdict)
    assert found[None]["verdict"] == "allow"


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.BloomCascade(universe)
    assert len(cascade.levels) > 1
    assert universe.filter(cascade.listed(F.col("key")) != F.col("listed")).count() == 0


@pytest.mark.parametrize("listed", [True, False])
def test_cascade_of_one_side(spark, listed):
    universe = spark.range(50).select(F.col("id").cast("string").alias("key"), F.lit(listed).alias("listed"))
    cascade = url_filter.BloomCascade(universe)
    assert universe.filter(cascade.listed(F.col("key")) != F.col("listed")).count() == 0


def test_url_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.filter_urls(pages, RULES, F.lit(True)).collect() == []


# --- near duplicates

def test_near_duplicates(plain):
    df, rows = plain
    for words, percent in ((4, 80), (5, 80)):
        want = brute.near_duplicates(rows, words, percent)
        got = near_dedup.near_duplicates(df, words, percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_in_cells(spark, monkeypatch):
    """A chain of edits: neighbours are alike, the ends are not; cells are made tiny."""
    monkeypatch.setattr(near_dedup, "LEFT", 3)
    monkeypatch.setattr(near_dedup, "RIGHT", 5)
    words, rows = prose(9, 100).split(), []
    for i in range(40):
        words = words[:]
        for j in range(3):
            words[(i * 7 + j * 31) % 100] = f"new{i}x{j}"
        rows.append((i, " ".join(words)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_duplicates(rows, 4, 80)


def test_near_duplicates_awkward(docs, empty):
    got = near_dedup.near_duplicates(docs, 5).collect()
    assert len(got) == len(awkward())
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert near_dedup.near_duplicates(empty).collect() == []


def test_near_duplicates_sends_small_batches(spark, monkeypatch):
    """Texts and sets go to Python a few at a time, and the session's own limit comes back."""
    def bounded(make):
        def made(*args):
            def work(rows, real=make(*args)):
                def each():
                    for batch in rows:
                        assert batch.nbytes < 100_000
                        yield batch
                return real(each())
            return work
        return made

    monkeypatch.setattr(batches, "BYTES", 1 << 15)
    for name in ("_sign", "_sets", "_confirmed", "_cells"):
        monkeypatch.setattr(near_dedup, name, bounded(getattr(near_dedup, name)))
    rows = [(k, prose(k // 2, 120) + " end" * (k % 2)) for k in range(300)]
    before = spark.conf.get(batches.SETTING)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), 4, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k - k % 2 for k in range(300)}
    assert spark.conf.get(batches.SETTING) == before


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_ids_with_several_texts(spark, monkeypatch, sent):
    """Links of a text that is a copy elsewhere are not lost, rows are not multiplied, ids hold their rows together."""
    monkeypatch.setattr(near_dedup, "SENT_NODES", sent)
    a, c, d = prose(11, 100), prose(12, 80), prose(13, 80)
    for rows in (
        [(1, a), (1, prose(14, 90)), (0, prose(14, 90)), (5, a + " end")],
        [(10, c), (10, d), (8, c), (9, d)],
        [(4, ""), (4, a), (3, None), (2, a), (None, a), (2, a), (7, a + " x"), (7, "")],
        [(r[0], r[1]) for r in awkward() if len(r[1] or "") < 5000],
    ):
        got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 4, 80).collect()
        assert sorted(map(repr, ((r[0], r[1], r[2]) for r in got))) == sorted(map(repr, brute.near_rows(rows, 4, 80)))


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1064)] + [(2000, i) for i in range(2001, 2100)]
    want = brute.components({n for e in links for n in e}, links)
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(want) - set(got) == {a for a, b in links if a == b} - set(got)


# --- fingerprints

def test_fingerprints(plain):
    df, rows = plain
    ordered = sorted(rows, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(df).collect()}
    weights = lambda t: Counter(brute.WORD.findall(t))
    jaccard = lambda a, b: sum((a & b).values()) / max(1, sum((a | b).values()))
    off, seen = [], {}
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = got[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        if weights(text) and weights(edited):
            off.append(row["near_edited"] - jaccard(weights(text), weights(edited)))
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.1


def test_fingerprints_awkward(docs, empty, spark):
    assert fingerprints.fingerprint_edits(docs).count() == len(awkward())
    assert fingerprints.fingerprint_edits(empty).collect() == []
    row = fingerprints.fingerprint_edits(spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")).first()
    assert row["near_next"] == 1.0


# --- html

@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>a <b", "a"), ('<a href="x>y">q</a> text', "q text"),
    ("<script>if (a</b) x</script><p>one&nbsp;two\n three<p>four", "one two three four"),
    ('<nav>menu</nav><div class="sidebar">s</div><article><h1>T</h1><p>body text here</p></article><footer>f</footer>', "T body text here"),
    ('<div id="comments"><p>c</p></div><main><p>Hello <i>w</i>orld</p></main><form>x</form><!-- no --><div hidden>h</div>', "Hello world"),
    ("<ul><li>a<li>b</ul>", "a b"), ("<br/>x<br>y", "x y"),
])
def test_html(html, text):
    assert html_text.main_text(html) == text


WORDS = "alpha beta gamma delta " * 10


@pytest.mark.parametrize("html", [
    f'<div class="content has-sidebar"><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p></div><footer>some foot</footer>',
    f'<div id="page" class="no-sidebar"><nav><a href=x>m</a></nav><div class="sidebar">side</div><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p></div>',
    f'<aside><h1>T</h1><p>{WORDS}</p><p>{WORDS}</p><div class="ad">buy</div></aside><p class="ads">buy this</p>',
])
def test_html_hints_never_take_most_of_the_page(html):
    assert html_text.main_text(html) == " ".join(f"T {WORDS} {WORDS}".split())


def test_html_density_without_hints():
    menu = "<ul>" + "".join(f"<li><a href=x>entry {i}</a>" for i in range(9)) + "</ul>"
    page = f"<body><div>{menu}</div><div>sold here</div><div><h1>T</h1><p>{WORDS}<p>{WORDS}<p>{WORDS}</div><div>foot</div>"
    assert html_text.main_text(page, hints=False) == " ".join(f"T {WORDS * 3}".split())


def test_html_equals_the_article_of_each_page(spark):
    plain = re.compile(r"<article.*?</article>", re.S)
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect() if r["html"]]
    marked = [(h, html_text.main_text(m[0], hints=False)) for h in pages if (m := plain.search(h))]
    assert len(marked) > 100
    assert [html_text.main_text(h) for h, _ in marked] == [a for _, a in marked]
    alone = sum(html_text.main_text(h, hints=False) == a for h, a in marked)
    assert alone >= 0.9 * len(marked)


def test_html_empty_table_and_clashing_names(spark):
    kinds = "page_id bigint, url string, html string, text string, n_chars string"
    assert html_text.extract_text(spark.createDataFrame([], kinds)).collect() == []
    long = "<p>" + "word " * 200_000 + "</p>"
    got = html_text.extract_text(spark.createDataFrame([(1, "u", long, "x", "y")] * 2, kinds)).collect()
    assert [r["n_chars"] for r in got] == [999_999, 999_999]


def test_html_table(spark):
    rows = [(1, "u", "<p>a</p>", "t"), (None, None, None, None), (1, "u", "<div>" * 3000 + "deep", "t")]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("a", 1), ("deep", 4)]


# --- embeddings

def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    vectors = [list(map(float, centres[i % 40] + rng.standard_normal(16) * 0.12)) for i in range(400)] + [list(map(float, centres[0]))] * 5
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)] + [(None, vectors[0], 1)]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")).collect()}
    assert len(got) == len(rows)
    units = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    found = np.array([got[i]["n_links"] for i in range(len(vectors))])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.9 * linked.sum()
    want = brute.components(range(len(vectors)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked))])
    assert sum(got[i]["component_id"] == c for i, c in want.items()) >= 0.97 * len(want)
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["kept"] for i in range(len(odd)))


def test_embeddings_none(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


# --- substrings

@pytest.mark.parametrize("most", [512, 5, 1])
def test_substrings(plain, monkeypatch, most):
    """Different records are told apart by sorting alone, by halving first, by halving alone."""
    monkeypatch.setattr(substring_dedup, "SORTED", most)
    df, rows = plain
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.remove_repeats(df).collect()}
    want = {i: (a, b, c, hashlib.sha256(d).hexdigest()) for i, a, b, c, d in brute.remove_repeats(rows)}
    assert got == want
    assert any(b for _, b, _, _ in want.values())


@pytest.mark.parametrize("most", [20, 1])
def test_substrings_of_a_hot_line(spark, monkeypatch, most):
    """A line in very many texts, whose surroundings agree for none, few or many bytes."""
    monkeypatch.setattr(substring_dedup, "SORTED", most)
    line = "".join(chr(97 + (i * i * 7) % 25) for i in range(230))
    rows = [(i, f"{prose(i, 9)}{'before it, ' * (i % 3)}{line}{' and behind' * (i % 2)} {prose(i // 4, 12)}") for i in range(240)]
    made = []
    halved = substring_dedup._halved
    monkeypatch.setattr(substring_dedup, "_halved", lambda df: made.append(halved(df)) or made[-1])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {i: (a, b, c, hashlib.sha256(d).hexdigest()) for i, a, b, c, d in brute.remove_repeats(rows)}
    assert made and all(m.count() <= 8 * len(rows) for m in made)  # rows of slices, not of windows


def said_over(n: int) -> list[tuple]:
    """Texts that say some bytes over and over, a different number of times, after words of their own."""
    said = ["a", "ab", "one two. ", prose(7, 6) + " ", prose(8, 18)[:151], prose(9, 40)[:180], "é😀 "]
    return [(i, f"{prose(500 + i, 12)} {said[i % len(said)] * (1500 // len(said[i % len(said)]) + i % 5)}{prose(600 + i, i % 9)}") for i in range(n)]


@pytest.mark.parametrize("most, piece", [(512, 1 << 19), (512, 300), (1, 1 << 19)])
def test_substrings_of_bytes_said_over_and_over(spark, monkeypatch, most, piece):
    """Runs of equal records are one row each, in what is shuffled and in the joins, and remove what they did."""
    monkeypatch.setattr(substring_dedup, "SORTED", most)
    monkeypatch.setattr(substring_dedup, "PIECE", piece)
    staged, stage = [], substring_dedup.stage
    monkeypatch.setattr(substring_dedup, "stage", lambda df, name: staged.append((name, stage(df, name))) or staged[-1][1])
    rows = said_over(42)
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: (a, b, c, hashlib.sha256(d).hexdigest()) for i, a, b, c, d in brute.remove_repeats(rows)}
    if piece > 300:
        met = dict(staged)["string-records"]
        assert met.count() <= 40 * len(rows) < met.agg(F.sum("times")).first()[0] / 4


@pytest.mark.parametrize("period", [1, 2, 9, 75, 150, 151, 152, 300])
def test_records_are_no_more_for_periodic_texts(period):
    """All windows are in one run, in order, and a run is no finer than records of other text."""
    rng = np.random.default_rng(period)
    data = np.concatenate((rng.integers(0, 256, 500), np.resize(rng.integers(0, 256, period), 9000), rng.integers(0, 256, 500))).astype(np.uint8)
    (mh, rh, start, n, off, times), = substring_dedup.records(data)
    assert len(start) <= 300 and (off >= 0).all() and (times >= 1).all()
    assert start.tolist() == np.concatenate(([0], np.cumsum(n * times)[:-1])).tolist()
    assert (n * times).sum() == len(data) - 199
    for s, c, o, t in zip(start, n, off, times):  # each record of a run: the same bytes, the anchor at the same place
        pieces = {data[s + i * c : s + i * c + c + 199].tobytes() for i in range(t)}
        assert len(pieces) == 1 and c <= o + 1


def test_substrings_across_pieces(plain, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 300)
    df, rows = plain
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {i: b for i, a, b, c, d in brute.remove_repeats(rows)}


def test_substrings_awkward(docs, empty):
    want = Counter((i, b) for i, a, b, c, d in brute.remove_repeats([(r[0], r[1]) for r in awkward()]))
    assert Counter((r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs).collect()) == want
    kept = substring_dedup.remove_repeats(docs, with_text=True)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < len(awkward())
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_suffix_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    starts, group = rng.permutation(2500)[:400], np.sort(rng.integers(0, 9, 400))
    order = substring_dedup.suffix_sort(data, substring_dedup._sums(data), starts, group, 200)
    keys = [(group[i], data[starts[i] : starts[i] + 200].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))


# --- packing

def check_pieces(rows, pieces, coder):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, text in rows:
        ids, at = coder.encode(text or "", add_special_tokens=False).ids + [0], 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(sum(n for _, n in held) < 1024 for held in by_sequence.values()) <= 1


def test_packing(plain):
    df, rows = plain
    tokenizer = queries.tokenizer()
    check_pieces(rows, packing.pack(df, tokenizer).collect(), packing.WordCoder(tokenizer[0]).whole)


def test_packing_awkward(docs, empty):
    pieces = packing.pack(docs, queries.tokenizer(), with_ids=True)
    assert pieces.filter("start = 0").count() == len(awkward())
    assert pieces.filter(F.size("ids") != F.col("length")).count() == 0
    assert packing.pack(empty, queries.tokenizer()).collect() == []


@pytest.mark.parametrize("text", [
    "", " ", "  a", "a ", "a  b", "a \n b\n", "\n\nx y", "don't  stop \t tab", "a\x1cb \x1c c", "é　 b  ", "x<|endoftext|> hi",
    "a   b    c", "\u00a0 x \u00a0", "😀 😀  z",
])
def test_token_ids(text):
    path, ranks, pattern = queries.tokenizer()
    for coder in (packing.WordCoder(path, ranks, pattern), packing.WordCoder(path)):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.whole.encode(text, add_special_tokens=False).ids


# --- sharding

def test_sharding(spark):
    rows = [(i, prose(i, int(5 + (i * 37) % 90))) for i in range(3000)] + [(5000 + i, "the hot text") for i in range(1500)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(16))
    sizes = [sum(r["size"] for r in held) for held in by.values()]
    assert max(sizes) < 1.05 * sum(sizes) / 16
    assert all(sorted(r["slot"] for r in held) == list(range(len(held))) for held in by.values())


def test_sharding_awkward(docs, empty):
    got = sharding.shard(docs).collect()
    assert len(got) == len(awkward()) and all(r["size"] >= 1 for r in got)
    assert sharding.shard(empty).collect() == []


# --- quality

def test_quality(spark, docs, empty):
    good = [(i, prose(i, 80), 1) for i in range(200)]
    bad = [(1000 + i, prose(i, 60).replace(" ", "!! ").upper(), 0) for i in range(100)] + [(2000 + i, "In In In zu zu zu " * 20, 0) for i in range(3)]
    table = spark.createDataFrame([r[:2] for r in good + bad] + [(9999, ""), (9998, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad] + [(None, 1), (0, 1), (77777, 0), (1, None)], "doc_id bigint, quality int")
    model = quality.fit(table, labels)
    held = {r["doc_id"] for r in table.filter(quality.held_out()).collect()}
    assert held == {i for i in [r[0] for r in good + bad] + [9999, 9998] if zlib.crc32(str(i).encode()) % 5 == 0}
    score = {r["doc_id"]: r["score"] for r in quality.score(table, model).collect()}
    want = {i: q for i, _, q in good + bad}
    assert np.mean([(score[i] >= 0.3) == bool(q) for i, q in want.items() if i in held]) > 0.95
    assert score[9999] == score[9998] == model.prior and all(0 <= s <= 1 for s in score.values())
    assert quality.score(docs, model).count() == len(awkward())
    assert quality.score(docs, model, keep_as="__score").columns == [*docs.columns, "__score"]
    assert quality.score(empty, model).collect() == []


def test_quality_without_labels(docs, spark):
    model = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}


# --- mixing

def test_mixing(spark):
    clean = [(i, prose(i, 60), 1, 0) for i in range(400)]
    toxic = [(1000 + i, prose(i, 30) + " scumbag idiotic " + prose(i + 1, 20), 1, 1) for i in range(150)]
    low = [(2000 + i, prose(i, 60).upper().replace(" ", "!! "), 0, 0) for i in range(100)]
    rows = clean + toxic + low
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows if r[0] % 2], "doc_id bigint, quality int, toxic int")
    got = mixing.mix(table, labels, queries.domain(), queries.TARGETS).collect()
    assert len(got) == len(rows)
    total = sum(r["tokens"] for r in got)
    assert total == sum(len(r[1].split()) for r in rows)
    for d, share in queries.TARGETS.items():
        assert abs(sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in got) / total - share) < 0.002
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert np.mean([by[i]["p_toxic"] > 0.5 for i, *_ in toxic]) > 0.95 and np.mean([by[i]["p_clean"] > 0.5 for i, *_ in clean]) > 0.95


def test_mixing_awkward(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (None, 1, 0), (6, None, None)], "doc_id bigint, quality int, toxic int")
    assert mixing.mix(docs, labels, queries.domain(), queries.TARGETS).count() == len(awkward())
    assert mixing.mix(docs, labels.limit(0), queries.domain(), queries.TARGETS).count() == len(awkward())
    assert mixing.mix(empty, labels, queries.domain(), queries.TARGETS).collect() == []


def test_quality_collects_no_copies(spark, monkeypatch):
    """Copies of a labelled text, with one id and with many, come to the driver once."""
    monkeypatch.setattr(quality, "SAMPLE", 20)
    rows = [(i if i % 2 else 1, "the same text in very many rows", 1) for i in range(4000)] + [(10_001 + i, prose(i, 30), i % 2) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame(sorted({(r[0], r[2]) for r in rows}), "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit_arrays", lambda counts, found: seen.append((counts.shape, found.tolist())))
    quality.fit(docs, labels)
    assert seen[0][0] == (40, quality.FEATURES + 1) and sorted(seen[0][1]) == [0] * 20 + [1] * 20


def test_substrings_of_null_ids(spark):
    """Spans of one text do not touch another, whatever stands for their missing ids."""
    passage = "".join(chr(97 + (i * i) % 23) for i in range(300))
    rows = [(None, passage + prose(1, 60)), (None, prose(2, 60) + passage), (None, prose(3, 80)), (None, ""), (None, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = brute.remove_repeats(rows)
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(
        (n, removed, runs, hashlib.sha256(rest).hexdigest()) for _, n, removed, runs, rest in want
    )
