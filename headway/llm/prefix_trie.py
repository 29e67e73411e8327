"""A z-fast trie of conversations: what their prefixes share, node by node.

A conversation is a string of turns, and a prefix of it is known by a 128-bit hash:
the exclusive or of a hash of each place and turn, which is summed up in slices so
that a conversation of any length is spread over tasks. Equal conversations are one
string, named by its smallest id.

The compacted trie is a table of nodes: the hash of the extent, the depths at which
its edge begins and ends, and a witness, some string that runs along it. A node is
found under its handle, the prefix of its extent whose depth is two-fattest (has the
most trailing zeros) on its edge. Strings come in batches, each several times as
large as the one before. Fat binary search finds a string's exit node by one look-up
of a handle per bit of its length, all strings of the batch at once, and a second
binary search finds the depth at which it leaves that node's edge. What is new below
is grouped by prefix, edges are split where strings leave them, and nodes that have
one child and are no string's end are compacted away: among nodes with the same
smallest string, which lie on one path, each hangs on the one before.

Sums over subtrees are taken by doubling: in each round a node adds what the nodes
2^k below it have gathered, and then looks 2^(k+1) up. At the end edges are expanded
to one row for each prefix. All tables are written in the shared folder, and nothing
but counts reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.operators.ordering import global_row_number
from headway.sources.writing import stage

SLICE = 4096  # turns whose hashes are summed in one group
BATCHES = (1, 8, 64)  # of 64 parts of the strings, those up to here are in the trie after each batch
CHUNK = 1 << 16  # characters of ids that are joined before they are hashed

_WORDS = r"[^\x20\x09-\x0D]+"
KEY = ["k1", "k2"]


def ranked_turns(turns: DataFrame) -> DataFrame:
    """conv_id, at (from 1, by turn), two hashes of role and text, and the text's words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    thin = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *[F.xxhash64(F.lit(i), role, text).alias(f"t{i}") for i in (1, 2)],
        F.regexp_count(text, F.lit(_WORDS)).cast("bigint").alias("n_words"),
    )
    numbered = stage(global_row_number(thin, ["conv_id", "turn", "t1", "t2"]), "trie-numbered")
    first = numbered.groupBy("conv_id").agg((F.min("rn") - 1).alias("first"))
    return stage(
        numbered.join(first, "conv_id").select("conv_id", (F.col("rn") - F.col("first")).alias("at"), "t1", "t2", "n_words"), "trie-turns"
    )


def rebuilt_turns(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, size, depth and the rest), and all ids with their sizes.

    A conversation begins with the first h turns of the one that its group of ids
    begins with, h being the checksum of its id modulo ``most``, and goes on with its
    own turns after its first h.
    """
    ranked = ranked_turns(turns)
    own = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    shape = own.select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
    )
    heads = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    borrowed = F.when(F.col("base") == F.col("conv_id"), F.least("h", "own")).otherwise(F.least("h", F.coalesce("there", F.lit(0))))
    shape = stage(
        shape.join(heads, "base", "left").withColumn("borrowed", borrowed)
        .select("conv_id", "base", "h", "borrowed", (F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")),
        "trie-shapes",
    )
    late = ranked.join(shape, "conv_id").filter(F.col("at") > F.col("h")).withColumn("depth", F.col("borrowed") + F.col("at") - F.col("h"))
    early = (
        shape.filter("borrowed > 0").withColumn("at", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("borrowed").cast("bigint"))))
        .join(ranked.filter(F.col("at") < most).withColumnRenamed("conv_id", "base"), ["base", "at"]).withColumn("depth", F.col("at"))
    )
    names = ["conv_id", "size", F.col("depth").cast("bigint").alias("depth"), "t1", "t2", "n_words"]
    return late.select(*names).unionByName(early.select(*names)), shape.select("conv_id", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, size, depth, hash, the hash without its last turn, words so far."""
    terms = turns.withColumns({f"x{i}": F.xxhash64("depth", f"t{i}") for i in (1, 2)}).withColumn(
        "slice", F.floor((F.col("depth") - 1) / SLICE)
    )
    within = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = stage(
        terms.select(
            "conv_id", "size", "depth", "slice", "n_words", *[f"x{i}" for i in (1, 2)],
            *[F.bit_xor(f"x{i}").over(within).alias(f"s{i}") for i in (1, 2)], F.sum("n_words").over(within).alias("upto"),
        ),
        "trie-slices",
    )
    # The last row of a full slice holds its sums: one row in SLICE.
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    carried = summed.filter(F.col("depth") % SLICE == 0).select(
        "conv_id", (F.col("slice") + 1).alias("slice"), *[F.bit_xor(f"s{i}").over(before).alias(f"c{i}") for i in (1, 2)],
        F.sum("upto").over(before).alias("more"),
    )
    whole = summed.join(carried, ["conv_id", "slice"], "left")
    for i in (1, 2):
        whole = whole.withColumn(f"k{i}", F.col(f"s{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))))
    return stage(
        whole.select(
            "conv_id", "size", "depth", *KEY, *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"g{i}") for i in (1, 2)],
            "n_words", (F.col("upto") + F.coalesce("more", F.lit(0))).alias("upto"),
        ),
        "trie-prefixes",
    )


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with the most trailing zeros."""
    unit = F.pow(F.lit(2.0), F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("bigint")
    return high - high % unit


def _at(paths: DataFrame, string: str, depth: str, *names: str) -> DataFrame:
    """Hashes of the prefixes of given strings at given depths, to be joined on both."""
    return paths.select(
        F.col("conv_id").alias(string), F.col("depth").alias(depth), *[F.col(k).alias(n) for k, n in zip(KEY, names)]
    )


def _exits(strings: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """string, size, at (deepest node on its way), known and the edge (w, low, high) that it leaves inside, if any.

    ``known`` is a depth up to which it runs along that edge.
    """
    placed = nodes.withColumn("f", two_fattest(F.col("low"), F.col("high"))).withColumn("top", F.col("low") + 1)
    handles = stage(placed.join(_at(paths, "w", "f", "f1", "f2"), ["w", "f"]).drop("top"), "trie-handles")
    begins = stage(
        placed.join(_at(paths, "w", "top", "b1", "b2"), ["w", "top"]).select("b1", "b2", F.col("w").alias("bw"), F.col("low").alias("blow"), F.col("high").alias("bhigh")),
        "trie-begins",
    )
    nothing = F.lit(None).cast("bigint")
    state = strings.select(
        "string", "size", F.lit(0).cast("bigint").alias("at"), F.col("size").alias("upto"),
        *[nothing.alias(c) for c in ("known", "w", "low", "high")],
    )
    open_ = F.col("w").isNull() & (F.col("at") < F.col("upto"))
    while True:
        asked = state.withColumn("f", F.when(open_, two_fattest(F.col("at"), F.col("upto"))))
        found = asked.join(_at(paths, "string", "f", "f1", "f2"), ["string", "f"], "left").join(
            handles.select("f1", "f2", *KEY, *[F.col(c).alias(f"n{c}") for c in ("w", "low", "high")]), ["f1", "f2"], "left"
        )
        # The extent of the node that was found is on the string's way, or the string leaves its edge.
        seen = found.join(_at(paths, "string", "nhigh", "e1", "e2"), ["string", "nhigh"], "left")
        hit = F.col("nw").isNotNull()
        whole = hit & F.coalesce((F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), F.lit(False))
        asked_for, left = F.col("f").isNotNull(), hit & ~whole
        state = stage(
            seen.select(
                "string", "size", F.when(whole, F.col("nhigh")).otherwise(F.col("at")).alias("at"),
                F.when(asked_for & ~hit, F.col("f") - 1).otherwise(F.col("upto")).alias("upto"),
                F.when(left, F.col("f")).otherwise(F.col("known")).alias("known"),
                *[F.when(left, F.col(f"n{c}")).otherwise(F.col(c)).alias(c) for c in ("w", "low", "high")],
            ),
            "trie-search",
        )
        if state.filter(open_).isEmpty():
            break
    # A string may leave an edge before the depth of its handle: the edge that begins with its next turn.
    state = state.withColumns(
        {"at": F.coalesce("low", "at"), "next": F.when(F.col("w").isNull(), F.col("at") + 1)}
    )
    begun = state.join(_at(paths, "string", "next", "b1", "b2"), ["string", "next"], "left").join(begins, ["b1", "b2"], "left")
    return begun.select(
        "string", "size", "at", F.coalesce("known", F.when(F.col("bw").isNotNull(), F.col("next"))).alias("known"),
        F.coalesce("w", "bw").alias("w"), F.coalesce("low", "blow").alias("low"), F.coalesce("high", "bhigh").alias("high"),
    )


def _left_at(exits: DataFrame, paths: DataFrame) -> DataFrame:
    """string, edge (w, low, high; null without one) and the depth at which the string leaves the trie."""
    state = stage(
        exits.select("string", "w", "low", "high", F.coalesce("known", "at").alias("depth"), F.coalesce(F.least("high", "size"), "at").alias("upto")),
        "trie-leaving",
    )
    while not state.filter(F.col("depth") < F.col("upto")).isEmpty():
        middle = F.when(F.col("depth") < F.col("upto"), F.floor((F.col("depth") + F.col("upto") + 1) / 2))
        both = (
            state.withColumn("middle", middle).join(_at(paths, "string", "middle", "a1", "a2"), ["string", "middle"], "left")
            .join(_at(paths, "w", "middle", "b1", "b2"), ["w", "middle"], "left")
        )
        same = F.coalesce((F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2")), F.lit(False))
        state = stage(
            both.select(
                "string", "w", "low", "high", F.when(same, F.col("middle")).otherwise(F.col("depth")).alias("depth"),
                F.when(F.col("middle").isNotNull() & ~same, F.col("middle") - 1).otherwise(F.col("upto")).alias("upto"),
            ),
            "trie-leaving",
        )
    return state.select("string", "w", "low", "high", "depth")


_NODE = [*KEY, "w", "low", "high"]


def _insert(nodes: DataFrame | None, strings: DataFrame, paths: DataFrame) -> DataFrame:
    """The trie's nodes (hash of the extent, witness, depths at which the edge begins and ends) with a batch of strings."""
    fresh = paths.join(strings.select(F.col("string").alias("conv_id")), "conv_id")
    split = None
    if nodes is not None:
        left = stage(_left_at(_exits(strings, nodes, paths), paths), "trie-left")
        fresh = fresh.join(left.select(F.col("string").alias("conv_id"), F.col("depth").alias("shared")), "conv_id").filter(
            F.col("depth") > F.col("shared")
        )
        cuts = left.filter(F.col("w").isNotNull()).groupBy("w", "low", "high", "depth").agg(F.min("string").alias("string"))
        split = cuts.join(_at(paths, "string", "depth", *KEY), ["string", "depth"]).select(*KEY, "w", F.col("high").alias("edge"), F.col("depth").alias("high"))
    below = stage(
        fresh.groupBy(*KEY).agg(
            F.min("conv_id").alias("w"), F.min("depth").alias("high"), F.max(F.col("depth") == F.col("size")).alias("ends"),
            F.min("g1").alias("g1"), F.min("g2").alias("g2"),
        ),
        "trie-below",
    )
    children = below.groupBy(F.col("g1").alias("k1"), F.col("g2").alias("k2")).agg(F.count(F.lit(1)).alias("children"))
    tops = below.groupBy("w").agg((F.min("high") - 1).alias("top"))
    along = Window.partitionBy("w").orderBy("high")
    kept = (
        below.join(children, KEY, "left").filter(F.col("ends") | (F.col("children") > 1)).join(tops, "w")
        .withColumn("low", F.coalesce(F.lag("high").over(along), F.col("top"))).select(*_NODE)
    )
    if nodes is None:
        return stage(kept, "trie-nodes")
    # The pieces of an edge hang on one another; the first hangs where the edge did.
    pieces = nodes.withColumn("edge", F.col("high")).unionByName(split.withColumn("low", F.lit(None).cast("bigint")))
    edge = Window.partitionBy("w", "edge")
    begin = F.coalesce(F.lag("high").over(edge.orderBy("high")), F.max("low").over(edge))
    return stage(pieces.withColumn("low", begin).select(*_NODE).unionByName(kept), "trie-nodes")


def build(strings: DataFrame, paths: DataFrame, batches: Sequence[int] = BATCHES) -> DataFrame:
    """The compacted trie of the strings (string, size), without its root; ``paths`` holds their prefixes."""
    nodes, done = None, 0
    place = F.pmod(F.xxhash64("string"), F.lit(batches[-1]))
    for upto in batches:
        batch = strings.filter((place >= done) & (place < upto))
        done = upto
        if not batch.isEmpty():
            nodes = _insert(nodes, batch, paths)
    return nodes


_ANC = ["a1", "a2"]


def _ancestors(tree: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ... the node 2^k above each node that has one."""
    levels = [stage(tree.filter(F.col("a1").isNotNull()).select(*KEY, *_ANC), "trie-above")]
    while not levels[-1].isEmpty():
        now = levels[-1]
        above = now.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("u1"), F.col("a2").alias("u2"))
        levels.append(stage(now.join(above, _ANC).select(*KEY, F.col("u1").alias("a1"), F.col("u2").alias("a2")), "trie-above"))
    return levels[:-1]


def _subtree(values: DataFrame, levels: list[DataFrame], merge: dict[str, tuple]) -> DataFrame:
    """Values gathered over each node's subtree, by doubling; ``merge`` names the aggregate and how two are put together."""
    now = values
    for level in levels:
        gathered = now.join(level, KEY).groupBy(*_ANC).agg(*[how(c).alias(f"more_{c}") for c, (how, _) in merge.items()])
        more = gathered.select(F.col("a1").alias("k1"), F.col("a2").alias("k2"), *[f"more_{c}" for c in merge])
        now = stage(
            now.join(more, KEY, "left").select(*KEY, *[both(F.col(c), F.col(f"more_{c}")).alias(c) for c, (_, both) in merge.items()]),
            "trie-sums",
        )
    return now


def _added(a: Column, b: Column) -> Column:
    return a + F.coalesce(b, F.lit(0))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids come ordered by string and number: joined by commas, piece by piece."""
    held: list = []
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.string()])], names=[*KEY, "first", "ids"]
        )
        rows.clear()
        return out

    def close() -> None:
        if held:
            rows.append((*held[0], held[1], ",".join(map(str, held[2]))))
            held.clear()

    for given in batches:
        for k1, k2, conv_id in zip(*(given.column(c).to_pylist() for c in (*KEY, "conv_id"))):
            if held and (held[0] != (k1, k2) or len(held[2]) * 8 > CHUNK):
                close()
            if not held:
                held += [(k1, k2), conv_id, []]
            held[2].append(conv_id)
        if len(rows) > 1000:
            yield batch()
    close()
    if rows:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come ordered: one digest runs over those of a string, whatever their number."""
    key, digest, rows = None, None, []
    for given in batches:
        for k1, k2, ids in zip(*(given.column(c).to_pylist() for c in (*KEY, "ids"))):
            if key == (k1, k2):
                digest.update(b",")
            else:
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256()
            digest.update(ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*KEY, "sha"])
            rows = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, digest.hexdigest()))], names=[*KEY, "sha"])


def ending_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each string, ascending and joined by commas.

    Ids are dealt out by string and number and joined in pieces; a digest cannot be
    taken in parts, so the pieces of one string run through one task, one by one.
    """
    order = [*KEY, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "k1 bigint, k2 bigint, first bigint, ids string"
    )
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "k1 bigint, k2 bigint, sha string")


NO_IDS = hashlib.sha256(b"").hexdigest()
RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def prefix_trie(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included.

    ``turns`` has conv_id, turn, role and text. Turns are ordered by turn, null first,
    ties by a digest of role and text; null roles and texts are empty; rows without a
    conv_id belong to no conversation; repeated rows are turns of their own. Rows are
    named by conv_id, the smallest member, and depth. n_convs counts members, n_children
    the prefixes one turn longer, n_leaves the childless ones of the subtree;
    saved_tokens is the sum over the subtree of (n_convs - 1) times the words of the
    last turn; ends_sha256 the digest of the ids that end here. Extra columns are not
    read; without conversations there are no rows.
    """
    spark = turns.sparkSession
    rebuilt, shape = rebuilt_turns(turns, group, most)
    if shape.isEmpty():
        return spark.createDataFrame([], RESULT)
    every = prefixes(rebuilt)
    zero = F.lit(0).cast("bigint")
    ends = stage(
        every.filter(F.col("depth") == F.col("size")).select("conv_id", "size", *KEY)
        .unionByName(shape.filter("size = 0").select("conv_id", F.col("size").cast("bigint").alias("size"), *[zero.alias(k) for k in KEY])),
        "trie-ends",
    )
    classes = stage(
        ends.groupBy(*KEY).agg(F.min("conv_id").alias("string"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n_ends")), "trie-strings"
    )
    strings = classes.filter("size > 0").select("string", "size")
    paths = stage(every.join(strings.select(F.col("string").alias("conv_id")), "conv_id"), "trie-paths")
    nodes = build(strings, paths)

    root = spark.range(1).select(*[zero.alias(k) for k in KEY], *[zero.alias(c) for c in ("w", "low", "high", "start", "upto")], *[F.lit(None).cast("bigint").alias(a) for a in _ANC])
    tree = root
    if nodes is not None:
        words = paths.select(F.col("conv_id").alias("w"), F.col("depth").alias("low"), *[F.col(k).alias(a) for k, a in zip(KEY, _ANC)], F.col("upto").alias("start"))
        to_end = paths.select(F.col("conv_id").alias("w"), F.col("depth").alias("high"), "upto")
        hung = nodes.join(words, ["w", "low"], "left").join(to_end, ["w", "high"])
        tree = hung.select(*_NODE, *[F.coalesce(c, zero).alias(c) for c in (*_ANC, "start")], "upto").unionByName(root)
    tree = stage(tree, "trie-tree")
    levels = _ancestors(tree)

    children = tree.filter(F.col("a1").isNotNull()).groupBy(*_ANC).agg(F.count(F.lit(1)).alias("n_children"))
    own = stage(
        tree.select(*KEY).join(classes, KEY, "left").join(children.select(F.col("a1").alias("k1"), F.col("a2").alias("k2"), "n_children"), KEY, "left")
        .select(
            *KEY, F.coalesce("n_children", zero).alias("n_children"), F.coalesce("n_ends", zero).alias("n_convs"),
            F.col("string").alias("conv_id"), F.col("n_children").isNull().cast("bigint").alias("n_leaves"),
        ),
        "trie-own",
    )
    gathered = _subtree(
        own.drop("n_children"), levels, {"n_convs": (F.sum, _added), "conv_id": (F.min, F.least), "n_leaves": (F.sum, _added)}
    )
    edge = (F.col("n_convs") - 1) * (F.col("upto") - F.col("start"))
    priced = stage(tree.join(gathered, KEY).withColumn("edge", edge), "trie-priced")
    saved = _subtree(priced.select(*KEY, F.col("edge").alias("saved")), levels, {"saved": (F.sum, _added)})

    named = gathered.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("conv_id").alias("parent"))
    whole = stage(
        priced.join(saved, KEY).join(own.select(*KEY, "n_children"), KEY).join(ending_digests(ends), KEY, "left")
        .join(named, _ANC, "left"),
        "trie-whole",
    )
    is_root = F.col("a1").isNull()
    laid = whole.withColumn(
        "depth", F.explode(F.sequence(F.when(is_root, zero).otherwise(F.col("low") + 1), F.col("high")))
    )
    here = paths.select(F.col("conv_id").alias("w"), "depth", (F.col("upto") - F.col("n_words")).alias("before"))
    last = F.col("depth") == F.col("high")
    return laid.join(here, ["w", "depth"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("low") + 1, F.col("parent")).when(~is_root, F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("saved") - F.col("edge") + (F.col("n_convs") - 1) * (F.col("upto") - F.coalesce("before", F.col("upto")))).alias("saved_tokens"),
        F.when(last, F.coalesce("sha", F.lit(NO_IDS))).otherwise(F.lit(NO_IDS)).alias("ends_sha256"),
    )
