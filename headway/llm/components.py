"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.sources.writing import stage

MOST_ROUNDS = 60  # each at least halves the depth; a graph that needs more is an error


def _print(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal for equal edge sets."""
    mark = F.pmod(F.xxhash64("hi", "lo"), F.lit((1 << 31) - 1))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node with an edge.

    Edges are kept from the higher to the lower node. Large-star hangs the higher
    neighbours of each node on its lowest neighbour, small-star its lower ones. The
    lowest neighbours are written before they are joined, so both sides of a join
    are plain shuffles and Spark can split a node with very many edges. Every step
    is a table in the shared folder: no lineage grows, and nothing reaches the
    driver but counts. Edges with a null end or of a node to itself link nothing.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(),
        "star-edges",
    )
    seen = _print(now)
    for _ in range(MOST_ROUNDS):
        if not seen[0]:
            break
        least = stage(now.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least")), "star-least")
        now = stage(  # large-star
            now.join(least, F.col("lo") == F.col("at"), "left").select("hi", F.coalesce("least", "lo").alias("lo")).distinct(),
            "star-edges",
        )
        least = stage(now.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least")), "star-least")
        joined = now.join(least, F.col("hi") == F.col("at"))
        now = stage(  # small-star
            joined.select(
                F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")), F.struct("hi", F.col("least").alias("lo")))).alias("e")
            ).select("e.hi", "e.lo").filter("hi <> lo").distinct(),
            "star-edges",
        )
        last, seen = seen, _print(now)
        if seen == last:
            break
    else:
        raise RuntimeError(f"components are not stable after {MOST_ROUNDS} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
