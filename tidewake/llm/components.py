"""Connected components of a link table, by alternating star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.session import stage

ROUNDS = 40
BROADCAST_KEYS = 1_000_000  # 8 bytes each


def semi_join(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys`` (distinct numbers): broadcast up to a counted size, else shuffled."""
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if small else keys, key, "left_semi")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, ``links`` being pairs a, b of numbers; root is the least of a component.

    Large-star links every larger neighbour of a node to its least one, small-star every smaller. Both
    reduce with a minimum per node before they join, so a node of many links is one row per task.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    for _ in range(ROUNDS):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(met.select("a", F.col("m").alias("b")))
        small = stage(small.filter("a <> b").distinct(), "small-star")
        # Done when every node has one link and no root has one of its own.
        nodes = small.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("d")).first()
        inner = small.select(F.col("b").alias("a")).distinct().join(small.select("a").distinct(), "a").limit(1).count()
        links = small
        if nodes["n"] == nodes["d"] and not inner:
            break
    else:
        raise RuntimeError("components did not converge")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stage(links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "components")


def local_roots(n: int, pairs) -> list[int]:
    """Least member of each of n members' component under index pairs."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
