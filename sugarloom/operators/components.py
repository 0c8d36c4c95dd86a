"""Connected components of a distributed edge table, by alternating large-star and small-star steps
(Kiveris et al., Connected Components in MapReduce and Beyond, 2014)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sugarloom.operators.staging import drop_stage, staged


def connected_components(edges: DataFrame, label: str = "cc", keys: Sequence[str] = ()) -> DataFrame:
    """edges(keys, a, b) of any orderable type to (keys, node, component): the smallest node of each component.

    keys: columns of graphs that are apart, such as a molecule. Nodes of no edge are not in the result; loops and repeated
    edges do no harm; no edges give no rows. Each round is one aggregation a node (with map-side combine) and one join on
    it, staged on shared storage; the driver sees a row count and a sum only. Rounds grow with the logarithm of the
    component's size.
    """
    at = [*keys, "u"]
    pairs = lambda df, u, v: df.select(*keys, u.alias("u"), v.alias("v"))
    now = staged(pairs(edges.where("a <> b"), F.greatest("a", "b"), F.least("a", "b")).distinct(), label)
    before = _print_of(now, at)
    while before[0]:
        # few edges are written by few tasks, whatever the number of shuffle partitions
        tasks = max(12, before[0] // 100_000)
        both = now.select(*at, "v").union(pairs(now, F.col("v"), F.col("u")))
        least = both.groupBy(*at).agg(F.min("v").alias("m")).select(*at, F.least("u", "m").alias("m"))
        # large star: every higher neighbour to the lowest one
        large = staged(pairs(both.where("v > u").join(least, at), F.col("v"), F.col("m")).distinct().coalesce(tasks), label)
        drop_stage(now)
        # small star: every lower neighbour, and the node itself, to the lowest of them
        low = large.groupBy(*at).agg(F.min("v").alias("m"))
        joined = pairs(large.join(low, at).where("v <> m"), F.col("v"), F.col("m"))
        now = staged(joined.union(pairs(low, F.col("u"), F.col("m"))).distinct().coalesce(tasks), label)
        drop_stage(large)
        after = _print_of(now, at)
        if after == before:
            break
        before = after
    return now.select(*keys, F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(*keys, "v", "v").distinct())


def _print_of(edges: DataFrame, at: Sequence[str]) -> tuple:
    """Row count and hash sums: equal for equal sets."""
    h = F.xxhash64(*at, "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
