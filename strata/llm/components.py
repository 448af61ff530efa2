"""Connected components of a link table, distributed.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): every node is tied to ever smaller nodes until each component
is a star around its smallest. Each step is a pre-aggregated minimum and a join, and
is written to the shared checkpoint folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(r)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b), both long and not null; the component
    is its smallest node. Self links and repeats are allowed; no links give no rows."""
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        # Large star: larger neighbours move to the smallest of the neighbourhood.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        moved = both.join(low, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.filter("a <> b").distinct()
        # Small star: smaller neighbours move to the smallest of them.
        low = moved.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        tied = moved.join(low, F.col("a") == F.col("u")).select("a", "b", "m")
        edges = cut(
            tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        before, state = state, _state(edges)
        if before == state:
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
