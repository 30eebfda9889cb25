"""Connected components of a link table by alternating star contractions, in DataFrame functions only.

Each round points every node's larger neighbours at its smallest one, then
every node's smaller neighbours; stars remain. The smallest neighbour per
node is a plain minimum (combined before the shuffle), written once and
joined back as a table of its own, so that a node with a large share of all
links is split by adaptive execution instead of loading one task. Rounds
grow with the logarithm of the longest path. Nothing but one row of check
sums per round reaches the driver. Tables of links are mostly small against
what they come from, so each is kept in partitions of about ``ROWS`` links:
a round of a small one then is a few tasks and files, not a few per shuffle
partition, and one of at most ``ROWS`` links needs no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.session import materialize


ROWS = 1 << 18


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node that has a link to another node.

    Links are undirected; repeats, self-links and rows with a NULL end count for nothing.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))).distinct())
    now, before = _sums(edges), None
    while now != before:
        n = -(-now[0] // ROWS) or 1
        edges = edges.coalesce(n)
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).coalesce(n)
        least = materialize(both.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
                            .select("node", F.least("node", "m").alias("m")).coalesce(n))
        large = edges.join(least, edges["lo"] == least["node"]).select("hi", F.col("m").alias("lo")).distinct()
        large = materialize(large.coalesce(n))
        least = materialize(large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m")).coalesce(n))
        moved = (large.join(least, large["hi"] == least["node"]).where(F.col("lo") > F.col("m"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        moved = moved.unionByName(least.select(F.col("node").alias("hi"), F.col("m").alias("lo")))
        edges = materialize(moved.coalesce(n).distinct().coalesce(n))
        now, before = _sums(edges), now
    heads = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        heads.select("node", F.col("node").alias("component")))


def _sums(edges: DataFrame) -> tuple:
    """Number and hash sum of the edges: equal before and after a round only if nothing moved."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
