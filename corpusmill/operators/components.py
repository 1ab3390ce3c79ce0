"""Connected components of an edge list, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.session import drop_stage, staged


def hash_to_min(edges: DataFrame) -> DataFrame:
    """(node, component) with the component's smallest node; edges has columns a and b.

    Hash-to-min (Rastogi, Machanavajjhala, Chitnis & Das Sarma 2013): every node sends its cluster
    to the cluster's minimum, and the minimum to the cluster's nodes, until nothing changes; that
    takes a number of rounds logarithmic in the longest path on all but contrived graphs, and it
    ends on all, as minima only fall. Clusters are rows, so none has to fit in a task; AQE splits
    the rows of a large cluster's minimum. Every round is written to the shared folder in one job,
    which also tells whether anything changed, and the round before is deleted. Null ends are
    dropped, self links keep their node; no edges give no rows.
    """
    sides = edges.filter("a is not null and b is not null").select(F.col("a").alias("v"), F.col("b").alias("u"))
    both = sides.unionByName(sides.select(F.col("u").alias("v"), F.col("v").alias("u")))
    state = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
    seen = Observation()
    clusters, before = staged(both.unionByName(both.select("v", F.col("v").alias("u"))).distinct(), "clusters", seen, *state), None
    while seen.get != before:
        before, seen, old = seen.get, Observation(), clusters
        held = old.join(old.groupBy("v").agg(F.min("u").alias("m")), "v")
        clusters = staged(held.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(held.select(F.col("m").alias("v"), "u")).distinct(), "clusters", seen, *state)
        drop_stage(old)
    return clusters.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))


def star_edges(rows: DataFrame, node: str, key: str) -> DataFrame:
    """Edges (a, b) from each node to the smallest node with the same key: n - 1 links for n equal
    keys instead of all pairs. Null keys link nothing."""
    keyed = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(node).alias("b"))
    return keyed.join(keyed.groupBy("k").agg(F.min("b").alias("a")), "k").select("a", "b")
