"""Duplicate clusters by equal hashes, equal signatures or similar fingerprints, one record kept of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.components import hash_to_min, star_edges
from corpusmill.operators.simjoin import set_classes, similar_pairs

#: How much each provenance is preferred; unknown ones rank 0.
PROVENANCE_RANK = {"curated": 3, "template_expanded": 2, "inferred": 1}


def provenance_rank(provenance: Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for kv in PROVENANCE_RANK.items() for x in kv))
    return F.coalesce(ranks[provenance], F.lit(0))


def clusters(rows: DataFrame, key: str, keys: list[str], fingerprint: str | None = None, tau: str = "97/100", bucket: str | None = None) -> DataFrame:
    """(key, cluster): rows linked by any equal column of keys or by similar fingerprints.

    Equal values link in stars, so a value that a third of all rows share costs one link per row.
    Fingerprints are compared within equal buckets. Rows without any link are their own cluster.
    """
    edges = None
    for col in keys:
        e = star_edges(rows, key, col)
        edges = e if edges is None else edges.unionByName(e)
    if fingerprint is not None:
        by = [bucket] if bucket else None
        equal = set_classes(rows, key, fingerprint, by).select(F.col("rep").alias("a"), F.col(key).alias("b"))
        near = similar_pairs(rows, key, fingerprint, tau, by).select("a", "b").unionByName(equal)
        edges = near if edges is None else edges.unionByName(near)
    comps = hash_to_min(edges.filter("a != b").distinct())
    return rows.select(key).join(comps.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("component", key).alias("cluster"))


def representatives(rows: DataFrame, clustered: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The row of each cluster with the smallest values of order, then key; keys are unique. The smallest
    is kept in an aggregate, so no cluster is sorted, and only keys go through the shuffle."""
    ranked = rows.select(key, F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(key).alias("k")).alias("_o")).join(clustered, key)
    first = ranked.groupBy("cluster").agg(F.min("_o")["k"].alias(key))
    return rows.join(first, key)


def size_distribution(clustered: DataFrame) -> DataFrame:
    """(cluster_size, clusters)."""
    return clustered.groupBy("cluster").agg(F.count("*").alias("cluster_size")).groupBy("cluster_size").agg(F.count("*").alias("clusters"))
