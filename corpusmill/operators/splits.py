"""Stratified splits, routing by manifest, leak checks, licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEED = 20240709
#: Sources in these verdicts may be used.
USABLE = ("usable", "usable_for_research_only")


def dominant(df: DataFrame, key: str, items: str) -> DataFrame:
    """(key, dominant): the most frequent element of a list, ties by first place, none if empty."""
    each = df.select(key, F.posexplode_outer(items).alias("p", "x"))
    per = each.groupBy(key, "x").agg(F.count("x").alias("n"), F.min("p").alias("first"))
    best = per.groupBy(key).agg(F.max_by("x", F.struct("n", -F.col("first"))).alias("dominant"))
    return best.select(key, F.coalesce("dominant", F.lit("none")).alias("dominant"))


def hash_order(key: Column, seed: int = SEED) -> Column:
    """A repeatable shuffle order."""
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def stratified(df: DataFrame, key: str, strata: list[str], fraction: float, seed: int = SEED) -> DataFrame:
    """(key, strata, split): of each stratum of n rows, 0 validation rows if n is 1, else at least 1
    and round-half-even(n * fraction), the first in hash order. Null strata are strata. The cut is
    found from counts per hash prefix; only rows of the prefix it falls in are ranked, so a stratum
    that holds most rows is no task's work."""
    rows = df.select(key, *strata, hash_order(F.col(key), seed).alias("_h")).withColumn("_p", F.substring("_h", 1, 4))
    per = rows.groupBy(*strata, "_p").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*strata)
    n = F.sum("_n").over(w)
    want = F.when(n <= 1, 0).otherwise(F.greatest(F.lit(1), F.bround(n * F.lit(fraction), 0).cast("int")))
    upto = per.withColumn("_u", F.sum("_n").over(w.orderBy("_p"))).withColumn("_w", want)
    edge = upto.filter((F.col("_u") >= F.col("_w")) & (F.col("_u") - F.col("_n") < F.col("_w"))).select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(strata)), F.col("_p").alias("_edge"), (F.col("_w") - F.col("_u") + F.col("_n")).alias("_open"))
    same = F.lit(True)
    for i, c in enumerate(strata):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    cut = rows.join(edge, same, "left")
    last = cut.filter("_p = _edge").withColumn("_r", F.row_number().over(w.orderBy("_h", key)))
    return last.select(key, *strata, F.when(F.col("_r") <= F.col("_open"), "validation").otherwise("train").alias("split")).unionByName(
        cut.filter("_edge is null or _p != _edge").select(key, *strata, F.when(F.col("_p") < F.col("_edge"), "validation").otherwise("train").alias("split"))
    )


def head_slice(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """(key, split): the first max(1, floor(n * fraction)) rows in hash order are validation; none
    for fraction 0. The cut is found from counts per hash prefix, so no task sorts all rows."""
    rows = df.select(key, hash_order(F.col(key), seed).alias("_h"))
    if fraction <= 0:
        return rows.select(key, F.lit("train").alias("split"))
    per = rows.groupBy(F.substring("_h", 1, 3).alias("_p")).agg(F.count("*").alias("_n"))
    upto = per.withColumn("_u", F.sum("_n").over(Window.orderBy("_p")))
    want = F.greatest(F.lit(1), F.floor(F.col("_t") * F.lit(fraction)).cast("int"))
    edge = upto.crossJoin(per.agg(F.sum("_n").alias("_t"))).filter((F.col("_u") >= want) & (F.col("_u") - F.col("_n") < want)).select(F.col("_p").alias("_edge"), (want - F.col("_u") + F.col("_n")).alias("_open"))
    cut = rows.withColumn("_p", F.substring("_h", 1, 3)).join(F.broadcast(edge))  # one row
    last = cut.filter("_p = _edge").withColumn("_r", F.row_number().over(Window.orderBy("_h", key)))
    return cut.filter("_p < _edge").select(key, F.lit("validation").alias("split")).unionByName(last.select(key, F.when(F.col("_r") <= F.col("_open"), "validation").otherwise("train").alias("split"))).unionByName(cut.filter("_p > _edge").select(key, F.lit("train").alias("split")))


def route(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Rows with the manifest's split; a key in several splits goes to validation, unknown ones to train."""
    m = manifest.groupBy(key).agg(F.max(F.col("split") == "validation").alias("_v"))
    return rows.drop("split").join(m, key, "left").withColumn("split", F.when(F.col("_v"), "validation").otherwise("train")).drop("_v")


def leaked(rows: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys found in more than one split, with their number of splits."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(split).alias("n_splits")).filter("n_splits > 1")


def license_gate(sources: DataFrame, enabled: str = "enabled", verdict: str = "verdict") -> DataFrame:
    """Adds status: usable, disabled or blocked; unknown verdicts are blocked."""
    ok = F.coalesce(F.col(verdict).isin(*USABLE), F.lit(False))
    return sources.withColumn("status", F.when(~ok, "blocked").when(~F.coalesce(F.col(enabled), F.lit(False)), "disabled").otherwise("usable"))


def resolve_license(rows: DataFrame, by: list[str], license_col: str, precedence: list[str], default: str) -> DataFrame:
    """Per group the licence that comes first in the precedence among those found, else the default."""
    rank = F.array_position(F.array(*(F.lit(x) for x in precedence)), F.col(license_col))
    got = F.min_by(license_col, F.when(rank > 0, rank))
    return rows.groupBy(*by).agg(F.coalesce(got, F.lit(default)).alias("license"))
