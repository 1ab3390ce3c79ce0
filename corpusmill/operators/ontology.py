"""Allowed (type, subtype) pairs: counts, cross-checks, and remapping with reason-coded rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(steps: DataFrame, kind: str, subtype: str) -> DataFrame:
    """(type, subtype, n) of steps that have both."""
    return steps.filter(F.col(kind).isNotNull() & F.col(subtype).isNotNull()).groupBy(F.col(kind).alias("type"), F.col(subtype).alias("subtype")).agg(F.count("*").alias("n"))


def cross_check(used: DataFrame, allowed: DataFrame) -> DataFrame:
    """(problem, value): used pairs that aren't allowed, allowed ones never used, and subtypes of
    several types. Both frames have type and subtype."""
    pair = F.concat_ws("/", "type", "subtype")
    u, a = used.select("type", "subtype").distinct(), allowed.select("type", "subtype").distinct()
    several = u.groupBy("subtype").agg(F.countDistinct("type").alias("k")).filter("k > 1").select(F.lit("several_types").alias("problem"), F.col("subtype").alias("value"))
    outside = u.exceptAll(a).select(F.lit("not_allowed").alias("problem"), pair.alias("value"))
    unused = a.exceptAll(u).select(F.lit("unused").alias("problem"), pair.alias("value"))
    return outside.unionByName(unused).unionByName(several)


def _shown(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def remap(steps: DataFrame, allowed: DataFrame, moves: DataFrame, key: str, pos: str) -> tuple[DataFrame, DataFrame]:
    """(steps of good records, rejects (key, reason)).

    steps has type and subtype; allowed holds pairs; moves has from_type, from_subtype and either
    to_type and to_subtype or nulls for an explicit reject. One bad step rejects its record; its
    first bad step gives the reason. The dimension tables are joined, so AQE broadcasts them while
    they are small.
    """
    ok = allowed.select("type", "subtype").distinct().withColumn("_ok", F.lit(True))
    m = moves.dropDuplicates(["from_type", "from_subtype"]).withColumnRenamed("from_type", "type").withColumnRenamed("from_subtype", "subtype").withColumn("_listed", F.lit(True))
    target = allowed.select(F.col("type").alias("to_type"), F.col("subtype").alias("to_subtype")).distinct().withColumn("_target_ok", F.lit(True))
    judged = steps.join(ok, ["type", "subtype"], "left").join(m, ["type", "subtype"], "left").join(target, ["to_type", "to_subtype"], "left")
    label = F.concat(F.lit("unmapped_step_type:"), _shown(F.col("type")), F.lit("::"), _shown(F.col("subtype")))
    why = (
        F.when(F.col("_ok"), None)
        .when(F.col("_listed").isNull(), label)
        .when(F.col("to_type").isNull(), F.concat(label, F.lit("(explicit_reject)")))
        .when(F.col("_target_ok").isNull(), F.concat(F.lit("remap_target_not_allowed:"), _shown(F.col("to_type")), F.lit("/"), _shown(F.col("to_subtype"))))
    )
    moved = F.col("_ok").isNull() & F.col("_target_ok")
    judged = judged.withColumn("_why", why).withColumn("remapped_from", F.when(moved, F.concat_ws("::", "type", "subtype")))
    judged = judged.withColumn("type", F.when(moved, F.col("to_type")).otherwise(F.col("type"))).withColumn("subtype", F.when(moved, F.col("to_subtype")).otherwise(F.col("subtype")))
    rejects = judged.filter("_why is not null").groupBy(key).agg(F.min_by("_why", pos).alias("reason"))
    return judged.drop("_ok", "_listed", "_target_ok", "to_type", "to_subtype", "_why").join(rejects.select(key), key, "left_anti"), rejects


def under_covered(counts: DataFrame, allowed: DataFrame, col: str = "subtype", least: int = 5) -> DataFrame:
    """(col, n) of allowed values seen fewer than least times, unseen ones included."""
    return allowed.select(col).distinct().join(counts.groupBy(col).agg(F.sum("n").alias("n")), col, "left").select(col, F.coalesce("n", F.lit(0).cast("bigint")).alias("n")).filter(F.col("n") < least)
