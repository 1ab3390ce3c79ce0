"""Mixing sources so that each gives a target share of the mix's tokens.

Method: tokens are added up per source, a source's repetition rate is its wanted tokens over its
tokens, at most max_repeats; every document then comes out floor(rate) times and once more with
the rate's fraction as probability, drawn from a hash of seed, mix and document. Documents meet
nothing but their source's rate, so no source is gathered anywhere.

Defined cases: spellings of a source are one, null and blank sources belong to no target; a target
whose source is missing or empty gives nothing and is reported; target rows of one mix and source
add up, with the largest max_repeats; null or negative max_repeats and targets count as 0; empty
texts have no tokens and come as often as their source's rate says; repeated rows draw alike;
empty tables give empty mixes; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import label
from corpusmill.session import bounded_broadcast

MOST_TARGETS = 10_000


def rates(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per mix and source: wanted tokens, tokens there are, and the repetition rate."""
    have = sized.groupBy(label(F.col("source")).alias("source")).agg(F.sum("n_tokens").alias("have"), F.count("*").alias("docs"))
    whole = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("x")).first()["x"]
    plus = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0))
    t = targets.groupBy("mix_id", label(F.col("source")).alias("source")).agg(F.sum(plus("target_permille")).alias("permille"), F.max(plus("max_repeats")).alias("most"), F.max(plus("total_tokens_permille")).alias("size_permille"))
    wanted = F.expr(f"(cast({whole} as bigint) * size_permille div 1000) * permille / 1000D")
    joined = t.join(have, "source", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("bigint"))).withColumn("docs", F.coalesce("docs", F.lit(0).cast("bigint"))).withColumn("wanted", wanted)
    rate = F.when(F.col("have") > 0, F.least(F.col("wanted") / F.col("have"), F.col("most").cast("double"))).otherwise(0.0)
    return joined.select("mix_id", "source", "permille", "most", "docs", "have", "wanted", rate.alias("rate"))


def mix(sized: DataFrame, targets: DataFrame, key: str, seed: int = 20240709) -> DataFrame:
    """(mix_id, source, key, n_tokens, copies) of every document in a mix."""
    r = bounded_broadcast(rates(sized, targets).select("mix_id", "source", "rate"), MOST_TARGETS)
    draw = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("mix_id").cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    copies = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("bigint")
    return sized.select(key, label(F.col("source")).alias("source"), "n_tokens").join(r, "source").select("mix_id", "source", key, "n_tokens", copies.alias("copies")).filter("copies > 0")


def report(sized: DataFrame, targets: DataFrame, key: str, seed: int = 20240709) -> DataFrame:
    """Per mix and source: wanted and actual tokens and shares, and whether the cap fell short."""
    got = mix(sized, targets, key, seed).groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    from pyspark.sql.window import Window

    out = rates(sized, targets).join(got, ["mix_id", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("bigint")))
    whole = F.sum("tokens").over(Window.partitionBy("mix_id"))
    return out.select(
        "mix_id", "source", "docs", F.col("have").alias("source_tokens"), F.round("wanted", 3).alias("wanted_tokens"), "tokens", F.coalesce("copies", F.lit(0).cast("bigint")).alias("copies"), F.coalesce("most_copies", F.lit(0).cast("bigint")).alias("most_copies"), F.round("rate", 6).alias("rate"),
        (F.col("rate") * F.col("have") < F.col("wanted") - 0.5).alias("short"), F.round(F.col("permille") / 1000, 6).alias("wanted_share"), F.round(F.col("tokens") / F.when(whole > 0, whole), 6).alias("actual_share"),
    )
