"""Removal of records that a held-out benchmark contains, with the first reason that hits."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.simjoin import similar_to

#: Reason codes in their order of precedence.
SET_MATCH, SKELETON_MATCH, STEPS_MATCH, SIMILAR = "inchikey_set_match", "skeleton_inchikey_match", "mechanism_hash_match", "reaction_fp_tanimoto>={tau}"


def reasons(candidates: DataFrame, benchmark: DataFrame, key: str, tau: str = "19/20", fingerprint: str | None = None) -> DataFrame:
    """Candidates with a reason column, null for clean ones.

    Both frames have columns sig, skel and steps (null where unknown) and, for the similarity
    stage, the named bit-set column. Only survivors of the exact stages reach the similarity join.
    Null signatures match nothing; repeated benchmark rows count once.
    """
    out = candidates
    for col, code in (("sig", SET_MATCH), ("skel", SKELETON_MATCH), ("steps", STEPS_MATCH)):
        known = benchmark.filter(F.col(col).isNotNull()).select(col).distinct().withColumn(f"_hit_{col}", F.lit(code))
        out = out.join(known, col, "left")
    out = out.withColumn("reason", F.coalesce("_hit_sig", "_hit_skel", "_hit_steps")).drop("_hit_sig", "_hit_skel", "_hit_steps")
    if fingerprint is None:
        return out
    left = out.filter("reason is null").select(key, fingerprint)
    near = similar_to(left, benchmark.withColumn(key, F.monotonically_increasing_id()), key, fingerprint, tau)
    code = SIMILAR.format(tau=f"{float(Fraction(tau)):g}")
    return out.join(near, key, "left").withColumn("reason", F.coalesce("reason", F.when(F.col("best").isNotNull(), code))).drop("best")


def blacklist(*corpora: DataFrame) -> DataFrame:
    """The signatures, skeletons, step hashes and fingerprints of several held-out corpora in one
    frame; each corpus has the columns that reasons() uses."""
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def split_clean(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed)."""
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def report(judged: DataFrame, source: str = "source") -> DataFrame:
    """Removed records by reason and source."""
    return judged.filter("reason is not null").groupBy("reason", source).agg(F.count("*").alias("removed"))


def leaks(kept: DataFrame, benchmark: DataFrame, col: str = "sig") -> DataFrame:
    """One row: survivors that still share a signature with the benchmark; must be 0."""
    known = benchmark.filter(F.col(col).isNotNull()).select(col).distinct()
    return kept.join(known, col, "left_semi").agg(F.count("*").alias("leaks"))
