"""Exact set-similarity joins by size and prefix filters (Chaudhuri, Ganti & Kaushik 2006; Bayardo, Ma & Srikant 2007)."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.features import let
from corpusmill.session import staged


def _prefixed(sets: DataFrame, key: str, items: str, tau: Fraction, by: list[str], order: DataFrame) -> DataFrame:
    """(key, by, n, i, token): each set's size and its prefix elements, from rare to frequent."""
    size = F.size("x")
    ranked = (
        sets.select(key, *by, F.explode(F.array_distinct(items)).alias("item"))
        .join(order, "item")
        .groupBy(key, *by)
        .agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("x"))
    )
    # n - ceil(tau n) + 1 elements: similar sets share one of them
    keep = size - F.ceil(F.lit(tau.numerator) * size / F.lit(tau.denominator)).cast("int") + 1
    return ranked.select(key, *by, size.alias("n"), F.posexplode(F.transform(F.slice("x", 1, keep), lambda s: s["item"])).alias("i", "token"))


def _frequencies(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("item").agg(F.count("*").alias("df"))


def _candidates(a: DataFrame, b: DataFrame, on: list[str], tau: Fraction, ordered: bool) -> DataFrame:
    """Pairs whose sizes and first shared prefix places still allow the similarity."""
    p, q = tau.numerator, tau.denominator
    sized = (F.col("na") * p <= F.col("nb") * q) & (F.col("nb") * p <= F.col("na") * q)
    most = 1 + F.least(F.col("na") - F.col("ia") - 1, F.col("nb") - F.col("ib") - 1)
    first = a.join(b, on).filter(sized & (F.col("a") < F.col("b")) if ordered else sized).groupBy("a", "b", "na", "nb").agg(F.min(F.struct("ia", "ib")).alias("f"))
    # the first shared element's places bound the overlap: at least tau / (1 + tau) of both sizes
    bound = first.select("a", "b", "na", "nb", F.col("f.ia").alias("ia"), F.col("f.ib").alias("ib"))
    return bound.filter(most * (p + q) >= (F.col("na") + F.col("nb")) * p).select("a", "b")


def _verified(cand: DataFrame, left: DataFrame, right: DataFrame, tau: Fraction) -> DataFrame:
    both = F.size(F.array_intersect("xa", "xb"))
    whole = F.size(F.array_distinct("xa")) + F.size(F.array_distinct("xb")) - both
    joined = cand.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), whole.alias("whole"))
    return joined.filter(F.col("both") * tau.denominator >= F.col("whole") * tau.numerator).select("a", "b", (F.col("both") / F.col("whole")).alias("similarity"))


def _content(items: str) -> Column:
    """Two hashes, 128 bits, of a set's sorted elements: equal for equal sets."""
    return let(F.sort_array(F.array_distinct(items)), lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit("2"), x).alias("g")))


def set_classes(sets: DataFrame, key: str, items: str, by: list[str] | None = None) -> DataFrame:
    """(key, rep): equal non-empty sets (equal in by, too) under their smallest key."""
    content = _content(items)
    kept = sets.filter(F.size(items) > 0).select(key, content.alias("_c"), *(by or []))
    on = ["_c", *(by or [])]
    return kept.join(kept.groupBy(*on).agg(F.min(key).alias("rep")), on).select(key, "rep")


def similar_pairs(sets: DataFrame, key: str, items: str, tau: str | Fraction, by: list[str] | None = None) -> DataFrame:
    """(a, b, similarity) of different sets with Tanimoto similarity of at least tau, a before b.

    Equal sets are one class and stand under their smallest key, as set_classes() tells, so a group
    of copies is never expanded into all its pairs; no link between different sets is lost.

    tau is an exact fraction (text such as "19/20"), so nothing hangs on floating-point rounding.
    With by, only sets equal in those columns are compared. Empty and null sets pair with nothing.
    Keys are unique, or their repeated rows equal. Candidates come from equi-joins on rare elements
    only, so there is no cross join and no cap.
    """
    tau, by = Fraction(tau), by or []
    given = sets.filter((F.size(items) > 0) & F.col(key).isNotNull()).select(key, F.col(items).alias("x"), _content(items).alias("_c"), *by)
    kept = staged(given.groupBy("_c", *by).agg(F.min(key).alias(key), F.first("x").alias("x")).drop("_c"), "sets")
    order = _frequencies(kept.select(F.explode(F.array_distinct("x")).alias("item")))
    p = _prefixed(kept, key, "x", tau, by, order)
    a = p.select(F.col(key).alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), "token", *by)
    b = p.select(F.col(key).alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), "token", *by)
    cand = _candidates(a, b, ["token", *by], tau, True)
    return _verified(cand, kept.select(F.col(key).alias("a"), F.col("x").alias("xa")), kept.select(F.col(key).alias("b"), F.col("x").alias("xb")), tau)


def similar_matches(left: DataFrame, right: DataFrame, key: str, items: str, tau: str | Fraction) -> DataFrame:
    """(a, b, similarity) of left and right sets with a similarity of at least tau."""
    tau = Fraction(tau)
    l = staged(left.filter(F.size(items) > 0).select(key, F.col(items).alias("x")), "sets")
    r = staged(right.filter(F.size(items) > 0).select(key, F.col(items).alias("x")), "sets")
    order = _frequencies(l.select(F.explode(F.array_distinct("x")).alias("item")), r.select(F.explode(F.array_distinct("x")).alias("item")))
    a = _prefixed(l, key, "x", tau, [], order).select(F.col(key).alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), "token")
    b = _prefixed(r, key, "x", tau, [], order).select(F.col(key).alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), "token")
    return _verified(_candidates(a, b, ["token"], tau, False), l.select(F.col(key).alias("a"), F.col("x").alias("xa")), r.select(F.col(key).alias("b"), F.col("x").alias("xb")), tau)


def similar_to(left: DataFrame, right: DataFrame, key: str, items: str, tau: str | Fraction) -> DataFrame:
    """(key, best) of left sets whose best similarity with any right set is at least tau."""
    return similar_matches(left, right, key, items, tau).groupBy(F.col("a").alias(key)).agg(F.max("similarity").alias("best"))
