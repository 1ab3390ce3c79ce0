"""Report aggregates: histograms, quantiles by place, tiers, top values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fixed_bins(value: Column, bins: int = 5) -> Column:
    """The bin 0..bins-1 of a number in [0, 1], the last bin closed; null for null or outside."""
    return F.when((value >= 0) & (value <= 1), F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int"))


def histogram(df: DataFrame, value: Column, bins: int = 5) -> DataFrame:
    """(bin, n), empty bins left out."""
    return df.select(fixed_bins(value, bins).alias("bin")).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))


def placed_quantiles(df: DataFrame, value: str, places: dict[str, float], by: list[str]) -> DataFrame:
    """Per group the values at places floor(n * p) of the sorted list (no interpolation), n and max.

    Equal values are counted first, so a group's work is bounded by its distinct values.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_k"))
    w = Window.partitionBy(*by)
    upto = counted.withColumn("_upto", F.sum("_k").over(w.orderBy(value))).withColumn("_n", F.sum("_k").over(w))
    at = lambda p: F.min(F.when(F.col("_upto") > F.least(F.floor(F.col("_n") * F.lit(p)), F.col("_n") - 1), F.col(value)))
    return upto.groupBy(*by).agg(F.first("_n").alias("n"), *(at(p).alias(name) for name, p in places.items()), F.max(value).alias("max"))


def length_report(df: DataFrame, tokens: str, by: list[str], budget: int) -> DataFrame:
    """Per group n, the lengths at places n // 2 and floor(0.95 n), the greatest, and how many texts
    are over the budget; tokens come of any tokenizer."""
    over = df.filter(F.col(tokens).isNotNull()).groupBy(*by).agg(F.count_if(F.col(tokens) > budget).alias("over_budget"))
    placed = placed_quantiles(df, tokens, {"p50": 0.5, "p95": 0.95}, by)
    same = F.lit(True)
    for c in by:
        same = same & placed[c].eqNullSafe(over[c])
    return placed.join(over, same).select(*(placed[c] for c in by), "n", "p50", "p95", "max", "over_budget")


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """A top-k report for the console: the first n records with the sizes of their lists."""
    cols = [c for c in ("reaction_id", "provenance", "name") if c in df.columns]
    sizes = [F.greatest(F.size(c), F.lit(0)).alias(f"n_{c.split('_')[0]}") for c in ("reactants_smiles", "products_smiles") if c in df.columns]
    first = [F.get("reactants_smiles", F.lit(0)).alias("first_reactant")] if "reactants_smiles" in df.columns else []
    return df.orderBy(*order).limit(n).select(*order, *(c for c in cols if c not in order), *sizes, *first)


def most_common(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values, equal ones in the values' order."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(n)


def tier_totals(rows: DataFrame, sources: DataFrame, source: str, has: Column) -> DataFrame:
    """Records and records with steps per tier; sources has source and tier."""
    return rows.join(sources, source).groupBy("tier").agg(F.count("*").alias("n"), F.sum(has.cast("int")).alias("n_with_mechanism"))


def first_rows(df: DataFrame, order: list[str], n: int, parts: int = 1000) -> DataFrame:
    """The first n rows in order, n of any size: the place of the cut is found from the counts of
    value ranges, and only the range it falls in is ranked. df is read three times."""
    if n <= 0:
        return df.limit(0)
    key = F.struct(*order)
    ranged = df.select(key.alias("_k")).repartitionByRange(parts, "_k").withColumn("_p", F.spark_partition_id())
    per = ranged.groupBy("_p").agg(F.max("_k").alias("_most"), F.count("*").alias("_n")).orderBy("_p").collect()  # at most so many rows as parts
    upto, before = 0, None
    for r in per:
        if upto + r["_n"] >= n:
            break
        upto, before = upto + r["_n"], r["_most"]
    else:
        return df
    value = lambda row: F.struct(*(F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in order))
    inside = df.filter(key <= value(before)) if before is not None else df.limit(0)
    edge = df.filter(key <= value(r["_most"])) if before is None else df.filter((key > value(before)) & (key <= value(r["_most"])))
    return inside.unionByName(edge.orderBy(*order).limit(n - upto))


def capped(df: DataFrame, order: list[str], fraction: float, base: int) -> DataFrame:
    """The first int(f / (1 - f) * base) rows in order, so that they make up at most that fraction."""
    return first_rows(df, order, int(fraction / (1 - fraction) * base))


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key, kept in an aggregate, so no key's rows are gathered."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_b")).select(key, "_b.*").select(df.columns)


def not_done(todo: DataFrame, done: DataFrame, key: str, retry: Column | None = None) -> DataFrame:
    """Rows whose key isn't done yet; with retry, keys whose rows all match it are done again."""
    finished = done if retry is None else done.filter(~F.coalesce(retry, F.lit(False)))
    return todo.join(finished.select(key).distinct(), key, "left_anti")
