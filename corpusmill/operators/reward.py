"""Rewards from score components, rejection sampling, round trips, curriculum order, rolling monitor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.session import staged

#: Weights of similarity, validity, format and round trip, and the reward of failures.
W_SIMILAR, W_VALID, W_FORMAT, W_ROUND_TRIP, FAILED = 1.0, 0.10, 0.05, 0.10, -0.5
#: Levels from easy to hard; unknown ones come last.
LEVEL_RANK = {"easy": 0, "medium": 1, "hard": 2}


def completion_text(messages: Column) -> Column:
    """The contents of a chat's turns joined by spaces."""
    return F.array_join(F.transform(messages, lambda m: m["content"]), " ")


def gated(parsed: Column, s_partial: Column, v: Column, round_trip: Column | None = None) -> Column:
    """The reward; failures and outputs without a valid structure get the failure reward."""
    good = W_SIMILAR * s_partial + W_VALID * v + W_FORMAT + (F.lit(0.0) if round_trip is None else W_ROUND_TRIP * F.coalesce(round_trip, F.lit(0.0)))
    return F.when(~F.coalesce(parsed, F.lit(False)) | (F.coalesce(v, F.lit(0.0)) == 0), FAILED).otherwise(good)


def components(parsed: Column, s_partial: Column, v: Column) -> Column:
    """struct(reward, validity, format) from one source for reward and monitor."""
    ok = F.coalesce(parsed, F.lit(False))
    return F.struct(gated(parsed, s_partial, v).alias("reward"), F.when(ok, v).otherwise(0.0).alias("validity"), F.when(ok, W_FORMAT).otherwise(0.0).alias("format"))


def standalone(parsed: Column, n_pred: Column, v: Column, round_trip: Column | None = None) -> dict[str, Column]:
    """The signals that also stand alone: validity, format and round trip; 0 for outputs without steps,
    and for a round trip on which the model abstains."""
    ok = F.coalesce(parsed & (n_pred > 0), F.lit(False))
    given = lambda c: F.when(ok, F.coalesce(c, F.lit(0.0))).otherwise(0.0)
    return {"validity": given(v), "format": F.when(ok, 1.0).otherwise(0.0), "round_trip": given(F.lit(0.0) if round_trip is None else round_trip)}


def composed(kind: str, parsed: Column, n_pred: Column, s_partial: Column, v: Column, round_trip: Column | None = None) -> dict[str, Column]:
    """The rewards of a training run by name: omes has the gated reward, validity and format;
    omes+roundtrip also counts the round trip, in the reward and by itself. Others are an error."""
    if kind not in ("omes", "omes+roundtrip"):
        raise ValueError(f"unknown reward {kind}")
    with_trip = kind == "omes+roundtrip"
    alone = standalone(parsed, n_pred, v, round_trip)
    out = {"reward": gated(parsed & (n_pred > 0), s_partial, v, round_trip if with_trip else None), "validity": alone["validity"], "format": alone["format"]}
    return out | ({"round_trip": alone["round_trip"]} if with_trip else {})


def accepted(attempts: DataFrame, key: str, attempt: str, threshold: float = 0.9, validity: float = 1.0, most: int = 1) -> DataFrame:
    """The first of at most so many attempts per key that parses and reaches both bounds."""
    good = attempts.filter((F.col(attempt) <= most) & F.col("parsed") & (F.col("s_partial") >= threshold) & (F.col("v") >= validity))
    w = Window.partitionBy(key).orderBy(attempt)
    return good.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def round_trip(steps: DataFrame, key: str, pos: str, verdict: str) -> DataFrame:
    """(key, fraction) of feasible steps after the first; null where every verdict abstains."""
    after = steps.withColumn("_p", F.row_number().over(Window.partitionBy(key).orderBy(pos)))
    return after.groupBy(key).agg(F.avg(F.when(F.col("_p") > 1, F.col(verdict).cast("int"))).alias("fraction"))


def chained(steps: DataFrame, key: str, pos: str, form: str, start: Column) -> DataFrame:
    """Adds pair: the structure before and this one; the first comes from start."""
    w = Window.partitionBy(key).orderBy(pos)
    return steps.withColumn("pair", F.concat_ws(">>", F.coalesce(F.lag(form).over(w), start), form))


def level_rank(level: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in LEVEL_RANK.items() for x in kv))[level], F.lit(99))


def curriculum(rows: DataFrame, level: str, pos: str) -> DataFrame:
    """Rows from easy to hard, each level in its original order."""
    return rows.withColumn("level_rank", level_rank(F.col(level))).orderBy("level_rank", pos)


def level_histogram(rows: DataFrame, level: str) -> DataFrame:
    """(level, n), null and empty as unknown."""
    return rows.groupBy(F.coalesce(F.when(F.col(level) != "", F.col(level)), F.lit("unknown")).alias("level")).agg(F.count("*").alias("n"))


def rolling(log: DataFrame, order: list[str], cols: list[str], by: list[str] | None = None, window: int = 256, parts: int | None = None) -> DataFrame:
    """Adds mean_<col> over the last observations of a series and their number; by splits into series.
    order tells rows of a series apart.

    The log is cut into ranges of by and order, each the work of one task however long a series is;
    the last rows of a range go along to the ranges behind it that still see them.
    """
    by = by or []
    parts = parts or max(1, int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the ranges are sampled, so they are fixed by being written
    ranged = staged(log.repartitionByRange(parts, *by, *order).withColumn("_p", F.spark_partition_id()), "rolling")
    series = Window.partitionBy(*by)
    sizes = ranged.groupBy(*by, "_p").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(series.orderBy("_p")))
    # ranges behind, with the rows of the series in between: each holds a row, so window of them suffice
    behind = F.collect_list(F.struct(F.col("_p").alias("p"), (F.col("_upto") - F.col("_n")).alias("start"))).over(series.orderBy("_p").rowsBetween(1, window))
    reach = sizes.withColumn("_behind", F.filter(behind, lambda x: x["start"] - F.col("_upto") < window - 1)).filter(F.size("_behind") > 0)
    last = ranged.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_p").orderBy(*(F.col(c).desc() for c in order)))).filter(F.col("_r") < window)
    same = F.col("_p") == F.col("_q")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    seen = last.join(reach.select(F.col("_p").alias("_q"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(by)), "_upto", "_behind"), same)
    carried = seen.select(*log.columns, "_r", "_upto", F.explode("_behind").alias("_b")).filter(F.col("_r") + F.col("_b.start") - F.col("_upto") < window).select(*log.columns, F.col("_b.p").alias("_p"), F.lit(False).alias("_own"))
    every = ranged.withColumn("_own", F.lit(True)).unionByName(carried)
    w = Window.partitionBy(*by, "_p").orderBy(*order).rowsBetween(1 - window, 0)
    out = every.withColumn("observed", F.count("*").over(w))
    for c in cols:
        out = out.withColumn(f"mean_{c}", F.avg(c).over(w))
    return out.filter("_own").drop("_own", "_p")


def validity_alarm(rolled: DataFrame, mean: str, floor: float = 0.8, window: int = 256) -> DataFrame:
    """Adds alarm: the mean is below the floor and enough observations are in."""
    return rolled.withColumn("alarm", F.coalesce((F.col("observed") >= max(8, window // 4)) & (F.col(mean) < floor), F.lit(False)))


def feasible(steps: DataFrame, form: str, model=None) -> DataFrame:
    """Adds verdict from a forward model (text -> True, False or None); without one all abstain."""
    import pyarrow as pa

    if model is None:
        return steps.withColumn("verdict", F.lit(None).cast("boolean"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model(x) for x in b.column(0).to_pylist()], pa.bool_())], names=[form, "verdict"])

    done = steps.select(form).distinct().mapInArrow(run, f"`{form}` string, verdict boolean")
    return steps.join(done.withColumnRenamed(form, "_f"), F.col(form).eqNullSafe(F.col("_f")), "left").drop("_f")
