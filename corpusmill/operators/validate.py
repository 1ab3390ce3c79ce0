"""Structural and step-by-step validation with reason codes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import smiles as S
from corpusmill.session import spread, staged

#: The largest change of heavy atoms and charge in one step, the joining tolerance,
#: and the least shared fraction for trusted and for inferred records.
HEAVY_DELTA, CHARGE_DELTA, JOIN_TOLERANCE, SHARED_TRUSTED, SHARED_INFERRED = 6, 2, 1, 0.34, 0.55
#: Fixed values.
PROVENANCES, LEVELS = ("curated", "template_expanded", "inferred"), ("easy", "medium", "hard")


def structural_problems(required: dict[str, Column], domains: dict[str, tuple[Column, tuple[str, ...]]]) -> Column:
    """The problems of a row as a list: missing_<name> and bad_<name>."""
    missing = [F.when(c.isNull() | (c == ""), f"missing_{n}") for n, c in required.items()]
    bad = [F.when(c.isNotNull() & ~c.isin(*ok), f"bad_{n}") for n, (c, ok) in domains.items()]
    return F.filter(F.array(*missing, *bad), lambda p: p.isNotNull())


def measured(steps: DataFrame, form: str) -> DataFrame:
    """Adds parse_ok, charge, heavy and counts (element -> number, no hydrogens) of a structure
    column; each distinct structure is parsed once."""

    def run(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            got = [S.measure(t) for t in texts]
            f = [None if x is None else x[0] for x in got]
            heavy = [None if x is None else {k: v for k, v in x.items() if k != "H"} for x in f]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x is not None for x in f]), pa.array([None if x is None else x[1] for x in got], pa.int32()), pa.array([None if h is None else sum(h.values()) for h in heavy], pa.int32()), pa.array([None if h is None else sorted(h.items()) for h in heavy], pa.map_(pa.string(), pa.int32()))],
                names=[form, "parse_ok", "charge", "heavy", "counts"],
            )

    done = spread(steps.select(form).distinct(), form).mapInArrow(run, f"`{form}` string, parse_ok boolean, charge int, heavy int, counts map<string,int>")
    return steps.join(done.withColumnRenamed(form, "_f"), F.col(form).eqNullSafe(F.col("_f")), "left").drop("_f")


def count_delta(a: Column, b: Column) -> Column:
    """Sum of absolute differences of two element maps; null if either is null."""
    zipped = F.map_zip_with(a, b, lambda k, x, y: F.abs(F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0))))
    return F.aggregate(F.map_values(zipped), F.lit(0), lambda s, x: s + x)


def shared_fractions(pairs: DataFrame) -> DataFrame:
    """(before, after, floor, shared), each distinct pair of structures once; shared is null where unknown."""

    def run(batches):
        for b in batches:
            got = [S.continuous(*x) for x in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=["before", "after", "floor", "shared"])

    return spread(pairs.select("before", "after", "floor").distinct(), "before", "after").mapInArrow(run, "before string, after string, floor double, shared double")


def seeds(steps: DataFrame, start: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, floor, seed, sizes, whole) out of (key, reactants, provenance), keys unique: the least
    shared fraction, the formula and charge of the reactant nearest to the first step, all reactants'
    heavy atoms, and their text."""
    first = steps.groupBy(key).agg(F.min_by("counts", pos).alias("_first"))
    parts = start.select(key, F.posexplode("reactants").alias("i", "m"))
    known = measured(parts, "m").filter("parse_ok").join(first, key)
    far = count_delta(F.col("counts"), F.col("_first"))
    best = known.groupBy(key).agg(F.min_by(F.struct("counts", "charge"), F.when(far.isNotNull(), F.struct(far, "i"))).alias("seed"), F.collect_list("heavy").alias("sizes"))
    floor = F.when(F.col("provenance") == "inferred", SHARED_INFERRED).otherwise(SHARED_TRUSTED)
    return start.select(key, floor.alias("floor"), F.array_join("reactants", ".").alias("whole")).join(best, key, "left")


def step_reasons(steps: DataFrame, key: str, pos: str, form: str, shared: Column | None = None, floor: float = SHARED_TRUSTED, start: DataFrame | None = None) -> DataFrame:
    """Adds reasons to measured steps: everything wrong with the step, in a list.

    Each step is compared with the one before it by lag; an unparseable step is reported twice, as a
    structure and as one without a balance, and the next one is then compared with nothing. A large change still passes if the shared fraction
    (a column, null meaning unknown) reaches the floor or is unknown when given. Positions count
    from 0, reasons name steps from 1.

    With start (key, reactants, provenance; keys unique) the first step is compared with the reactant
    nearest to it, and a large change passes if it is the size of a reactant that joins or leaves,
    or if the structures share enough; that is computed for these few pairs only.
    """
    if start is not None:
        steps = staged(steps, "steps-measured")  # read twice, for the seeds, too
    w = Window.partitionBy(key).orderBy(pos)
    ok = F.coalesce(F.col("parse_ok"), F.lit(False))
    n = (F.col(pos) + 1).cast("string")
    before = steps.withColumn("_form", F.lag(form).over(w)).withColumn("_ok", F.lag(ok).over(w)).withColumn("_counts", F.lag("counts").over(w)).withColumn("_charge", F.lag("charge").over(w))
    delta, jump = count_delta(F.col("_counts"), F.col("counts")), F.abs(F.col("charge") - F.col("_charge"))
    fine = (delta <= HEAVY_DELTA) if shared is None else (delta <= HEAVY_DELTA) | F.coalesce(shared >= floor, F.lit(True))
    if start is not None:
        at_start = F.row_number().over(w) == 1
        before = before.withColumn("_start", at_start).join(seeds(steps, start, key, pos), key, "left")
        for c, seed in (("_ok", F.col("seed").isNotNull()), ("_counts", F.col("seed.counts")), ("_charge", F.col("seed.charge"))):
            before = before.withColumn(c, F.when(F.col("_start"), seed).otherwise(F.col(c)))
        joined = F.coalesce(F.exists("sizes", lambda s: F.abs(delta - s) <= JOIN_TOLERANCE), F.lit(False))
        before = staged(before.withColumn("_small", (delta <= HEAVY_DELTA) | joined).withColumn("_before", F.when(F.col("_start"), F.col("whole")).otherwise(F.col("_form"))).withColumn("floor", F.coalesce("floor", F.lit(SHARED_TRUSTED))), "steps-before")
        costly = before.filter(ok & F.col("_ok") & ~F.col("_small")).select(F.col("_before").alias("before"), F.col(form).alias("after"), "floor")
        found = shared_fractions(costly).withColumnsRenamed({"before": "_before", "after": form, "floor": "floor"})
        before = before.join(found, ["_before", form, "floor"], "left").select(*before.columns, "shared")
        fine = F.col("_small") | F.coalesce(F.col("shared") >= F.col("floor"), F.lit(True))
    compared = ok & F.coalesce(F.col("_ok"), F.lit(False))
    why = F.array(
        F.when(~ok, F.concat(F.lit("sanitize_fail:step"), n)),
        F.when(~ok, F.concat(F.lit("balance_unparseable:step"), n)),
        F.when(ok & (F.col("_form") == F.col(form)), F.concat(F.lit("noop_step:step"), n)),
        F.when(compared & ~fine, F.concat(F.lit("discontinuous_step:step"), n, F.lit("(heavy_delta="), delta.cast("string"), F.lit(")"))),
        F.when(compared & (jump > CHARGE_DELTA), F.concat(F.lit("charge_jump:step"), n, F.lit("(delta="), jump.cast("string"), F.lit(")"))),
    )
    return before.withColumn("reasons", F.array_compact(why)).select(*steps.columns, "reasons")


def side_reasons(records: DataFrame, key: str, sides: list[str]) -> DataFrame:
    """(key, reasons): sanitize_fail:<side> of each list column with a structure that can't be read;
    keys without any are left out."""
    each = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda m: F.struct(F.lit(c).alias("side"), m.alias("m")))
    parts = records.select(key, F.explode(F.concat(*(each(c) for c in sides))).alias("x")).select(key, "x.side", "x.m")
    bad = measured(parts, "m").filter(~F.coalesce("parse_ok", F.lit(False)))
    return bad.groupBy(key).agg(F.transform(F.collect_set("side"), lambda c: F.concat(F.lit("sanitize_fail:"), c)).alias("reasons"))


#: What each persisted check forbids.
CHECKS = {"sanitized": ("sanitize_fail",), "atom_balanced": ("discontinuous_step",), "charge_balanced": ("charge_jump",), "step_continuity": ("discontinuous_step", "charge_jump", "noop_step"), "no_noop_steps": ("noop_step",)}


def checks(judged: DataFrame, key: str, sides: DataFrame | None = None) -> DataFrame:
    """Per record the checks and the sorted distinct reasons; with sides (key, reasons) those, too."""
    every = judged.select(key, "reasons") if sides is None else judged.select(key, "reasons").unionByName(sides.select(key, "reasons"))
    out = every.groupBy(key).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("reasons")))).alias("reasons"))
    free = lambda kinds: ~F.exists("reasons", lambda r: F.substring_index(r, ":", 1).isin(*kinds))
    return out.select(key, *(free(kinds).alias(c) for c, kinds in CHECKS.items()), "reasons")


def reject_breakdown(rejects: DataFrame, reasons: str = "reasons") -> DataFrame:
    """(reason, n) by the reason before its bracket."""
    return rejects.select(F.explode(reasons).alias("r")).groupBy(F.substring_index("r", "(", 1).alias("reason")).agg(F.count("*").alias("n"))


def pass_counts(rows: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """(check, passed, failed, unknown) for boolean columns, one row each."""
    stacked = rows.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), c.alias("ok")) for n, c in cols.items()))).alias("x")).select("x.*")
    count = lambda c: F.sum(c.cast("int")).cast("bigint")
    ok = F.col("ok")
    return stacked.groupBy("check").agg(count(F.coalesce(ok, F.lit(False))).alias("passed"), count(F.coalesce(~ok, F.lit(False))).alias("failed"), count(ok.isNull()).alias("unknown"))


def staged_filter(df: DataFrame, cheap: Column, costly) -> DataFrame:
    """Rows that pass the cheap test, and of the others those that the costly one keeps: Catalyst
    promises no order around Python functions, so the costly one gets only what needs it."""
    passed = F.coalesce(cheap, F.lit(False))
    return df.filter(passed).unionByName(costly(df.filter(~passed)))
