"""The curation pipeline: every phase a function from frames to frames, written and reported in between.

Records have record_id, source, provenance, level, name, reactants and products (lists of
structures), conditions and steps (array<struct<step, type, subtype, smiles, rationale>>; the number
and the reason given for a step are carried through). Phase results can be
written as tables; nothing but counts comes to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import aggregates as A
from corpusmill.operators import decontaminate as D
from corpusmill.operators import dedup as U
from corpusmill.operators import expand as X
from corpusmill.operators import features as FT
from corpusmill.operators import normalize as N
from corpusmill.operators import ontology as O
from corpusmill.operators import splits as P
from corpusmill.operators import tasks as T
from corpusmill.operators import validate as V
from corpusmill.plans.export import gate, write_phase, write_rejects
from corpusmill.session import staged

RECORD = "record_id string, source string, license string, provenance string, level string, name string, reactants array<string>, products array<string>, conditions string, steps array<struct<step:int,type:string,subtype:string,smiles:string,rationale:string>>"


STEPS = "array<struct<step:int,type:string,subtype:string,smiles:string,rationale:string>>"


def _clean_steps(records: DataFrame) -> DataFrame:
    """Steps with the fields of STEPS alone; missing ones are null."""
    have = records.schema["steps"].dataType.elementType.names
    names = ("step", "type", "subtype", "smiles", "rationale")
    return records.withColumn("steps", F.transform("steps", lambda s: F.struct(*((s[n] if n in have else F.lit(None)).cast("int" if n == "step" else "string").alias(n) for n in names))))


def _gathered(steps: DataFrame, pos: str) -> DataFrame:
    """(record_id, x): the steps in order, out of rows with their fields."""
    return steps.groupBy("record_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(pos, F.struct("step", "type", "subtype", "smiles", "rationale").alias("s")))), lambda t: t["s"]).alias("x"))


@dataclass
class Run:
    """Frames and gate reports of one run; with a folder every phase is also written there."""

    folder: str | None = None
    gates: dict[str, dict] = field(default_factory=dict)
    kernel: N.Kernel | None = None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        if self.folder is None:
            return staged(df, name)
        write_phase(df, f"{self.folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def normalize_phase(run: Run, records: DataFrame) -> DataFrame:
    """Canonical structures on both sides and in the steps (failures keep their text), molecule keys,
    and the level where it is missing."""
    k = run.kernel or N.SmilesKernel()
    records = _clean_steps(records)
    forms = records.select(F.explode(F.concat(F.coalesce("reactants", F.array()), F.coalesce("products", F.array()), F.coalesce(F.transform("steps", lambda s: s["smiles"]), F.array()))).alias("m"))
    done = run.keep(N.normalized(forms, "m", k), "molecules")
    names = done.select("m", "canonical", "mol_key", "ok")

    def side(df: DataFrame, col: str) -> DataFrame:
        parts = df.select("record_id", F.posexplode(col).alias("p", "m")).join(names, "m", "left")
        agg = parts.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("p", F.coalesce("canonical", "m").alias("c"), F.when(F.col("ok"), F.col("mol_key")).alias("k")))).alias("x"))
        return df.join(agg, "record_id", "left").withColumn(col, F.coalesce(F.transform("x", lambda s: s["c"]), F.array().cast("array<string>"))).withColumn(f"{col}_keys", F.coalesce(F.transform("x", lambda s: s["k"]), F.array().cast("array<string>"))).drop("x")

    out = side(side(records, "reactants"), "products")
    parts = records.select("record_id", F.posexplode("steps").alias("p", "s")).select("record_id", "p", "s.*").join(names.withColumnRenamed("m", "smiles"), "smiles", "left")
    steps = _gathered(parts.withColumn("smiles", F.coalesce("canonical", "smiles")), "p")
    out = out.drop("steps").join(steps, "record_id", "left").withColumn("steps", F.coalesce("x", F.array().cast(STEPS))).drop("x")
    out = out.withColumn("level", F.coalesce("level", N.level_of(F.size("steps")))).withColumn("is_template", N.is_template(F.concat("reactants", "products", F.transform("steps", lambda s: s["smiles"]))))
    run.gates["normalize"] = gate("normalize", done.agg(F.count("*").alias("molecules"), F.count_if("ok").alias("ok")))
    return run.keep(out, "normalized")


def type_phase(run: Run, records: DataFrame, allowed: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps remapped to allowed pairs; records with a step that can't be go to the rejects."""
    steps = records.select("record_id", F.posexplode("steps").alias("pos", "s")).select("record_id", "pos", "s.*")
    good, rejects = O.remap(steps, allowed, moves, "record_id", "pos")
    again = _gathered(good, "pos")
    rejects = run.keep(rejects, "typing_rejects")
    out = records.join(rejects.select("record_id"), "record_id", "left_anti").drop("steps").join(again, "record_id", "left").withColumn("steps", F.coalesce("x", F.array().cast(STEPS))).drop("x")
    out = run.keep(out, "typed")
    run.gates["type"] = gate("type", out.agg(F.count("*").alias("kept")).crossJoin(rejects.agg(F.count("*").alias("rejected"))))
    return out, rejects


def expand_phase(run: Run, typed: DataFrame, most: int = X.MOST) -> DataFrame:
    """Instances of templates with a product that isn't known yet, added to the typed records."""
    templates = typed.filter("is_template")
    made = X.expanded(templates.withColumn("forms", F.transform("steps", lambda s: s["smiles"])), "record_id", "reactants", "products", "forms", most)
    known = typed.filter("not is_template").select(F.explode("products").alias("m"))
    new = X.unknown_only(made, known, "instance_id", "products", "m")
    rows = new.join(templates.select("record_id", "source", "license", "level", "name", "conditions", F.col("steps").alias("old")), "record_id")
    steps = F.transform(F.arrays_zip("old", "step_forms"), lambda z: z["old"].withField("smiles", z["step_forms"]))
    fresh = rows.select(F.col("instance_id").alias("record_id"), "source", "license", F.lit("template_expanded").alias("provenance"), "level", "name", "reactants", "products", "conditions", steps.alias("steps"), F.lit(False).alias("is_template"))
    k = lambda c: F.transform(c, lambda m: F.concat(F.lit("SMI:"), m))
    out = run.keep(typed.unionByName(fresh.withColumn("reactants_keys", k("reactants")).withColumn("products_keys", k("products"))), "expanded")
    run.gates["expand"] = gate("expand", out.agg(F.count("*").alias("records"), F.count_if(F.col("provenance") == "template_expanded").alias("expanded")))
    return out


def infer_phase(run: Run, records: DataFrame, fraction: float = 0.20) -> DataFrame:
    """Step-less records get the steps of the first template of their name, so many at most that
    they make up the fraction."""
    have, lack = records.filter(F.size("steps") > 0), records.filter(F.size("steps") == 0)
    found = X.inferred(lack.drop("steps"), have.filter("is_template").select("name", "record_id", "steps"), "name", ["record_id"], ["steps"])
    kept = A.capped(staged(found, "inferred-all"), ["record_id"], fraction, have.count())
    out = run.keep(have.unionByName(kept.select(have.columns)), "inferred")
    run.gates["infer"] = gate("infer", out.agg(F.count("*").alias("records"), F.count_if(F.col("provenance") == "inferred").alias("inferred")))
    return out


def validate_phase(run: Run, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid concrete records with their checks, rejects with reasons)."""
    concrete = records.filter("not is_template")
    steps = concrete.select("record_id", F.posexplode("steps").alias("pos", "s")).select("record_id", "pos", "s.*")
    judged = V.checks(V.step_reasons(V.measured(steps, "smiles"), "record_id", "pos", "smiles", start=concrete.select("record_id", "reactants", "provenance")), "record_id", V.side_reasons(concrete, "record_id", ["reactants", "products"]))
    both = run.keep(concrete.join(judged, "record_id", "left"), "checked")
    bad = F.coalesce(F.size("reasons") > 0, F.lit(False))
    checks = F.struct(*(F.coalesce(c, F.lit(True)).alias(c) for c in V.CHECKS))
    out = both.filter(~bad).withColumn("checks", checks).drop(*V.CHECKS, "reasons")
    rejects = both.filter(bad).select("record_id", "source", "reasons")
    run.gates["validate"] = gate("validate", both.agg(F.count_if(~bad).alias("valid"), F.count_if(bad).alias("rejected")))
    return out, rejects


def featured(records: DataFrame) -> DataFrame:
    """Signature, skeleton, step hash, reaction fingerprint and product bucket: computed once, used
    by decontamination and dedup."""
    out = records.withColumn("sig", FT.signature(F.col("reactants_keys"), F.col("products_keys"))).withColumn("step_hash", FT.step_hash(F.col("steps"), "subtype", "smiles"))
    out = FT.skeleton_keys(FT.reaction_bits(out, "record_id", "reactants", "products"), "record_id", ["reactants", "products"])
    whole = F.col("sig").isNotNull()  # without a signature a record has no skeleton and no bucket
    out = out.withColumn("skel", F.when(whole, FT.signature(F.col("reactants_skeletons"), F.col("products_skeletons")))).withColumn("bucket", F.when(whole, F.get("products_skeletons", F.lit(0))))
    return staged(out.drop("reactants_skeletons", "products_skeletons"), "featured")


def decontaminate_phase(run: Run, records: DataFrame, *benchmarks: DataFrame) -> DataFrame:
    """Records without those that any of the held-out corpora (gold, templates) contains; fails if any
    leak remains."""
    held_out = [featured(b).select("sig", "skel", F.col("step_hash").alias("steps"), "fp") for b in benchmarks]
    f, b = featured(records), D.blacklist(*held_out)
    judged = run.keep(D.reasons(f.withColumnRenamed("steps", "_steps").withColumnRenamed("step_hash", "steps"), b, "record_id", "19/20", "fp"), "judged")
    kept, removed = D.split_clean(judged)
    leaks = D.leaks(kept, b).first()["leaks"]
    run.gates["decontaminate"] = gate("decontaminate", judged.agg(F.count("*").alias("candidates"), F.count("reason").alias("removed"))) | {"leaks": leaks}
    if leaks:
        raise RuntimeError(f"{leaks} records still match the benchmark")
    return kept.withColumnRenamed("steps", "step_hash").withColumnRenamed("_steps", "steps")


def dedup_phase(run: Run, records: DataFrame) -> DataFrame:
    """One record of each cluster of equal signatures, equal step hashes or similar fingerprints
    within a product bucket."""
    clustered = U.clusters(records, "record_id", ["sig", "step_hash"], "fp", "97/100", "bucket")
    out = run.keep(U.representatives(records, clustered, "record_id", [-U.provenance_rank(F.col("provenance")), -F.size("steps")]).drop("cluster", "fp", "bucket"), "deduped")
    run.gates["dedup"] = gate("dedup", out.agg(F.count("*").alias("kept")))
    return out


def format_phase(run: Run, records: DataFrame, system: str = "You answer questions about organic reaction mechanisms.") -> DataFrame:
    """All task rows as (record_id, task, user, assistant, messages, reference)."""
    conditions = F.col("conditions")
    user = F.concat(F.lit("Give the full mechanism.\nReactants: "), T.json_list(F.col("reactants")), F.lit("\nProducts: "), T.json_list(F.col("products")))
    nxt = T.next_step(records, "record_id", "steps").select("record_id", F.lit("mechanism_next_step").alias("task"), F.concat(F.lit("Steps so far: "), T.json_list(F.transform("done", lambda s: s["smiles"])), F.lit("\nGive the next step.")).alias("user"), F.col("smiles").alias("assistant"))
    out = T.union_tasks(
        T.mechanism_full(records, "record_id", "steps", user, system, "rationale"), nxt, T.forward_prediction(records, "record_id", "reactants", "products", conditions), T.retrosynthesis(records, "record_id", "reactants", "products"), T.reagent_prediction(records, "record_id", "reactants", "products", conditions)
    )
    out = run.keep(out, "tasks")
    run.gates["format"] = gate("format", out.agg(F.count("*").alias("rows"), F.countDistinct("task").alias("tasks")))
    return out


def split_phase(run: Run, records: DataFrame, fraction: float = 0.05) -> DataFrame:
    """(record_id, dominant, level, split)."""
    kinds = P.dominant(records.select("record_id", F.transform("steps", lambda s: s["subtype"]).alias("x")), "record_id", "x")
    out = run.keep(P.stratified(records.select("record_id", "level").join(kinds, "record_id"), "record_id", ["dominant", "level"], fraction), "split")
    run.gates["split"] = gate("split", out.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "validation").alias("n_val"), F.countDistinct("dominant", "level").alias("strata")))
    return out


def curate(records: DataFrame, benchmark: DataFrame | list[DataFrame], allowed: DataFrame, moves: DataFrame, folder: str | None = None, fraction: float = 0.05) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """(clean records, task rows, split, gates): all phases in order; benchmark is the held-out corpus
    or a list of them. With a folder the phases, their rejects and the report are written there."""
    run = Run(folder)
    typed, _ = type_phase(run, normalize_phase(run, records), allowed, moves)
    valid, rejects = validate_phase(run, infer_phase(run, expand_phase(run, typed)))
    if folder is not None:
        write_rejects(rejects, f"{folder}/rejects")
    held_out = [normalize_phase(Run(None), b) for b in (benchmark if isinstance(benchmark, list) else [benchmark])]
    clean = dedup_phase(run, decontaminate_phase(run, valid, *held_out))
    return clean, format_phase(run, clean), split_phase(run, clean, fraction), run.gates


def records_of(table: DataFrame, chats: DataFrame) -> DataFrame:
    """The pipeline's records out of the driver's tables; a record's steps are its reference."""
    ref = chats.filter("task = 'mechanism_full'").groupBy("record_no").agg(F.min_by("reference", "row_id").alias("r"))
    trim: Column = lambda c: F.transform(c, lambda m: F.trim(m))
    steps = F.coalesce(F.transform("r", lambda s, i: F.struct((i + 1).alias("step"), F.lit("step").alias("type"), s["subtype"].alias("subtype"), s["smiles"].alias("smiles"), F.lit(None).cast("string").alias("rationale"))), F.array().cast(STEPS))
    return table.join(ref, "record_no", "left").select(F.col("record_no").cast("string").alias("record_id"), "source", "license", "provenance", "level", "name", trim("reactants_smiles").alias("reactants"), trim("products_smiles").alias("products"), "conditions", steps.alias("steps"), "split")
