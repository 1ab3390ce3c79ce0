"""Training rows: validity bar, split, augmentation of the train side, decontamination, shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import decontaminate as D
from corpusmill.operators import features as FT
from corpusmill.operators import splits as P
from corpusmill.operators import tasks as T
from corpusmill.operators.expand import randomized
from corpusmill.operators.normalize import normalized
from corpusmill.session import staged

SYSTEM = "You answer questions about organic reaction mechanisms."


def clean_mechanisms(records: DataFrame, key: str, least: float = 1.0) -> DataFrame:
    """Records of which at least that fraction of steps has a valid structure, with canonical ones in
    their steps; those without steps are dropped. Each distinct structure is read once."""
    each = records.select(key, F.posexplode("steps").alias("p", "s")).withColumn("m", F.col("s.smiles"))
    done = normalized(each, "m").select(F.col("m").alias("_m"), "canonical", "ok")
    judged = each.join(done, F.col("m").eqNullSafe(F.col("_m")), "left").withColumn("s", F.col("s").withField("canonical", F.col("canonical")).withField("ok", F.col("ok")))
    steps = judged.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "s"))), lambda t: t["s"]).alias("_steps"))
    names = records.schema["steps"].dataType.elementType.names
    kept = T.clean_steps(records.join(steps, key), "_steps", "ok", "canonical", "smiles", least)
    return kept.withColumn("steps", F.transform("_steps", lambda s: F.struct(*(s[n].alias(n) for n in names)))).drop("_steps")


def rows_of(records: DataFrame, key: str, cot: bool = True) -> DataFrame:
    """(key, level, reactants, messages, prompt, reference) of records with steps."""
    rationale = "rationale" if "rationale" in records.schema["steps"].dataType.elementType.names else None
    user = F.concat(F.lit("Reactants: "), T.json_list(F.col("reactants")), F.lit("\nProducts: "), T.json_list(F.col("products")))
    rows = records.filter(F.size("steps") > 0)
    return rows.select(key, "level", "reactants", "products", T.chat(SYSTEM, user, T.answer(F.col("steps"), cot, rationale)).alias("messages"), user.alias("prompt"), T.reference(F.col("steps")).alias("reference"))


def augmented(train: DataFrame, key: str, variants: int) -> DataFrame:
    """Train rows and up to so many copies with redrawn reactants; targets stay as they are. Each
    reactant is redrawn by itself, so lists keep their elements, salts included."""
    if variants <= 0:
        return train.withColumn("variant", F.lit(None).cast("int"))
    parts = train.select(key, F.posexplode("reactants").alias("p", "m")).filter("m != ''")
    drawn = randomized(parts.select(F.struct(key, "p").alias("id"), "m"), "id", "m", variants)
    # where a reactant has fewer drawings than asked for, its last one serves again
    each = drawn.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("variant", "drawing"))).alias("d")).select("id.*", "d", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("variant"))
    picked = each.select(key, "p", "variant", F.get("d", F.least(F.col("variant"), F.size("d") - 1))["drawing"].alias("drawing"))
    lists = picked.groupBy(key, "variant").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "drawing"))), lambda s: s["drawing"]).alias("_r"))
    lists = lists.groupBy(key, "_r").agg(F.min("variant").alias("variant"))
    fresh = lists.join(train, key).filter(F.col("_r") != F.col("reactants"))
    fresh = fresh.withColumn("prompt", F.concat(F.lit("Reactants: "), T.json_list(F.col("_r")), F.lit("\nProducts: "), T.json_list(F.col("products"))))
    fresh = fresh.withColumn("messages", F.transform("messages", lambda m: F.when(m["role"] == "user", F.struct(m["role"].alias("role"), F.col("prompt").alias("content"))).otherwise(m)))
    return train.withColumn("variant", F.lit(None).cast("int")).unionByName(fresh.drop("_r"))


def decontaminated(rows: DataFrame, benchmark: DataFrame, key: str) -> DataFrame:
    """Rows whose reaction isn't the benchmark's, by canonical molecules, skeletons and fingerprints of
    at least 0.95 similarity; steps play no part here. Rows without a reaction stay. Judged once per
    key, on the record's own molecules, so redrawn copies of a removed row go with it."""
    known = featured_sides(benchmark.withColumn(key, F.monotonically_increasing_id()), key)
    own = featured_sides(rows.groupBy(key).agg(F.min_by("reactants", F.coalesce("variant", F.lit(-1))).alias("reactants"), F.min_by("products", F.coalesce("variant", F.lit(-1))).alias("products")), key)
    clean = D.split_clean(D.reasons(own, known, key, "19/20", "fp"))[0].select(key)
    return rows.join(clean, key, "left_semi")


def featured_sides(rows: DataFrame, key: str) -> DataFrame:
    """(key, sig, skel, steps, fp) of reactants and products, keys unique; steps are null."""
    canon = lambda c: F.sort_array(F.collect_list(F.when((F.col("side") == c) & F.col("ok"), F.col("mol_key"))))
    each = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda m: F.struct(F.lit(c).alias("side"), m.alias("m")))
    given = staged(rows.select(key, "reactants", "products"), "sides")
    parts = given.select(key, F.explode(F.concat(each("reactants"), each("products"))).alias("x")).select(key, "x.*")
    sig = parts.join(normalized(parts, "m"), "m").groupBy(key).agg(FT.signature(canon("reactants"), canon("products")).alias("sig"))
    out = FT.skeleton_keys(FT.reaction_bits(given, key, "reactants", "products"), key, ["reactants", "products"])
    skel = FT.signature(F.col("reactants_skeletons"), F.col("products_skeletons"))
    return staged(out.join(sig, key, "left").select(key, "sig", skel.alias("skel"), F.lit(None).cast("string").alias("steps"), "fp"), "sides-featured")


def build(records: DataFrame, benchmark: DataFrame, key: str, fraction: float = 0.03, variants: int = 0, seed: int = P.SEED) -> tuple[DataFrame, DataFrame]:
    """(train, validation): only mechanisms whose structures are all valid, then split, augment train
    only, shuffle, decontaminate both. The order is a contract: copies come of train rows alone, and
    nothing leaks past the last step."""
    rows = staged(rows_of(clean_mechanisms(records, key), key), "training-rows")
    parts = rows.join(P.head_slice(rows.select(key), key, fraction, seed), key)
    train = augmented(parts.filter("split = 'train'").drop("split"), key, variants)
    order = P.hash_order(F.concat_ws("|", F.col(key).cast("string"), F.coalesce(F.col("variant").cast("string"), F.lit(""))), seed)
    shuffled = lambda d: decontaminated(d, benchmark, key).orderBy(order)
    return shuffled(train), shuffled(parts.filter("split = 'validation'").drop("split").withColumn("variant", F.lit(None).cast("int")))


def distillation_prompts(records: DataFrame, key: str) -> DataFrame:
    """Prompts that show the answer and ask for the reasons behind it."""
    steps = T.json_list(F.transform("steps", lambda s: F.concat_ws(": ", s["subtype"], s["smiles"])))
    return records.filter(F.size("steps") > 0).select(key, F.concat(F.lit("Reactants: "), T.json_list(F.col("reactants")), F.lit("\nThe steps are: "), steps, F.lit("\nGive a reason for each step.")).alias("prompt"))
