"""Queries of the record-level operators: normalisation, ontology, validation, signatures."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.text import LEVEL_ALIASES, category
from corpusmill.operators import aggregates as A
from corpusmill.operators import expand as X
from corpusmill.operators import features as FT
from corpusmill.operators import normalize as N
from corpusmill.operators import ontology as O
from corpusmill.operators import validate as V
from corpusmill.queries import query
from corpusmill.queries.common import COLLAPSED, FULL, MOLECULES, STEPS, full_rows, molecules, records, steps
from corpusmill.session import table


@query(f"with {FULL} select row_id, len(reference)::bigint as n_steps, case when len(reference) <= 3 then 'easy' when len(reference) <= 6 then 'medium' else 'hard' end as level from full_rows")
def level_from_steps(spark, d):
    return full_rows(spark, d).select("row_id", F.size("reference").cast("bigint").alias("n_steps"), N.level_of(F.size("reference")).alias("level"))


@query("select record_no, array_to_string(list_filter(string_split(array_to_string(products_smiles, '.'), '.'), lambda x: x <> ''), ' ') as parts from mechanism_records where products_smiles is not null")
def coerce_list(spark, d):
    return records(spark, d).filter("products_smiles is not null").select("record_no", F.array_join(N.as_list(F.array_join("products_smiles", ".")), " ").alias("parts"))


@query(
    r"""
with f as (select record_no, string_split(regexp_extract(trim(reaction_smiles_mapped), '^(\S*)', 1), '>') as p from mechanism_records where reaction_smiles_mapped is not null),
s as (select record_no, len(p) as n, list_filter(string_split(p[1], '.'), lambda x: x <> '') as r, list_filter(string_split(p[2], '.'), lambda x: x <> '') as a, list_filter(string_split(p[3], '.'), lambda x: x <> '') as q from f)
select record_no, array_to_string(r, ' ') as reactants, array_to_string(a, ' ') as agents, array_to_string(q, ' ') as products from s where n = 3 and len(r) > 0 and len(q) > 0"""
)
def reaction_split(spark, d):
    p = records(spark, d).select("record_no", N.reaction_parts(F.col("reaction_smiles_mapped")).alias("p")).filter("p is not null")
    return p.select("record_no", *(F.array_join(f"p.{c}", " ").alias(c) for c in ("reactants", "agents", "products")))


@query(rf"select doc_id, nullif(substr(string_split({'trim(text)'}, chr(10) || chr(10))[1], 1, 1200), '') as summary from documents")
def page_summary(spark, d):
    return table(spark, d, "documents").select("doc_id", N.first_paragraph(F.col("text")).alias("summary"))


@query(f"with {MOLECULES}, k as (select *, {COLLAPSED.format('molecule')} as key from molecules) select key as mol_key, min(molecule) as canonical, count(*) as n, array_to_string(list_sort(list_distinct(list(source))), ',') as sources from k where key <> '' group by key")
def molecule_vocab(spark, d):
    m = molecules(spark, d).withColumn("mol_key", F.trim(F.regexp_replace(F.lower("molecule"), r"\s+", " "))).filter("mol_key <> ''")
    return N.vocabulary(m, "mol_key", "molecule", "source", ["molecule"]).withColumn("sources", F.array_join("sources", ","))


@query()
def molecule_normalization(spark, d):
    """The line-formula kernel over every distinct molecule: canonical text, key and reason."""
    return N.normalized(molecules(spark, d), "molecule")


@query("select source, count(*) as n, sum(case when checks.sanitized then 1 else 0 end)::bigint as n_ok, round(100 * sum(case when checks.sanitized then 1 else 0 end) / count(*), 4)::double as pct from mechanism_records group by source")
def sanitize_stats(spark, d):
    return N.sanitize_stats(records(spark, d), "source", "checks.sanitized")


@query(f"with {STEPS} select 'step' as type, subtype, count(*) as n from steps where subtype is not null group by subtype")
def ontology_pair_counts(spark, d):
    return O.pair_counts(steps(spark, d).withColumn("kind", F.lit("step")), "kind", "subtype")


@query(
    f"""with {STEPS}, used as (select distinct 'step' as type, subtype from steps where subtype is not null),
allowed as (select distinct 'step' as type, unnest(subtypes) as subtype from templates)
select 'not_allowed' as problem, type || '/' || subtype as value from (select * from used except select * from allowed)
union all select 'unused', type || '/' || subtype from (select * from allowed except select * from used)"""
)
def ontology_crosscheck(spark, d):
    allowed = table(spark, d, "templates").select(F.lit("step").alias("type"), F.explode("subtypes").alias("subtype"))
    return O.cross_check(steps(spark, d).filter("subtype is not null").withColumn("type", F.lit("step")), allowed)


#: Moves of the remap queries: from, to; null for an explicit reject.
MOVES = [("step", "dissociation", "step", "heterolytic_cleavage"), ("step", "coordination", None, None), ("step", "group_transfer", "step", "transfer")]
_REMAP = f"""with {STEPS},
allowed as (select distinct subtype from steps where subtype not in ('dissociation', 'coordination', 'group_transfer', 'cycloreversion')),
judged as (select *, case when subtype in (select subtype from allowed) then null when subtype = 'dissociation' then case when 'heterolytic_cleavage' in (select subtype from allowed) then null else 'remap_target_not_allowed:step/heterolytic_cleavage' end
  when subtype = 'coordination' then 'unmapped_step_type:step::coordination(explicit_reject)' when subtype = 'group_transfer' then 'remap_target_not_allowed:step/transfer'
  else 'unmapped_step_type:step::' || coalesce(subtype, 'None') end as why from steps),
rejects as (select row_id, arg_min(why, pos) as reason from judged where why is not null group by row_id)"""


def _remapped(spark, d):
    s = steps(spark, d).withColumn("type", F.lit("step"))
    allowed = s.filter("subtype not in ('dissociation', 'coordination', 'group_transfer', 'cycloreversion')").select("type", "subtype").distinct()
    moves = spark.createDataFrame(MOVES, "from_type string, from_subtype string, to_type string, to_subtype string")
    return O.remap(s, allowed, moves, "row_id", "pos")


@query(_REMAP + " select row_id, reason from rejects")
def ontology_rejects(spark, d):
    return _remapped(spark, d)[1]


@query(_REMAP + " select j.row_id, pos, case when subtype = 'dissociation' then 'heterolytic_cleavage' else subtype end as subtype, case when subtype = 'dissociation' then 'step::dissociation' end as remapped_from from judged j anti join rejects r on j.row_id = r.row_id")
def ontology_remap(spark, d):
    return _remapped(spark, d)[0].select("row_id", "pos", "subtype", "remapped_from")


@query(f"with {STEPS}, c as (select subtype, count(*) as n from steps group by 1), a as (select distinct unnest(subtypes) as subtype from templates) select a.subtype, coalesce(n, 0) as n from a left join c using (subtype) where coalesce(n, 0) < 5")
def under_covered(spark, d):
    allowed = table(spark, d, "templates").select(F.explode("subtypes").alias("subtype"))
    return O.under_covered(steps(spark, d).groupBy("subtype").agg(F.count("*").alias("n")), allowed)


SQL_PROBLEMS = r"""with p as (select record_no, unnest([case when coalesce(source, '') = '' then 'missing_source' end, case when coalesce(name, '') = '' then 'missing_name' end,
  case when reactants_smiles is null or len(reactants_smiles) = 0 then 'missing_reactants' end,
  case when provenance is not null and provenance not in ('curated', 'template_expanded', 'inferred') then 'bad_provenance' end,
  case when level is not null and level not in ('easy', 'medium', 'hard') then 'bad_level' end]) as problem from mechanism_records)"""


@query(SQL_PROBLEMS + " select record_no, problem from p where problem is not null")
def structural_problems(spark, d):
    r = records(spark, d)
    some = F.when(F.size("reactants_smiles") > 0, "given")
    problems = V.structural_problems({"source": F.col("source"), "name": F.col("name"), "reactants": some}, {"provenance": (F.col("provenance"), V.PROVENANCES), "level": (F.col("level"), V.LEVELS)})
    return r.select("record_no", F.explode(problems).alias("problem"))


@query(f"with {STEPS} select row_id, pos, smiles = lag(smiles) over (partition by row_id order by pos) as noop from steps qualify noop")
def step_noop(spark, d):
    w = Window.partitionBy("row_id").orderBy("pos")
    return steps(spark, d).withColumn("noop", F.col("smiles") == F.lag("smiles").over(w)).filter("noop").select("row_id", "pos", "noop")


@query(
    rf"""with {STEPS}, m as (select row_id, pos, length(regexp_replace(smiles, '[^A-Z]', '', 'g')) as heavy, length(regexp_replace(smiles, '[^+]', '', 'g')) - length(regexp_replace(regexp_replace(smiles, '\[|\]', '', 'g'), '[^-]', '', 'g')) as charge from steps)
select row_id, pos, abs(heavy - lag(heavy) over w)::int as heavy_delta, abs(charge - lag(charge) over w)::int as charge_jump from m window w as (partition by row_id order by pos)"""
)
def step_delta(spark, d):
    w = Window.partitionBy("row_id").orderBy("pos")
    heavy = F.length(F.regexp_replace("smiles", "[^A-Z]", ""))
    charge = F.length(F.regexp_replace("smiles", "[^+]", "")) - F.length(F.regexp_replace("smiles", "[^-]", ""))
    m = steps(spark, d).select("row_id", "pos", heavy.alias("heavy"), charge.alias("charge"))
    return m.select("row_id", "pos", F.abs(F.col("heavy") - F.lag("heavy").over(w)).cast("int").alias("heavy_delta"), F.abs(F.col("charge") - F.lag("charge").over(w)).cast("int").alias("charge_jump"))


@query(
    f"""with {STEPS}, {MOLECULES}, one as (select r.record_no, length(regexp_replace(s.smiles, '[^A-Z]', '', 'g')) as h from full_rows r join steps s on r.row_id = s.row_id where s.pos = 0 qualify row_number() over (partition by r.record_no order by r.row_id) = 1)
select record_no, pos, molecule from molecules join one using (record_no) qualify row_number() over (partition by record_no order by abs(length(regexp_replace(molecule, '[^A-Z]', '', 'g')) - h), pos) = 1"""
)
def seed_step(spark, d):
    """Per record the reactant nearest in size to its first step; ties go to the first."""
    first = full_rows(spark, d).filter(F.size("reference") > 0).groupBy("record_no").agg(F.min_by(F.col("reference")[0]["smiles"], "row_id").alias("s"))
    m = molecules(spark, d).join(first, "record_no")
    far = F.abs(F.length(F.regexp_replace("molecule", "[^A-Z]", "")) - F.length(F.regexp_replace("s", "[^A-Z]", "")))
    best = m.groupBy("record_no").agg(F.min_by(F.struct("pos", "molecule"), F.struct(far, "pos")).alias("b"))
    return best.select("record_no", "b.pos", "b.molecule")


def _judged(spark, d):
    own = records(spark, d).select("record_no", F.transform("reactants_smiles", lambda m: F.trim(m)).alias("reactants"), "provenance")
    start = full_rows(spark, d).select("row_id", "record_no").join(own, "record_no").drop("record_no")
    return V.step_reasons(V.measured(steps(spark, d), "smiles"), "row_id", "pos", "smiles", start=start)


@query()
def step_validation(spark, d):
    """Everything wrong with each step by the line-formula kernel."""
    return _judged(spark, d).select("row_id", "pos", F.explode("reasons").alias("reason"))


@query()
def record_checks(spark, d):
    own = records(spark, d).select("record_no", F.transform("reactants_smiles", lambda m: F.trim(m)).alias("reactants"), F.transform("products_smiles", lambda m: F.trim(m)).alias("products"))
    sides = V.side_reasons(full_rows(spark, d).select("row_id", "record_no").join(own, "record_no"), "row_id", ["reactants", "products"])
    return V.checks(_judged(spark, d), "row_id", sides).withColumn("reasons", F.array_join("reasons", ","))


@query(
    r"""with p as (select unnest([case when coalesce(name, '') = '' then 'missing_name(record)' end, case when reactants_smiles is null or len(reactants_smiles) = 0 then 'missing_reactants(record)' end, case when not checks.atom_balanced then 'unbalanced(atoms)' end]) as r from mechanism_records)
select string_split(r, '(')[1] as reason, count(*) as n from p where r is not null group by 1"""
)
def reject_breakdown(spark, d):
    reasons = F.array_compact(F.array(F.when(F.coalesce("name", F.lit("")) == "", "missing_name(record)"), F.when(F.coalesce(F.size("reactants_smiles"), F.lit(0)) <= 0, "missing_reactants(record)"), F.when(~F.col("checks.atom_balanced"), "unbalanced(atoms)")))
    return V.reject_breakdown(records(spark, d).select(reasons.alias("reasons")))


_CHECKS = ("sanitized", "atom_balanced", "charge_balanced", "step_continuity")


@query(" union all ".join(f"select '{c}' as \"check\", sum(coalesce(checks.{c}, false)::int)::bigint as passed, sum(coalesce(not checks.{c}, false)::int)::bigint as failed, sum((checks.{c} is null)::int)::bigint as unknown from mechanism_records" for c in _CHECKS))
def check_pass_counts(spark, d):
    return V.pass_counts(records(spark, d), {c: F.col(f"checks.{c}") for c in _CHECKS})


_SIDE = "array_to_string(list_sort(list_filter(list_transform({0}, lambda x: trim(x)), lambda x: x is not null and x <> '')), '.')"
SIGS = f"sigs as (select record_no, source, split, provenance, mechanism_step_nums, 'R:' || nullif({_SIDE.format('reactants_smiles')}, '') || '>>P:' || nullif({_SIDE.format('products_smiles')}, '') as sig from mechanism_records)"


def signatures(spark, d):
    trim = lambda c: F.transform(c, lambda x: F.trim(x))
    return records(spark, d).select("record_no", "source", "split", "provenance", "mechanism_step_nums", FT.signature(trim("reactants_smiles"), trim("products_smiles")).alias("sig"))


@query(f"with {SIGS} select record_no, sig from sigs")
def set_signature(spark, d):
    return signatures(spark, d).select("record_no", "sig")


BARE_TEXT = r"regexp_replace(regexp_replace(trim(x), '\[\d*(Br|Cl|[BCNOPSFI]|[bcnops])@{0,2}(?:H\d*)?(?:\++\d*|-+\d*)?(?::\d+)?\]', '\1', 'g'), '[/\\]', '', 'g')"
_BARE_SIDE = "array_to_string(list_sort(list_filter(list_transform({0}, lambda x: " + BARE_TEXT.replace("{", "{{").replace("}", "}}") + "), lambda x: x is not null and x <> '')), '.')"
SKELETONS = f"skels as (select record_no, 'R:' || nullif({_BARE_SIDE.format('reactants_smiles')}, '') || '>>P:' || nullif({_BARE_SIDE.format('products_smiles')}, '') as skel from mechanism_records)"


def skeletons(spark, d):
    """Records with the signature of their structures without charges, hydrogens, maps and stereo."""
    bare = lambda c: FT.skeleton(F.transform(c, lambda x: F.trim(x)))
    return records(spark, d).select("record_no", FT.signature(bare("reactants_smiles"), bare("products_smiles")).alias("skel"))


@query(f"with {SKELETONS} select record_no, skel as skeleton from skels")
def set_skeleton(spark, d):
    return skeletons(spark, d).withColumnRenamed("skel", "skeleton")


HASHES = f"{STEPS}, hashes as (select row_id, sha1(string_agg(coalesce(subtype, '') || '|' || coalesce(smiles, ''), chr(10) order by pos)) as step_hash from steps group by row_id)"


@query(f"with {HASHES} select row_id, step_hash from hashes")
def step_sequence_hash(spark, d):
    return full_rows(spark, d).select("row_id", FT.step_hash(F.col("reference"), "subtype", "smiles").alias("step_hash")).filter("step_hash is not null")


@query(
    r"""select r.record_no, t.base, t.n_steps, 'inferred' as provenance from mechanism_records r join (select *, row_number() over (partition by lower(trim(coalesce(name, ''))) order by base) as k from templates) t on lower(trim(coalesce(r.name, ''))) = lower(trim(t.name)) and k = 1
where lower(trim(coalesce(t.name, ''))) <> '' and coalesce(r.mechanism_step_nums, 0) = 0"""
)
def name_join(spark, d):
    """Records without steps that get those of the template of their exact name."""
    r = records(spark, d).filter("coalesce(mechanism_step_nums, 0) = 0").select("record_no", "name")
    return X.inferred(r, table(spark, d, "templates"), "name", ["base"], ["base", "n_steps"]).select("record_no", "base", "n_steps", "provenance")


@query(
    """with base as (select floor(0.2 / (1 - 0.2) * count(*))::bigint as most from mechanism_records where mechanism_step_nums > 0),
c as (select record_no, row_number() over (order by record_no) as k from mechanism_records where coalesce(mechanism_step_nums, 0) = 0) select record_no from c, base where k <= most"""
)
def infer_cap(spark, d):
    """Step-less records, so many at most that they make up a fifth of all."""
    r = records(spark, d)
    return A.capped(r.filter("coalesce(mechanism_step_nums, 0) = 0").select("record_no"), ["record_no"], 0.2, r.filter("mechanism_step_nums > 0").count())


@query("select t.base from templates t where not exists (select 1 from documents x where x.template_base = t.base)")
def uncovered_templates(spark, d):
    return X.uncovered(table(spark, d, "templates").select("base"), table(spark, d, "documents").filter("template_base is not null"), "base", "template_base")


@query()
def rgroup_expand(spark, d):
    """Every template as a pattern of two attachment points, and its concrete instances."""
    pattern = F.array(F.lit("O=C([*:1])OC"), F.lit("NC[*:2]"))
    t = table(spark, d, "templates").select("base", pattern.alias("r"), F.array(F.lit("O=C([*:1])NC[*:2]")).alias("p"), F.transform("subtypes", lambda s, i: F.lit("[O-]C([*:1])(OC)NC[*:2]")).alias("s"))
    return X.expanded(t, "base", "r", "p", "s").select("base", "instance_id", F.array_join("reactants", ".").alias("reactants"), F.array_join("products", ".").alias("products"), F.size("step_forms").alias("n_steps"))


@query(r"""with k as (select record_no, regexp_replace(regexp_replace(lower(level), '^\s*[a-z]+\s*:\s*', ''), '[^\p{L}\p{N}]+', '', 'g') as l from mechanism_records)
select coalesce(case when l = 'med' then 'medium' when l in ('', 'na', 'unknown', 'none') then null else l end, 'unknown') as level, count(*) as n from k group by 1""")
def level_histogram(spark, d):
    from corpusmill.operators.reward import level_histogram as histogram

    return histogram(records(spark, d).select(category(F.col("level"), LEVEL_ALIASES).alias("level")), "level")


@query(
    f"""with {STEPS} select s.row_id, pos, concat_ws('>>', coalesce(lag(smiles) over (partition by s.row_id order by pos), array_to_string(r.reactants_smiles, '.')), smiles) as pair
from steps s join full_rows f on s.row_id = f.row_id join mechanism_records r on f.record_no = r.record_no"""
)
def chained_pairs(spark, d):
    from corpusmill.operators.reward import chained

    start = full_rows(spark, d).join(records(spark, d).select("record_no", F.array_join("reactants_smiles", ".").alias("start")), "record_no").select("row_id", "start")
    return chained(steps(spark, d).join(start, "row_id"), "row_id", "pos", "smiles", F.col("start")).select("row_id", "pos", "pair")


@query()
def drawing_variants(spark, d):
    """Other drawings of all products of the train split, for augmentation; targets stay as they are."""
    p = records(spark, d).filter("split = 'train'").select("record_no", F.posexplode("products_smiles").alias("pos", "m")).select(F.struct("record_no", "pos").alias("id"), F.trim("m").alias("m"))
    return X.randomized(p, "id", "m", 2).select("id.*", "variant", "drawing")
