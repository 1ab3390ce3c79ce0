"""Queries of prompts, targets, generation and score tables; columns stand in for scores where these need the kernel."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import expand as X
from corpusmill.operators import normalize as N
from corpusmill.operators import reward as R
from corpusmill.operators import scoring as C
from corpusmill.operators import tasks as T
from corpusmill.plans import evaluation, training_data
from corpusmill.queries import query
from corpusmill.queries.common import FULL, STEPS, full_rows, records, steps
from corpusmill.queries.training import _P, _R
from corpusmill.session import table

_SAID = "'The step is a ' || coalesce(replace(s.subtype, '_', ' '), 'step') || '.'"


@query(f"with {FULL} select row_id, array_to_string(list_transform(reference, lambda s, i: 'Step ' || i::varchar || ': ' || {_SAID}), chr(10)) as text from full_rows")
def step_lines(spark, d):
    """The chain of thought of each chat row: a line a step."""
    return full_rows(spark, d).select("row_id", T.step_lines(F.col("reference"), None).alias("text"))


@query(f"select record_no, 'Reactants: ' || coalesce({_R}, '[]') || chr(10) || 'Products: ' || coalesce({_P}, '[]') as prompt from mechanism_records where mechanism_step_nums > 0")
def training_prompts(spark, d):
    """The prompts of training rows; records stand in with as many steps as they say."""
    r = records(spark, d).select("record_no", "level", F.col("reactants_smiles").alias("reactants"), F.col("products_smiles").alias("products"), F.array_repeat(F.struct(F.lit("s").alias("subtype"), F.lit("C").alias("smiles")), F.coalesce("mechanism_step_nums", F.lit(0))).alias("steps"))
    return training_data.rows_of(r, "record_no").select("record_no", "prompt")


@query(
    f"""with {FULL}, r as (select f.row_id, f.reference, {_R} as rs from full_rows f join mechanism_records m on f.record_no = m.record_no)
select row_id, 'Reactants: ' || coalesce(rs, '[]') || chr(10) || 'The steps are: [' || array_to_string(list_transform(reference, lambda s: '"' || replace(replace(concat_ws(': ', s.subtype, s.smiles), '\\', '\\\\'), '"', '\\"') || '"'), ', ') || ']' || chr(10) || 'Give a reason for each step.' as prompt from r where len(reference) > 0"""
)
def distillation_prompts(spark, d):
    own = records(spark, d).select("record_no", F.col("reactants_smiles").alias("reactants"))
    rows = full_rows(spark, d).select("row_id", "record_no", F.col("reference").alias("steps")).join(own, "record_no")
    return training_data.distillation_prompts(rows, "row_id")


@query(f"with {FULL} select row_id, len(reference)::int as n_steps, reference[1].subtype as first_subtype from full_rows where len(reference) > 0 and len(list_filter(reference, lambda s: contains(s.smiles, 'N'))) >= 0.5 * len(reference)")
def clean_mechanism(spark, d):
    """Rows of which at least half the steps pass; holding nitrogen stands in for validity."""
    marked = F.transform("reference", lambda s: s.withField("ok", s["smiles"].contains("N")).withField("canonical", F.lit(None).cast("string")))
    rows = full_rows(spark, d).select("row_id", marked.alias("s"))
    return T.clean_steps(rows, "s", "ok", "canonical", "smiles", 0.5).select("row_id", F.size("s").alias("n_steps"), F.col("s")[0]["subtype"].alias("first_subtype"))


@query("select distinct r.record_no from mechanism_records r, unnest(r.products_smiles) as u(m) where r.split = 'test' and trim(u.m) not in (select trim(x.m) from mechanism_records t, unnest(t.products_smiles) as x(m) where t.split = 'train' and x.m is not null)")
def unknown_products(spark, d):
    """Test records with a product that no train record has."""
    own = records(spark, d).select("record_no", "split", F.transform("products_smiles", lambda m: F.trim(m)).alias("p"))
    known = own.filter("split = 'train'").select(F.explode("p").alias("m"))
    return X.unknown_only(own.filter("split = 'test'").select("record_no", "p"), known, "record_no", "p", "m").select("record_no")


@query("select record_no, case when trim(coalesce(name, '')) = '' then null when contains(name, 'Michael') then null when contains(name, 'a') then upper(name) end as structure, case when trim(coalesce(name, '')) = '' then 'empty' when contains(name, 'Michael') then 'resolver_error:ValueError' when not contains(name, 'a') then 'no_result' end as resolve_reason from mechanism_records")
def name_resolution(spark, d):
    """Names resolved by a stand-in that knows some, has nothing for others and fails on one."""

    def resolver(name):
        if "Michael" in name:
            raise ValueError
        return (name.upper(), None) if "a" in name else (None, "no_result")

    return N.resolve_names(records(spark, d).select("record_no", "name"), "name", resolver).select("record_no", "structure", "resolve_reason")


@query(f"with {STEPS} select row_id, pos, case when contains(smiles, 'Br') then null when contains(smiles, 'N') then 'yes' else 'no' end as verdict from steps")
def forward_verdicts(spark, d):
    """A stand-in forward model that abstains on bromine."""
    return R.feasible(steps(spark, d), "smiles", lambda t: None if "Br" in t else "N" in t).select("row_id", "pos", F.when(F.col("verdict"), "yes").when(~F.col("verdict"), "no").alias("verdict"))


@query("select record_no, case when not contains(coalesce(name, ''), 'Wittig') then length(coalesce(name, ''))::varchar end as raw_output, case when contains(coalesce(name, ''), 'Wittig') then 'RuntimeError: busy' end as error from mechanism_records where split <> 'train'")
def generate_answers(spark, d):
    """A stand-in model over the prompts that have no answer yet; its failures are rows."""

    def model(prompts):
        if any("Wittig" in p for p in prompts):
            raise RuntimeError("busy")
        return [str(len(p)) for p in prompts]

    todo = records(spark, d).select("record_no", F.coalesce("name", F.lit("")).alias("prompt"))
    done = records(spark, d).filter("split = 'train'").select("record_no", F.lit(None).cast("string").alias("error"))
    return evaluation.generate(todo, done, "record_no", "prompt", model)


@query("select record_no, p.n from mechanism_records left join (select record_no, count(*) as n from sft_mechanisms where task = 'retrosynthesis' group by 1) p using (record_no)")
def prediction_join(spark, d):
    """Every record with what was predicted for it, if anything was."""
    said = table(spark, d, "sft_mechanisms").filter("task = 'retrosynthesis'").groupBy("record_no").agg(F.count("*").alias("n"))
    return C.against_gold(records(spark, d).select("record_no"), said, "record_no")


_TABLE = """t as (select record_no, level, coalesce(checks.sanitized, false) as parsed, coalesce(mechanism_step_nums, 0) % 5 / 4.0::double as s_total, coalesce(mechanism_step_nums, 0) % 9 / 8.0::double as s_partial, coalesce(mechanism_step_nums, 0) % 3 / 2.0::double as v, coalesce(len(reactants_smiles), 0) % 3 / 2.0::double as l from mechanism_records)"""
_MEANS = ", ".join(f"round(avg({c}), {{0}})::double as avg_{c}" for c in ("s_total", "s_partial", "v", "l"))


def _table(spark, d):
    n = F.coalesce("mechanism_step_nums", F.lit(0))
    r = F.greatest(F.coalesce(F.size("reactants_smiles"), F.lit(0)), F.lit(0))
    return records(spark, d).select("record_no", "level", F.coalesce("checks.sanitized", F.lit(False)).alias("parsed"), (n % 5 / 4).alias("s_total"), (n % 9 / 8).alias("s_partial"), (n % 3 / 2).alias("v"), (r % 3 / 2).alias("l"))


@query(f"with {_TABLE} select count(*) as evaluated, sum(parsed::int)::bigint as successful, {_MEANS.format(3)} from t")
def score_summary(spark, d):
    return C.summary(_table(spark, d))


@query(f"with {_TABLE} select level, count(*) as n, {_MEANS.format(3)} from t where level is not null and parsed group by level")
def score_levels(spark, d):
    return C.by_level(_table(spark, d), "level")


@query(f"with {_TABLE} select level, count(*) as n, {_MEANS.format(4)} from t where level is not null group by level")
def score_levels_all(spark, d):
    """As the notebook's scorer: failures stay in their level's means."""
    return C.by_level(_table(spark, d), "level", 4, keep_failed=True)


@query(f"with {_TABLE} select count(*) as n, sum((s_total >= 0.99 and s_partial >= 0.99)::int)::bigint as perfect, round(sum((s_total >= 0.99 and s_partial >= 0.99)::int) / count(*), 6)::double as fraction, round(avg(s_total), 4)::double as mean_s_total, round(avg(s_partial), 4)::double as mean_s_partial from t")
def format_check_table(spark, d):
    return C.format_check(_table(spark, d))


@query(f"with {_TABLE} select record_no, s_partial, s_total from t where s_total < 0.99 or s_partial < 0.99 order by record_no limit 20")
def format_mismatches(spark, d):
    """A top-k report: the first twenty outputs that miss their own reference."""
    return C.mismatches(_table(spark, d), "record_no")


@query(f"with {_TABLE} select record_no, case when parsed and v > 0 then round(s_partial + 0.10 * v + 0.05, 6) else -0.5 end::double as reward, case when parsed then v else 0 end::double as validity, case when parsed then 0.05 else 0 end::double as format from t")
def score_components(spark, d):
    """Reward, validity and format out of one struct."""
    t = _table(spark, d).select("record_no", R.components(F.col("parsed"), F.col("s_partial"), F.col("v")).alias("c"))
    return t.select("record_no", F.round("c.reward", 6).alias("reward"), "c.validity", "c.format")
