"""Queries of task builders, scoring, rewards, monitors, aggregates and exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.text import label
from corpusmill.operators import aggregates as A
from corpusmill.operators import reward as R
from corpusmill.operators import scoring as C
from corpusmill.operators import tasks as T
from corpusmill.queries import query
from corpusmill.queries.common import FULL, full_rows, records
from corpusmill.session import table

_BOTH = "len(reactants_smiles) > 0 and len(products_smiles) > 0"
_LIST = "'[' || array_to_string(list_transform({0}, lambda x: '\"' || replace(replace(x, '\\', '\\\\'), '\"', '\\\"') || '\"'), ', ') || ']'"
_R, _P = _LIST.format("reactants_smiles"), _LIST.format("products_smiles")
_AGENTS = "coalesce(array_to_string(nullif(raw_ref.agents, []), '.'), conditions)"


def _agents():
    return F.coalesce(F.when(F.size("raw_ref.agents") > 0, F.array_join("raw_ref.agents", ".")), F.col("conditions"))


@query(f"with {FULL} select row_id, u.k as k, array_to_string(list_transform(list_slice(reference, 1, u.k), lambda s: s.smiles), '>>') as done, reference[u.k + 1].subtype as subtype, reference[u.k + 1].smiles as smiles from full_rows, unnest(generate_series(1, len(reference) - 1)) as u(k)")
def next_step_prefix(spark, d):
    n = T.next_step(full_rows(spark, d).select("row_id", "reference"), "row_id", "reference")
    return n.select("row_id", F.col("k").cast("bigint").alias("k"), F.array_join(F.transform("done", lambda s: s["smiles"]), ">>").alias("done"), "subtype", "smiles")


@query(f"select record_no, 'forward_prediction' as task, 'Reactants: ' || {_R} || chr(10) || 'Reagents: ' || coalesce({_AGENTS}, 'none') || chr(10) || 'Give the products.' as \"user\", {_P} as assistant from mechanism_records where {_BOTH}")
def task_forward(spark, d):
    return T.forward_prediction(records(spark, d), "record_no", "reactants_smiles", "products_smiles", _agents())


@query(f"select record_no, 'retrosynthesis' as task, 'Products: ' || {_P} || chr(10) || 'Give the reactants.' as \"user\", {_R} as assistant from mechanism_records where {_BOTH}")
def task_retrosynthesis(spark, d):
    return T.retrosynthesis(records(spark, d), "record_no", "reactants_smiles", "products_smiles")


@query(f"select record_no, 'reagent_prediction' as task, 'Reactants: ' || {_R} || chr(10) || 'Products: ' || {_P} || chr(10) || 'Give the reagents.' as \"user\", {_AGENTS} as assistant from mechanism_records where {_BOTH} and {_AGENTS} <> ''")
def task_reagents(spark, d):
    return T.reagent_prediction(records(spark, d), "record_no", "reactants_smiles", "products_smiles", _agents())


@query("select record_no, 'named_reaction_qa' as task, 'What is the ' || trim(name) || '?' as \"user\", trim(raw_ref.summary) as assistant from mechanism_records where trim(name) <> '' and trim(raw_ref.summary) <> ''")
def task_named_qa(spark, d):
    return T.named_reaction_qa(records(spark, d), "record_no", "name", F.col("raw_ref.summary"))


@query(
    f"""with {FULL} select 'forward_prediction' as task, count(*) as n from mechanism_records where {_BOTH} union all select 'retrosynthesis', count(*) from mechanism_records where {_BOTH}
union all select 'reagent_prediction', count(*) from mechanism_records where {_BOTH} and {_AGENTS} <> '' union all select 'mechanism_full', count(*) from full_rows where len(reference) > 0"""
)
def task_union_counts(spark, d):
    full = T.mechanism_full(full_rows(spark, d), "row_id", "reference", F.lit("Give the full mechanism."), "You answer questions.")
    return T.union_tasks(task_forward(spark, d), task_retrosynthesis(spark, d), task_reagents(spark, d), full).groupBy("task").agg(F.count("*").alias("n"))


_PROMPT = "Reactants: {R}\nProducts: {P}\nConditions: {C}"


@query(f"select record_no, replace(replace(replace('{_PROMPT}', '{{R}}', coalesce({_R}, '[]')), '{{P}}', coalesce({_P}, '[]')), '{{C}}', coalesce(conditions, 'null')) as prompt from mechanism_records".replace("\n", "' || chr(10) || '"))
def prompt_fill(spark, d):
    return records(spark, d).select("record_no", T.fill(_PROMPT, {"{R}": T.json_list(F.col("reactants_smiles")), "{P}": T.json_list(F.col("products_smiles")), "{C}": F.col("conditions")}).alias("prompt"))


@query(f"with {FULL} select row_id, u.i as pos, reference[u.i].subtype as subtype, round(1.0::double / len(reference), 6)::double as weight from full_rows, unnest(generate_series(1, len(reference))) as u(i)")
def reference_tuples(spark, d):
    r = full_rows(spark, d).select("row_id", F.posexplode(T.reference(F.col("reference"))).alias("p", "s"))
    return r.select("row_id", (F.col("p") + 1).cast("bigint").alias("pos"), "s.subtype", "s.weight")


@query("with l as (select unnest(reactants_smiles) as line from mechanism_records union select unnest(products_smiles) from mechanism_records) select distinct line from l where line is not null and line <> ''")
def text_corpus_distinct(spark, d):
    return T.text_corpus(records(spark, d), ["reactants_smiles", "products_smiles"])


_LAST = "messages[len(messages)].content"


@query(
    rf"""with {FULL}, t as (select row_id, regexp_extract({_LAST}, '\[ANSWER\]\s*(.*?)\s*(?:\[/ANSWER\]|$)', 1, 's') as tagged, {_LAST} as whole from full_rows),
j as (select row_id, case when tagged <> '' then tagged else regexp_extract(whole, '(\[.*\])', 1, 's') end as txt from t)
select row_id, case when json_valid(txt) and txt <> '' then json_array_length(txt)::bigint end as n_steps, case when json_valid(txt) and txt <> '' then json_extract_string(txt, '$[0].subtype') end as first_subtype from j"""
)
def parse_answers(spark, d):
    p = full_rows(spark, d).select("row_id", C.parsed_steps(F.element_at("messages", -1)["content"]).alias("p"))
    return p.select("row_id", F.when(F.col("p").isNotNull(), F.size("p")).cast("bigint").alias("n_steps"), F.get("p", F.lit(0))["subtype"].alias("first_subtype"))


def _scored(spark, d):
    rows = full_rows(spark, d).select("row_id", "reference", F.element_at("messages", -1)["content"].alias("output"))
    return C.scored(rows, "row_id", "reference", "output")


@query()
def align_score(spark, d):
    """The chat rows' own answers aligned with their references."""
    return _scored(spark, d)


def _pairs(spark, d):
    """Each record's steps against those of the next row of the same length: a stand-in model."""
    w = Window.partitionBy(F.size("reference"), F.pmod("row_id", F.lit(64))).orderBy("row_id")
    rows = full_rows(spark, d).select("row_id", "reference", "meta.level", F.to_json(F.lead("reference").over(w)).alias("output"))
    return rows


@query()
def eval_summary(spark, d):
    """Averages of a stand-in model's answers, missing ones included."""
    return C.summary(C.scored(_pairs(spark, d), "row_id", "reference", "output"))


@query()
def eval_by_level(spark, d):
    rows = _pairs(spark, d)
    return C.by_level(C.scored(rows, "row_id", "reference", "output").join(rows.select("row_id", "level"), "row_id"), "level", keep_failed=True, digits=4)


@query()
def format_check(spark, d):
    return C.format_check(_scored(spark, d))


@query(
    "with m as (select source as model, round(avg(mechanism_step_nums), 3)::double as avg_s_partial from mechanism_records where mechanism_step_nums is not null group by 1 union all select * from (values ('baseline-a', 3.5::double), ('baseline-b', 0.0::double))) select model, avg_s_partial, row_number() over (order by avg_s_partial desc nulls last, model)::int as rank from m"
)
def leaderboard(spark, d):
    """Measured and static rows ranked together."""
    measured = records(spark, d).filter("mechanism_step_nums is not null").groupBy(F.col("source").alias("model")).agg(F.round(F.avg("mechanism_step_nums"), 3).alias("avg_s_partial"))
    return C.leaderboard(measured, spark.createDataFrame([("baseline-a", 3.5), ("baseline-b", 0.0)], "model string, avg_s_partial double"))


@query("select record_no from mechanism_records anti join (select distinct record_no from sft_mechanisms where task = 'mechanism_full') s using (record_no)")
def resume_anti(spark, d):
    """Records without a finished mechanism row."""
    done = table(spark, d, "sft_mechanisms").filter("task = 'mechanism_full'").select("record_no")
    return A.not_done(records(spark, d).select("record_no"), done, "record_no")


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def last_wins(spark, d):
    return A.last_wins(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select least(floor(l_discount * 10 * 5), 4)::int as bin, count(*) as n from lineitem where l_discount * 10 between 0 and 1 group by 1")
def histogram_conf(spark, d):
    return A.histogram(table(spark, d, "lineitem"), F.col("l_discount") * 10)


@query(
    """with r as (select lower(trim(source)) as source, n_chars, row_number() over (partition by lower(trim(source)) order by n_chars) - 1 as i, count(*) over (partition by lower(trim(source))) as n from documents)
select source, n, max(case when i = n // 2 then n_chars end) as p50, max(case when i = floor(0.95::double * n)::bigint then n_chars end) as p95, max(n_chars) as "max" from r group by source, n"""
)
def quantile_nearest(spark, d):
    docs = table(spark, d, "documents").select(label(F.col("source")).alias("source"), "n_chars")
    return A.placed_quantiles(docs, "n_chars", {"p50": 0.5, "p95": 0.95}, ["source"])


@query("select coalesce(lower(lang), 'none') as lang, round(quantile_cont(n_chars, 0.5), 4)::double as p50, round(quantile_cont(n_chars, 0.95), 4)::double as p95, round(quantile_cont(n_chars, 0.99), 4)::double as p99, max(n_chars) as \"max\" from documents group by 1")
def quantile_interpolated(spark, d):
    q = lambda p: F.round(F.percentile("n_chars", F.lit(p)), 4)
    return table(spark, d, "documents").groupBy(F.coalesce(F.lower("lang"), F.lit("none")).alias("lang")).agg(q(0.5).alias("p50"), q(0.95).alias("p95"), q(0.99).alias("p99"), F.max("n_chars").alias("max"))


@query(r"select lower(trim(source)) as source, sum(len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: w <> '')))::bigint as n_tokens from documents group by 1")
def whitespace_tokens(spark, d):
    words = F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != ""))
    return table(spark, d, "documents").groupBy(label(F.col("source")).alias("source")).agg(F.sum(words).alias("n_tokens"))


@query("select event_id, count(*) over w as observed, avg(floor(value * 100 + 0.5)::bigint) over w as mean_hundredths from events window w as (partition by event_type order by ts, event_id rows between 255 preceding and current row)")
def rolling_monitor(spark, d):
    # whole hundredths, so that the means are exact
    e = table(spark, d, "events").withColumn("hundredths", F.floor(F.col("value") * 100 + 0.5).cast("bigint"))
    return R.rolling(e, ["ts", "event_id"], ["hundredths"], ["event_type"]).select("event_id", "observed", "mean_hundredths")


@query("with r as (select event_id, event_type, count(*) over w as observed, avg((value > 20)::int) over w as m from events window w as (partition by event_type order by ts, event_id rows between 255 preceding and current row)) select event_id, event_type from r where observed >= 64 and m < 0.8")
def validity_floor(spark, d):
    e = table(spark, d, "events").withColumn("ok", (F.col("value") > 20).cast("int"))
    return R.validity_alarm(R.rolling(e, ["ts", "event_id"], ["ok"], ["event_type"]), "mean_ok").filter("alarm").select("event_id", "event_type")


@query(
    """select record_no, round(case when not coalesce(checks.sanitized, false) or coalesce(mechanism_step_nums, 0) = 0 then -0.5 else 1.0 * least(mechanism_step_nums, 5) / 5.0 + 0.10 * least(mechanism_step_nums, 4) / 4.0 + 0.05 end, 6)::double as reward from mechanism_records"""
)
def reward_gate(spark, d):
    n = F.coalesce("mechanism_step_nums", F.lit(0))
    return records(spark, d).select("record_no", F.round(R.gated(F.col("checks.sanitized"), F.least(n, F.lit(5)) / 5, F.least(n, F.lit(4)) / 4), 6).alias("reward"))


@query(
    """with a as (select record_no, row_number() over (partition by record_no order by row_id) as attempt, row_id, (row_id % 10) / 10.0::double as s, (row_id % 4 <> 0)::int::double as v from sft_mechanisms)
select record_no, row_id, attempt::int as attempt from a where attempt <= 3 and s >= 0.5 and v >= 1 qualify row_number() over (partition by record_no order by attempt) = 1"""
)
def rejection_sampling(spark, d):
    """The first of three attempts that is good enough; rows of a record stand in for attempts."""
    w = Window.partitionBy("record_no").orderBy("row_id")
    a = table(spark, d, "sft_mechanisms").select("record_no", "row_id", F.row_number().over(w).alias("attempt"), F.lit(True).alias("parsed"), (F.col("row_id") % 10 / 10).alias("s_partial"), (F.col("row_id") % 4 != 0).cast("double").alias("v"))
    return R.accepted(a, "record_no", "attempt", 0.5, 1.0, 3).select("record_no", "row_id", "attempt")


@query("select record_no, case level when 'easy' then 0 when 'medium' then 1 when 'hard' then 2 else 99 end as level_rank from mechanism_records")
def curriculum_order(spark, d):
    return R.curriculum(records(spark, d).select("record_no", "level"), "level", "record_no").select("record_no", "level_rank")


@query(f"with {FULL}, s as (select row_id, u.i as pos, reference[u.i].smiles as smiles from full_rows, unnest(generate_series(1, len(reference))) as u(i)) select row_id, avg(case when pos > 1 then case when smiles like '%Cl%' then 1 when smiles like '%S%' then 0 end end) as fraction from s group by row_id")
def round_trip(spark, d):
    """Share of feasible later steps under a stand-in model that abstains on most."""
    s = full_rows(spark, d).select("row_id", F.posexplode("reference").alias("pos", "s")).select("row_id", "pos", "s.smiles")
    verdict = F.when(F.col("smiles").contains("Cl"), True).when(F.col("smiles").contains("S"), False)
    return R.round_trip(s.withColumn("verdict", verdict), "row_id", "pos", "verdict")


@query("select row_id, array_to_string(list_transform(messages, lambda m: m.content), ' ') as text from sft_mechanisms")
def completion_text(spark, d):
    return table(spark, d, "sft_mechanisms").select("row_id", R.completion_text(F.col("messages")).alias("text"))


@query()
def target_self_check(spark, d):
    """Answers with unreadable JSON, unknown subtypes or bad structures, over all full rows."""
    rows = full_rows(spark, d).select(F.element_at("messages", -1)["content"].alias("text"))
    # at most the ontology's subtypes come to the driver
    allowed = {r[0] for r in table(spark, d, "templates").select(F.explode("subtypes")).distinct().collect()}
    return T.self_check(rows, "text", allowed)


@query("select subtype, count(*) as n from mechanism_records where subtype is not null group by subtype order by n desc, subtype limit 10")
def most_common_subtypes(spark, d):
    """A top-k report."""
    return A.most_common(records(spark, d), "subtype", 10)


@query("select task, split as config_split, count(*) as n from sft_mechanisms group by 1, 2")
def export_counts(spark, d):
    from corpusmill.plans.export import routed

    return routed(table(spark, d, "sft_mechanisms"), "task", "split").groupBy("task", "config_split").agg(F.count("*").alias("n"))


@query("select row_id, meta.reaction_id as reaction_id, meta.source as source, meta.level as level, meta.n_steps as n_steps from sft_mechanisms")
def flatten_meta(spark, d):
    return table(spark, d, "sft_mechanisms").select("row_id", "meta.*").select("row_id", "reaction_id", "source", "level", "n_steps")
