"""Instruction rows out of records: one builder per task, prefix windows, formatting, self-check, text corpus."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import smiles as S

OPEN, CLOSE = "[ANSWER]", "[/ANSWER]"


def fill(template: str, fields: dict[str, Column]) -> Column:
    """The template with each token replaced by its field; null fields become null's JSON text."""
    out = F.lit(template)
    for token, value in fields.items():
        out = F.replace(out, F.lit(token), F.coalesce(value, F.lit("null")))
    return out


def json_list(items: Column) -> Column:
    """A list of texts as JSON with a space after commas."""
    quoted = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda s: F.to_json(F.array(s)))
    return F.concat(F.lit("["), F.array_join(F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2)), ", "), F.lit("]"))


def chat(system: str, user: Column, assistant: Column) -> Column:
    """messages of three turns."""
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", assistant))


def reference(steps: Column, kind: str = "subtype", form: str = "smiles") -> Column:
    """array<struct<subtype, smiles, weight>> with equal weights of six decimals."""
    w = F.round(1 / F.size(steps), 6)
    return F.transform(steps, lambda s: F.struct(s[kind].alias("subtype"), s[form].alias("smiles"), w.alias("weight")))


def step_lines(steps: Column, rationale: str | None, kind: str = "subtype") -> Column:
    """Step n: rationale, or a sentence naming the step where there is none."""
    plain = lambda s: F.concat(F.lit("The step is a "), F.coalesce(F.replace(s[kind], F.lit("_"), F.lit(" ")), F.lit("step")), F.lit("."))
    said = (lambda s: F.coalesce(F.when(F.trim(s[rationale]) != "", s[rationale]), plain(s))) if rationale else plain
    return F.array_join(F.transform(steps, lambda s, i: F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), said(s))), "\n")


def answer(steps: Column, cot: bool = False, rationale: str | None = None) -> Column:
    """The steps as JSON, with cot behind step lines and between answer tags."""
    body = F.to_json(steps)
    return F.concat(step_lines(steps, rationale), F.lit(f"\n{OPEN}\n"), body, F.lit(f"\n{CLOSE}")) if cot else body


def mechanism_full(rows: DataFrame, key: str, steps: str, user: Column, system: str, rationale: str | None = None) -> DataFrame:
    """One row per record with steps; rationale names the field with a step's reason, if there is one."""
    return rows.filter(F.size(steps) > 0).select(key, F.lit("mechanism_full").alias("task"), chat(system, user, answer(F.col(steps), True, rationale)).alias("messages"), reference(F.col(steps)).alias("reference"))


def next_step(rows: DataFrame, key: str, steps: str) -> DataFrame:
    """(key, k, done, subtype, smiles): steps 1..k known, step k + 1 wanted, for every k from 1."""
    return rows.filter(F.size(steps) > 1).select(key, steps, F.explode(F.sequence(F.lit(1), F.size(steps) - 1)).alias("k")).select(key, "k", F.slice(steps, F.lit(1), F.col("k")).alias("done"), F.get(F.col(steps), F.col("k")).alias("_n")).select(key, "k", "done", "_n.subtype", "_n.smiles")


def forward_prediction(rows: DataFrame, key: str, reactants: str, products: str, agents: Column) -> DataFrame:
    """Reactants and reagents to products; needs both sides."""
    both = (F.size(reactants) > 0) & (F.size(products) > 0)
    return rows.filter(both).select(key, F.lit("forward_prediction").alias("task"), F.concat(F.lit("Reactants: "), json_list(F.col(reactants)), F.lit("\nReagents: "), F.coalesce(agents, F.lit("none")), F.lit("\nGive the products.")).alias("user"), json_list(F.col(products)).alias("assistant"))


def retrosynthesis(rows: DataFrame, key: str, reactants: str, products: str) -> DataFrame:
    both = (F.size(reactants) > 0) & (F.size(products) > 0)
    return rows.filter(both).select(key, F.lit("retrosynthesis").alias("task"), F.concat(F.lit("Products: "), json_list(F.col(products)), F.lit("\nGive the reactants.")).alias("user"), json_list(F.col(reactants)).alias("assistant"))


def reagent_prediction(rows: DataFrame, key: str, reactants: str, products: str, agents: Column) -> DataFrame:
    """Both sides to reagents; needs reagents or conditions."""
    good = (F.size(reactants) > 0) & (F.size(products) > 0) & F.coalesce(agents != "", F.lit(False))
    return rows.filter(good).select(key, F.lit("reagent_prediction").alias("task"), F.concat(F.lit("Reactants: "), json_list(F.col(reactants)), F.lit("\nProducts: "), json_list(F.col(products)), F.lit("\nGive the reagents.")).alias("user"), agents.alias("assistant"))


def named_reaction_qa(rows: DataFrame, key: str, name: str, summary: Column) -> DataFrame:
    """Name to summary; needs both."""
    good = F.coalesce((F.trim(name) != "") & (F.trim(summary) != ""), F.lit(False))
    return rows.filter(good).select(key, F.lit("named_reaction_qa").alias("task"), F.concat(F.lit("What is the "), F.trim(name), F.lit("?")).alias("user"), F.trim(summary).alias("assistant"))


def union_tasks(*frames: DataFrame) -> DataFrame:
    """All builders' rows, columns by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def text_corpus(df: DataFrame, lists: list[str]) -> DataFrame:
    """Distinct non-empty texts of list columns, sorted by code points."""
    parts = [df.select(F.explode(c).alias("line")) for c in lists]
    return union_tasks(*parts).filter("line is not null and line != ''").distinct().orderBy("line")


def self_check(rows: DataFrame, text: str, allowed: set[str]) -> DataFrame:
    """One row: rows, and how many have unreadable JSON, a subtype that isn't allowed, a bad structure."""

    def run(batches):
        for b in batches:
            bad_json, bad_type, bad_form = [], [], []
            for t in b.column(0).to_pylist():
                inner = (t or "").partition(OPEN)[2].partition(CLOSE)[0] or t
                try:
                    steps = json.loads(inner)
                    ok = isinstance(steps, list) and all(isinstance(s, dict) for s in steps)
                except (TypeError, ValueError):
                    ok = False
                bad_json.append(not ok)
                bad_type.append(ok and any(s.get("subtype") not in allowed for s in steps))
                bad_form.append(ok and any(not S.valid(s.get("intermediate_smiles", s.get("smiles"))) for s in steps))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.bool_()) for x in (bad_json, bad_type, bad_form)], names=["a", "b", "c"])

    n = lambda c: F.count_if(c)
    return rows.select(F.col(text).cast("string")).mapInArrow(run, "a boolean, b boolean, c boolean").agg(F.count("*").alias("n_rows"), n("a").alias("bad_json"), n("b").alias("bad_subtype"), n("c").alias("bad_smiles"))


def clean_steps(rows: DataFrame, steps: str, ok: str, canonical: str, form: str, least: float = 1.0) -> DataFrame:
    """Rows of which at least that fraction of steps is valid; their steps with canonical structures
    where there are any. Rows without steps are dropped."""
    good = F.size(F.filter(F.col(steps), lambda s: F.coalesce(s[ok], F.lit(False)))) / F.size(steps)
    return rows.filter((F.size(steps) > 0) & (good >= least)).withColumn(steps, F.transform(steps, lambda s: s.withField(form, F.coalesce(s[canonical], s[form]))))
