"""Parsing of predicted step sequences, weighted alignment with references, averages, leaderboard."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import smiles as S
from corpusmill.operators.features import let
from corpusmill.session import spread

#: Similarities below TAU count nothing; a gap or mismatch costs GAP.
TAU, GAP = 0.60, 1e-6
#: Preference of the actions match, mismatch and gap.
MATCH, MISMATCH, SKIP = 3, 2, 1
_TAGGED = re.compile(r"\[ANSWER\](.*?)(?:\[/ANSWER\]|\Z)", re.DOTALL | re.IGNORECASE)
_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$")


def parse_steps(output) -> list | None:
    """The step list in a model's output: a list, an object's mechanism, or JSON text in answer tags
    (the closing one may lack), code fences, or the widest [...] of the text; else None."""
    if isinstance(output, list):
        return output
    if isinstance(output, dict):
        return output["mechanism"] if isinstance(output.get("mechanism"), list) else None
    if not isinstance(output, str):
        return None
    m = _TAGGED.search(output)
    text = _FENCE.sub("", (m[1] if m else output).strip())
    wide = re.search(r"\[.*\]", text, re.DOTALL)
    for t in (text, wide[0] if wide else None):
        if t:
            try:
                got = json.loads(t)
            except (ValueError, RecursionError):
                continue
            got = got.get("mechanism") if isinstance(got, dict) else got
            if isinstance(got, list):
                return got
    return None


def align(gold: list[tuple], pred: list[tuple], similarity=None, same=None) -> tuple[float, float, list[tuple]]:
    """(total, partial, actions) of the best alignment of (subtype, form, weight) with (subtype, form).

    The best cell is the greatest (total, partial, preference, penalty) in this order; of equal ones
    skipping a gold step comes before skipping a predicted one and that before pairing. Actions are
    (kind, gold place or None, predicted place or None).
    """
    same = same or (lambda a, b: bool(a) and a == b)
    similarity = similarity or (lambda a, b: 1.0 if a and a == b else 0.0)
    n, m = len(gold), len(pred)
    zero = (0.0, 0.0, 0.0)
    best = [[None] * (m + 1) for _ in range(n + 1)]
    how = [[None] * (m + 1) for _ in range(n + 1)]
    best[0][0] = zero
    for i in range(n + 1):
        for j in range(m + 1):
            if i == j == 0:
                continue
            options = []
            if i:
                t, p, e = best[i - 1][j]
                options.append(((t, p, SKIP, e - GAP), "skip_gold"))
            if j:
                t, p, e = best[i][j - 1]
                options.append(((t, p, SKIP, e - GAP), "skip_pred"))
            if i and j:
                t, p, e = best[i - 1][j - 1]
                kind, form, w = gold[i - 1]
                if kind == pred[j - 1][0]:
                    other = pred[j - 1][1]
                    near = similarity(form, other) if form and other else 0.0
                    options.append(((t + (w if same(form, other) else 0.0), p + w * (near if near >= TAU else 0.0), MATCH, e), "match"))
                else:
                    options.append(((t, p, MISMATCH, e - GAP), "mismatch"))
            top = options[0]
            for o in options[1:]:
                if o[0] > top[0]:
                    top = o
            best[i][j] = (top[0][0], top[0][1], top[0][3])
            how[i][j] = top[1]
    actions, i, j = [], n, m
    while i or j:
        kind = how[i][j]
        if kind == "skip_gold":
            i -= 1
            actions.append((kind, i, None))
        elif kind == "skip_pred":
            j -= 1
            actions.append((kind, None, j))
        else:
            i, j = i - 1, j - 1
            actions.append((kind, i, j))
    return best[n][m][0], best[n][m][1], actions[::-1]


@lru_cache(maxsize=50_000)
def _valid(text: str | None) -> bool:
    return bool(text) and S.valid(text)


def _canonical(text: str) -> str | None:
    return S.canonical(text)


@lru_cache(maxsize=50_000)
def _bits(text: str | None) -> tuple[int, ...]:
    return tuple(S.fingerprint_bits(text) or ())


def score(gold: list[tuple], pred: list[tuple]) -> dict:
    """s_total, s_partial, v (valid predictions) and l (matched gold steps), as fractions of two decimals."""
    g = [(k, f if _valid(f) else "", w) for k, f, w in gold]
    p = [(k, f if _valid(f) else "") for k, f in pred]
    # equal texts need no canonical form and no fingerprint
    same = lambda a, b: bool(a) and (a == b or bool(b) and _canonical(a) == _canonical(b))
    near = lambda a, b: 1.0 if a == b else S.tanimoto(list(_bits(a)), list(_bits(b)))
    total, partial, actions = align(g, p, near, same)
    valid, matched = sum(bool(f) for _, f in p), sum(a[0] == "match" for a in actions)
    return {"s_total": round(total, 2), "s_partial": round(partial, 2), "v": round(valid / max(1, len(p)), 2), "l": round(matched / max(1, len(g)), 2), "n_pred": len(p), "n_gold": len(g)}


SCORE = "parsed boolean, s_total double, s_partial double, v double, l double, n_pred int, n_gold int"


def scored(rows: DataFrame, key: str, reference: str, output: str) -> DataFrame:
    """(key, parsed, s_total, s_partial, v, l, n_pred, n_gold) of model outputs against references
    (array<struct<subtype, smiles, weight>>). Unparseable or missing outputs score 0 with parsed
    false; an empty list parses and scores 0."""
    ddl = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for ref, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                steps = parse_steps(text)
                gold = [(s["subtype"], s["smiles"], s["weight"] or 0.0) for s in ref or []]
                pred = [(s.get("subtype"), s.get("intermediate_smiles", s.get("smiles"))) for s in steps or [] if isinstance(s, dict)]
                pred = [(k, f if isinstance(f, str) else None) for k, f in pred]
                r = score(gold, pred) if steps is not None else {"s_total": 0.0, "s_partial": 0.0, "v": 0.0, "l": 0.0, "n_pred": 0, "n_gold": len(gold)}
                for c, v in zip(out, (steps is not None, *r.values())):
                    c.append(v)
            types = [pa.bool_()] + [pa.float64()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=[key, "parsed", "s_total", "s_partial", "v", "l", "n_pred", "n_gold"])

    return spread(rows.select(key, reference, F.col(output).cast("string")), key).mapInArrow(run, f"`{key}` {ddl[key]}, {SCORE}")


def parsed_steps(text: Column) -> Column:
    """JVM-side, by the rules of parse_steps() for text: the step list in answer tags (the closing one
    may lack) or the whole, without code fences; a list, an object's mechanism, or the widest [...];
    null if unreadable."""
    steps = "array<struct<step:int,type:string,subtype:string,intermediate_smiles:string>>"
    listed = lambda t: F.from_json(F.when(t.startswith("["), t), steps)
    tagged = F.when(text.ilike("%[ANSWER]%"), F.regexp_extract(text, r"(?is)\[ANSWER\](.*?)(?:\[/ANSWER\]|\z)", 1)).otherwise(text)
    bare = lambda t: F.when(t.contains("```"), F.regexp_replace(t, r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "")).otherwise(t)
    wide = lambda t: let(F.regexp_extract(t, r"(?s)(\[.*\])", 1), listed)
    read = lambda t: F.coalesce(listed(t), F.from_json(F.when(t.startswith("{"), t), f"struct<mechanism:{steps}>")["mechanism"], wide(t))
    return let(let(F.trim(tagged, F.lit(" \n\r\t")), bare), read)


def against_gold(gold: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Every gold row with its prediction, null where there is none."""
    return gold.join(predictions, key, "left")


def summary(scores: DataFrame, digits: int = 3) -> DataFrame:
    """One row: evaluated, successful and the averages over all rows, failures included."""
    avg = lambda c: F.round(F.avg(c), digits).alias(f"avg_{c}")
    return scores.agg(F.count("*").alias("evaluated"), F.count_if("parsed").alias("successful"), *(avg(c) for c in ("s_total", "s_partial", "v", "l")))


def by_level(scores: DataFrame, level: str, digits: int = 3, keep_failed: bool = False) -> DataFrame:
    """Averages per level; rows without a level are left out, and unparsed ones unless kept."""
    rows = scores.filter(F.col(level).isNotNull())
    rows = rows if keep_failed else rows.filter("parsed")
    avg = lambda c: F.round(F.avg(c), digits).alias(f"avg_{c}")
    return rows.groupBy(level).agg(F.count("*").alias("n"), *(avg(c) for c in ("s_total", "s_partial", "v", "l")))


def leaderboard(*results: DataFrame, by: str = "avg_s_partial") -> DataFrame:
    """Models ranked by a score, best first, equal ones by name; measured and static results alike."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.col(by).desc_nulls_last(), "model"))).orderBy("rank")


def format_check(scores: DataFrame) -> DataFrame:
    """One row: how many outputs score at least 0.99 against their own references, and the means."""
    perfect = F.count_if((F.col("s_total") >= 0.99) & (F.col("s_partial") >= 0.99))
    return scores.agg(F.count("*").alias("n"), perfect.alias("perfect"), F.round(perfect / F.count("*"), 6).alias("fraction"), F.round(F.avg("s_total"), 4).alias("mean_s_total"), F.round(F.avg("s_partial"), 4).alias("mean_s_partial"))


def mismatches(scores: DataFrame, key: str, n: int = 20) -> DataFrame:
    """A top-k report: the first n outputs, by key, that score below 0.99 against their own references."""
    bad = scores.filter((F.col("s_total") < 0.99) | (F.col("s_partial") < 0.99))
    return bad.select(key, "s_partial", "s_total").orderBy(key).limit(n)
