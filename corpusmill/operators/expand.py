"""Concrete records out of templates with attachment points; steps inferred by reaction name."""

from __future__ import annotations

import itertools
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import smiles as S
from corpusmill.operators.normalize import name_key

#: The fragments in order, how many labels vary, what the others get, most instances.
FRAGMENTS = ("[H]", "C", "CC", "c1ccccc1", "Cl", "OC")
VARIED, REST, MOST = 2, "C", 40
_POINT = re.compile(r"\[\*:(\d+)\]")


def substitute(smiles: str, fragments: dict[int, str]) -> str | None:
    """The canonical structure with its attachment points replaced on the graph; a label without a
    fragment and the fragment [H] become hydrogen. A structure without points comes out canonical.
    None if the result isn't valid."""
    if _POINT.search(smiles):
        return _substituted(smiles.strip(), tuple(sorted(fragments.items())))
    return S.canonical(smiles) if S.valid(smiles) else None


@lru_cache(maxsize=50_000)
def _substituted(smiles: str, fragments: tuple[tuple[int, str], ...]) -> str | None:
    return S.substituted(smiles, dict(fragments))


def combinations(labels: list[int], fragments: tuple[str, ...] = FRAGMENTS, varied: int = VARIED, most: int = MOST) -> list[dict[int, str]]:
    """What each label gets, in the fragments' product order over the first labels."""
    free, fixed = labels[:varied], labels[varied:]
    return [dict(zip(free, c)) | {x: REST for x in fixed} for c in itertools.islice(itertools.product(fragments, repeat=len(free)), most)]


def expanded(templates: DataFrame, key: str, reactants: str, products: str, steps: str, most: int = MOST) -> DataFrame:
    """(key, instance_id, combo, reactants, products, step_forms) of every valid instance, all structures
    canonical; of equal product lists of a template the first stays. Templates without labels give
    none."""
    ddl = {f.name: f.dataType.simpleString() for f in templates.schema}
    texts = "array<string>"

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for k, rs, ps, ss in zip(*(c.to_pylist() for c in b.columns)):
                labels = sorted({int(x) for t in [*(rs or []), *(ps or []), *(ss or [])] for x in _POINT.findall(t or "")})
                seen = set()
                for i, combo in enumerate(combinations(labels, most=most) if labels else []):
                    made = [[substitute(t or "", combo) for t in side or []] for side in (rs, ps, ss)]
                    if any(x is None for side in made for x in side) or tuple(made[1]) in seen:
                        continue
                    seen.add(tuple(made[1]))
                    for c, v in zip(out, (k, i, *made)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.column(0).type), pa.array(out[1], pa.int32()), *(pa.array(c, pa.list_(pa.string())) for c in out[2:])], names=[key, "combo", "reactants", "products", "step_forms"])

    made = templates.select(key, reactants, products, steps).mapInArrow(run, f"`{key}` {ddl[key]}, combo int, reactants {texts}, products {texts}, step_forms {texts}")
    return made.withColumn("instance_id", F.concat(F.col(key).cast("string"), F.lit("__x"), F.col("combo").cast("string")))


def unknown_only(instances: DataFrame, known: DataFrame, key: str, products: str, molecule: str) -> DataFrame:
    """Instances with at least one product that isn't known; none products count as known."""
    items = instances.select(key, F.explode(products).alias("_m"))
    new = items.join(known.select(F.col(molecule).alias("_m")).distinct(), "_m", "left_anti").select(key).distinct()
    return instances.join(new, key, "left_semi")


def uncovered(templates: DataFrame, expanded_rows: DataFrame, key: str, base: str) -> DataFrame:
    """Templates without any expanded record."""
    return templates.join(expanded_rows.select(F.col(base).alias(key)).distinct(), key, "left_anti")


def inferred(reactions: DataFrame, templates: DataFrame, name: str, order: list[str], carry: list[str]) -> DataFrame:
    """Reactions with the columns carried over from the first template of their exact name (case and
    outer white space aside), tagged as inferred. Nameless rows match nothing."""
    w = Window.partitionBy("_name").orderBy(*order)
    first = templates.withColumn("_name", name_key(F.col(name))).filter("_name != ''").withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("_name", *carry)
    return reactions.withColumn("_name", name_key(F.col(name))).join(first, "_name").drop("_name").withColumn("provenance", F.lit("inferred"))


def randomized(rows: DataFrame, key: str, molecule: str, n: int, seed: int = 20240709) -> DataFrame:
    """(key, variant, drawing): up to n different drawings of each molecule, from 8n tries; the
    original text where there is no other."""
    import random

    ddl = {f.name: f.dataType.simpleString() for f in rows.schema}

    def drawings(text):
        parts = text.split(".")
        found: list[str] = []
        canon = S.canonical(text)
        for t in range(8 * n):
            rng = random.Random(f"{seed}|{text}|{t}")
            made = ".".join(rng.sample([S.drawn_from(p, rng.randrange(1 << 30)) for p in parts], len(parts)))
            if made != text and made != canon and made not in found:
                found.append(made)
            if len(found) == n:
                break
        return found or [text]

    def run(batches):
        for b in batches:
            out: list[list] = [[], [], []]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, v in enumerate(drawings(t) if t and S.parse(t) else [t]):
                    for c, x in zip(out, (k, i, v)):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.column(0).type), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=[key, "variant", "drawing"])

    return rows.select(key, molecule).mapInArrow(run, f"`{key}` {ddl[key]}, variant int, drawing string")
