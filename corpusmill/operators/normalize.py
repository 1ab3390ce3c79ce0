"""Record-level clean-up: list coercion, reaction text, levels, and molecules normalised once each."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import smiles as S
from corpusmill.session import spread

#: Level bounds in steps.
EASY_STEPS, MEDIUM_STEPS = 3, 6
#: Fixed pattern: the suffix of extended line formulas behind white space and a bar.
CX_SUFFIX = r"\s+\|[^|]*\|?\s*$"
#: Fixed patterns: attachment points with a label, and any attachment point.
LABELLED, ANY_STAR = r"\[\*:(\d+)\]", r"\*"


def as_list(value: Column) -> Column:
    """Text becomes a list at the points, empties dropped; null becomes the empty list."""
    return F.coalesce(F.filter(F.split(value, r"\."), lambda x: x != ""), F.array().cast("array<string>"))


def as_lists(df: DataFrame, col: str) -> Column:
    """The column as a list of texts: text by as_list(); a list keeps its elements whole, as text."""
    value = F.col(col)
    return as_list(value) if df.schema[col].dataType.typeName() == "string" else F.coalesce(value.cast("array<string>"), F.array().cast("array<string>"))


def strip_cx(value: Column) -> Column:
    return F.regexp_replace(value, CX_SUFFIX, "")


def reaction_parts(text: Column) -> Column:
    """struct(reactants, agents, products) of a>>b or a>agents>b; null if malformed or a side is empty.

    Only what stands before the first white space counts.
    """
    first = F.regexp_extract(F.trim(text), r"^(\S*)", 1)
    part = F.split(first, ">")
    side = lambda i: F.filter(F.split(F.get(part, F.lit(i)), r"\."), lambda x: x != "")
    good = (F.size(part) == 3) & (F.size(side(0)) > 0) & (F.size(side(2)) > 0)
    return F.when(good, F.struct(side(0).alias("reactants"), side(1).alias("agents"), side(2).alias("products")))


def level_of(n_steps: Column) -> Column:
    """easy, medium or hard by the number of steps; null for null."""
    return F.when(n_steps <= EASY_STEPS, "easy").when(n_steps <= MEDIUM_STEPS, "medium").when(n_steps.isNotNull(), "hard")


def name_key(name: Column) -> Column:
    return F.lower(F.trim(F.coalesce(name, F.lit(""))))


def rgroup_labels(molecules: Column) -> Column:
    """Sorted distinct labels of attachment points in a list of molecules."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(molecules, lambda m: F.transform(F.regexp_extract_all(m, F.lit(LABELLED), F.lit(1)), lambda d: d.cast("int"))))))


def is_template(molecules: Column) -> Column:
    return F.exists(molecules, lambda m: m.rlike(LABELLED))


def first_paragraph(text: Column, limit: int = 1200) -> Column:
    """The first paragraph of trimmed text, at most so many characters; null if empty."""
    para = F.substring(F.split(F.trim(text), "\n\n").getItem(0), 1, limit)
    return F.when(para != "", para)


class Kernel:
    """What the operators need to know of molecules; any object with these methods will do."""

    def normal(self, text: str | None) -> tuple[str | None, str | None, bool, str | None]:
        """(canonical, key, ok, reason)."""
        raise NotImplementedError


class SmilesKernel(Kernel):
    """The pure-Python line-formula kernel."""

    def __init__(self, keep_maps: bool = True):
        self.keep_maps = keep_maps

    def normal(self, text):
        import re

        if text is None or not text.strip():
            return None, None, False, "empty"
        bare = re.sub(CX_SUFFIX, "", text).strip()
        if re.search(ANY_STAR, bare):
            return bare, "SMI:" + bare, False, "rgroup_template"
        if not S.valid(bare):
            return None, None, False, "unparseable"
        canon = S.canonical(bare, self.keep_maps)
        return canon, "SMI:" + (S.canonical(bare, False) if ":" in bare and self.keep_maps else canon), True, None


class TextKernel(Kernel):
    """Canonical text is lower case with single spaces, its key the sha1: exact in SQL."""

    def normal(self, text):
        import hashlib

        canon = " ".join((text or "").lower().split())
        if not canon:
            return None, None, False, "empty"
        return canon, hashlib.sha1(canon.encode()).hexdigest(), True, None


def normalized(values: DataFrame, col: str, kernel: Kernel | None = None) -> DataFrame:
    """(col, canonical, mol_key, ok, reason), one row per distinct value: the kernel sees each once."""
    kernel = kernel or SmilesKernel()

    def run(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            got = [kernel.normal(t) for t in texts]
            cols = [list(c) for c in zip(*got)] if got else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.string())], names=[col, "canonical", "mol_key", "ok", "reason"])

    return spread(values.select(F.col(col).cast("string")).distinct(), col).mapInArrow(run, f"`{col}` string, canonical string, mol_key string, ok boolean, reason string")


def normalize_list(df: DataFrame, key: str, col: str, kernel: Kernel | None = None) -> DataFrame:
    """(key, pos, col's element, canonical, mol_key, ok, reason); failures keep the original text."""
    items = df.select(key, F.posexplode(col).alias("pos", "molecule"))
    done = normalized(items, "molecule", kernel)
    out = items.join(done.withColumnRenamed("molecule", "_m"), F.col("molecule").eqNullSafe(F.col("_m"))).drop("_m")
    return out.withColumn("canonical", F.coalesce("canonical", "molecule"))


def vocabulary(items: DataFrame, key: str, canonical: str, source: str, order: list[str]) -> DataFrame:
    """Per key: first canonical text in the given order, total count, sorted distinct sources."""
    return items.groupBy(key).agg(F.min_by(canonical, F.struct(*order)).alias("canonical"), F.count("*").alias("n"), F.sort_array(F.collect_set(source)).alias("sources"))


def sanitize_stats(items: DataFrame, source: str, ok: str) -> DataFrame:
    """Per source: values, good ones and their percentage."""
    good = F.sum(F.coalesce(F.col(ok), F.lit(False)).cast("int"))
    return items.groupBy(source).agg(F.count("*").alias("n"), good.alias("n_ok"), F.round(100 * good / F.count("*"), 4).alias("pct"))


def sanitize_reasons(items: DataFrame, source: str, ok: str, reason: str) -> DataFrame:
    """(source, reason, n) of the values that failed; without a reason they count as unknown."""
    bad = items.filter(~F.coalesce(F.col(ok), F.lit(False)))
    return bad.groupBy(source, F.coalesce(reason, F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


Resolver = Callable[[str], tuple[str | None, str | None]]


def resolve_names(df: DataFrame, col: str, resolver: Resolver | None = None) -> DataFrame:
    """Adds structure and resolve_reason to each row by a name resolver that sees distinct names
    once; without one, or where it fails, the reason tells."""

    def run(batches):
        for b in batches:
            names, forms, whys = b.column(0).to_pylist(), [], []
            for n in names:
                form, why = None, "unavailable"
                if n is None or not n.strip():
                    why = "empty"
                elif resolver is not None:
                    try:
                        form, why = resolver(n)
                    except Exception as e:  # a resolver's failure is a reason, not the job's end
                        why = f"resolver_error:{type(e).__name__}"
                forms.append(form)
                whys.append(why)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string()), pa.array(whys, pa.string())], names=[col, "structure", "resolve_reason"])

    done = df.select(col).distinct().mapInArrow(run, f"`{col}` string, structure string, resolve_reason string")
    return df.join(done.withColumnRenamed(col, "_n"), F.col(col).eqNullSafe(F.col("_n")), "left").drop("_n")
