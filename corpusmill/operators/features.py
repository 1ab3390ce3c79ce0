"""Order-independent signatures, step hashes and fingerprints of records."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import smiles as S
from corpusmill.session import spread

#: Fixed patterns: bracket atoms of the organic subset, of which a skeleton keeps the element only, and
#: the signs of double-bond stereo.
BARE_ATOM, STEREO_SIGN = r"\[\d*(Br|Cl|[BCNOPSFI]|[bcnops])@{0,2}(?:H\d*)?(?:\++\d*|-+\d*)?(?::\d+)?\]", r"[/\\]"
_BARE, _STEREO = re.compile(BARE_ATOM), re.compile(STEREO_SIGN)
#: The only bit of a reaction whose sides set the same bits: two such reactions are alike.
UNCHANGED = -1


def side_key(keys: Column) -> Column:
    """Sorted keys joined by points, null for an empty or null side; null keys are left out."""
    kept = F.sort_array(F.filter(keys, lambda k: k.isNotNull() & (k != "")))
    return F.when(F.size(kept) > 0, F.array_join(kept, "."))


def signature(reactants: Column, products: Column) -> Column:
    """R:...>>P:... over molecule keys, null if either side is empty."""
    return F.concat(F.lit("R:"), side_key(reactants), F.lit(">>P:"), side_key(products))


def skeleton(keys: Column) -> Column:
    """Each key without charges, hydrogens, isotopes, maps and stereo: the connectivity as written.
    skeleton_keys() gives one text for all drawings."""
    return F.transform(keys, lambda k: F.regexp_replace(F.regexp_replace(k, BARE_ATOM, "$1"), STEREO_SIGN, ""))


def connectivity(text: str) -> str | None:
    """Canonical text of a structure without charges, hydrogens, isotopes, maps and stereo."""
    return S.canonical(_STEREO.sub("", _BARE.sub(r"\1", text))) if S.valid(text) else None


def step_hash(steps: Column, kind: str, form: str) -> Column:
    """sha1 over kind|form lines in order; null without steps. Null parts count as empty."""
    line = lambda s: F.concat(F.coalesce(s[kind], F.lit("")), F.lit("|"), F.coalesce(s[form], F.lit("")))
    return F.when(F.size(steps) > 0, F.sha1(F.array_join(F.transform(steps, line), "\n")))


def sign_bits(vector: Column) -> Column:
    """The places of positive numbers: a bit set out of a vector."""
    return F.filter(F.transform(vector, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())


def union_bits(sets: Column) -> Column:
    """All bits of an array of bit sets."""
    return F.array_distinct(F.flatten(sets))


def xor_bits(a: Column, b: Column) -> Column:
    """Bits of exactly one side, ascending."""
    return F.sort_array(F.array_union(F.array_except(a, b), F.array_except(b, a)))


def _by_molecule(values: DataFrame, col: str, one, kind: pa.DataType, ddl: str, out: str) -> DataFrame:
    """(col, out) by a function of the text, which sees each distinct molecule once."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(t) for t in b.column(0).to_pylist()], kind)], names=[col, out])

    return spread(values.select(F.col(col).cast("string")).filter(F.col(col).isNotNull()).distinct(), col).mapInArrow(run, f"`{col}` string, `{out}` {ddl}")


def molecule_bits(text: str) -> list[int] | None:
    """The kernel's fingerprint; None if the structure isn't valid."""
    return S.fingerprint_bits(text) if S.valid(text) else None


def reaction_bits(rows: DataFrame, key: str, reactants: str, products: str, out: str = "fp", bits_of=molecule_bits) -> DataFrame:
    """Adds the reaction fingerprint of unique keys: the bits of exactly one side, each side the
    union of its molecules' bits; null if a side has nothing parseable. bits_of gives a molecule's."""
    side = lambda c, n: F.coalesce(F.transform(c, lambda m: F.struct(F.lit(n).alias("side"), m.alias("m"))), F.array())
    parts = rows.select(key, F.explode(F.concat(side(reactants, 0), side(products, 1))).alias("x")).select(key, "x.side", "x.m")
    done = _by_molecule(parts, "m", bits_of, pa.list_(pa.int32()), "array<int>", "bits").filter("bits is not null")
    of = lambda n: union_bits(F.collect_list(F.when(F.col("side") == n, F.col("bits"))))
    sides = parts.join(done, "m").groupBy(key).agg(of(0).alias("_r"), of(1).alias("_p")).filter((F.size("_r") > 0) & (F.size("_p") > 0))
    bits = sides.select(key, xor_bits(F.col("_r"), F.col("_p")).alias(out)).withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(F.array(F.lit(UNCHANGED))))
    return rows.join(bits, key, "left")


def skeleton_keys(rows: DataFrame, key: str, sides: list[str], skeleton_of=connectivity) -> DataFrame:
    """Adds <side>_skeletons for list columns of unique keys: the connectivity of each structure that
    can be read, sorted; each distinct structure once. skeleton_of gives a structure's."""
    each = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda m: F.struct(F.lit(c).alias("side"), m.alias("m")))
    parts = rows.select(key, F.explode(F.concat(*(each(c) for c in sides))).alias("x")).select(key, "x.side", "x.m")
    done = _by_molecule(parts, "m", skeleton_of, pa.string(), "string", "_s").filter("_s is not null")
    of = lambda c: F.sort_array(F.collect_list(F.when(F.col("side") == c, F.col("_s")))).alias(f"{c}_skeletons")
    return rows.join(parts.join(done, "m").groupBy(key).agg(*(of(c) for c in sides)), key, "left")


def product_bucket(rows: DataFrame, key: str, products: str, out: str = "bucket", skeleton_of=connectivity) -> DataFrame:
    """Adds the smallest of the products' skeletons, for unique keys; null without a parseable product."""
    done = skeleton_keys(rows.select(key, products), key, [products], skeleton_of).select(key, F.get(f"{products}_skeletons", F.lit(0)).alias(out))
    return rows.join(done, key, "left")


def tanimoto(a: Column, b: Column) -> Column:
    """Shared over all bits, 1.0 for two empty sets."""
    both, whole = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(whole == 0, 1.0).otherwise(both / whole)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also within lambdas."""
    return F.transform(F.array(value), body)[0]


def word_shingles(text: Column, n: int = 5) -> Column:
    """Hashes of the distinct runs of n words, or of the whole of a shorter text; empty for null or blank."""

    # single elements, as slice() would copy the whole list for every run
    def runs(words: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(n))))
        return F.when(F.size(words) >= n, F.array_distinct(several)).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))

    return let(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != ""), runs)
