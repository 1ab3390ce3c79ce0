"""Train, validation and test splits that keep related rows together.

Method: the entities that ids name (templates, deposits, patents) are nodes, entities named in one
id are linked, and hash-to-min (Rastogi, Machanavajjhala, Chitnis & Das Sarma 2013) finds the
components: each node sends its cluster to the cluster's minimum and the minimum to the cluster's
nodes until nothing changes. Weighted rendezvous hashing then gives each component to a split.

Proportions are kept by bounded loads: a split takes part in a component's draw only while it has
room for all its rows, and its weight is the room it has left. Rooms are brought up to date after
each component of more than a thousandth of all rows (at most a thousand of them), largest first,
and once for the others, which are far too small to fill a split by themselves; the rule is the
same for all.

Defined cases: a null, blank or nameless id is read from the row's record; a row without any
entity is a group of its own, named "row" and its row_id; white space, case, separators, leading
zeros, re-export marks and percent escapes in ids do not matter; cycles and self links do no harm;
repeated rows are kept, each in its group's split; empty tables give empty results; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators.components import hash_to_min
from corpusmill.session import staged

#: Names that may link entities but never give a group its name begin with this; it sorts last.
HIDDEN = "~"


def _tidy(name: Column) -> Column:
    """A reaction's name in lower case, words apart by single spaces."""
    return F.trim(F.regexp_replace(F.lower(name), r"[\s_\-‐-―]+", " "))


def entities(reaction_id: Column) -> Column:
    """The entities an id names, in order: templates as NR-417, deposits as ds000408, patents as
    P0069633, named reactions as the hidden name ~wiki and their tidied name."""
    text = F.lower(F.trim(reaction_id))
    text = F.regexp_replace(text, r"^v\d+:\s*", "")
    text = F.regexp_replace(text, r"((__|#)[a-z]+\d+)+\s*$", "")
    head = F.regexp_extract(text, r"^(.*?)(?=_\d+-|$)", 1)

    def numbers(source: Column, pattern: str, made) -> Column:
        return F.transform(F.regexp_extract_all(source, F.lit(pattern), F.lit(0)), made)

    digits = lambda x: F.regexp_extract(x, r"0*(\d+)$", 1)
    templates = numbers(head, r"(?<![a-z])n[rg][^a-z0-9]*\d+", lambda x: F.concat(F.upper(F.substring(x, 1, 2)), F.lit("-"), digits(x)))
    deposits = numbers(text, r"(?<![a-z])(?:ds|dataset)[^a-z0-9]?\d+", lambda x: F.concat(F.lit("ds"), F.lpad(digits(x), 6, "0")))
    patents = numbers(text, r"(?<![a-z])p[^a-z0-9]?\d+", lambda x: F.concat(F.lit("P"), F.lpad(digits(x), 7, "0")))
    named = F.array(F.concat(F.lit(HIDDEN + "wiki "), _tidy(F.coalesce(F.try_url_decode(F.regexp_replace(text, r"^wiki[^a-z0-9%]*", "")), text))))
    return F.when(text.startswith("wiki"), named).when(F.size(templates) > 0, templates).otherwise(F.array_union(deposits, patents))


def links(rows: DataFrame, templates: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct links (a, b): entities in one id, names of templates, and retired numbers."""
    pairs = rows.filter(F.size("names") > 1).select(F.explode(F.transform(F.sequence(F.lit(2), F.size("names")), lambda i: F.struct(F.element_at("names", 1).alias("a"), F.element_at("names", i).alias("b")))).alias("p")).select("p.a", "p.b")
    names = templates.filter("name is not null and base is not null").select(F.concat(F.lit(HIDDEN + "wiki "), _tidy(F.col("name"))).alias("a"), F.col("base").alias("b"))
    retired = aliases.filter("alias is not null and base is not null").select(F.col("alias").alias("a"), F.col("base").alias("b"))
    return pairs.unionByName(names).unionByName(retired).filter("a != b").distinct()


def group_keys(rows: DataFrame, records: DataFrame, templates: DataFrame, aliases: DataFrame) -> DataFrame:
    """(row_id, group_key) for every row; rows has row_id, record_no and reaction_id."""
    named = rows.select("row_id", "record_no", entities(F.col("reaction_id")).alias("names"))
    lacking = F.coalesce(F.size("names") < 1, F.lit(True))
    of_record = records.filter("record_no is not null").groupBy("record_no").agg(F.min("reaction_id").alias("reaction_id"))
    filled = named.filter(lacking).select("row_id", "record_no").join(of_record, "record_no", "left").select("row_id", entities(F.col("reaction_id")).alias("names"))
    every = named.filter(~lacking).select("row_id", "names").unionByName(filled)
    hidden = aliases.filter("alias is not null").select(F.col("alias").alias("name")).exceptAll(templates.select(F.col("base").alias("name")))
    edges = links(every, templates, aliases)
    # a retired number may link, but must not name a group
    for side in ("a", "b"):
        edges = edges.join(hidden.distinct().withColumnRenamed("name", side).withColumn("old", F.lit(HIDDEN)), side, "left").withColumn(side, F.concat(F.coalesce("old", F.lit("")), F.col(side))).drop("old")
    found = hash_to_min(edges)
    plain = found.select(F.regexp_replace("node", rf"^{HIDDEN}(?!wiki )", "").alias("name"), "component").groupBy("name").agg(F.min("component").alias("component"))
    first = every.select("row_id", F.get("names", F.lit(0)).alias("name"))
    key = F.coalesce("component", "name")
    return first.join(plain, "name", "left").select("row_id", F.coalesce(F.regexp_replace(key, rf"^{HIDDEN}(wiki )?", ""), F.concat(F.lit("row "), F.col("row_id"))).alias("group_key"))


def _draw(key: Column, split: str, seed: int) -> Column:
    """A number in (0, 1) from key, split and seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{split}|"), key))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _rendezvous(key: str, rooms: dict[str, float], n: float, seed: int) -> str:
    """The split that wins the draw among those with room for n rows; the roomiest if none has."""
    fit = {s: w for s, w in rooms.items() if w >= n and w > 0}
    return min(sorted(fit), key=lambda s: -math.log(_drawn(key, s, seed)) / fit[s]) if fit else max(sorted(rooms), key=lambda s: rooms[s])


def _drawn(key: str, split: str, seed: int) -> float:
    """As _draw()."""
    return (int(hashlib.md5(f"{seed}|{split}|{key}".encode()).hexdigest()[:13], 16) + 0.5) / float(1 << 52)


def split_of(sizes: DataFrame, shares: dict[str, float], seed: int = 20240709, heavy: float = 0.001) -> Column:
    """The split of the column group_key, given (group_key, n) of all groups: needs no join."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    rooms, placed = {s: w * total / sum(shares.values()) for s, w in sorted(shares.items())}, {}
    # at most 1/heavy groups can be larger than heavy times all rows
    for r in sizes.filter(F.col("n") > heavy * total).orderBy(F.desc("n"), "group_key").collect():
        placed[r["group_key"]] = _rendezvous(r["group_key"], rooms, r["n"], seed)
        rooms[placed[r["group_key"]]] -= r["n"]
    open_ = {s: w for s, w in rooms.items() if w > 0} or {s: 1.0 for s in rooms}
    hashed = F.array_min(F.array(*(F.struct((-F.ln(_draw(F.col("group_key"), s, seed)) / w).alias("score"), F.lit(s).alias("split")) for s, w in open_.items())))["split"]
    fixed = F.create_map(*(F.lit(x) for kv in placed.items() for x in kv))[F.col("group_key")] if placed else F.lit(None).cast("string")
    return F.coalesce(fixed, hashed)


def group_sizes(keys: DataFrame) -> DataFrame:
    return staged(keys.groupBy("group_key").agg(F.count("*").alias("n")), "group-sizes")


def assign(keys: DataFrame, shares: dict[str, float], seed: int = 20240709) -> DataFrame:
    """(group_key, n, split) for each group; shares are the wanted proportions by split."""
    sizes = group_sizes(keys)
    return sizes.withColumn("split", split_of(sizes, shares, seed))


def split_rows(keys: DataFrame, shares: dict[str, float], seed: int = 20240709) -> DataFrame:
    """(row_id, group_key, split)."""
    return keys.select("row_id", "group_key", split_of(group_sizes(keys), shares, seed).alias("split"))


def report(keys: DataFrame, shares: dict[str, float], seed: int = 20240709) -> DataFrame:
    """Per split: rows, groups, wanted and actual share."""
    whole = sum(shares.values())
    wanted = F.create_map(*(F.lit(x) for s, w in shares.items() for x in (s, w / whole)))
    per = assign(keys, shares, seed).groupBy("split").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"))
    total = F.sum("n_rows").over(Window.partitionBy())  # one row a split
    return per.select("split", "n_rows", "n_groups", F.round(wanted[F.col("split")], 6).alias("wanted_share"), F.round(F.col("n_rows") / total, 6).alias("actual_share"))
