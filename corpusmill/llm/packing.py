"""Filling containers of fixed capacity with items of varying length.

Method: Martello and Toth's reduction. While, for the largest open item, a set of at most three
items provably dominates every other set that could go with it, that set is fixed as a container;
the shrunk rest is packed best-fit decreasing. Items are whole numbers of at most the capacity, so
the instance is its histogram: how often each length occurs. The reduction and the fit run on
lengths with multiplicities, whose number is bounded by the capacity and not by the data; they
give patterns with multiplicities. Every item then finds its container from its rank among the
items of its length, without meeting other items.

Defined cases: an item above the capacity is cut into full pieces and a remainder, others are never
split; items without tokens (null or empty text) lie in container 1; equal lengths go by a hash of
key and piece, which spreads them over 256 blocks, and within a block by key; repeated rows are items of their own; a capacity null or below 1 packs nothing; specs of a
language take the rows of that language in any spelling; empty tables give empty results; further
columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.text import label
from corpusmill.session import staged

#: Tables of specs have at most so many rows, and all their solutions so many rows in all (48 bytes
#: each); both depend on the specs, not on the number of items. They are held in every task.
MOST_SPECS, MOST_PLACES = 1_000, 4_000_000
#: Ranks within a length are counted in so many blocks.
BLOCKS = 256
Pattern = tuple[tuple[int, int], ...]


class _Bag:
    """Lengths with multiplicities."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, k: int) -> None:
        self.n[size] -= k
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest_upto(self, limit: int, without: dict[int, int]) -> int | None:
        """The largest length of at most limit that is left besides those in without."""
        i = bisect_right(self.sizes, limit) - 1
        while i >= 0:
            if self.n[self.sizes[i]] > without.get(self.sizes[i], 0):
                return self.sizes[i]
            i -= 1
        return None

    def smallest(self, k: int, without: dict[int, int]) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(k - len(out), self.n[s] - without.get(s, 0))
            if len(out) >= k:
                break
        return out


def _best_pair(bag: _Bag, limit: int, a: int) -> int:
    """The largest sum of two lengths of at most limit, the item of length a aside; 0 if none."""
    best, lo, hi = 0, 0, bisect_right(bag.sizes, limit) - 1
    left = lambda s: bag.n[s] - (s == a)
    while lo <= hi:
        x, y = bag.sizes[lo], bag.sizes[hi]
        if x + y > limit or not left(y):
            hi -= 1
        elif not left(x):
            lo += 1
        else:
            if lo < hi or left(x) > 1:
                best = max(best, x + y)
            lo += 1
    return best


def _dominating(bag: _Bag, a: int, capacity: int) -> tuple[int, ...] | None:
    """Companions of an item of length a that dominate all other sets with it, or None."""
    room, own = capacity - a, {a: 1}
    low = bag.smallest(3, own)
    if not low or low[0] > room:
        return ()
    k = bag.largest_upto(room, own)
    if k == room or len(low) < 2 or low[0] + low[1] > room:
        return (k,)
    if len(low) == 3 and sum(low) <= room:
        return None  # sets of four or more could fit
    if k >= _best_pair(bag, room, a):
        return (k,)
    also = dict(own)
    also[k] = also.get(k, 0) + 1
    q = bag.largest_upto(room - k, also)
    most = bag.largest_upto(room // 2, own)
    return (k, q) if q is not None and most is not None and q >= most else None


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Containers fixed by dominance, as patterns with multiplicities, and the lengths left."""
    bag, fixed = _Bag(counts), []
    for a in sorted(counts, reverse=True):
        while bag.n.get(a, 0):
            others = _dominating(bag, a, capacity)
            if others is None:
                break
            need: dict[int, int] = {}
            for s in (a, *others):
                need[s] = need.get(s, 0) + 1
            # the same set stays dominating while none of its lengths runs out
            times = min(bag.n[s] // k for s, k in need.items())
            for s, k in need.items():
                bag.take(s, k * times)
            fixed.append((tuple(sorted(need.items(), reverse=True)), times))
    return fixed, dict(bag.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on lengths with multiplicities."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, times))

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            i = bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms[i]
                pattern, times = open_[room].pop()
                if times > left:
                    open_[room].append((pattern, times - left))
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
                t = min(times, left)
                grown = pattern[:-1] + ((s, pattern[-1][1] + 1),) if pattern[-1][0] == s else pattern + ((s, 1),)
                put(room - s, grown, t)
                left -= t
            else:
                each = capacity // s
                if left >= each:
                    put(capacity - each * s, ((s, each),), left // each)
                if left % each:
                    put(capacity - left % each * s, ((s, left % each),), 1)
                left = 0
    return [p for room in rooms for p in open_[room]]


def solve(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns (lengths with how often) and how many containers have each."""
    fixed, rest = reduce(counts, capacity)
    return fixed + best_fit(rest, capacity)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer containers."""
    sizes = sorted(counts)
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    total = np.zeros(capacity + 2)
    num = np.zeros(capacity + 2)
    for s in sizes:
        total[s + 1 :] += s * counts[s]
        num[s + 1 :] += counts[s]
    for alpha in {0, *(s for s in sizes if s <= capacity // 2)}:
        big = num[capacity + 1] - num[capacity - alpha + 1]
        mid_n = num[capacity - alpha + 1] - num[capacity // 2 + 1]
        mid_s = total[capacity - alpha + 1] - total[capacity // 2 + 1]
        small = total[capacity // 2 + 1] - total[alpha]
        best = max(best, int(big + mid_n + max(0, -(-(small - (mid_n * capacity - mid_s)) // capacity))))
    return best


class _Places:
    """Where the items of each length go: arrays over all patterns, sorted by length and rank."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        rows, upto, base = [], {}, 1
        for pattern, times in patterns:
            for s, each in pattern:
                start = upto.get(s, 0)
                rows.append((s, start, base, each))
                upto[s] = start + each * times
            base += times
        rows.sort()
        self.containers = base - 1
        self.size, self.start, self.base, self.each = (np.array([r[i] for r in rows], np.int64) for i in range(4)) if rows else (np.zeros(0, np.int64),) * 4

    def find(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.ones(len(size), np.int64)
        ok = size > 0
        for s in np.unique(size[ok]):
            lo, hi = np.searchsorted(self.size, [s, s + 1])
            at = np.flatnonzero(size == s)
            row = lo + np.searchsorted(self.start[lo:hi], rank[at], side="right") - 1
            out[at] = self.base[row] + (rank[at] - self.start[row]) // self.each[row]
        return out


def _given(specs: DataFrame) -> list[tuple[int, int, str | None]]:
    rows = specs.filter("capacity_tokens > 0").select("spec_id", "capacity_tokens", label(F.col("lang")).alias("only")).limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} specs")
    return sorted((r["spec_id"], r["capacity_tokens"], r["only"] or "") for r in rows)


def items(sized: DataFrame, specs: DataFrame, key: str) -> DataFrame:
    """(spec_id, key, piece, from_token, n_tokens) of every piece to be packed: each document under
    the specs of its language and those of all."""
    given = _given(specs)
    every = F.from_json(F.lit(json.dumps([{"i": i, "c": c, "only": only} for i, c, only in given])), "array<struct<i:int,c:bigint,only:string>>")
    own = F.filter(every, lambda s: s["only"].isin("", F.col("lang")))
    docs = sized.select(key, F.coalesce(label(F.col("lang")), F.lit("")).alias("lang"), F.col("n_tokens").alias("whole")).select(key, "whole", F.explode(own).alias("s"))
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.expr("(whole - 1) div s.c")))).alias("piece")
    start = F.col("piece") * F.col("c")
    return docs.select(F.col("s.i").alias("spec_id"), F.col("s.c").alias("c"), key, "whole", pieces).select("spec_id", key, "piece", start.alias("from_token"), F.least(F.col("c"), F.col("whole") - start).alias("n_tokens"))


def plan(pieces: DataFrame, specs: DataFrame) -> dict[int, tuple[int, dict[int, int], list[tuple[Pattern, int]]]]:
    """Per spec its capacity, histogram and solution. At most the capacity's number of lengths per
    spec comes to the driver, MOST_PLACES in all."""
    hist: dict[int, dict[int, int]] = {}
    rows = pieces.filter("n_tokens > 0").groupBy("spec_id", "n_tokens").agg(F.count("*").alias("n")).limit(MOST_PLACES + 1).collect()
    if len(rows) > MOST_PLACES:
        raise ValueError(f"more than {MOST_PLACES} lengths over all specs")
    for r in rows:
        hist.setdefault(r["spec_id"], {})[r["n_tokens"]] = r["n"]
    return {i: (c, hist.get(i, {}), solve(hist.get(i, {}), c)) for i, c, _ in _given(specs)}


def pack(sized: DataFrame, specs: DataFrame, key: str) -> DataFrame:
    """(spec_id, container, key, piece, from_token, n_tokens): where every piece lies."""
    pieces = staged(items(sized, specs, key), "pack-items")
    solved = {i: _Places(p) for i, (_, _, p) in plan(pieces, specs).items()}
    if sum(len(p.size) for p in solved.values()) > 4 * MOST_PLACES:
        raise ValueError("the solutions are too many to be held in every task")
    places = sized.sparkSession.sparkContext.broadcast(solved)
    fields = {f.name: f.dataType.simpleString() for f in pieces.schema}
    group = ["spec_id", "n_tokens", "block"]
    blocked = pieces.withColumn("block", F.pmod(F.xxhash64(key, "piece"), F.lit(BLOCKS)))
    within = (F.row_number().over(Window.partitionBy(*group).orderBy(key, "piece")) - 1).cast("bigint")
    upto = Window.partitionBy("spec_id", "n_tokens").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocked.groupBy(*group).agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    ranked = blocked.withColumn("within", within).join(before, group).withColumn("rank", F.col("within") + F.col("before"))

    def run(batches):
        for b in batches:
            spec, size, at = (np.asarray(b.column(c)) for c in (0, 4, 5))
            out = np.ones(len(spec), np.int64)
            for i in np.unique(spec):
                own = np.flatnonzero(spec == i)
                out[own] = places.value[int(i)].find(size[own].astype(np.int64), at[own].astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), *b.columns[1:5]], names=["spec_id", "container", key, "piece", "from_token", "n_tokens"])

    return ranked.select("spec_id", key, "piece", "from_token", "n_tokens", "rank").mapInArrow(run, f"spec_id int, container bigint, `{key}` {fields[key]}, piece bigint, from_token bigint, n_tokens bigint")


def report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: pieces, split items, containers, tokens, share of unused space, fewest possible by tokens."""
    per = packed.groupBy("spec_id", "container").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("k"), F.sum((F.col("piece") > 0).cast("int")).alias("cuts"))
    out = per.groupBy("spec_id").agg(F.sum("k").alias("pieces"), F.sum("cuts").alias("cuts"), F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    cap = specs.select("spec_id", F.col("capacity_tokens").alias("capacity"))
    return out.join(cap, "spec_id").select("spec_id", "capacity", "pieces", "cuts", "containers", "tokens", "fullest", F.expr("(tokens + capacity - 1) div capacity").alias("fewest"), F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("unused_share"))
