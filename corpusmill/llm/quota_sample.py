"""Samples whose category shares meet given targets.

Method: one pass over the rows fills a reservoir per target in every task: of the rows that match,
the so many of smallest priority, a hash of request and row, as the target can need at most; and it
counts the matches. Reservoirs merge by union and the counts by addition. After the final counts
each target's union is trimmed to its feasible quota, by the priority range in which the quota is
reached, so that only rows of that range are ranked and no category is gathered in one task.
Targets whose counts stay below what they need are the exhausted ones.

Quota: size = floor(N * sample_permille / 1000), need = max(min_rows, ceil(size * target_permille /
1000)), taken = min(need, rows that match).

Defined cases: null level or subtype in a target means any; null, blank and filler values of a row
match no named value; all spellings of a value are one; ties in priority go by row key and then do
not matter, as tied rows are then equal; repeated rows are each a row; a target that no row matches
takes none and is reported; empty tables give empty samples and unmet targets (need above 0);
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions.text import LEVEL_ALIASES, category
from corpusmill.session import bounded_broadcast, staged

#: Tables of targets have at most so many rows; they are held in every task.
MOST_TARGETS = 10_000
#: Stands for any value in a cell key.
ANY = "*"


def _cell(level: Column, subtype: Column) -> Column:
    return F.concat_ws("\t", F.coalesce(level, F.lit(ANY)), F.coalesce(subtype, F.lit(ANY)))


def _targets(targets: DataFrame) -> DataFrame:
    """Targets with their cell key; a named value that is only a filler matches nothing."""
    key = lambda c, a=None: F.when(F.col(c).isNull(), F.lit(ANY)).otherwise(F.coalesce(category(F.col(c), a), F.lit("")))
    return targets.withColumn("cell", _cell(key("level", LEVEL_ALIASES), key("subtype")))


class _Reservoir:
    """The rows of smallest priority, at most so many, and how many were seen."""

    def __init__(self, most: int):
        self.most, self.seen, self.held, self.parts = most, 0, 0, []

    def add(self, priority: np.ndarray, keys: pa.Array) -> None:
        self.seen += len(keys)
        if self.most > 0:
            self.parts.append((priority, keys))
            self.held += len(keys)
            if self.held > 2 * self.most + 10_000:
                self.rows()

    def rows(self) -> tuple[np.ndarray, pa.Array] | None:
        if not self.parts:
            return None
        priority, keys = np.concatenate([p for p, _ in self.parts]), pa.concat_arrays([k for _, k in self.parts])
        if len(priority) > self.most:
            kept = np.argsort(priority, kind="stable")[: self.most]
            priority, keys = priority[kept], keys.take(pa.array(kept))
        self.parts, self.held = [(priority, keys)], len(keys)
        return priority, keys


def _priorities(request: int, keys: list) -> np.ndarray:
    """The first 60 bits of the md5 of request and key."""
    return np.array([int(hashlib.md5(f"{request}|{'' if k is None else k}".encode()).hexdigest()[:15], 16) for k in keys], np.int64)


def _filling(targets: list[tuple[int, int, str, int]]):
    by_cell: dict[str, list[tuple[int, int]]] = {}
    for target, request, cell, _ in targets:
        by_cell.setdefault(cell, []).append((target, request))

    def run(batches):
        held = {target: _Reservoir(need) for target, _, _, need in targets}
        kind = None
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            kind = keys.type
            cells: dict[tuple, list[int]] = {}
            for i, pair in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                cells.setdefault(pair, []).append(i)
            for (level, subtype), at in cells.items():
                drawn: dict[int, np.ndarray] = {}
                for cell in {f"{x}\t{y}" for x in (level or ANY, ANY) for y in (subtype or ANY, ANY)}:
                    for target, request in by_cell.get(cell, ()):
                        if request not in drawn:
                            drawn[request] = _priorities(request, [texts[i] for i in at])
                        held[target].add(drawn[request], keys.take(pa.array(at)))
        for target, r in held.items():
            if r.seen:
                rows = r.rows() or (np.zeros(0, np.int64), pa.array([], kind))
                n = len(rows[0]) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, target), pa.int64()), pa.concat_arrays([pa.array([None], pa.int64()), pa.array(rows[0], pa.int64())]), pa.concat_arrays([pa.nulls(1, kind), rows[1]]), pa.array([r.seen] + [0] * (n - 1), pa.int64())], names=["target_id", "priority", "key", "seen"]
                )

    return run


class Sampler:
    """One run over rows with level and subtype: the merged reservoirs of all targets."""

    def __init__(self, rows: DataFrame, targets: DataFrame, key: str):
        self.key = key
        size = F.expr(f"cast({rows.count()} as bigint) * sample_permille div 1000")
        need = F.greatest(F.coalesce("min_rows", F.lit(0)).cast("bigint"), F.expr("(size * target_permille + 999) div 1000"))
        self.targets = _targets(targets).withColumn("size", size).withColumn("need", need).select("target_id", "request_id", "cell", "target_permille", "size", "need")
        wanted = [(r["target_id"], r["request_id"], r["cell"], max(0, r["need"] or 0)) for r in self.targets.limit(MOST_TARGETS + 1).collect()]
        if len(wanted) > MOST_TARGETS:
            raise ValueError(f"more than {MOST_TARGETS} targets")
        kind = {f.name: f.dataType.simpleString() for f in rows.schema}[key]
        given = rows.select(F.col(key), F.col(key).cast("string").alias("text"), category(F.col("level"), LEVEL_ALIASES).alias("l"), category(F.col("subtype")).alias("s"))
        self.reservoirs = staged(given.mapInArrow(_filling(wanted), f"target_id bigint, priority bigint, key {kind}, seen bigint"), "reservoirs")

    def quotas(self) -> DataFrame:
        """Per target: size, need, have and taken."""
        have = self.reservoirs.filter("seen > 0").groupBy("target_id").agg(F.sum("seen").alias("have"))
        out = self.targets.join(have, "target_id", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("bigint")))
        return out.withColumn("taken", F.least("need", "have"))

    def unmet(self) -> DataFrame:
        """target_id of every target with fewer matching rows than needed."""
        return self.quotas().filter("have < need").select("target_id")

    def sample(self) -> DataFrame:
        """(request_id, target_id, key) of the sampled rows."""
        held = self.reservoirs.filter("priority is not null")
        bits = max(8, min(24, math.ceil(math.log2(held.count() + 1)) - 10))
        held = held.withColumn("slot", F.shiftright("priority", 60 - bits).cast("int"))
        upto = Window.partitionBy("target_id").orderBy("slot")
        quota = bounded_broadcast(self.quotas().select("target_id", "request_id", "taken"), MOST_TARGETS)
        reached = held.groupBy("target_id", "slot").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto)).join(quota, "target_id")
        edge = reached.filter("upto >= taken and upto - n < taken").select("target_id", "request_id", F.col("slot").alias("edge"), (F.col("taken") - F.col("upto") + F.col("n")).alias("open"))
        drawn = held.join(bounded_broadcast(edge, MOST_TARGETS), "target_id")
        out = ["request_id", F.col("target_id").cast(self.targets.schema["target_id"].dataType).alias("target_id"), F.col("key").alias(self.key)]
        rank = F.row_number().over(Window.partitionBy("target_id").orderBy("priority", "key"))
        return drawn.filter("slot < edge").select(*out).unionByName(drawn.filter("slot = edge").withColumn("r", rank).filter("r <= open").select(*out))

    def report(self) -> DataFrame:
        """Per target: need, have, taken, whether it is met, wanted and actual share of its request."""
        whole = F.sum("taken").over(Window.partitionBy("request_id"))
        share = F.round(F.col("taken") / F.when(whole > 0, whole), 6).alias("actual_share")
        return self.quotas().select("target_id", "request_id", "size", "need", "have", "taken", (F.col("have") >= F.col("need")).alias("met"), (F.col("target_permille") / 1000).alias("wanted_share"), share)
