"""Atom mapping of reactions and their steps by a pluggable mapper, with quarantine of doubtful maps."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import smiles as S
from corpusmill.operators.aggregates import fixed_bins, first_rows
from corpusmill.session import spread

#: Reaction texts (a.b>>c) to (mapped text, confidence between 0 and 1), called once per batch.
Mapper = Callable[[list[str]], list[tuple[str | None, float]]]
#: Maps below this confidence are put aside, and the reasons where there is none.
CONFIDENT, INVALID, UNAVAILABLE = 0.30, "invalid_or_rgroup", "mapper_unavailable"


def valid_side(forms: list[str | None] | None) -> bool:
    """Whether a side can be mapped: not empty, no attachment points, every structure readable."""
    return bool(forms) and all(f and "*" not in f and S.valid(f) for f in forms)


def mapped(reactions: DataFrame, mapper: Mapper | None = None) -> DataFrame:
    """(reactants, products, mapped, confidence, map_reason) of each distinct reaction in the list
    columns reactants and products; a mapper's failure is a reason, not the job's end."""

    def run(batches):
        for b in batches:
            sides = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            out: list[tuple] = [(None, None, INVALID)] * len(sides)
            good = [i for i, (r, p) in enumerate(sides) if valid_side(r) and valid_side(p)]
            texts = [f"{'.'.join(sides[i][0])}>>{'.'.join(sides[i][1])}" for i in good]
            if mapper is None:
                found = [(None, None, UNAVAILABLE)] * len(good)
            else:
                try:
                    found = [(t, float(c), None) for t, c in mapper(texts)]
                except Exception:  # one by one, so that only the failing reactions fail
                    found = []
                    for t in texts:
                        try:
                            x, c = mapper([t])[0]
                            found.append((x, float(c), None))
                        except Exception as e:
                            found.append((None, None, f"map_error:{type(e).__name__}"))
            for i, x in zip(good, found):
                out[i] = x
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.string())))], names=["reactants", "products", "mapped", "confidence", "map_reason"])

    lists = "array<string>"
    distinct = spread(reactions.select(F.col("reactants").cast(lists), F.col("products").cast(lists)).distinct(), "reactants", "products")
    return distinct.mapInArrow(run, f"reactants {lists}, products {lists}, mapped string, confidence double, map_reason string")


def _with_map(rows: DataFrame, mapper: Mapper | None) -> DataFrame:
    found = mapped(rows, mapper).withColumnsRenamed({"reactants": "_r", "products": "_p"})
    return rows.join(found, F.col("reactants").eqNullSafe(F.col("_r")) & F.col("products").eqNullSafe(F.col("_p")), "left").drop("_r", "_p")


def map_records(records: DataFrame, key: str, mapper: Mapper | None = None, premapped: str = "reaction_smiles_mapped", least: float = CONFIDENT) -> DataFrame:
    """(key, reaction_smiles_mapped, confidence, map_reason, quarantine, premapped): a source's own map
    is kept where none can be made, and then not put aside."""
    rows = _with_map(records.select(key, "reactants", "products", F.col(premapped).alias("_pre")), mapper)
    ok = F.col("map_reason").isNull()
    kept = ~ok & (F.col("_pre") != "")
    reason = F.when(kept, F.concat(F.lit("kept_premapped("), "map_reason", F.lit(")"))).otherwise(F.col("map_reason"))
    quarantine = ok & F.coalesce(F.round("confidence", 10) < least, F.lit(False))
    return rows.select(key, F.when(ok, F.col("mapped")).otherwise(F.col("_pre")).alias("reaction_smiles_mapped"), F.round("confidence", 4).alias("confidence"), reason.alias("map_reason"), quarantine.alias("quarantine"), F.when(~kept, F.col("_pre")).alias("premapped"))


def map_steps(records: DataFrame, key: str, steps: str, form: str, mapper: Mapper | None = None) -> DataFrame:
    """(key, pos, mapped, confidence, map_reason) of each step, mapped from the one before it; the first
    from the reactants."""
    each = records.select(key, F.col("reactants").alias("_start"), F.col(steps).alias("_s"), F.posexplode(steps).alias("pos", "_step"))
    before = F.when(F.col("pos") == 0, F.col("_start")).otherwise(F.array(F.get("_s", F.col("pos") - 1)[form]))
    rows = _with_map(each.select(key, "pos", before.alias("reactants"), F.array(F.col("_step")[form]).alias("products")), mapper)
    return rows.select(key, "pos", "mapped", F.round("confidence", 4).alias("confidence"), "map_reason")


def least_confidence(steps: DataFrame, key: str) -> DataFrame:
    """(key, least) of the mapped steps' confidences; null where no step has one."""
    return steps.groupBy(key).agg(F.min("confidence").alias("least"))


def confidence_report(rows: DataFrame, confidence: str = "confidence") -> DataFrame:
    """One row: rows with a confidence, its mean of four decimals (null without any), and counts in
    five bins as an array."""
    bins = [F.count_if(fixed_bins(F.col(confidence)) == i) for i in range(5)]
    return rows.agg(F.count(confidence).alias("n"), F.round(F.avg(confidence), 4).alias("mean"), F.array(*bins).alias("histogram"))


def mapping_sample(records: DataFrame, order: list[str], n: int = 200) -> DataFrame:
    """The records to map: the first n in order, all for 0."""
    return records if n == 0 else first_rows(records, order, n)
