"""Deeply nested JSON text as related flat tables.

Every object of a known kind gets pre-order and post-order numbers by one depth-first walk over
its document, so a node lies under another exactly if its interval lies inside the other's. Node
tables per type are cut from the one node table and linked by interval containment.

Defined cases: null, blank, incomplete or otherwise unreadable text gives no rows; JSON text
within JSON text is read again; a wrapper object with the list inside it is opened; a lone object
in place of a list is position 0; lists filed under whole numbers stand in the order of the
numbers; null elements keep their position and give no row; elements that are no objects count as
positions only; an empty object under a name (a gate) is a row; unknown fields stay in the node's
body; rows with equal keys are walked one by one; empty tables give empty results.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = "parent_table string, parent_key bigint, kind string, pos_path string, depth int, pre int, post int, body string"


@dataclass(frozen=True)
class Kind:
    """A kind of object and its fields that hold further kinds."""

    name: str
    parts: tuple[tuple[str, Kind], ...] = ()
    #: Fields of which a lone object of this kind has at least one.
    marks: tuple[str, ...] = ()


EVIDENCE = Kind("evidence")
STEP = Kind("step", (("arrows", Kind("arrow")), ("species", Kind("species", (("evidence", EVIDENCE),)))), ("step", "type", "subtype", "intermediate_smiles", "arrows", "species", "rationale"))
GATE = Kind("gate", (("inputs", Kind("input")), ("checks", Kind("check", (("failures", Kind("failure")),)))), ("phase", "status", "inputs", "checks"))


def _read(text):
    """The value behind text, however often it was encoded; None if it isn't complete JSON."""
    while isinstance(text, str):
        try:
            text = json.loads(text)
        except (ValueError, RecursionError):
            return None
    return text


def _listed(value, kind: Kind, wrappers: tuple[str, ...] = ()) -> list:
    """The elements that value stands for, each at its position."""
    value = _read(value) if isinstance(value, str) else value
    while isinstance(value, dict) and not any(m in value for m in kind.marks) and (inner := next((w for w in wrappers if w in value), None)):
        value = _read(value[inner]) if isinstance(value[inner], str) else value[inner]
    if isinstance(value, list):
        return value
    if not isinstance(value, dict):
        return []
    if value and all(k.strip().isdecimal() for k in value):
        return [value[k] for k in sorted(value, key=lambda k: (int(k), k))]
    return [value] if value or not wrappers else []


def _named(value, kind: Kind, wrappers: tuple[str, ...], name_field: str) -> list[tuple[str, dict]]:
    """(name, object) of objects filed under names, or listed with their name in a field."""
    while isinstance(value, dict) and (inner := next((w for w in wrappers if w in value), None)):
        value = _read(value[inner]) if isinstance(value[inner], str) else value[inner]
    if isinstance(value, dict) and isinstance(value.get(name_field), str):
        value = [value]
    if isinstance(value, dict):
        return list(value.items())
    if isinstance(value, list):
        return [(x[name_field] if isinstance(x.get(name_field), str) else str(i), x) for i, x in enumerate(value) if isinstance(x, dict)]
    return []


def walk(text: str | None, kind: Kind, wrappers: tuple[str, ...], name_field: str | None = None) -> list[tuple]:
    """(kind, pos_path, depth, pre, post, body) of every object in the text, in pre-order."""
    if text is None or not text.strip():
        return []
    value = _read(text)
    if value is None:
        return []
    out: list[list] = []
    clock = 0

    def visit(node: dict, kind: Kind, path: str, depth: int) -> None:
        nonlocal clock
        row = [kind.name, path, depth, clock, 0, json.dumps({k: v for k, v in node.items() if k not in dict(kind.parts)}, ensure_ascii=False, separators=(",", ":"))]
        out.append(row)
        clock += 1
        for field, part in kind.parts:
            for i, x in enumerate(_listed(node.get(field), part)):
                x = _read(x) if isinstance(x, str) else x
                if isinstance(x, dict):
                    visit(x, part, f"{path}.{i}", depth + 1)
        row[4] = clock
        clock += 1

    if name_field is None:
        for i, x in enumerate(_listed(value, kind, wrappers)):
            x = _read(x) if isinstance(x, str) else x
            if isinstance(x, dict):
                visit(x, kind, str(i), 0)
    else:
        for name, x in _named(value, kind, wrappers, name_field):
            x = _read(x) if isinstance(x, str) else x
            if isinstance(x, dict):
                visit(x, kind, name, 0)
    return [tuple(r) for r in out]


def nodes(df: DataFrame, key: str, text: str, parent_table: str, kind: Kind, wrappers: tuple[str, ...], name_field: str | None = None, bodies: bool = True) -> DataFrame:
    """The node table of one JSON column; without bodies only places and intervals are sent on."""

    def run(batches):
        schema = pa.schema([("parent_table", pa.string()), ("parent_key", pa.int64()), ("kind", pa.string()), ("pos_path", pa.string()), ("depth", pa.int32()), ("pre", pa.int32()), ("post", pa.int32()), ("body", pa.string())])
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for r in walk(t, kind, wrappers, name_field):
                    for c, v in zip(cols, (parent_table, k, *r[:5], r[5] if bodies else None)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return df.select(F.col(key).cast("bigint"), F.col(text).cast("string")).filter(F.length(F.trim(text)) > 1).mapInArrow(run, NODE_SCHEMA)


def mechanism_nodes(records: DataFrame, bodies: bool = True) -> DataFrame:
    return nodes(records, "record_no", "mechanism", "mechanism_records", STEP, ("mechanism", "steps"), None, bodies)


def gate_nodes(cards: DataFrame, bodies: bool = True) -> DataFrame:
    return nodes(cards, "card_no", "gates", "data_cards", GATE, ("gates",), "phase", bodies)


def contained(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Each child with the pos_path of the parent whose interval holds it; both from one node table."""
    p = parents.select(F.col("parent_table").alias("_t"), F.col("parent_key").alias("_k"), F.col("pre").alias("_pre"), F.col("post").alias("_post"), F.col("depth").alias("_depth"), F.col("pos_path").alias("parent_path"))
    hit = (F.col("parent_table") == F.col("_t")) & F.col("parent_key").eqNullSafe(F.col("_k")) & (F.col("pre") > F.col("_pre")) & (F.col("post") < F.col("_post")) & (F.col("depth") == F.col("_depth") + 1)
    return children.join(p, hit).drop("_t", "_k", "_pre", "_post", "_depth")


def typed(node_table: DataFrame, kind: str, fields: str, under: str | None = None) -> DataFrame:
    """The flat table of one kind: places, the parent's place, the fields (a DDL string), the interval,
    and the body with whatever isn't among the fields."""
    own = node_table.filter(F.col("kind") == kind)
    if under is not None:
        own = contained(own, node_table.filter(F.col("kind") == under))
    else:
        own = own.withColumn("parent_path", F.lit(None).cast("string"))
    return own.withColumn("f", F.from_json("body", fields)).select("parent_key", "pos_path", "parent_path", "f.*", "pre", "post", "body")


#: The fields of each kind, as DDL for from_json.
FIELDS = {
    "step": "step int, type string, subtype string, intermediate_smiles string, rationale string, checks struct<charge:struct<before:int,after:int>>",
    "arrow": "`from` struct<atom:int,kind:string>, `to` struct<atom:int,bond:array<int>>, electrons int",
    "species": "smiles string, role string",
    "evidence": "kind string, ref struct<`table`:string,row:int>",
    "gate": "phase string, status string",
    "input": "source string, rows bigint, license struct<label:string,tier:string>",
    "check": "name string, value double",
    "failure": "reaction_id string, reason struct<code:string,detail:struct<step:int>>",
}
PARENT = {"arrow": "step", "species": "step", "evidence": "species", "input": "gate", "check": "gate", "failure": "check"}
