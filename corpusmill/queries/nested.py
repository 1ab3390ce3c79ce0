"""Queries of the nested-JSON operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import nested as N
from corpusmill.queries import query
from corpusmill.session import table


def _nodes(spark: SparkSession, d: str, bodies: bool) -> DataFrame:
    return N.mechanism_nodes(table(spark, d, "mechanism_records"), bodies).unionByName(N.gate_nodes(table(spark, d, "data_cards"), bodies))


def _listed(value: str, numbered: bool) -> str:
    """The elements of a JSON value as a list: an array's, those filed under numbers, or itself."""
    arr = f"list_transform(range(json_array_length({value})::bigint), lambda i: json_extract({value}, '$[' || i::varchar || ']'))"
    num = f"list_transform(list_sort(list_transform(json_keys({value}), lambda k: k::int)), lambda k: json_extract({value}, '$.\"' || k::varchar || '\"'))"
    keyed = f"when json_type({value}) = 'OBJECT' and len(json_keys({value})) > 0 and len(list_filter(json_keys({value}), lambda k: not regexp_full_match(k, '[0-9]+'))) = 0 then {num}" if numbered else ""
    return f"case when json_type({value}) = 'ARRAY' then {arr} {keyed} when json_type({value}) = 'OBJECT' and ({value}::varchar <> '{{}}' or {str(not numbered).lower()}) then [{value}] else [] end"


def _exploded(name: str, source: str, value: str, path: str, kind: str, numbered: bool = False) -> str:
    return f"""{name}_all as (select parent_key, {path} as up, {_listed(value, numbered)} as l from {source}),
{name} as (select parent_key, '{kind}' as kind, up || (u.i - 1)::varchar as pos_path, l[u.i] as e from {name}_all, unnest(generate_series(1, len(l))) as u(i) where json_type(l[u.i]) = 'OBJECT')"""


def _unwrapped(table_: str, key: str, text: str) -> str:
    once = f"select {key} as parent_key, case when json_valid({text}) then {text}::json end as v from {table_}"
    return f"(select parent_key, case when json_type(v) = 'VARCHAR' then case when json_valid(json_extract_string(v, '$')) then json_extract_string(v, '$')::json end else v end as v from ({once}))"


_GATES = """gates_all as (select parent_key, case when json_type(v) = 'OBJECT' and json_exists(v, '$.gates') then v->'gates' else v end as v from g0),
gate as (select parent_key, 'gate' as kind, k as pos_path, json_extract(v, '$."' || k || '"') as e from (select parent_key, v, unnest(json_keys(v)) as k from gates_all where json_type(v) = 'OBJECT') where json_type(json_extract(v, '$."' || k || '"')) = 'OBJECT'
  union all select parent_key, 'gate', json_extract_string(e, '$.phase'), e from (select parent_key, unnest(list_transform(range(json_array_length(v)::bigint), lambda i: json_extract(v, '$[' || i::varchar || ']'))) as e from gates_all where json_type(v) = 'ARRAY') where json_type(e) = 'OBJECT')"""

_OBJECTS = f"""with m0 as (select * from {_unwrapped("mechanism_records", "record_no", "mechanism")} where v is not null),
m1 as (select parent_key, case when json_type(v) = 'OBJECT' and json_exists(v, '$.mechanism') then v->'mechanism' else v end as v from m0),
m2 as (select parent_key, case when json_type(v) = 'OBJECT' and json_exists(v, '$.steps') then v->'steps' else v end as v from m1),
{_exploded("step", "m2", "v", "''", "step", True)},
{_exploded("arrow", "step", "(e->'arrows')", "pos_path || '.'", "arrow")},
{_exploded("species", "step", "(e->'species')", "pos_path || '.'", "species")},
{_exploded("evidence", "species", "(e->'evidence')", "pos_path || '.'", "evidence")},
g0 as (select * from {_unwrapped("data_cards", "card_no", "gates")} where v is not null), {_GATES},
{_exploded("input", "gate", "(e->'inputs')", "pos_path || '.'", "input")},
{_exploded("chk", "gate", "(e->'checks')", "pos_path || '.'", "check")},
{_exploded("failure", "chk", "(e->'failures')", "pos_path || '.'", "failure")}
"""
_WHERE = (("mechanism_records", ("step", "arrow", "species", "evidence")), ("data_cards", ("gate", "input", "chk", "failure")))
_P3 = _OBJECTS + " union all ".join(f"select '{t}' as parent_table, parent_key, kind, pos_path from {c}" for t, cs in _WHERE for c in cs)


@query(_P3)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d, False).select("parent_table", "parent_key", "kind", "pos_path")


def _typed(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        whole = N.mechanism_nodes(table(spark, d, "mechanism_records")) if kind in ("step", "arrow", "species", "evidence") else N.gate_nodes(table(spark, d, "data_cards"))
        return N.typed(whole, kind, N.FIELDS[kind], N.PARENT.get(kind))

    run.__name__ = f"p3_{kind}_table"
    return run


for _kind in N.FIELDS:
    query()(_typed(_kind))


#: Of each kind the scalar fields of its flat table: name, place in from_json's struct, JSON path, SQL type.
_SCALARS = {
    "step": (("step", "step", "$.step", "int"), ("type", "type", "$.type", "varchar"), ("subtype", "subtype", "$.subtype", "varchar"), ("intermediate_smiles", "intermediate_smiles", "$.intermediate_smiles", "varchar"), ("rationale", "rationale", "$.rationale", "varchar"), ("charge_before", "checks.charge.before", "$.checks.charge.before", "int"), ("charge_after", "checks.charge.after", "$.checks.charge.after", "int")),
    "arrow": (("from_atom", "from.atom", "$.from.atom", "int"), ("from_kind", "from.kind", "$.from.kind", "varchar"), ("to_atom", "to.atom", "$.to.atom", "int"), ("bond_first", "to.bond[0]", "$.to.bond[0]", "int"), ("electrons", "electrons", "$.electrons", "int")),
    "species": (("smiles", "smiles", "$.smiles", "varchar"), ("role", "role", "$.role", "varchar")),
    "evidence": (("evidence_kind", "kind", "$.kind", "varchar"), ("ref_table", "ref.table", "$.ref.table", "varchar"), ("ref_row", "ref.row", "$.ref.row", "int")),
    "gate": (("status", "status", "$.status", "varchar"),),
    "input": (("source", "source", "$.source", "varchar"), ("n_rows", "rows", "$.rows", "bigint"), ("license", "license.label", "$.license.label", "varchar"), ("tier", "license.tier", "$.license.tier", "varchar")),
    "check": (("name", "name", "$.name", "varchar"), ("value", "value", "$.value", "double")),
    "failure": (("reaction_id", "reaction_id", "$.reaction_id", "varchar"), ("code", "reason.code", "$.reason.code", "varchar"), ("step", "reason.detail.step", "$.reason.detail.step", "int")),
}


def _flat(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _typed(kind)(spark, d).select("parent_key", "pos_path", "parent_path", *(F.expr(at).alias(name) for name, at, _, _ in _SCALARS[kind]))

    run.__name__ = f"p3_{kind}_flat"
    return run


for _kind, _fields in _SCALARS.items():
    _parent = "regexp_replace(pos_path, '[.][0-9]+$', '')" if _kind in N.PARENT else "null::varchar"
    query(_OBJECTS + f"select parent_key, pos_path, {_parent} as parent_path, " + ", ".join(f"json_extract_string(e, '{path}')::{kind} as {name}" for name, _, path, kind in _fields) + f" from {'chk' if _kind == 'check' else _kind}")(_flat(_kind))


_DEPTH = "case kind when 'step' then 0 when 'gate' then 0 when 'evidence' then 2 when 'failure' then 2 else 1 end"


@query(f"select parent_table, kind, count(*) as objects, count(distinct parent_key) as documents, max({_DEPTH})::int as deepest from ({_P3}) group by 1, 2")
def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Objects, documents and deepest level per kind."""
    return _nodes(spark, d, False).groupBy("parent_table", "kind").agg(F.count("*").alias("objects"), F.countDistinct("parent_key").alias("documents"), F.max("depth").alias("deepest"))
