import json

import pytest

from corpusmill.operators import nested as N
from corpusmill.queries import load

QUERIES = load()

STEP = {"step": 1, "subtype": "x", "arrows": [{"from": {"atom": 1}}, None, {"from": {"atom": 2}}], "species": [{"smiles": "O", "evidence": [{"kind": "ir"}, {"kind": "nmr"}]}, {"smiles": "C", "evidence": {"kind": "ms"}}]}
WANT = {("step", "0"), ("arrow", "0.0"), ("arrow", "0.2"), ("species", "0.0"), ("evidence", "0.0.0"), ("evidence", "0.0.1"), ("species", "0.1"), ("evidence", "0.1.0")}


def places(text, kind=N.STEP, wrappers=("mechanism", "steps"), name=None):
    return {(k, p) for k, p, *_ in N.walk(text, kind, wrappers, name)}


def test_forms_of_a_mechanism():
    for form in ([STEP], {"version": 2, "steps": [STEP]}, {"mechanism": {"steps": [STEP], "complete": True}}, {"1": STEP}, STEP, json.dumps([STEP]), json.dumps(json.dumps({"steps": [STEP]}))):
        assert places(json.dumps(form)) == WANT
    assert [p for _, p in sorted(places(json.dumps({"10": {"step": 10}, "9": {"step": 9}})))] == ["0", "1"]
    by_number = N.walk(json.dumps({"10": {"step": 10}, "9": {"step": 9}}), N.STEP, ("steps",))
    assert [json.loads(r[5])["step"] for r in by_number] == [9, 10]


def test_nothing_to_read():
    for text in (None, "", "  ", "null", "{}", "[]", "[null]", '""', "5", '[{"step": 1', '[{"step": 1}] x', '"not json"', "[" * 5000):
        assert places(text) == set()
    assert places(json.dumps([None, {"step": 2, "arrows": None, "species": {}}])) == {("step", "1"), ("species", "1.0")}


def test_forms_of_gates():
    gates = {"phase1": {"status": "ok", "inputs": {"source": "a"}, "checks": [{"name": "n", "failures": [{"reaction_id": "r"}, None, {}]}]}, "phase2": {}, "phase3": None}
    want = {("gate", "phase1"), ("input", "phase1.0"), ("check", "phase1.0"), ("failure", "phase1.0.0"), ("failure", "phase1.0.2"), ("gate", "phase2")}
    listed = [{"phase": k, **v} for k, v in gates.items() if v is not None]
    for form in (gates, {"gates": gates}, json.dumps(gates), listed, [*listed, None]):
        assert places(json.dumps(form), N.GATE, ("gates",), "phase") == want


def test_intervals_nest(spark):
    docs = spark.createDataFrame([(1, json.dumps([STEP, STEP]), "x", 5), (2, json.dumps({"steps": [STEP]}), "x", 5), (3, None, "x", 5), (None, json.dumps([STEP]), "x", 5), (1, json.dumps([STEP]), "x", 5)], "record_no bigint, mechanism string, kind string, pre int")
    nodes = N.mechanism_nodes(docs).toPandas()
    for _, doc in nodes[nodes.parent_key == 2].groupby("parent_key"):
        rows = doc.to_dict("records")
        for a in rows:
            inside = {b["pos_path"] + b["kind"] for b in rows if a["pre"] < b["pre"] and b["post"] < a["post"]}
            below = {b["pos_path"] + b["kind"] for b in rows if b["pos_path"].startswith(a["pos_path"] + ".") and (a["kind"] in ("step", "gate") or b["kind"] == "evidence" and a["kind"] == "species")}
            assert inside == below
    one = N.mechanism_nodes(docs.filter("record_no = 2"))
    linked = {(r["pos_path"], r["parent_path"]) for r in N.typed(one, "evidence", N.FIELDS["evidence"], "species").collect()}
    assert linked == {("0.0.0", "0.0"), ("0.0.1", "0.0"), ("0.1.0", "0.1")}
    assert {(r["pos_path"], r["parent_path"]) for r in N.typed(one, "arrow", N.FIELDS["arrow"], "step").collect()} == {("0.0", "0"), ("0.2", "0")}
    assert N.typed(one, "step", N.FIELDS["step"]).first()["subtype"] == "x"


def test_typed_tables_keep_all_fields(spark):
    step = {"step": 1, "checks": {"charge": {"before": 0, "after": -1}}, "later": [1], "arrows": [{"from": {"atom": 1, "kind": "lone"}, "to": {"atom": 2, "bond": [2, 3]}, "electrons": 2}]}
    one = N.mechanism_nodes(spark.createDataFrame([(1, json.dumps([step]))], "record_no bigint, mechanism string"))
    s, a = N.typed(one, "step", N.FIELDS["step"]).first(), N.typed(one, "arrow", N.FIELDS["arrow"], "step").first()
    assert (s["checks"]["charge"]["before"], s["checks"]["charge"]["after"]) == (0, -1) and json.loads(s["body"])["later"] == [1]
    assert a["to"]["bond"] == [2, 3] and a["to"]["atom"] == 2 and s["pre"] < a["pre"] < a["post"] < s["post"]


@pytest.mark.parametrize("kind", list(N.FIELDS))
def test_fields_hold_what_the_tables_hold(spark, data, kind):
    """Every leaf of a body stands in the typed columns, too."""

    def leaves(x, at=""):
        if isinstance(x, dict):
            return {v for k, y in x.items() for v in leaves(y, f"{at}.{k}")}
        return set() if x is None else {(at, json.dumps(x))}

    for r in QUERIES[f"p3_{kind}_table"](spark, data).collect():
        typed = {k: v for k, v in r.asDict(True).items() if k not in ("parent_key", "pos_path", "parent_path", "pre", "post", "body")}
        assert leaves(json.loads(r["body"])) <= leaves(typed)


def test_empty_table(spark):
    assert N.mechanism_nodes(spark.createDataFrame([], "record_no bigint, mechanism string")).count() == 0
    assert N.gate_nodes(spark.createDataFrame([], "card_no bigint, gates string")).count() == 0
