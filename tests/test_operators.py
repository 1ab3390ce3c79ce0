from pyspark.sql import functions as F

from corpusmill.operators import aggregates as A
from corpusmill.operators import expand as X
from corpusmill.operators import features as FT
from corpusmill.operators import normalize as N
from corpusmill.operators import ontology as O
from corpusmill.operators import splits as P
from corpusmill.operators import tasks as T
from corpusmill.operators import validate as V
from corpusmill.plans import evaluation, training_data


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_text_to_lists(spark):
    assert one(spark, N.as_list, "A..B.") == ["A", "B"] and one(spark, N.as_list, None) == []
    parts = lambda t: one(spark, N.reaction_parts, t)
    assert tuple(parts("C.O>>CO |f:1|")) == (["C", "O"], [], ["CO"]) and parts("C>N>CO")["agents"] == ["N"]
    assert parts("garbage") is None and parts(">>C") is None and parts(None) is None and parts("a>b>c>d") is None
    assert one(spark, N.strip_cx, "CCO |c:1|") == "CCO" and one(spark, N.first_paragraph, " a\n\nb") == "a"
    assert [one(spark, N.level_of, n, "int") for n in (0, 3, 4, 6, 7, None)] == ["easy", "easy", "medium", "medium", "hard", None]
    assert one(spark, N.rgroup_labels, ["C[*:2]", "[*:1]C[*:2]"], "array<string>") == [1, 2]


def test_molecules_seen_once(spark):
    df = spark.createDataFrame([(1, ["OCC", "CCO", None, "C(", "C[*:1]", ""])], "id int, ms array<string>")
    got = {(r["pos"]): (r["mol_key"], r["ok"], r["reason"]) for r in N.normalize_list(df, "id", "ms").collect()}
    assert got[0] == got[1] and got[0][1] and got[2][2] == got[5][2] == "empty" and got[3][2] == "unparseable" and got[4][2] == "rgroup_template"
    assert N.normalized(df.select(F.explode("ms").alias("m")), "m", N.TextKernel()).filter("ok").count() == 4
    res = N.resolve_names(spark.createDataFrame([("a",), ("b",), (None,)], "n string"), "n", lambda n: ("C", None) if n == "a" else 1 / 0)
    assert {r["n"]: (r["structure"], r["resolve_reason"]) for r in res.collect()} == {"a": ("C", None), "b": (None, "resolver_error:ZeroDivisionError"), None: (None, "empty")}


def test_remap(spark):
    steps = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "old"), (2, 0, "c", "bad"), (2, 1, "z", None), (3, 0, "d", "gone"), (4, 0, "e", "lost")], "id int, pos int, type string, subtype string")
    allowed = spark.createDataFrame([("a", "x"), ("b", "new")], "type string, subtype string")
    moves = spark.createDataFrame([("b", "old", "b", "new"), ("d", "gone", None, None), ("e", "lost", "q", "q")], "from_type string, from_subtype string, to_type string, to_subtype string")
    good, rejects = O.remap(steps, allowed, moves, "id", "pos")
    assert sorted((r["pos"], r["subtype"], r["remapped_from"]) for r in good.collect()) == [(0, "x", None), (1, "new", "b::old")]
    assert {r["id"]: r["reason"] for r in rejects.collect()} == {2: "unmapped_step_type:c::bad", 3: "unmapped_step_type:d::gone(explicit_reject)", 4: "remap_target_not_allowed:q/q"}


def test_step_reasons(spark):
    rows = [(1, 0, "CCO"), (1, 1, "CCO"), (2, 0, "CC=O"), (2, 1, "C(C)(C)(C)(C)C"), (2, 2, "CCCCCCCCCCCCCC"), (3, 0, "C"), (3, 1, "CCCCCCCCC"), (4, 0, "[Na+]"), (4, 1, "[O-][O-]"), (5, 0, "CC=O"), (5, 1, "CC[OH2+]")]
    judged = V.step_reasons(V.measured(spark.createDataFrame(rows, "id int, pos int, smiles string"), "smiles"), "id", "pos", "smiles")
    got = {(r["id"], r["pos"]): r["reasons"] for r in judged.filter("size(reasons) > 0").collect()}
    assert got == {(1, 1): ["noop_step:step2"], (2, 1): ["sanitize_fail:step2", "balance_unparseable:step2"], (3, 1): ["discontinuous_step:step2(heavy_delta=8)"], (4, 1): ["charge_jump:step2(delta=3)"]}
    checks = {r["id"]: (r["sanitized"], r["atom_balanced"], r["charge_balanced"], r["step_continuity"]) for r in V.checks(judged, "id").collect()}
    assert checks[5] == (True,) * 4 and checks[1] == (True, True, True, False) and checks[2][0] is False
    assert checks[4] == (True, True, False, False)
    both = V.step_reasons(V.measured(spark.createDataFrame([(1, 0, "C"), (1, 1, "[O-][O-].CCCCCCCC[O-]")], "id int, pos int, smiles string"), "smiles"), "id", "pos", "smiles")
    sides = V.side_reasons(spark.createDataFrame([(1, ["CC", "C("], ["C"]), (2, ["C"], None), (3, [None], ["C", "?"])], "id int, reactants array<string>, products array<string>"), "id", ["reactants", "products"])
    assert {r["id"]: sorted(r["reasons"]) for r in sides.collect()} == {1: ["sanitize_fail:reactants"], 3: ["sanitize_fail:products", "sanitize_fail:reactants"]}
    first = V.checks(both, "id", sides).filter("id = 1").first()
    assert first["reasons"] == ["charge_jump:step2(delta=3)", "discontinuous_step:step2(heavy_delta=10)", "sanitize_fail:reactants"] and not first["sanitized"] and first["no_noop_steps"]
    assert V.step_reasons(V.measured(spark.createDataFrame(rows, "id int, pos int, smiles string"), "smiles"), "id", "pos", "smiles", F.lit(0.5)).filter("exists(reasons, r -> r like 'disc%')").count() == 0


def test_continuity_of_large_changes(spark):
    """A joining reactant, a shared scaffold and an unlike seed: the change in size alone is the same."""
    acyl, amine = "CCCCC(=O)Cl", "NCCCCCCCO"
    big = "CCCCC(=O)NCCCCCCCO"
    rows = [
        (1, [acyl, amine], "curated", [acyl, big]),  # the amine joins: its 9 atoms
        (2, ["CCCCCCCC"], "curated", ["CCCCCCCC", "CCCCCCCCOC(=O)C(F)(F)F"]),  # a group of 7 from nowhere on the same chain
        (3, ["CCCCCCCC"], "curated", ["CCCCCCCC", "FC(F)(F)S(=O)(=O)Br"]),  # nothing of the chain is left
        (4, ["BrBr"], "curated", ["CCCCCCCC"]),  # not out of its reactant
        (5, ["NCCCCCOCC"], "inferred", ["NCCCCCOCC", "NCCCSSSSSS"]),  # 4 of 9 atoms
        (6, ["NCCCCCOCC"], "curated", ["NCCCCCOCC", "NCCCSSSSSS"]),
        (7, None, "curated", ["CO", "CCCCCCCCCCO"]),  # no reactants known; the step holds the other whole
    ]
    start = spark.createDataFrame([r[:3] for r in rows], "id int, reactants array<string>, provenance string")
    steps = spark.createDataFrame([(r[0], i, m) for r in rows for i, m in enumerate(r[3])], "id int, pos int, smiles string")
    judged = V.step_reasons(V.measured(steps, "smiles"), "id", "pos", "smiles", start=start)
    assert judged.count() == steps.count()
    bad = {(r["id"], x.split("(")[0]) for r in judged.collect() for x in r["reasons"]}
    assert bad == {(3, "discontinuous_step:step2"), (4, "discontinuous_step:step1"), (5, "discontinuous_step:step2")}


def test_expansion(spark):
    assert X.substitute("C([*:1])=O", {1: "CC"}) == X.substitute("O=CCC", {}) and X.substitute("[*:1]", {1: "C"}) is None and X.substitute("C(C)(C)(C)(C)C", {}) is None
    assert len(X.combinations([1, 2, 3])) == 36 and X.combinations([1, 2, 3])[0] == {1: "[H]", 2: "[H]", 3: "C"}
    t = spark.createDataFrame([("t", ["C([*:1])=O"], ["OC[*:1]"], ["[O-]C[*:1]"]), ("n", ["C"], ["C"], []), ("bad", ["C[*:1]", "C("], ["C"], [])], "id string, r array<string>, p array<string>, s array<string>")
    got = X.expanded(t, "id", "r", "p", "s", 40)
    rows = got.collect()
    assert len(rows) == 6 and all("*" not in "".join(r["reactants"] + r["products"] + r["step_forms"]) for r in rows) and rows[0]["instance_id"] == "t__x0"
    known = spark.createDataFrame([(r["products"][0],) for r in rows[:4]], "m string")
    assert X.unknown_only(got, known, "instance_id", "products", "m").count() == 2
    drawn = X.randomized(spark.createDataFrame([(1, "CCOC(=O)N"), (2, "C"), (3, None)], "id int, m string"), "id", "m", 3).collect()
    assert sum(r["id"] == 1 for r in drawn) == 3 and [r["drawing"] for r in drawn if r["id"] == 2] == ["C"]


def test_features(spark):
    df = spark.createDataFrame([(["b", "a", None], ["p"]), ([], ["p"]), (None, ["p"])], "r array<string>, p array<string>")
    assert [x[0] for x in df.select(FT.signature(F.col("r"), F.col("p"))).collect()] == ["R:a.b>>P:p", None, None]
    bits = spark.createDataFrame([([1, 2], [2, 3], [0.5, -1.0, 2.0])], "a array<int>, b array<int>, v array<double>")
    assert bits.select(FT.xor_bits(F.col("a"), F.col("b")), FT.tanimoto(F.col("a"), F.col("b")), FT.sign_bits(F.col("v"))).first()[:] == ([1, 3], 1 / 3, [0, 2])
    assert one(spark, lambda c: F.size(FT.word_shingles(c)), "a b c d e f a b c d e") == 6
    assert one(spark, lambda c: F.size(FT.word_shingles(c)), None) == 0 and one(spark, lambda c: F.size(FT.word_shingles(c)), "a b") == 1


def test_tasks(spark):
    steps = "array<struct<subtype:string,smiles:string>>"
    r = spark.createDataFrame([(1, [("a", "C"), ("b", "CC"), ("c", "CCC")], ["C"], ["O"]), (2, [], [], ["O"])], f"id int, s {steps}, rs array<string>, ps array<string>")
    n = T.next_step(r, "id", "s").collect()
    assert [(x["k"], len(x["done"]), x["smiles"]) for x in n] == [(1, 1, "CC"), (2, 2, "CCC")]
    full = T.mechanism_full(r, "id", "s", F.lit("u"), "sys").collect()
    assert len(full) == 1 and full[0]["reference"][0]["weight"] == 0.333333 and full[0]["messages"][2]["content"].startswith("Step 1: The step is a a.\n")
    assert T.forward_prediction(r, "id", "rs", "ps", F.lit(None).cast("string")).first()["assistant"] == '["O"]'
    check = T.self_check(T.mechanism_full(r, "id", "s", F.lit("u"), "s").select(F.element_at("messages", -1)["content"].alias("t")), "t", {"a", "b"}).first()
    assert (check["n_rows"], check["bad_json"], check["bad_subtype"], check["bad_smiles"]) == (1, 0, 1, 0)
    assert one(spark, lambda c: T.fill("x {A} {B}", {"{A}": c, "{B}": F.lit(None).cast("string")}), 'q"') == 'x q" null'
    ok = spark.createDataFrame([(1, [("C", "K", True), ("D", None, True)]), (2, [("C", "K", True), ("D", None, False)]), (3, [])], "id int, s array<struct<f:string,c:string,ok:boolean>>")
    assert [x["s"][0]["f"] for x in T.clean_steps(ok, "s", "ok", "c", "f").collect()] == ["K"] and T.clean_steps(ok, "s", "ok", "c", "f", 0.5).count() == 2


def test_splits(spark):
    df = spark.range(120).selectExpr("id", "concat('s', id % 3) as a", "concat('l', id % 3) as b")
    s = P.stratified(df, "id", ["a", "b"], 0.05).toPandas()
    assert len(s) == 120 and (s[s.split == "validation"].groupby("a").size() == 2).all()
    assert P.stratified(df.limit(1), "id", ["a"], 0.5).first()["split"] == "train"
    for f, n in ((0.0, 0), (0.001, 1), (0.1, 12), (0.5, 60)):
        assert P.head_slice(df.select("id"), "id", f).filter("split = 'validation'").count() == n
    routed = P.route(df.select("id"), spark.createDataFrame([(1, "train"), (1, "validation"), (2, "train")], "id bigint, split string"), "id")
    assert [r["id"] for r in routed.filter("split = 'validation'").collect()] == [1]
    d = P.dominant(spark.createDataFrame([(1, ["b", "a", "a", "b"]), (2, []), (3, None), (4, [None, "c"])], "id int, x array<string>"), "id", "x")
    assert {r["id"]: r["dominant"] for r in d.collect()} == {1: "b", 2: "none", 3: "none", 4: "c"}
    lic = P.resolve_license(spark.createDataFrame([("x", "MIT"), ("x", "SA"), ("y", "odd"), ("y", None)], "g string, l string"), ["g"], "l", ["SA", "MIT"], "other")
    assert {r["g"]: r["license"] for r in lic.collect()} == {"x": "SA", "y": "other"}


def test_aggregates(spark):
    v = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.2, 0.99, 1.0, None, 1.5)], "v double")
    assert {r["bin"]: r["n"] for r in A.histogram(v, F.col("v")).collect()} == {0: 2, 1: 1, 4: 2}
    q = A.placed_quantiles(spark.range(10).selectExpr("'g' as g", "id as v"), "v", {"p50": 0.5, "p95": 0.95, "p100": 1.0}, ["g"]).first()
    assert (q["n"], q["p50"], q["p95"], q["p100"], q["max"]) == (10, 5, 9, 9, 9)
    assert [r["v"] for r in A.most_common(spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string"), "v", 2).collect()] == ["a", "b"]
    done = spark.createDataFrame([(1, "e"), (2, None)], "id bigint, error string")
    assert sorted(r["id"] for r in A.not_done(spark.range(4), done, "id", F.col("error").isNotNull()).collect()) == [0, 1, 3]


def test_generation_and_evaluation(spark):
    todo = spark.createDataFrame([(1, "a"), (2, "boom"), (3, "c")], "id int, prompt string")

    def model(prompts):
        if "boom" in prompts:
            raise ValueError("boom")
        return [f'[{{"subtype": "{p}", "smiles": "C"}}]' for p in prompts]

    out = evaluation.generate(todo, spark.createDataFrame([(3, None)], "id int, error string"), "id", "prompt", model)
    assert {r["id"]: (r["raw_output"] is not None, r["error"]) for r in out.collect()} == {1: (True, None), 2: (False, "ValueError: boom")}
    gold = spark.createDataFrame([(i, [("a", "C", 1.0)], "easy") for i in (1, 2, 3)], "id int, reference array<struct<subtype:string,smiles:string,weight:double>>, level string")
    _, total, levels = evaluation.evaluate(gold, out, "id", "reference", "level")
    assert total.first()["avg_s_total"] == 0.333 and levels.first()["avg_s_total"] == 1.0
    assert [r["model"] for r in evaluation.board({"m": total.select("avg_s_partial")}, spark.createDataFrame([("s", 0.9)], "model string, avg_s_partial double")).collect()] == ["s", "m"]


def test_training_rows(spark):
    schema = "id bigint, level string, reactants array<string>, products array<string>, steps array<struct<subtype:string,smiles:string>>"
    recs = spark.createDataFrame([(i, "easy", ["CCOC(=O)N" + "C" * i], ["O"], [("a", "C")]) for i in range(20)], schema)
    train, val = training_data.build(recs, recs.filter("id = 3"), "id", 0.1, 2)
    t, v = train.toPandas(), val.toPandas()
    assert 3 not in set(t.id) | set(v.id) and not set(t.id) & set(v.id) and len(v) <= 2
    assert t.variant.notna().sum() > t.variant.isna().sum() and v.variant.isna().all()
    assert training_data.distillation_prompts(recs, "id").count() == 20


def test_first_rows_and_hot_strata(spark):
    rows = spark.range(5000).selectExpr("cast(hash(id) as bigint) as v", "id")
    want = [r["id"] for r in rows.orderBy("v", "id").limit(1234).collect()]
    assert sorted(r["id"] for r in A.first_rows(rows, ["v", "id"], 1234, 20).collect()) == sorted(want)
    assert A.first_rows(rows, ["id"], 0).count() == 0 and A.first_rows(rows, ["id"], 9999).count() == 5000 and A.first_rows(rows.limit(0), ["id"], 5).count() == 0
    assert sorted(r["id"] for r in A.first_rows(rows, ["id"], 3, 50).collect()) == [0, 1, 2]
    df = spark.range(3000).selectExpr("id", "case when id < 2000 then 'hot' when id = 2999 then 'one' when id > 2900 then null end as s", "id % 2 as t")
    got = P.stratified(df, "id", ["s", "t"], 0.05).toPandas()
    n = got[got.split == "validation"].groupby(["s", "t"], dropna=False).size().to_dict()
    assert len(got) == 3000 and n[("hot", 0)] == 50 and n[("hot", 1)] == 50 and ("one", 1) not in n and sum(n.values()) == 150
    last = A.last_wins(spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, None)], "k int, o int, v string"), "k", ["o"])
    assert {(r["k"], r["o"], r["v"]) for r in last.collect()} == {(1, 7, "b"), (2, 1, None)}


def test_skeletons(spark):
    bare = lambda ms: one(spark, FT.skeleton, ms, "array<string>")
    assert bare(["[O-]C(=O)C", "[O-]c1ccccc1", "F/C=C/[C@@H](N)O", "[13CH3:2]C"]) == ["OC(=O)C", "Oc1ccccc1", "FC=CC(N)O", "CC"]
    rows = spark.createDataFrame([(1, ["[O-]C(=O)C", "CN"]), (2, ["CC(=O)O", "NC"]), (3, ["[O-]c1ccccc1"]), (4, None), (5, ["?"])], "id int, r array<string>")
    got = {r["id"]: r["r_skeletons"] for r in FT.skeleton_keys(rows, "id", ["r"]).collect()}
    assert got[1] == got[2] != got[3] and got[4] is None and not got[5]


def test_atom_mapping(spark):
    from corpusmill.operators import atommap as M

    steps = "array<struct<smiles:string>>"
    rows = [(1, ["C", "O"], ["CO"], None, [("CO",), ("C[OH2+]",)]), (2, ["C"], ["[*:1]C"], "kept", []), (3, ["N"], ["CN"], "old", [("C(",), ("CN",)]), (4, None, ["C"], None, None), (5, ["S"], ["CS"], None, None)]
    r = spark.createDataFrame(rows, f"id int, reactants array<string>, products array<string>, reaction_smiles_mapped string, steps {steps}")

    def mapper(texts):
        if any(t.startswith("S") for t in texts):
            raise ValueError
        return [(t + "!", 0.2 if t.startswith("N") else 0.91234) for t in texts]

    got = {x["id"]: x[1:] for x in M.map_records(r, "id", mapper).collect()}
    assert got[1] == ("C.O>>CO!", 0.9123, None, False, None) and got[3] == ("N>>CN!", 0.2, None, True, "old")
    assert got[2] == ("kept", None, "kept_premapped(invalid_or_rgroup)", False, None) and got[4] == (None, None, "invalid_or_rgroup", False, None)
    assert got[5] == (None, None, "map_error:ValueError", False, None)
    none = {x["id"]: x["map_reason"] for x in M.map_records(r, "id").collect()}
    assert none[1] == "mapper_unavailable" and none[2] == "kept_premapped(invalid_or_rgroup)"
    s = M.map_steps(r, "id", "steps", "smiles", mapper)
    by = {(x["id"], x["pos"]): (x["mapped"], x["map_reason"]) for x in s.collect()}
    assert by == {(1, 0): ("C.O>>CO!", None), (1, 1): ("CO>>C[OH2+]!", None), (3, 0): (None, "invalid_or_rgroup"), (3, 1): (None, "invalid_or_rgroup")}
    assert {x["id"]: x["least"] for x in M.least_confidence(s, "id").collect()} == {1: 0.9123, 3: None}
    rep = M.confidence_report(M.map_records(r, "id", mapper)).first()
    assert (rep["n"], rep["mean"], rep["histogram"]) == (2, 0.5562, [0, 1, 0, 0, 1]) and M.confidence_report(M.map_records(r, "id")).first()["mean"] is None
    assert M.mapping_sample(r, ["id"], 2).count() == 2 and M.mapping_sample(r, ["id"], 0).count() == 5


def test_both_parsers_read_alike(spark):
    from corpusmill.operators import scoring as C

    one_ = '[{"step": 1, "type": "t", "subtype": "s", "intermediate_smiles": "C"}]'
    texts = [f"x [ANSWER]\n{one_}\n[/ANSWER] y", f"[answer]{one_}", one_, f"```json\n{one_}\n```", f'{{"mechanism": {one_}}}', f'[ANSWER]{{"mechanism": {one_}}}[/ANSWER]', f"Here: {one_} is it", "no list", "[ANSWER][/ANSWER]", "[]", "[1, 2", None, "", '{"a": 1}', f"[ANSWER]```\n{one_}\n```[/ANSWER]", f"[ANSWER]none[/ANSWER] {one_}"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", C.parsed_steps(F.col("t")).alias("p")).collect()
    for r in got:
        want = C.parse_steps(texts[r["i"]])
        assert (r["p"] is None) == (want is None) and len(r["p"] or []) == len(want or []), texts[r["i"]]
        assert not want or r["p"][0]["subtype"] == want[0]["subtype"]


def test_rewards_by_name(spark):
    from corpusmill.operators import reward as R

    rows = spark.createDataFrame([(True, 2, 1.0, 1.0, 0.5), (True, 2, 0.4, 0.0, 1.0), (False, 0, 0.0, 0.0, None), (True, 0, 0.0, 0.0, None), (True, 1, 0.5, 1.0, None)], "parsed boolean, n int, s double, v double, rt double")
    c = lambda kind: [tuple(round(x, 6) for x in r) for r in rows.select(*(v.alias(k) for k, v in R.composed(kind, F.col("parsed"), F.col("n"), F.col("s"), F.col("v"), F.col("rt")).items())).collect()]
    assert c("omes") == [(1.15, 1.0, 1.0), (-0.5, 0.0, 1.0), (-0.5, 0.0, 0.0), (-0.5, 0.0, 0.0), (0.65, 1.0, 1.0)]
    assert c("omes+roundtrip") == [(1.2, 1.0, 1.0, 0.5), (-0.5, 0.0, 1.0, 1.0), (-0.5, 0.0, 0.0, 0.0), (-0.5, 0.0, 0.0, 0.0), (0.65, 1.0, 1.0, 0.0)]
    try:
        R.composed("other", *[F.lit(1)] * 4)
    except ValueError:
        return
    raise AssertionError


def test_rolling_over_ranges(spark):
    """One series holds most rows and one range holds few: the same as a window over whole series."""
    from corpusmill.operators import reward as R

    log = spark.range(2000).selectExpr("id as event_id", "case when id % 10 < 8 then 'hot' when id % 10 = 8 then 'few' end as s", "hash(id) % 500 as ts", "cast(id % 7 as bigint) as v")
    for window, parts in ((16, 40), (300, 40), (5, 1)):
        w = R.Window.partitionBy("s").orderBy("ts", "event_id").rowsBetween(1 - window, 0)
        want = {r[0]: (r[1], r[2]) for r in log.select("event_id", F.count("*").over(w), F.avg("v").over(w)).collect()}
        got = {r["event_id"]: (r["observed"], r["mean_v"]) for r in R.rolling(log, ["ts", "event_id"], ["v"], ["s"], window, parts).collect()}
        assert got == want
    assert R.rolling(log, ["ts", "event_id"], ["v"], None, 4, 7).count() == 2000 and R.rolling(log.limit(0), ["ts"], ["v"]).count() == 0
