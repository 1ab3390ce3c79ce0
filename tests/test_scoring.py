import random

from corpusmill.operators import reward as R
from corpusmill.operators import scoring as C

G = [("a", "CCO", 0.5), ("b", "CC=O", 0.5)]


def brute(gold, pred):
    """The best (total, partial) over all alignments, by listing them."""
    if not gold and not pred:
        return [(0.0, 0.0)]
    out = []
    if gold:
        out += brute(gold[:-1], pred)
    if pred:
        out += brute(gold, pred[:-1])
    if gold and pred:
        (k, f, w), (k2, f2) = gold[-1], pred[-1]
        t, p = ((w if f and f == f2 else 0), (w if f and f == f2 else 0)) if k == k2 else (0, 0)
        out += [(a + t, b + p) for a, b in brute(gold[:-1], pred[:-1])]
    return out


def test_alignment_is_the_best():
    rng = random.Random(1)
    for _ in range(150):
        gold = [(rng.choice("ab"), rng.choice(["x", "y", ""]), 0.25) for _ in range(rng.randrange(5))]
        pred = [(rng.choice("ab"), rng.choice(["x", "y", ""])) for _ in range(rng.randrange(5))]
        t, p, actions = C.align(gold, pred)
        assert (t, p) == max(brute(gold, pred))
        assert sorted(i for _, i, _ in actions if i is not None) == list(range(len(gold)))
        assert sorted(j for _, _, j in actions if j is not None) == list(range(len(pred)))
        assert all(gold[i][0] == pred[j][0] for k, i, j in actions if k == "match")


def test_ties_and_preference():
    assert [a[0] for a in C.align([("a", "", 1.0)], [("b", "")])[2]] == ["mismatch"]
    assert [a[0] for a in C.align([("a", "", 1.0)], [("a", "")])[2]] == ["match"]
    assert C.align([], [])[2] == [] and [a[0] for a in C.align([], [("a", "")])[2]] == ["skip_pred"]


def test_scores():
    assert C.score(G, [("a", "OCC"), ("b", "O=CC")]) == {"s_total": 1.0, "s_partial": 1.0, "v": 1.0, "l": 1.0, "n_pred": 2, "n_gold": 2}
    assert C.score(G, [("x", "CCO"), ("y", "CC=O")])["s_partial"] == 0 and C.score(G, [("a", "C(")])["v"] == 0
    near = C.align([("a", "p", 1.0)], [("a", "q")], lambda a, b: 0.59)[1], C.align([("a", "p", 1.0)], [("a", "q")], lambda a, b: 0.7)[1]
    assert near == (0.0, 0.7)


def test_parsing():
    s = [{"subtype": "a"}]
    for good in (s, {"mechanism": s}, '[{"subtype": "a"}]', 'x [ANSWER]\n[{"subtype": "a"}]\n[/ANSWER] y', 'x [ANSWER] [{"subtype": "a"}]', '```json\n[{"subtype": "a"}]\n```', '{"mechanism": [{"subtype": "a"}]}', 'so: [{"subtype": "a"}] done'):
        assert C.parse_steps(good) == s
    for bad in (None, "", "nothing", {"x": 1}, "[ANSWER] {} [/ANSWER]", 5, "[{]"):
        assert C.parse_steps(bad) is None
    assert C.parse_steps("[]") == []


def test_frames(spark):
    ref = [("a", "CCO", 0.5), ("b", "CC=O", 0.5)]
    rows = spark.createDataFrame([(1, ref, '[{"subtype":"a","smiles":"OCC"},{"subtype":"b","smiles":"CC=O"}]', "easy"), (2, ref, "[]", "easy"), (3, ref, None, None), (4, None, "[]", "hard")], "id int, reference array<struct<subtype:string,smiles:string,weight:double>>, output string, level string")
    s = C.scored(rows, "id", "reference", "output")
    got = {r["id"]: (r["parsed"], r["s_total"], r["n_gold"]) for r in s.collect()}
    assert got == {1: (True, 1.0, 2), 2: (True, 0.0, 2), 3: (False, 0.0, 2), 4: (True, 0.0, 0)}
    total = C.summary(s).first()
    assert (total["evaluated"], total["successful"], total["avg_s_total"]) == (4, 3, 0.25)
    levels = {r["level"]: (r["n"], r["avg_s_total"]) for r in C.by_level(s.join(rows.select("id", "level"), "id"), "level").collect()}
    assert levels == {"easy": (2, 0.5), "hard": (1, 0.0)}
    assert C.format_check(s).first()["perfect"] == 1


def test_reward_arithmetic(spark):
    df = spark.createDataFrame([(1, True, 1.0, 1.0), (2, True, 0.0, 1.0), (3, False, 0.0, 0.0), (4, True, 0.0, 0.0), (5, None, None, None)], "id int, parsed boolean, s_partial double, v double")
    r = {x["id"]: round(x["r"], 6) for x in df.select("id", R.gated(df.parsed, df.s_partial, df.v).alias("r")).collect()}
    assert r == {1: 1.15, 2: 0.15, 3: -0.5, 4: -0.5, 5: -0.5}


def test_acceptance_and_monitor(spark):
    a = spark.createDataFrame([("k", 1, True, 0.8, 1.0), ("k", 2, True, 0.95, 1.0), ("k", 3, True, 1.0, 1.0), ("m", 1, True, 0.99, 0.5)], "key string, attempt int, parsed boolean, s_partial double, v double")
    assert [(r["key"], r["attempt"]) for r in R.accepted(a, "key", "attempt", most=3).collect()] == [("k", 2)]
    assert R.accepted(a, "key", "attempt", most=1).count() == 0
    log = spark.range(20).selectExpr("id", "cast(id % 2 as double) as v")
    rolled = R.validity_alarm(R.rolling(log, ["id"], ["v"], window=8), "mean_v", window=8)
    alarms = [r["id"] for r in rolled.filter("alarm").collect()]
    assert min(alarms) == 7 and rolled.filter("id = 9").first()["mean_v"] == 0.5
    ranks = [r["id"] for r in R.curriculum(spark.createDataFrame([(1, "hard"), (2, None), (3, "easy"), (4, "easy")], "id int, level string"), "level", "id").collect()]
    assert ranks == [3, 4, 1, 2]
