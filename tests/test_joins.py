import random
from fractions import Fraction

from corpusmill.operators import decontaminate as D
from corpusmill.operators import dedup as U
from corpusmill.operators.components import hash_to_min, star_edges
from corpusmill.operators.simjoin import set_classes, similar_pairs, similar_to

SETS = "k bigint, x array<int>, g string, token int"


def _sets(rng, n):
    base = [rng.sample(range(40), rng.randint(1, 14)) for _ in range(8)]
    out = []
    for i in range(n):
        s = list(base[rng.randrange(8)])
        if rng.random() < 0.5 and len(s) > 1:
            s.pop()
        if rng.random() < 0.3:
            s.append(rng.randrange(40, 60))
        rng.shuffle(s)
        out.append((i, s, "ab"[i % 2], 1))
    return out + [(n, [], "a", 1), (n + 1, None, "a", 1)]


def _tanimoto(a, b):
    a, b = set(a), set(b)
    return Fraction(len(a & b), len(a | b))


def test_similar_pairs_against_brute_force(spark):
    rows = _sets(random.Random(1), 70)
    df = spark.createDataFrame(rows, SETS)
    for tau, by in (("4/5", None), ("1/2", ["g"])):
        reps = {r["k"]: r["rep"] for r in set_classes(df, "k", "x", by).collect()}
        first = [r for r in rows if r[1] and reps[r[0]] == r[0]]
        want = {(a[0], b[0]) for i, a in enumerate(first) for b in first[i + 1 :] if _tanimoto(a[1], b[1]) >= Fraction(tau) and (not by or a[2] == b[2])}
        assert {(r["a"], r["b"]) for r in similar_pairs(df, "k", "x", tau, by).collect()} == want and want
        for a in rows:
            for b in rows:
                if a[1] and b[1]:
                    assert (reps[a[0]] == reps[b[0]]) == (set(a[1]) == set(b[1]) and (not by or a[2] == b[2]))


def test_similar_to_against_brute_force(spark):
    rows = _sets(random.Random(2), 40)
    l, r = spark.createDataFrame(rows[:20], SETS), spark.createDataFrame(rows[20:], SETS)
    want = {a[0]: max(_tanimoto(a[1], b[1]) for b in rows[20:] if b[1]) for a in rows[:20] if a[1]}
    got = {x["k"]: x["best"] for x in similar_to(l, r, "k", "x", "19/20").collect()}
    assert got == {k: float(v) for k, v in want.items() if v >= Fraction("19/20")}
    assert similar_to(l.limit(0), r, "k", "x", "19/20").count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(None, 3), (7, 7)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in hash_to_min(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert hash_to_min(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    stars = star_edges(spark.createDataFrame([(1, "p"), (2, "p"), (3, "p"), (4, None)], "n int, key string"), "n", "key")
    assert {(r["a"], r["b"]) for r in stars.collect()} == {(1, 1), (1, 2), (1, 3)}


def test_dedup_keeps_the_best(spark):
    rows = spark.createDataFrame([(1, "inferred", "s1", "h1", [1, 2]), (2, "curated", "s1", "h2", [7]), (3, "template_expanded", None, "h2", [8]), (4, "curated", "s9", "h9", [9]), (5, None, None, None, None), (6, "curated", "s8", "h8", [9])], "id int, provenance string, sig string, hash string, fp array<int>")
    c = U.clusters(rows, "id", ["sig", "hash"], "fp")
    best = U.representatives(rows, c, "id", [-U.provenance_rank(rows["provenance"])])
    assert {(r["cluster"], r["id"]) for r in best.collect()} == {(1, 2), (4, 4), (5, 5)}
    assert {(r["cluster_size"], r["clusters"]) for r in U.size_distribution(c).collect()} == {(3, 1), (2, 1), (1, 1)}


def test_decontamination_controls(spark):
    schema = "id bigint, source string, sig string, skel string, steps string, fp array<int>"
    gold = spark.createDataFrame([(1, "g", "A", "a", "h", [1, 2, 3]), (2, "g", None, None, None, [5, 6])], schema)
    cand = spark.createDataFrame([(10, "x", "A", "a", "h", [9]), (11, "x", "B", "a", "h", [9]), (12, "x", "B", "b", "h", [9]), (13, "y", None, None, None, [6, 5]), (14, "y", "Z", None, None, [5]), (15, "y", None, None, None, None)], schema)
    judged = D.reasons(cand, gold, "id", fingerprint="fp")
    assert {r["id"]: r["reason"] for r in judged.collect()} == {10: D.SET_MATCH, 11: D.SKELETON_MATCH, 12: D.STEPS_MATCH, 13: "reaction_fp_tanimoto>=0.95", 14: None, 15: None}
    kept, removed = D.split_clean(judged)
    assert kept.count() == 2 and removed.count() == 4 and D.leaks(kept, gold).first()[0] == 0
    assert D.split_clean(D.reasons(gold, gold, "id", fingerprint="fp"))[0].count() == 0  # all of the benchmark itself is caught


def test_pipeline_compares_reaction_fingerprints(spark):
    """The same reaction with a spectator twice differs in signature and steps only: removed by its
    fingerprint, against the benchmark and among the records themselves."""
    from pyspark.sql import functions as F

    from corpusmill.functions import smiles as S
    from corpusmill.operators import features as FT
    from corpusmill.plans import pipeline as PL

    acid, ester = "CCCC(=O)O", "CCCC(=O)OC"
    gold = [("g1", [acid, "CO"], [ester, "O"])]
    rows = [
        ("a", [acid, acid, "CO"], [ester, "O"]),  # as the benchmark's, one reactant twice
        ("b", ["c1ccccc1C(=O)Cl", "NC"], ["c1ccccc1C(=O)NC", "Cl"]),
        ("c", ["c1ccccc1C(=O)Cl", "NC", "NC"], ["c1ccccc1C(=O)NC", "Cl"]),  # as b, one reactant twice
        ("d", ["CC#N"], ["CCN"]),
    ]

    def frame(data):
        made = [(k, "s", "CC0", "curated", "easy", k, r, p, None, [(1, "step", "x", f"{'C' * (i + 2)}O", None)]) for i, (k, r, p) in enumerate(data)]
        return PL.normalize_phase(PL.Run(), spark.createDataFrame(made, PL.RECORD))

    run = PL.Run()
    # another step than any of the records'
    bench = frame(gold).withColumn("steps", F.transform("steps", lambda s: s.withField("smiles", F.lit("N"))))
    kept = PL.decontaminate_phase(run, frame(rows), frame([("t1", ["CCCCCCCCC"], ["CCCCCCCCCC"])]), bench)
    assert {r["record_id"] for r in kept.collect()} == {"b", "c", "d"} and run.gates["decontaminate"]["removed"] == 1
    out = PL.dedup_phase(run, kept)
    assert {r["record_id"] for r in out.collect()} == {"b", "d"} and not {"fp", "bucket"} & set(out.columns)
    sides = spark.createDataFrame([(1, ["CO"], ["CO"]), (2, ["CO", "?"], ["CN"]), (3, ["?"], ["CN"]), (4, None, ["CN"])], "id int, r array<string>, p array<string>")
    bits = {r["id"]: r["fp"] for r in FT.reaction_bits(sides, "id", "r", "p").collect()}
    one, two = (set(S.fingerprint_bits(x)) for x in ("CO", "CN"))
    assert bits == {1: [FT.UNCHANGED], 2: sorted(one ^ two), 3: None, 4: None}
    salts = spark.createDataFrame([(1, ["CC(=O)[O-]"]), (2, ["OC(C)=O"]), (3, ["CCO"])], "id int, p array<string>")
    b = {r["id"]: r["bucket"] for r in FT.product_bucket(salts, "id", "p").collect()}
    assert b[1] == b[2] != b[3]


def test_search_finds_queries_among_each_other(spark, tmp_path):
    from corpusmill.queries import load

    rows = [(0, "a", [1.0, 1.0, 1.0, -1.0]), (50, "a", [1.0, 1.0, 1.0, 1.0]), (51, "a", [1.0, 1.0, -1.0, -1.0]), (52, "a", [-1.0, -1.0, -1.0, 1.0])]
    spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {tuple(r) for r in load()["sim_search_bits"](spark, str(tmp_path)).collect()}
    assert got == {(0, 0.75, 50, 2), (50, 0.75, 0, 2)}
