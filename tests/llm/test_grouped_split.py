from corpusmill.llm import grouped_split as G

ROWS = "row_id bigint, record_no bigint, reaction_id string, group_key string, names string"


def tables(spark, rows, records=(), templates=(("NR-417", "Torik addition"), ("NG-510", "Quin–Mar coupling"), ("NR-9", None)), aliases=(("NG-750", "NG-751"), ("NG-751", "NR-417"), ("NR-9", "NR-9"))):
    mk = lambda r, s: spark.createDataFrame([tuple(x) for x in r], s)
    return mk([(*r, "x", "y") for r in rows], ROWS), mk(records, "record_no bigint, reaction_id string"), mk(templates, "base string, name string"), mk(aliases, "alias string, base string")


def keys(spark, rows, **kw):
    return {r["row_id"]: r["group_key"] for r in G.group_keys(*tables(spark, rows, **kw)).collect()}


def test_names_in_all_spellings(spark):
    got = keys(
        spark,
        [
            (1, 1, "SILVER-NR-417_1-CCP1_2-NR"), (2, 1, " v2:silver/nr 00417_1-C__k2\t"), (3, 1, "Gold_NG750_1-C#step5"), (4, 1, "WIKI:torik%20addition"), (5, 1, "wiki-TORIK-ADDITION"),
            (6, 1, "ORD-ds008387.P0064135-992941"), (7, 1, "uspto_p64135;0455"), (8, 1, "US:P-0064135/P12-0456"), (9, 1, "ord/DS-8387/9"), (10, 1, "USPTO-P0000012-1"),
            (11, 1, "ORD/dataset000005-1"), (12, 2, None), (13, 2, "  "), (14, 3, None), (15, None, None), (16, 1, "WIKI-Quin–Mar_coupling"), (17, 1, "WIKI-Unheard of"), (18, 1, "GOLD /NG510_1-CC"),
        ],
        records=[(2, "SILVER-NR-417_1-C"), (3, None), (None, "GOLD-NG-510_1-C")],
    )
    assert {got[i] for i in (1, 2, 3, 4, 5, 12, 13)} == {"NR-417"}
    assert {got[i] for i in (6, 7, 8, 9, 10)} == {"P0000012"}
    assert got[11] == "ds000005" and got[14] == "row 14" and got[15] == "row 15"
    assert got[16] == got[18] == "NG-510" and got[17] == "unheard of"


def test_components_against_union_find(spark):
    import random

    rng = random.Random(3)
    rows = [(i, 1, f"USPTO-P{rng.randrange(60)}/P{rng.randrange(60)}-{i}") for i in range(45)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for _, _, t in rows:
        a, b = (f"P{int(x[1:]):07d}" for x in t[6:].split("-")[0].split("/"))
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = keys(spark, rows)
    assert all(got[i] == find(f"P{int(t[7:].split('/')[0]):07d}") for i, _, t in rows)


def test_empty_tables(spark):
    assert keys(spark, []) == {}
    k = G.group_keys(*tables(spark, []))
    assert G.split_rows(k, {"train": 0.8, "test": 0.2}).count() == 0 and G.report(k, {"train": 0.8, "test": 0.2}).count() == 0


def test_groups_stay_whole_and_shares_hold(spark):
    k = spark.range(3000).selectExpr("id as row_id", "case when id < 1000 then 'hot' else concat('g', id % 300) end as group_key")
    split = G.split_rows(k, {"train": 0.6, "validation": 0.2, "test": 0.2}).toPandas()
    assert len(split) == 3000 and (split.groupby("group_key").split.nunique() == 1).all()
    share = split.split.value_counts(normalize=True)
    assert abs(share["train"] - 0.6) < 0.05 and abs(share["test"] - 0.2) < 0.05
    again = G.split_rows(k, {"train": 0.6, "validation": 0.2, "test": 0.2}).toPandas()
    assert (split.sort_values("row_id").split.values == again.sort_values("row_id").split.values).all()


def test_rendezvous_moves_little(spark):
    k = spark.range(4000).selectExpr("id as row_id", "concat('g', id) as group_key")
    a = G.assign(k, {"train": 0.8, "test": 0.2}).toPandas().set_index("group_key").split
    b = G.assign(k, {"train": 0.7, "test": 0.3}).toPandas().set_index("group_key").split
    moved = (a != b.loc[a.index]).mean()
    assert 0.05 < moved < 0.15


def test_no_split_overflows_on_large_groups(spark):
    """One group with a third of all rows and some with a twentieth: the draw goes among splits with room."""
    k = spark.range(9000).selectExpr("id as row_id", "case when id < 3000 then 'hot' when id < 6000 then concat('large', id % 7) else concat('g', id % 500) end as group_key")
    for seed in range(4):
        rep = {r["split"]: r["actual_share"] for r in G.report(k, {"train": 0.8, "validation": 0.1, "test": 0.1}, seed).collect()}
        assert abs(rep["train"] - 0.8) < 0.03 and abs(rep["test"] - 0.1) < 0.02
    assert G._drawn("a", "train", 1) == spark.range(1).select(G._draw(G.F.lit("a"), "train", 1)).first()[0]
