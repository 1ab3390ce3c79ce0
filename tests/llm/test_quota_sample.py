from corpusmill.llm import quota_sample as Q

ROWS = "record_no bigint, level string, subtype string, target_id int, cell string, priority string"
T = "target_id int, request_id int, sample_permille int, level string, subtype string, target_permille int, min_rows int"


def frames(spark, rows, targets):
    return spark.createDataFrame([(*r, 7, "c", "p") for r in rows], ROWS), spark.createDataFrame(targets, T)


LEVELS = ["easy", "Easy ", "level: EASY", "medium", "med.", "HARD", None, "", "n/a"]
ROWS_ = [(i, LEVELS[i % 9], ["acidBase", "Acid Base", "acid-base", "1,2-shift", None, "none"][i % 6]) for i in range(900)]


def test_quota_and_reservoir(spark):
    rows, targets = frames(spark, ROWS_, [(1, 1, 500, "easy", None, 400, 5), (2, 1, 500, "medium", None, 600, 5), (3, 2, 1000, "hard", None, 900, 0), (4, 2, 10, "hard", "1,2 Shift", 1000, 0), (5, 3, 100, None, None, 1000, 0), (6, 3, 100, "unknown", None, 0, 1), (7, 3, 100, None, "acid_base", 10, 200)])
    rep = {r["target_id"]: r for r in Q.Sampler(rows, targets, "record_no").report().collect()}
    assert (rep[1]["size"], rep[1]["need"], rep[1]["have"], rep[1]["taken"]) == (450, 180, 300, 180)
    assert (rep[2]["need"], rep[2]["have"], rep[2]["taken"], rep[2]["met"]) == (270, 200, 200, False)
    assert rep[3]["have"] == 100 and rep[3]["taken"] == 100 and rep[5]["taken"] == 90
    assert rep[6]["have"] == 0 and rep[6]["need"] == 1 and rep[7]["need"] == 200 and rep[7]["have"] == 450
    assert sorted(r[0] for r in Q.Sampler(rows, targets, "record_no").unmet().collect()) == [2, 3, 4, 6]
    got = Q.Sampler(rows, targets, "record_no").sample().toPandas()
    assert got.groupby("target_id").size().to_dict() == {i: r["taken"] for i, r in rep.items() if r["taken"]}
    assert not got.duplicated(["target_id", "record_no"]).any()
    one = got[got.target_id == 1].record_no
    assert {LEVELS[i % 9] for i in one} == {"easy", "Easy ", "level: EASY"}


def test_uniform_over_a_category(spark):
    rows, targets = frames(spark, [(i, "easy", None) for i in range(2000)], [(1, r, 500, "easy", None, 1000, 0) for r in range(1, 2)])
    got = Q.Sampler(rows, targets, "record_no").sample().toPandas().record_no
    assert len(got) == 1000 and 430 < (got < 1000).sum() < 570


def test_empty_and_repeated(spark):
    rows, targets = frames(spark, [], [(1, 1, 500, "easy", None, 400, 5), (2, 1, 500, None, None, 600, 0)])
    assert Q.Sampler(rows, targets, "record_no").sample().count() == 0
    assert [r[0] for r in Q.Sampler(rows, targets, "record_no").unmet().collect()] == [1]
    rows, targets = frames(spark, [(1, "easy", None)] * 4 + [(None, "easy", None)], [(1, 1, 1000, "easy", None, 800, 0)])
    assert Q.Sampler(rows, targets, "record_no").sample().count() == 4
    rows, _ = frames(spark, ROWS_, [(1, 1, 1, "easy", None, 1, 1)])
    assert Q.Sampler(rows, spark.createDataFrame([], T), "record_no").sample().count() == 0


def test_reservoirs_merge(spark):
    """Tasks' reservoirs are bounded by the need, and their union holds the rows of smallest priority
    however the rows are spread, also with one category of most rows."""
    many = [(i, "easy" if i % 10 else "hard", None) for i in range(6000)]
    rows, targets = frames(spark, many, [(1, 5, 100, "easy", None, 500, 0), (2, 5, 100, "hard", None, 500, 0)])
    want = {t: sorted(sorted((r for r in many if (r[1] == "easy") == (t == 1)), key=lambda r: Q._priorities(5, [r[0]])[0])[:300]) for t in (1, 2)}
    for tasks in (1, 7):
        s = Q.Sampler(rows.repartition(tasks), targets, "record_no")
        assert s.reservoirs.filter("priority is not null").count() <= 600 * tasks
        got = s.sample().toPandas()
        assert {t: sorted(g.record_no) for t, g in got.groupby("target_id")} == {t: [r[0] for r in w] for t, w in want.items()}
    r = Q._Reservoir(3)
    import numpy as np
    import pyarrow as pa

    for i in range(30):
        r.add(np.arange(1000) + 1000 * (30 - i), pa.array(np.arange(1000)))
    assert r.seen == 30_000 and r.rows()[0].tolist() == [1000, 1001, 1002]
