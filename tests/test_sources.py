import json

import pytest

from corpusmill.plans import export as K
from corpusmill.sources import readers as R
from corpusmill.sources.registry import Config, Fetcher, PagedArticles, Source, ingest
from corpusmill.streaming import monitor as M


def test_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "A_1", "n": 1}\n\n  \nnot json\n{"id": "B_2", "n": 2}\n')
    rows = R.json_lines(spark, str(tmp_path / "a.jsonl"), "id string, n int")
    assert sorted((r["id"], r["n"]) for r in rows.collect() if r["id"]) == [("A_1", 1), ("B_2", 2)]
    assert sorted(r[0] for r in rows.filter("id is not null").select(R.template_base(rows["id"])).collect()) == ["A", "B"]
    (tmp_path / "b.json").write_text('[\n{"id": "x"},\n{"id": "y"}]')
    assert R.benchmark_split(spark, "gold", {"gold": str(tmp_path / "b.json")}, "id string").count() == 2
    with pytest.raises(KeyError):
        R.benchmark_split(spark, "none", {}, "id string")


def test_tables(spark, tmp_path):
    (tmp_path / "u.tsv").write_text("ReactionSmiles\tYear\nCC.O>[Na+]>CCO |f:0.1|\t1999\nCC>>\t2000\nshort\nC>>CO\t2001\n")
    got = R.reaction_tsv(spark, str(tmp_path / "u.tsv"), "ReactionSmiles").collect()
    assert [(r["reactants"], r["agents"], r["products"]) for r in got if r["Year"]] == [(["CC", "O"], ["[Na+]"], ["CCO"]), (["C"], [], ["CO"])]
    (tmp_path / "s.csv").write_text('Reaction SMIRKS,Arrow codes,Original source,Auxiliary information\nC.O>>CO,"1,2=3",book,\ngarbage,,,\nN>A>NC,,,"x, y"\n')
    steps = R.polar_steps(spark, str(tmp_path / "s.csv")).collect()
    assert [(r["products"], r["origin"], r["family"]) for r in steps] == [(["CO"], "book", "polar"), (["NC"], None, "polar")]
    with pytest.raises(FileNotFoundError):
        R.radical_steps(spark, str(tmp_path / "none.csv"))


def test_deposits(spark, tmp_path):
    smi = lambda v: [("NAME", "x"), ("SMILES", v)]
    rows = [("a", [("REACTANT", smi("CC")), ("SOLVENT", smi("O")), (None, [("NAME", "y")])], [([(smi("CCO"),)],)], 25.0), ("b", [("SOLVENT", smi("O"))], [([(smi("C"),)],)], None)]
    spark.createDataFrame(rows, R.DEPOSIT).write.parquet(str(tmp_path / "d/s1"))
    got = R.deposit_records(R.deposits(spark, str(tmp_path / "d"), 2)).collect()
    assert [(r["identifier"], r["reactants"], r["reagents"], r["products"], r["conditions"]) for r in got] == [("a", ["CC"], ["O"], ["CCO"], "T=25.0; reagents:O")]


def test_predictions_prompts_and_summaries(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id": 1, "o": "a"}\n{bad\n{"id": 2, "o": "b"}\n{"id": 1, "o": "c"}\n')
    got = R.last_predictions(spark, str(tmp_path / "p.jsonl"), "id int, o string", "id")
    assert sorted((r["id"], r["o"]) for r in got.collect()) == [(1, "c"), (2, "b")]
    p = spark.createDataFrame([('See [{"x": 1}] and [{"type": "a", "subtype": "b"}, {"type": "c", "subtype": "d"}] end',)], "t string")
    assert sorted(tuple(r) for r in R.embedded_pairs(p, "t").collect()) == [("a", "b"), ("c", "d")]
    pages = spark.createDataFrame([("A", "  First.\n\nSecond."), ("B", " "), (None, "x")], "title string, text string")
    assert [tuple(r) for r in R.summaries(pages, "title", "text").collect()] == [("A", "First.")]
    assert R.optional(spark, str(tmp_path / "no"), "a int").count() == 0


def test_gate_and_config(spark, tmp_path):
    def broken(_):
        raise ValueError("no file")

    ok = lambda s: s.range(3)
    frames, status = ingest(spark, [Source("a", "A", "MIT", "A", "usable", True, ok), Source("b", "B", "?", "B", "unclear", True, ok), Source("c", "C", "MIT", "B", "usable", False, ok), Source("d", "D", "MIT", "C", "usable_for_research_only", True, broken)])
    assert list(frames) == ["a"] and status["b"] == "blocked" and status["c"] == "disabled" and status["d"].startswith("error: ValueError")
    (tmp_path / "c.json").write_text('{"a": {"b": 1, "p": "x/y"}}')
    c = Config.load(str(tmp_path / "c.json"))
    assert c.get("a.b") == 1 and c.get("a.z", 5) == 5 and c.get("a.b.c") is None and c.path("a.p") == tmp_path / "x/y"


def test_fetcher(tmp_path):
    calls, waits = [], []

    def opener(url):
        calls.append(url)
        if url.endswith("robots.txt"):
            return b"User-agent: *\nDisallow: /private"
        if len(calls) < 4:
            raise OSError("busy")
        return b"body"

    f = Fetcher(str(tmp_path), opener, sleep=waits.append)
    assert f.get("http://h/x") == b"body" and f.get("http://h/x") == b"body" and len(calls) == 4
    assert 2.0 in waits and 4.0 in waits
    with pytest.raises(PermissionError):
        f.get("http://h/private/1")


def test_paged_source(spark, tmp_path):
    (tmp_path / "list-.json").write_text(json.dumps({"titles": ["A", "B"], "continue": "t2"}))
    (tmp_path / "list-t2.json").write_text(json.dumps({"titles": ["C"]}))
    for t, v in {"A": {"text": "a"}, "B": {"redirect": "A"}, "C": {"text": ""}}.items():
        (tmp_path / f"{t}.json").write_text(json.dumps({"title": t} | v))
    spark.dataSource.register(PagedArticles)
    got = spark.read.format("paged_articles").option("listing", f"file://{tmp_path}/list-{{token}}.json").option("article", f"file://{tmp_path}/{{title}}.json").load()
    assert sorted(tuple(r) for r in got.collect()) == [("A", "a"), ("A", "a")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["é", None], ("m", 2), "t", "train"), (2, None, None, "u", None)], "id int, xs array<string>, meta struct<a:string,b:int>, task string, split string")
    back = K.decoded(K.encoded(df), {"xs": "array<string>", "meta": "struct<a:string,b:int>"})
    assert sorted(back.collect()) == sorted(df.collect())
    K.append_new(df, str(tmp_path / "a"), "id")
    K.append_new(df.unionByName(df.withColumn("id", df.id + 5)), str(tmp_path / "a"), "id")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    K.export_configs(df, "task", "split", str(tmp_path / "x"))
    out = spark.read.parquet(str(tmp_path / "x"))
    assert {(r["config"], r["config_split"]) for r in out.collect()} == {("t", "train"), ("u", "train")} and "meta_a" in out.columns
    K.write_card(str(tmp_path / "card"), {"n": 2}, {"phase1": K.gate("phase1", df.selectExpr("count(*) as n"))})
    assert json.loads((tmp_path / "card/data_card.json").read_text())["gates"]["phase1"] == {"n": 2}
    K.write_corpus(df.select("task"), str(tmp_path / "t"))
    K.write_jsonl(df, str(tmp_path / "j"))
    K.write_manifest(df, "id", str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id * 10) as ts, 'a' as k, cast(id as double) as v from range(60)").write.parquet(src)
    stream = lambda: spark.readStream.schema("id bigint, ts timestamp, k string, v double").parquet(src)
    q = M.windowed_means(stream(), "ts", "v", "k", "2 hours").writeStream.format("memory").queryName("means").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("means").filter("observed = 12").count() >= 4
    for _ in range(2):
        M.append_once(stream(), str(tmp_path / "out"), "id", str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    assert M.session_counts(spark.read.parquet(src), "ts", "k").first()["n"] == 60


def test_wire_format():
    from corpusmill.sources import wire as W

    m = {"identifier": "x", "inputs": [{"key": "a", "value": {"components": [{"identifiers": [{"kind": 2, "value": "C" * 300}, {"kind": 6, "value": "é"}], "role": 1}, {"identifiers": [], "role": 300}]}}], "outcomes": [{"products": [{"identifiers": [{"kind": 2, "value": "O"}]}]}, {"products": []}], "conditions": {"temperature": {"setpoint": {"value": 25.5}}}}
    blob = W.encode(m, W.REACTION)
    assert W.decode(blob, W.REACTION) == m
    got = W.reaction(blob)
    assert got["identifier"] == "x" and got["temperature"] == 25.5 and [i["role"] for i in got["inputs"]] == ["REACTANT", "300"] and got["inputs"][0]["identifiers"][1] == {"kind": "6", "value": "é"}
    more = b"\x0d\x00\x00\x80\x3f" + b"\x3a\x02hi" + blob  # fields that are not in the spec
    assert W.reaction(more) == got
    for bad in (None, b"", b"\xff", blob[:-1], b"\x52\x01\xff", b"\x50\x01", b"\x0b", b"\xff" * 12):
        assert W.reaction(bad) is None
    assert W.decode(b"", W.REACTION) == {"inputs": [], "outcomes": []}
