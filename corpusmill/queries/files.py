"""Queries of sources and sinks: each writes whole tables in a format and reads them back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import aggregates as A
from corpusmill.operators import atommap as M
from corpusmill.operators import normalize as N
from corpusmill.operators import reward as W
from corpusmill.operators import splits as P
from corpusmill.operators import tasks as T
from corpusmill.operators import validate as V
from corpusmill.plans import export as K
from corpusmill.queries import corpora, query
from corpusmill.queries import records as Q
from corpusmill.queries.common import FULL, full_rows, records
from corpusmill.session import scratch, table
from corpusmill.sources import readers as R
from corpusmill.sources.registry import Source, ingest


@query("select record_no, reaction_id, name, raw_ref.line as line from mechanism_records")
def jsonl_scan(spark, d):
    """Records written as JSON lines, nulls and nested fields kept, and scanned by file and line."""
    path = scratch(spark, "jsonl")
    K.write_jsonl(records(spark, d).select("record_no", "reaction_id", "name", "raw_ref"), path)
    rows = R.json_lines(spark, path, "record_no bigint, reaction_id string, name string, raw_ref struct<line:int>")
    return rows.filter("line_no > 0 and file is not null").select("record_no", "reaction_id", "name", F.col("raw_ref.line").alias("line"))


@query("select doc_id, title, source from documents")
def jsonl_ascii_scan(spark, d):
    """Documents' heads as JSON lines with other than ASCII characters escaped."""
    path = scratch(spark, "jsonl-ascii")
    K.write_jsonl(table(spark, d, "documents").select("doc_id", "title", "source"), path, ascii_only=True)
    return R.json_lines(spark, path, "doc_id bigint, title string, source string").drop("file", "line_no")


@query("select base, name, level, n_steps, subtypes[1] as first_subtype from templates")
def json_array_scan(spark, d):
    """The fixed table of templates as one JSON array."""
    path = scratch(spark, "json-array")
    table(spark, d, "templates").agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).coalesce(1).write.text(path)
    return R.json_array(spark, path, "base string, name string, level string, n_steps int, subtypes array<string>").select("base", "name", "level", "n_steps", F.get("subtypes", F.lit(0)).alias("first_subtype"))


@query("select record_no, string_split(reaction_id, '_')[1] as base from mechanism_records where reaction_id is not null")
def template_parent(spark, d):
    return records(spark, d).filter("reaction_id is not null").select("record_no", R.template_base(F.col("reaction_id")).alias("base"))


@query("select row_id, len(messages)::int as n_messages, reference[1].subtype as first_subtype, meta.level as level from sft_mechanisms")
def interim_round_trip(spark, d):
    """A phase's table in the interchange form, nested columns as JSON text, read back with types; a
    phase that isn't there reads as an empty table."""
    path, rows = scratch(spark, "interim"), table(spark, d, "sft_mechanisms").select("row_id", "messages", "reference", "meta")
    K.write_phase(K.encoded(rows), path)
    schemas = {c: rows.schema[c].dataType.simpleString() for c in ("messages", "reference", "meta")}
    text = "row_id bigint, messages string, reference string, meta string"
    back = K.decoded(R.optional(spark, path, text).unionByName(R.optional(spark, path + "-none", text)), schemas)
    return back.select("row_id", F.size("messages").alias("n_messages"), F.get("reference", F.lit(0))["subtype"].alias("first_subtype"), "meta.level")


_NAMED = "list_filter({0}, lambda x: x is not null and x <> '')"
_PICKED = "array_to_string({0}, ' ')"


_DEPOSITS = f"""with p as (select record_no, {_NAMED.format("reactants_smiles")} as r, {_NAMED.format("products_smiles")} as q, coalesce({_NAMED.format("raw_ref.agents")}, []) as a, mechanism_step_nums as t from mechanism_records)
select record_no, {_PICKED.format("r")} as reactants, {_PICKED.format("q")} as products, concat_ws('; ', case when t is not null then 'T=' || t::varchar || '.0' end, case when len(a) > 0 then 'reagents:' || array_to_string(a[1:6], '.') end) as conditions from p where len(r) > 0 and len(q) > 0"""


@query(_DEPOSITS)
def deposit_scan(spark, d):
    """Records as deposits in sharded folders: inputs with roles and several identifiers, outcomes,
    a temperature; read back and projected."""
    named = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.array(F.struct(F.lit("NAME").alias("kind"), F.lit("n").alias("value")), F.struct(F.lit("SMILES").alias("kind"), x.alias("value"))))
    put = lambda role, c: F.transform(named(c), lambda i: F.struct(F.lit(role).alias("role"), i.alias("identifiers")))
    inputs = F.concat(put("REACTANT", F.col("reactants_smiles")), put("REAGENT", F.col("raw_ref.agents")))
    outcomes = F.array(F.struct(F.transform(named(F.col("products_smiles")), lambda i: F.struct(i.alias("identifiers"))).alias("products")))
    path = scratch(spark, "deposits")
    rows = records(spark, d).select(F.col("record_no").cast("string").alias("identifier"), inputs.alias("inputs"), outcomes.alias("outcomes"), F.col("mechanism_step_nums").cast("double").alias("temperature"), F.pmod("record_no", F.lit(8)).alias("shard"))
    rows.write.partitionBy("shard").parquet(path)
    got = R.deposit_records(R.deposits(spark, path))
    return got.select(F.col("identifier").cast("bigint").alias("record_no"), F.array_join("reactants", " ").alias("reactants"), F.array_join("products", " ").alias("products"), "conditions")


@query(_DEPOSITS)
def deposit_blob_scan(spark, d):
    """Records as encoded deposits in sharded folders, with some blobs that can't be decoded."""
    import pyarrow as pa

    from corpusmill.sources import wire

    def encode(batches):
        named = lambda x: [{"kind": 6, "value": "n"}, {"kind": 2, "value": x}]
        for b in batches:
            blobs = []
            for n, rs, ags, ps, t in zip(*(c.to_pylist() for c in b.columns)):
                parts = [{"identifiers": named(x or ""), "role": role} for role, xs in ((1, rs), (2, ags)) for x in xs or []]
                m = {"identifier": str(n), "inputs": [{"key": "all", "value": {"components": parts}}], "outcomes": [{"products": [{"identifiers": named(x or "")} for x in ps or []]}]}
                blobs.append(wire.encode(m if t is None else m | {"conditions": {"temperature": {"setpoint": {"value": float(t)}}}}, wire.REACTION))
            yield pa.RecordBatch.from_arrays([pa.array([*blobs, b"\xff", None], pa.binary())], names=["data"])

    path = scratch(spark, "deposit-blobs")
    rows = records(spark, d).select("record_no", "reactants_smiles", "raw_ref.agents", "products_smiles", "mechanism_step_nums").mapInArrow(encode, "data binary")
    rows.withColumn("shard", F.pmod(F.xxhash64("data"), F.lit(8))).write.partitionBy("shard").parquet(path)
    got = R.deposit_records(R.deposits(spark, path))
    return got.select(F.col("identifier").cast("bigint").alias("record_no"), F.array_join("reactants", " ").alias("reactants"), F.array_join("products", " ").alias("products"), "conditions")


_PARTS = r"""f as (select record_no, string_split(regexp_extract(trim(reaction_smiles_mapped), '^(\S*)', 1), '>') as p from mechanism_records where reaction_smiles_mapped is not null),
s as (select record_no, len(p) as n, list_filter(string_split(p[1], '.'), lambda x: x <> '') as r, list_filter(string_split(p[3], '.'), lambda x: x <> '') as q from f),
split_ as (select record_no, array_to_string(r, ' ') as reactants, array_to_string(q, ' ') as products from s where n = 3 and len(r) > 0 and len(q) > 0)"""


def _lists(rows):
    return rows.select("record_no", F.array_join("reactants", " ").alias("reactants"), F.array_join("products", " ").alias("products"))


@query(f"with {_PARTS} select * from split_")
def tsv_scan(spark, d):
    """Mapped reactions as tab-separated rows with the suffix of extended line formulas."""
    path = scratch(spark, "tsv")
    rows = records(spark, d).filter("reaction_smiles_mapped is not null").select("record_no", F.concat(F.trim("reaction_smiles_mapped"), F.lit(" |f:0.1|")).alias("ReactionSmiles"))
    rows.write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return _lists(R.reaction_tsv(spark, path, "ReactionSmiles").withColumn("record_no", F.col("record_no").cast("bigint")))


@query(f"with {_PARTS}, o as (select record_no, source from mechanism_records where source <> 'Wikipedia') select record_no, reactants, products, source as origin, family from split_ join o using (record_no), (values ('polar'), ('radical')) f(family)")
def step_csv_scan(spark, d):
    """Mapped reactions as tables of elementary steps under two headers, read as polar and as radical."""
    rows = records(spark, d).filter("reaction_smiles_mapped is not null").select(F.col("reaction_smiles_mapped").alias("r"), "source", F.col("record_no").cast("string").alias("n"))
    out = None
    for family, read, names in (("polar", R.polar_steps, ("Reaction SMIRKS", "Original source", "Auxiliary information")), ("radical", R.radical_steps, ("smirks", "source", "note"))):
        path = scratch(spark, family)
        rows.toDF(*names).write.option("header", True).option("escape", '"').csv(path)
        got = read(spark, path).filter("origin != 'Wikipedia'")
        one = got.select(F.col("note").cast("bigint").alias("record_no"), F.array_join("reactants", " ").alias("reactants"), F.array_join("products", " ").alias("products"), "origin", "family")
        out = one if out is None else out.unionByName(one)
    return out


@query("select record_no, split from mechanism_records where split = 'test'")
def named_split(spark, d):
    """One of three named splits, each a JSON-lines file set."""
    path = scratch(spark, "splits")
    for s in ("train", "validation", "test"):
        K.write_jsonl(records(spark, d).filter(F.col("split") == s).select("record_no", "split"), f"{path}/{s}.jsonl")
    return R.benchmark_split(spark, "test", {s: f"{path}/{s}.jsonl" for s in ("train", "validation", "test")}, "record_no bigint, split string").drop("file", "line_no")


@query(f"with {FULL} select row_id, case when meta.level = 'easy' then 'second' else 'first' end as attempt from full_rows")
def resume_scan(spark, d):
    """Predictions appended in two rounds, with unreadable lines; the last of a row counts."""
    path, rows = scratch(spark, "predictions"), full_rows(spark, d)
    line = lambda a: F.to_json(F.struct("row_id", F.lit(a).alias("attempt"))).alias("value")
    rows.select(line("first")).unionByName(rows.limit(3).select(F.lit('{"row_id": ').alias("value"))).write.text(f"{path}/round=1")
    rows.filter("meta.level = 'easy'").select(line("second")).write.text(f"{path}/round=2")
    return R.last_predictions(spark, path, "row_id bigint, attempt string", "row_id").select("row_id", "attempt")


@query("select distinct 'step' as type, unnest(subtypes) as subtype from templates")
def ontology_prompt(spark, d):
    """The pairs that prompts' texts hold as a JSON list, behind another list without subtypes."""
    pairs = F.to_json(F.transform("subtypes", lambda s: F.struct(F.lit("step").alias("type"), s.alias("subtype"))))
    prompts = table(spark, d, "templates").select(F.concat(F.lit('Answer as [{"a": 1}] with these:\n'), pairs, F.lit("\nand no other.")).alias("text"))
    return R.embedded_pairs(prompts, "text")


@query(f"with {corpora._SOURCES} select source as key, case when verdict not in ('usable', 'usable_for_research_only') then 'blocked' when not enabled then 'disabled' when source = 'oMe-Gold' then 'error' else 'ok' end as status, case when enabled and verdict in ('usable', 'usable_for_research_only') and source <> 'oMe-Gold' then (select count(*) from mechanism_records r where r.source = src.source) end as n from src")
def registry_ingest(spark, d):
    """Registered sources behind the licence gate; one whose reader fails is an error, the others go on."""

    def reader(key):
        def read(s):
            if key == "oMe-Gold":
                raise OSError("not there")
            return records(s, d).filter(F.col("source") == key)

        return read

    frames, status = ingest(spark, [Source(s, s, "MIT", t, v, e, reader(s)) for s, t, e, v in corpora.SOURCES])
    states = spark.createDataFrame([(k, v.split(":")[0]) for k, v in status.items()], "key string, status string")
    counts = None
    for key, f in frames.items():
        one = f.agg(F.count("*").alias("n")).withColumn("key", F.lit(key))
        counts = one if counts is None else counts.unionByName(one)
    return states.join(counts, "key", "left").select("key", "status", "n")


@query(Q.SQL_PROBLEMS + " select record_no, array_to_string(list_sort(list(problem)), ',') as reasons from p where problem is not null group by 1")
def reject_sink(spark, d):
    """Rejected records with their reasons, written and read back."""
    path = scratch(spark, "rejects")
    K.write_rejects(Q.structural_problems(spark, d).groupBy("record_no").agg(F.sort_array(F.collect_list("problem")).alias("reasons")), path)
    return spark.read.schema("record_no bigint, reasons array<string>").json(path).select("record_no", F.array_join("reasons", ",").alias("reasons"))


@query("with l as (select unnest(reactants_smiles) as value from mechanism_records union select unnest(products_smiles) from mechanism_records) select distinct value from l where value is not null and value <> ''")
def corpus_sink(spark, d):
    path = scratch(spark, "corpus")
    K.write_corpus(T.text_corpus(records(spark, d), ["reactants_smiles", "products_smiles"]), path)
    return spark.read.text(path)


@query("select row_id, task from sft_mechanisms")
def resumable_append(spark, d):
    """Rows appended in two overlapping goes: each once."""
    path, rows = scratch(spark, "append"), table(spark, d, "sft_mechanisms").select("row_id", "task")
    K.append_new(rows.filter("task = 'mechanism_full'"), path, "row_id")
    K.append_new(rows, path, "row_id")
    return spark.read.parquet(path)


@query(corpora._REASONS + " select reason, source, count(*) as removed from judged where reason is not null group by 1, 2")
def decon_report_sink(spark, d):
    path = scratch(spark, "report")
    K.write_report(corpora.decon_report(spark, d), path)
    return spark.read.schema("reason string, source string, removed bigint").json(path)


_CARD = ("provenance", "source", "level", "split")


@query(" union all ".join(f"select '{c}' as what, coalesce({c}, 'none') as value, count(*) as n from mechanism_records group by 2" for c in _CARD))
def card_tables(spark, d):
    """The data card's distribution tables."""
    return K.distributions(records(spark, d), list(_CARD))


@query("select record_no, case when k <= greatest(1, floor(n * 0.03::double)) then 'validation' else 'train' end as split from (select record_no, row_number() over (order by sha1('20240709|' || record_no::varchar), record_no) as k, count(*) over () as n from mechanism_records)")
def manifest_sink(spark, d):
    path = scratch(spark, "manifest")
    K.write_manifest(P.head_slice(records(spark, d).select("record_no"), "record_no", 0.03), "record_no", path)
    return spark.read.schema("record_no bigint, split string").json(path)


@query("select row_id, task as config, split as config_split, meta.level as meta_level, len(reference)::int as n_steps from sft_mechanisms")
def config_export(spark, d):
    """Chat rows in a folder per config and split, meta as columns, nested columns as JSON text."""
    path, rows = scratch(spark, "export"), table(spark, d, "sft_mechanisms").drop("created_at", "reaction_id")
    K.export_configs(rows, "task", "split", path)
    back = K.decoded(spark.read.parquet(path), {"reference": rows.schema["reference"].dataType.simpleString()})
    return back.select("row_id", "config", "config_split", "meta_level", F.when(F.col("reference").isNotNull(), F.size("reference")).alias("n_steps"))


@query("select task as config, split as config_split, count(*) as n from sft_mechanisms group by 1, 2")
def export_page(spark, d):
    """A dry run of the export: its page, read back, tells the rows of each config and split."""
    path, rows = scratch(spark, "dry-run"), table(spark, d, "sft_mechanisms").select("row_id", "task", "split", "reference")
    K.dry_run(rows, "task", "split", path, "other", "Mechanism rows", check={"perfect": "all"})
    page = spark.read.text(f"{path}/_card")
    split = F.explode(F.split(F.regexp_extract("value", r"^- \w+: (.+)$", 1), ", ")).alias("s")
    listed = page.filter(F.col("value").rlike(r"^- \w+: \w+ \d+(, |$)")).select(F.regexp_extract("value", r"^- (\w+):", 1).alias("config"), split)
    return listed.select("config", F.substring_index("s", " ", 1).alias("config_split"), F.substring_index("s", " ", -1).cast("bigint").alias("n"))


@query("select * from (select count(*) as n from mechanism_records), (select count(*) as n_named from mechanism_records where name is not null), (select count(distinct source) as n_sources from mechanism_records)")
def gate_report(spark, d):
    """A phase's gate: its metrics in one job."""
    got = K.gate("ingest", records(spark, d).agg(F.count("*").alias("n"), F.count("name").alias("n_named"), F.countDistinct("source").alias("n_sources")))
    return spark.createDataFrame([tuple(got.values())], "n bigint, n_named bigint, n_sources bigint")


@query("select record_no, array_to_string(coalesce(reactants_smiles, []), ' ') as parts from mechanism_records")
def coerce_list_input(spark, d):
    """Lists keep their elements whole; null becomes the empty list."""
    r = records(spark, d)
    return r.select("record_no", F.array_join(N.as_lists(r, "reactants_smiles"), " ").alias("parts"))


@query("select record_no, array_to_string(list_filter(string_split(reaction_id, '.'), lambda x: x <> ''), ' ') as parts from mechanism_records where reaction_id is not null")
def coerce_text_input(spark, d):
    r = records(spark, d).filter("reaction_id is not null")
    return r.select("record_no", F.array_join(N.as_lists(r, "reaction_id"), " ").alias("parts"))


@query("select record_no, reaction_id, provenance, name, coalesce(len(reactants_smiles), 0)::int as n_reactants, coalesce(len(products_smiles), 0)::int as n_products, reactants_smiles[1] as first_reactant from mechanism_records order by record_no limit 5")
def record_preview(spark, d):
    """A top-k report: the first five records."""
    return A.preview(records(spark, d), ["record_no"])


@query("select source, 'empty' as reason, count(*) as n from mechanism_records where coalesce(trim(name), '') = '' group by source")
def sanitize_reasons(spark, d):
    """Why names fail as texts, by source, with the text kernel."""
    names = records(spark, d).select("source", "name")
    done = N.normalized(names, "name", N.TextKernel()).withColumnRenamed("name", "_n")
    return N.sanitize_reasons(names.join(done, F.col("name").eqNullSafe(F.col("_n"))), "source", "ok", "reason")


_TOKENS = r"len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: w <> ''))"


@query(
    f"""with t as (select lower(trim(source)) as source, {_TOKENS} as n_tokens from documents where text is not null), r as (select *, row_number() over (partition by source order by n_tokens) - 1 as i, count(*) over (partition by source) as n from t)
select source, n, max(case when i = n // 2 then n_tokens end)::int as p50, max(case when i = floor(0.95::double * n)::bigint then n_tokens end)::int as p95, max(n_tokens)::int as "max", sum((n_tokens > 300)::int)::bigint as over_budget from r group by source, n"""
)
def token_budget(spark, d):
    """Lengths of texts in white-space tokens and how many are over a budget of 300."""
    from corpusmill.functions.text import label

    words = F.size(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != ""))
    docs = table(spark, d, "documents").filter("text is not null").select(label(F.col("source")).alias("source"), words.alias("n_tokens"))
    return A.length_report(docs, "n_tokens", ["source"], 300)


@query(
    """with t as (select *, row_number() over (partition by lower(trim(coalesce(name, ''))) order by base) as k from templates)
select r.record_no, t.base from mechanism_records r join t on lower(trim(coalesce(r.name, ''))) = lower(trim(t.name)) and k = 1 where lower(trim(coalesce(t.name, ''))) <> '' and coalesce(r.mechanism_step_nums, 0) = 0 order by r.record_no limit 25"""
)
def review_sample(spark, d):
    """A review sample: the first 25 inferred records."""
    return A.first_rows(Q.name_join(spark, d), ["record_no"], 25).select("record_no", "base")


@query("select record_no from mechanism_records order by record_no limit 200")
def mapping_sample(spark, d):
    """The bounded sample that goes to the mapper."""
    return M.mapping_sample(records(spark, d).select("record_no"), ["record_no"])


def stand_in_mapper(texts):
    """Marks the text and is as sure as its length's last two digits say."""
    return [(t + " mapped", len(t) % 100 / 100) for t in texts]


_SIDES = "list_transform({0}, lambda x: trim(x))"
_MAPS = f"""with r as (select record_no, {_SIDES.format("reactants_smiles")} as a, {_SIDES.format("products_smiles")} as b, reaction_smiles_mapped as pre from mechanism_records),
t as (select record_no, pre, array_to_string(a, '.') || '>>' || array_to_string(b, '.') as txt, coalesce(len(a) > 0 and len(b) > 0 and len(list_filter(list_concat(a, b), lambda x: coalesce(x, '') = '' or contains(x, '*'))) = 0, false) as ok from r),
m as (select record_no, case when ok then txt || ' mapped' else pre end as mapped, case when ok then (length(txt) % 100) / 100.0::double end as confidence, case when not ok then case when pre <> '' then 'kept_premapped(invalid_or_rgroup)' else 'invalid_or_rgroup' end end as map_reason, ok and length(txt) % 100 < 30 as quarantine from t)"""


def _mapped(spark, d):
    trim = lambda c: F.transform(c, lambda x: F.trim(x))
    rows = records(spark, d).select("record_no", trim("reactants_smiles").alias("reactants"), trim("products_smiles").alias("products"), "reaction_smiles_mapped")
    return M.map_records(rows, "record_no", stand_in_mapper)


@query(_MAPS + " select record_no, mapped, confidence, map_reason, quarantine from m")
def map_records(spark, d):
    """Every record mapped by a stand-in; sides that can't be mapped keep the source's map."""
    return _mapped(spark, d).select("record_no", F.col("reaction_smiles_mapped").alias("mapped"), "confidence", "map_reason", "quarantine")


@query(_MAPS + ", bins as (select least(floor(confidence * 5), 4)::int as bin from m where confidence is not null) select count(confidence) as n, round(avg(confidence), 4)::double as mean, " + ", ".join(f"(select count(*) from bins where bin = {i}) as bin{i}" for i in range(5)) + " from m")
def map_confidence(spark, d):
    got = M.confidence_report(_mapped(spark, d))
    return got.select("n", "mean", *(F.col("histogram")[i].alias(f"bin{i}") for i in range(5)))


@query(
    f"""with {FULL}, s as (select f.row_id, u.i as pos, case when u.i = 1 then array_to_string(list_transform(r.reactants_smiles, lambda x: trim(x)), '.') else f.reference[u.i - 1].smiles end || '>>' || f.reference[u.i].smiles as txt, u.i > 1 or (len(r.reactants_smiles) > 0 and len(list_filter(r.reactants_smiles, lambda x: coalesce(trim(x), '') = '')) = 0) as ok
from full_rows f join mechanism_records r on f.record_no = r.record_no, unnest(generate_series(1, len(f.reference))) as u(i))
select row_id, min(case when ok then (length(txt) % 100) / 100.0::double end) as least from s group by row_id"""
)
def map_step_confidence(spark, d):
    """Per chat row the least sure of its steps' maps."""
    own = records(spark, d).select("record_no", F.transform("reactants_smiles", lambda x: F.trim(x)).alias("reactants"))
    rows = full_rows(spark, d).select("row_id", "record_no", "reference").join(own, "record_no")
    return M.least_confidence(M.map_steps(rows, "row_id", "reference", "smiles", stand_in_mapper), "row_id")


_OK = "(coalesce(checks.sanitized, false) and coalesce(mechanism_step_nums, 0) > 0)"


@query(
    f"""with r as (select record_no, {_OK} as ok, coalesce(mechanism_step_nums, 0) as n, case when checks.step_continuity then 1.0 when not checks.step_continuity then 0.5 end as rt from mechanism_records)
select record_no, round(case when ok then least(n, 5) / 5.0 + 0.10 * least(n, 4) / 4.0 + 0.05 + 0.10 * coalesce(rt, 0) else -0.5 end, 6)::double as reward, case when ok then least(n, 4) / 4.0 else 0 end::double as validity, ok::int::double as format, case when ok then coalesce(rt, 0) else 0 end::double as round_trip from r"""
)
def reward_table(spark, d):
    """The rewards of a run with round trips, over columns that stand in for scores."""
    n, c = F.coalesce("mechanism_step_nums", F.lit(0)), F.col("checks.step_continuity")
    got = W.composed("omes+roundtrip", F.col("checks.sanitized"), n, F.least(n, F.lit(5)) / 5, F.least(n, F.lit(4)) / 4, F.when(c, 1.0).when(~c, 0.5))
    return records(spark, d).select("record_no", *(F.round(v, 6).alias(k) for k, v in got.items()))


@query("select record_no, coalesce(len(reactants_smiles) > 0 and len(list_filter(reactants_smiles, lambda x: coalesce(trim(x), '') = '')) = 0, false) as ok from mechanism_records")
def sides_sanitized(spark, d):
    """Whether all reactants can be read and there are any, by the line-formula kernel."""
    r = records(spark, d).select("record_no", F.transform("reactants_smiles", lambda x: F.trim(x)).alias("reactants"))
    bad = V.side_reasons(r, "record_no", ["reactants"])
    return r.join(bad, "record_no", "left").select("record_no", (F.col("reasons").isNull() & (F.coalesce(F.size("reactants"), F.lit(0)) > 0)).alias("ok"))
