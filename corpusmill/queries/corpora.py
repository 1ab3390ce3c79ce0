"""Queries of decontamination, duplicates, similarity joins, splits and licences."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions.text import collapsed, trigram_bits
from corpusmill.operators import decontaminate as D
from corpusmill.operators import dedup as U
from corpusmill.operators import features as FT
from corpusmill.operators import simjoin as J
from corpusmill.operators import splits as P
from corpusmill.operators.components import hash_to_min, star_edges
from corpusmill.queries import query
from corpusmill.queries.common import COLLAPSED, FULL, STEPS, full_rows, records
from corpusmill.queries.records import BARE_TEXT, SIGS, SKELETONS, signatures, skeletons
from corpusmill.session import staged, table, widened


def _featured(spark, d):
    """Records with signature, skeleton and step hash."""
    hashes = full_rows(spark, d).groupBy("record_no").agg(F.min_by(FT.step_hash(F.col("reference"), "subtype", "smiles"), "row_id").alias("steps"))
    return signatures(spark, d).join(skeletons(spark, d), "record_no").join(hashes, "record_no", "left").select("record_no", "source", "split", "provenance", "mechanism_step_nums", "sig", "skel", "steps")


_FEATURED = f"""{SIGS}, {FULL}, {SKELETONS},
hashes as (select record_no, sha1(array_to_string(list_transform(reference, lambda s: coalesce(s.subtype, '') || '|' || coalesce(s.smiles, '')), chr(10))) as steps from full_rows where len(reference) > 0 qualify row_number() over (partition by record_no order by row_id) = 1),
featured as (select sigs.*, skel, steps from sigs join skels using (record_no) left join hashes using (record_no))"""
_REASONS = f"""with {_FEATURED}, bench as (select * from featured where split in ('validation', 'test')), cand as (select * from featured where split = 'train'),
judged as (select *, case when sig in (select sig from bench where sig is not null) then 'inchikey_set_match' when skel in (select skel from bench where skel is not null) then 'skeleton_inchikey_match' when steps in (select steps from bench where steps is not null) then 'mechanism_hash_match' end as reason from cand)"""


def _held_out(f):
    """Both held-out corpora as one blacklist."""
    return D.blacklist(f.filter("split = 'validation'"), f.filter("split = 'test'"))


def _judged(spark, d):
    f = _featured(spark, d)
    return D.reasons(f.filter("split = 'train'"), _held_out(f), "record_no")


@query(_REASONS + " select record_no, reason from judged where reason is not null")
def decon_reasons(spark, d):
    return D.split_clean(_judged(spark, d))[1].select("record_no", "reason")


@query(_REASONS + " select record_no from judged where reason is null")
def decon_kept(spark, d):
    return D.split_clean(_judged(spark, d))[0].select("record_no")


@query(_REASONS + " select reason, source, count(*) as removed from judged where reason is not null group by 1, 2")
def decon_report(spark, d):
    return D.report(_judged(spark, d))


@query(_REASONS + " select count(*) as leaks from judged where reason is null and sig in (select sig from bench where sig is not null)")
def decon_leak_postcheck(spark, d):
    judged = staged(_judged(spark, d), "judged")
    return D.leaks(D.split_clean(judged)[0], _held_out(_featured(spark, d)))


def _fingerprinted(spark, d):
    """Records with their reaction fingerprint besides signature, skeleton and step hash."""
    trim = lambda c: F.transform(c, lambda x: F.trim(x)).alias(c)
    sides = records(spark, d).select("record_no", trim("reactants_smiles"), trim("products_smiles"))
    f = _featured(spark, d).join(sides, "record_no")
    return FT.reaction_bits(f, "record_no", "reactants_smiles", "products_smiles")


def _judged_by_all(spark, d):
    f = staged(_fingerprinted(spark, d).drop("reactants_smiles", "products_smiles"), "fingerprinted")
    return D.reasons(f.filter("split = 'train'"), _held_out(f), "record_no", "19/20", "fp")


@query()
def decon_fp_reasons(spark, d):
    """Exact stages, then reaction fingerprints of at least 0.95 similarity (decon_reasons: exact stages only)."""
    return D.split_clean(_judged_by_all(spark, d))[1].select("record_no", "reason")


@query()
def decon_fp_kept(spark, d):
    return D.split_clean(_judged_by_all(spark, d))[0].select("record_no")


@query()
def decon_fp_report(spark, d):
    return D.report(_judged_by_all(spark, d))


_TRIGRAMS = "list_distinct(flatten(list_transform(list_filter(list_transform({0}, lambda x: trim(x)), lambda x: x is not null), lambda x: list_transform(range(greatest(0, length(x) - 2)), lambda i: (unicode(x[i + 1]) * 256 + unicode(x[i + 2])) * 256 + unicode(x[i + 3])))))"
#: Reaction fingerprints over the texts' runs of three characters, which SQL can follow exactly.
_TEXT_FPS = f"""sides_ as (select record_no, {_TRIGRAMS.format("reactants_smiles")} as r, {_TRIGRAMS.format("products_smiles")} as p from mechanism_records),
xors as (select record_no, list_concat(list_filter(r, lambda b: not list_contains(p, b)), list_filter(p, lambda b: not list_contains(r, b))) as x from sides_ where len(r) > 0 and len(p) > 0),
fps as (select record_no, case when len(x) > 0 then list_sort(x) else [-1] end as fp from xors)"""


def _text_fingerprinted(spark, d):
    trim = lambda c: F.transform(c, lambda x: F.trim(x)).alias(c)
    sides = records(spark, d).select("record_no", trim("reactants_smiles"), trim("products_smiles"))
    return FT.reaction_bits(sides, "record_no", "reactants_smiles", "products_smiles", bits_of=trigram_bits)


@query(f"with {_TEXT_FPS} select record_no, len(fp)::int as n_bits, fp[1]::int as first, fp[len(fp)]::int as last, list_sum(fp)::bigint as total from fps")
def reaction_fingerprint(spark, d):
    """The bits of exactly one side of each reaction, with runs of characters as the molecules' bits."""
    f = _text_fingerprinted(spark, d).filter("fp is not null").select("record_no", F.sort_array("fp").alias("fp"))
    return f.select("record_no", F.size("fp").alias("n_bits"), F.col("fp")[0].alias("first"), F.element_at("fp", -1).alias("last"), F.aggregate("fp", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


def _judged_by_text(spark, d):
    f = staged(_featured(spark, d).join(_text_fingerprinted(spark, d).select("record_no", "fp"), "record_no"), "text-fingerprinted")
    return D.reasons(f.filter("split = 'train'"), _held_out(f), "record_no", "19/20", "fp")


@query(
    _REASONS
    + f""", {_TEXT_FPS}, near as (select distinct c.record_no from judged c join fps a on c.record_no = a.record_no, bench b join fps q on b.record_no = q.record_no
where c.reason is null and len(a.fp) * 20 >= len(q.fp) * 19 and len(q.fp) * 20 >= len(a.fp) * 19 and len(list_intersect(a.fp, q.fp)) * 20 >= (len(a.fp) + len(q.fp) - len(list_intersect(a.fp, q.fp))) * 19)
select record_no, coalesce(reason, 'reaction_fp_tanimoto>=0.95') as reason from judged where reason is not null or record_no in (select record_no from near)"""
)
def decon_bits_reasons(spark, d):
    """All four stages in their order, with runs of characters as the molecules' bits."""
    return D.split_clean(_judged_by_text(spark, d))[1].select("record_no", "reason")


@query(f"with b as (select record_no, list_min(list_filter(list_transform(products_smiles, lambda x: {BARE_TEXT}), lambda x: x is not null)) as bucket from mechanism_records) select record_no, bucket from b where bucket is not null")
def product_buckets(spark, d):
    """The smallest of each record's products without charges, hydrogens, maps and stereo, as written."""
    import re

    bare, stereo = re.compile(FT.BARE_ATOM), re.compile(FT.STEREO_SIGN)
    p = records(spark, d).select("record_no", F.transform("products_smiles", lambda x: F.trim(x)).alias("p"))
    return FT.product_bucket(p, "record_no", "p", skeleton_of=lambda t: stereo.sub("", bare.sub(r"\1", t))).filter("bucket is not null").select("record_no", "bucket")


_SHINGLES = r"""words as (select {key} as key, {by} as part, list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '\s+'), lambda w: w <> '') as w from {table}),
raw as (select key, part, case when len(w) >= 5 then list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) else [array_to_string(w, ' ')] end as x from words where len(w) > 0),
sets as (select min(key) as key, any_value(x) as x from raw group by part, list_sort(x))"""


@query(
    f"""with {_SHINGLES.format(key="doc_id", by="1", text="text", table="documents")}, inv as (select key, unnest(x) as s from sets), n as (select key, len(x) as n from sets),
shared as (select a.key as ka, b.key as kb, count(*) as k from inv a join inv b on a.s = b.s and a.key < b.key group by 1, 2)
select ka as a, kb as b, round(k / (na.n + nb.n - k), 9)::double as similarity from shared join n na on ka = na.key join n nb on kb = nb.key where k * 5 >= (na.n + nb.n - k) * 4"""
)
def sim_join_shingles(spark, d):
    """Pairs of different documents, of equal ones the first, with at least 0.8 of their five-word shingles in common."""
    s = widened(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", FT.word_shingles(F.col("text")).alias("x"))
    return J.similar_pairs(s, "doc_id", "x", "4/5").select("a", "b", F.round("similarity", 9).alias("similarity"))


_BITS = """bits as (select vec_id, label, list_filter(list_transform(embedding, lambda x, i: case when x > 0 then i - 1 end), lambda i: i is not null) as x from embeddings),
reps as (select min(vec_id) as vec_id, label, any_value(x) as x from bits group by label, x)"""


def _bits(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", FT.sign_bits(F.col("embedding")).alias("x"))


@query(
    f"""with {_BITS}, inv as (select vec_id, label, unnest(x) as s from reps), shared as (select a.vec_id as a, b.vec_id as b, count(*) as k from inv a join inv b on a.s = b.s and a.label = b.label and a.vec_id < b.vec_id group by 1, 2)
select a, b, round(k / (len(p.x) + len(q.x) - k), 9)::double as similarity from shared join bits p on a = p.vec_id join bits q on b = q.vec_id where k * 2 >= len(p.x) + len(q.x) - k"""
)
def bucket_pairs(spark, d):
    """Pairs of vectors of one label whose sign bits have at least half in common."""
    return J.similar_pairs(_bits(spark, d), "vec_id", "x", "1/2", ["label"]).select("a", "b", F.round("similarity", 9).alias("similarity"))


@query(
    f"""with {_BITS}, inv as (select vec_id, unnest(x) as s, vec_id % 50 = 0 as q from bits), shared as (select a.vec_id as a, b.vec_id as b, count(*) as k from inv a join inv b on a.s = b.s where a.q and not b.q group by 1, 2)
select a as vec_id, round(max(k / (len(p.x) + len(q.x) - k)), 9)::double as best from shared join bits p on a = p.vec_id join bits q on b = q.vec_id where k * 2 >= len(p.x) + len(q.x) - k group by 1"""
)
def sim_join_bits(spark, d):
    """The stated query set (ids divisible by 50) against the vectors outside it, as its SQL says;
    sim_search_bits searches all vectors."""
    b = _bits(spark, d)
    return J.similar_to(b.filter("vec_id % 50 = 0"), b.filter("vec_id % 50 != 0"), "vec_id", "x", "1/2").select("vec_id", F.round("best", 9).alias("best"))


@query(
    f"""with {_BITS}, inv as (select vec_id, unnest(x) as s, vec_id % 50 = 0 as q from bits), shared as (select a.vec_id as a, b.vec_id as b, count(*) as k from inv a join inv b on a.s = b.s where a.q and a.vec_id <> b.vec_id group by 1, 2),
hits as (select a, b, round(k / (len(p.x) + len(q.x) - k), 9)::double as similarity from shared join bits p on a = p.vec_id join bits q on b = q.vec_id where k * 2 >= len(p.x) + len(q.x) - k)
select a as vec_id, max(similarity) as best, arg_min(b, (-similarity, b)) as partner, count(*) as hits from hits group by 1"""
)
def sim_search_bits(spark, d):
    """The stated query set (ids divisible by 50) against all vectors but the row itself: the best
    similarity, its partner (the smallest id of equals) and the number of hits."""
    b = _bits(spark, d)
    found = J.similar_matches(b.filter("vec_id % 50 = 0"), b, "vec_id", "x", "1/2").filter("a != b").withColumn("similarity", F.round("similarity", 9))
    return found.groupBy(F.col("a").alias("vec_id")).agg(F.max("similarity").alias("best"), F.min_by("b", F.struct(-F.col("similarity"), "b")).alias("partner"), F.count("*").alias("hits"))


_EDGES = f"""with recursive {_FEATURED}, nodes as (select record_no, sig, steps from featured),
star as (select min(record_no) over (partition by sig) as a, record_no as b from nodes where sig is not null union select min(record_no) over (partition by steps), record_no from nodes where steps is not null),
links as (select a, b from star where a <> b union select b, a from star where a <> b),
reach as (select record_no as node, record_no as other from nodes union select r.node, l.b from reach r join links l on r.other = l.a),
clustered as (select node as record_no, min(other) as cluster from reach group by 1)"""


@query(_EDGES + " select record_no, cluster from clustered where record_no in (select a from links)")
def components(spark, d):
    """Records linked by equal signatures or equal step hashes; unlinked ones are left out."""
    f = _featured(spark, d)
    edges = star_edges(f, "record_no", "sig").unionByName(star_edges(f, "record_no", "steps")).filter("a != b").distinct()
    return hash_to_min(edges).select(F.col("node").alias("record_no"), F.col("component").alias("cluster"))


def _clustered(spark, d):
    f = staged(_featured(spark, d), "featured")
    return f, U.clusters(f, "record_no", ["sig", "steps"])


_RANK = "case provenance when 'curated' then 3 when 'template_expanded' then 2 when 'inferred' then 1 else 0 end"


@query(_EDGES + f" select cluster, record_no, provenance from (select *, row_number() over (partition by cluster order by {_RANK} desc, mechanism_step_nums desc nulls last, record_no) as k from clustered join featured using (record_no)) where k = 1")
def dedup_representative(spark, d):
    f, c = _clustered(spark, d)
    best = U.representatives(f, c, "record_no", [-U.provenance_rank(F.col("provenance")), -F.coalesce("mechanism_step_nums", F.lit(-1))])
    return best.select("cluster", "record_no", "provenance")


def _clustered_by_all(spark, d):
    f = FT.product_bucket(_fingerprinted(spark, d), "record_no", "products_smiles").drop("reactants_smiles", "products_smiles")
    f = staged(f.withColumn("bucket", F.when(F.col("sig").isNotNull(), F.col("bucket"))), "fingerprinted")
    return f, U.clusters(f, "record_no", ["sig", "steps"], "fp", "97/100", "bucket")


@query()
def dedup_fp_representative(spark, d):
    """As dedup_representative, with fingerprints of at least 0.97 similarity in a product bucket as links, too."""
    f, c = _clustered_by_all(spark, d)
    best = U.representatives(f, c, "record_no", [-U.provenance_rank(F.col("provenance")), -F.coalesce("mechanism_step_nums", F.lit(-1))])
    return best.select("cluster", "record_no", "provenance")


_BUCKETS = f"buckets as (select record_no, list_min(list_filter(list_transform(products_smiles, lambda x: {BARE_TEXT}), lambda x: x is not null)) as bucket from mechanism_records)"
_BIT_EDGES = f"""with recursive {_FEATURED}, {_TEXT_FPS}, {_BUCKETS},
held as (select record_no, fp, bucket from fps join buckets using (record_no) join featured using (record_no) where sig is not null and bucket is not null),
near as (select a.record_no as a, b.record_no as b from held a join held b on a.bucket = b.bucket and a.record_no < b.record_no where len(list_intersect(a.fp, b.fp)) * 100 >= (len(a.fp) + len(b.fp) - len(list_intersect(a.fp, b.fp))) * 97),
star as (select min(record_no) over (partition by sig) as a, record_no as b from featured where sig is not null union select min(record_no) over (partition by steps), record_no from featured where steps is not null union select a, b from near),
links as (select a, b from star where a <> b union select b, a from star where a <> b),
reach as (select record_no as node, record_no as other from featured union select r.node, l.b from reach r join links l on r.other = l.a),
clustered as (select node as record_no, min(other) as cluster from reach group by 1)"""


@query(_BIT_EDGES + f" select cluster, record_no, provenance from (select *, row_number() over (partition by cluster order by {_RANK} desc, mechanism_step_nums desc nulls last, record_no) as k from clustered join featured using (record_no)) where k = 1")
def dedup_bits_representative(spark, d):
    """As dedup_fp_representative, with runs of characters as the molecules' bits and buckets as written."""
    f = _featured(spark, d).join(_text_fingerprinted(spark, d).select("record_no", "fp"), "record_no").join(product_buckets(spark, d), "record_no", "left")
    f = staged(f.withColumn("bucket", F.when(F.col("sig").isNotNull(), F.col("bucket"))), "text-fingerprinted")
    best = U.representatives(f, U.clusters(f, "record_no", ["sig", "steps"], "fp", "97/100", "bucket"), "record_no", [-U.provenance_rank(F.col("provenance")), -F.coalesce("mechanism_step_nums", F.lit(-1))])
    return best.select("cluster", "record_no", "provenance")


@query()
def dedup_fp_cluster_sizes(spark, d):
    return U.size_distribution(_clustered_by_all(spark, d)[1])


@query(_EDGES + ", s as (select cluster, count(*) as cluster_size from clustered group by 1) select cluster_size, count(*) as clusters from s group by 1")
def dedup_cluster_sizes(spark, d):
    return U.size_distribution(_clustered(spark, d)[1])


@query(f"select min(doc_id) as doc_id, count(*) as copies from documents where {COLLAPSED.format('text')} <> '' group by {COLLAPSED.format('text')}")
def exact_text_classes(spark, d):
    """Classes of equal texts (case and white space aside): the smallest id and their size."""
    return table(spark, d, "documents").withColumn("k", F.sha2(collapsed(F.col("text")), 256)).filter(collapsed(F.col("text")) != "").groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "copies")


_DOMINANT = f"""{STEPS}, per as (select row_id, subtype, count(*) as n, min(pos) as first from steps where subtype is not null group by 1, 2), dom as (select row_id, arg_max(subtype, n * 1000 - first) as dominant from per group by 1)"""


@query(f"with {_DOMINANT} select f.row_id, coalesce(dominant, 'none') as dominant from full_rows f left join dom using (row_id)")
def dominant_subtype(spark, d):
    return P.dominant(full_rows(spark, d).select("row_id", F.transform("reference", lambda s: s["subtype"]).alias("x")), "row_id", "x")


@query(
    f"""with {_DOMINANT}, s as (select f.row_id, coalesce(dominant, 'none') as dominant, case when len(reference) <= 3 then 'easy' when len(reference) <= 6 then 'medium' else 'hard' end as level from full_rows f left join dom using (row_id)),
r as (select *, row_number() over (partition by dominant, level order by sha1('20240709|' || row_id::varchar), row_id) as k, count(*) over (partition by dominant, level) as n from s)
select row_id, dominant, level, case when k <= (case when n <= 1 then 0 else greatest(1, round_even(n * 0.05::double, 0)) end) then 'validation' else 'train' end as split from r"""
)
def stratified_split(spark, d):
    from corpusmill.operators.normalize import level_of

    s = full_rows(spark, d).select("row_id", level_of(F.size("reference")).alias("level")).join(dominant_subtype(spark, d), "row_id")
    return P.stratified(s, "row_id", ["dominant", "level"], 0.05)


@query("with r as (select record_no, row_number() over (order by sha1('20240709|' || record_no::varchar), record_no) as k, count(*) over () as n from mechanism_records) select record_no, case when k <= greatest(1, floor(n * 0.03::double)) then 'validation' else 'train' end as split from r")
def head_slice_split(spark, d):
    return P.head_slice(records(spark, d).select("record_no"), "record_no", 0.03)


@query("select row_id, task, case when record_no in (select record_no from mechanism_records where split = 'validation') then 'validation' else 'train' end as split from sft_mechanisms")
def split_route(spark, d):
    rows = table(spark, d, "sft_mechanisms").select("row_id", "task", "record_no", "split")
    return P.route(rows, records(spark, d).filter("split = 'validation'").select("record_no", "split"), "record_no").select("row_id", "task", "split")


@query("select lower(trim(reaction_id)) as id, count(distinct split) as n_splits from mechanism_records group by 1 having count(distinct split) > 1 and lower(trim(reaction_id)) is not null")
def split_leakage(spark, d):
    return P.leaked(records(spark, d).withColumn("id", F.lower(F.trim("reaction_id"))), "id")


#: The gate queries' sources: name, tier, enabled, verdict.
SOURCES = [("oMe-Gold", "A", True, "usable"), ("oMe-Template", "A", True, "usable"), ("oMe-Silver", "A", True, "usable"), ("ORD", "B", True, "usable_for_research_only"), ("USPTO", "B", False, "usable"), ("Wikipedia", "C", True, "unclear")]
_SOURCES = "src(source, tier, enabled, verdict) as (values " + ", ".join(f"('{s}', '{t}', {str(e).lower()}, '{v}')" for s, t, e, v in SOURCES) + ")"


def sources(spark):
    return spark.createDataFrame(SOURCES, "source string, tier string, enabled boolean, verdict string")


@query(f"with {_SOURCES} select source, tier, case when verdict not in ('usable', 'usable_for_research_only') then 'blocked' when not enabled then 'disabled' else 'usable' end as status, (select count(*) from mechanism_records r where r.source = src.source) as n from src")
def license_gate(spark, d):
    n = records(spark, d).groupBy("source").agg(F.count("*").alias("n"))
    return P.license_gate(sources(spark)).join(n, "source", "left").select("source", "tier", "status", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("select split, coalesce(arg_min(license, case license when 'CC-BY-SA-4.0' then 1 when 'CC-BY-4.0' then 2 when 'MIT' then 3 when 'CC0-1.0' then 4 end) , 'other') as license from mechanism_records where license in ('CC-BY-SA-4.0', 'CC-BY-4.0', 'MIT', 'CC0-1.0') group by split")
def license_resolve(spark, d):
    return P.resolve_license(records(spark, d), ["split"], "license", ["CC-BY-SA-4.0", "CC-BY-4.0", "MIT", "CC0-1.0"], "other")


@query(f"with {_SOURCES} select tier, count(*) as n, sum((mechanism_step_nums > 0)::int)::bigint as n_with_mechanism from mechanism_records join src using (source) group by tier")
def tier_totals(spark, d):
    from corpusmill.operators.aggregates import tier_totals as totals

    return totals(records(spark, d), sources(spark), "source", F.coalesce(F.col("mechanism_step_nums") > 0, F.lit(False)))


@query("select provenance, level, grouping(provenance) + 2 * grouping(level) as g, count(*) as n from mechanism_records group by grouping sets ((provenance, level), (provenance), (level), ())")
def provenance_level_cube(spark, d):
    """An extra beyond the inventory: counts by provenance, level and both."""
    return records(spark, d).cube("provenance", "level").agg((F.grouping("provenance").cast("bigint") + 2 * F.grouping("level").cast("bigint")).alias("g"), F.count("*").alias("n"))
