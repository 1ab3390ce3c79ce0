"""SQL that DuckDB runs on the same tables, for the queries that SQL can express on whole tables."""


def _category(column: str) -> str:
    key = rf"regexp_replace(regexp_replace(lower({column}), '^\s*[a-z]+\s*:\s*', ''), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    key = f"case when {key} = 'med' then 'medium' else {key} end" if column.endswith("level") else key
    return f"case when {key} not in ('', 'none', 'null', 'na', 'nan', 'unknown', 'und', 'unspecified', 'tbd') then {key} end"


_QUOTAS = f"""
with r as (select record_no, {_category("level")} as l, {_category("subtype")} as s from mechanism_records),
t as (select *, {_category("level")} as tl, {_category("subtype")} as ts from sample_targets),
m as (select t.target_id, t.request_id, r.record_no from t join r on (t.level is null or t.tl = r.l) and (t.subtype is null or t.ts = r.s)),
h as (select target_id, count(*) as have from m group by 1),
q as (
  select t.target_id, t.request_id, t.target_permille, n * t.sample_permille // 1000 as size, coalesce(have, 0) as have,
    greatest(coalesce(min_rows, 0), (n * t.sample_permille // 1000 * t.target_permille + 999) // 1000) as need
  from t left join h using (target_id) cross join (select count(*) as n from mechanism_records)
)
"""

_TIDY = r"trim(regexp_replace(lower({0}), '[\s_\-‐-―]+', ' ', 'g'))"
_NUMBER = r"regexp_extract(x, '0*(\d+)$', 1)"
_GROUPS = rf"""
with recursive recs as (select record_no, min(reaction_id) as rid from mechanism_records group by 1),
ids as (select s.row_id, case when coalesce(trim(s.reaction_id), '') = '' then r.rid else s.reaction_id end as id from sft_mechanisms s left join recs r using (record_no)),
t as (select row_id, regexp_replace(regexp_replace(lower(trim(id, e' \t\r\n')), '^v\d+:\s*', ''), '((__|#)[a-z]+\d+)+\s*$', '') as x from ids),
h as (select row_id, x, regexp_extract(x, '^(.*?)(_\d+-|$)', 1) as head from t),
p as (select row_id, x, list_transform(regexp_extract_all(head, '(^|[^a-z])(n[rg][^a-z0-9]*\d+)', 2), lambda x: upper(substr(x, 1, 2)) || '-' || {_NUMBER}) as nr,
  list_transform(regexp_extract_all(x, '(^|[^a-z])((ds|dataset)[^a-z0-9]?\d+)', 2), lambda x: 'ds' || lpad({_NUMBER}, 6, '0')) as ds,
  list_transform(regexp_extract_all(x, '(^|[^a-z])(p[^a-z0-9]?\d+)', 2), lambda x: 'P' || lpad({_NUMBER}, 7, '0')) as pt from h),
n as (select row_id, case when x like 'wiki%' then ['~wiki ' || {_TIDY.format("url_decode(regexp_replace(x, '^wiki[^a-z0-9%]*', ''))")}] when len(nr) > 0 then nr else list_concat(ds, pt) end as names from p),
old as (select alias from template_aliases where alias not in (select base from templates)),
raw as (select distinct names[1] as a, unnest(names[2:]) as b from n where len(names) > 1
  union select '~wiki ' || {_TIDY.format("name")}, base from templates union select alias, base from template_aliases),
shown as (select case when a in (select alias from old) then '~' || a else a end as a, case when b in (select alias from old) then '~' || b else b end as b from raw where a <> b),
links as (select a, b from shown union select b, a from shown),
reach as (select a as node, a as other from links union select r.node, l.b from reach r join links l on r.other = l.a),
comp as (select regexp_replace(node, '^~(N)', '\1') as node, min(other) as component from reach group by 1)
"""

SQL: dict[str, str] = {
    "p2_found": _GROUPS + "select row_id, coalesce(regexp_replace(coalesce(component, names[1]), '^~(wiki )?', ''), 'row ' || row_id::varchar) as group_key from n left join comp on names[1] = node",
    "p4_found": _QUOTAS + "select target_id from q where have < need",
    "p4_sample": _QUOTAS
    + """
, ranked as (select m.*, row_number() over (partition by target_id order by md5(concat(request_id::varchar, '|', record_no::varchar)), record_no) as k from m)
select ranked.request_id, ranked.target_id, record_no from ranked join q using (target_id) where k <= least(have, need)""",
    "p4_report": _QUOTAS
    + """
select target_id, request_id, size, need, have, least(need, have) as taken, have >= need as met, target_permille / 1000.0::double as wanted_share,
  round(least(need, have) / nullif(sum(least(need, have)) over (partition by request_id), 0)::double, 6) as actual_share
from q""",
}
