"""DuckDB forms of the queries of problems 1 to 6."""

from __future__ import annotations

_S = lambda c: f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"

_P1 = """
with r as (
  select ds_time_id, ds_source, 'ccy_code' col_name,
    case when ccy_code is null or regexp_full_match(ccy_code, '\\s*') then 'M'
         when regexp_full_match(ccy_code, '[A-Z]{3}') then 'V' || ccy_code else 'X' end cell from ds1_job
  union all
  select ds_time_id, ds_source, 'amount_ind',
    case when amount_ind is null then 'M' when amount_ind in (0, 1, 2) then 'V' || amount_ind else 'X' end from ds1_job
  union all
  select ds_time_id, ds_source, 'cls_bal_lcy',
    case when cls_bal_lcy is null then 'M' when cls_bal_lcy between -1000000000000 and 10000000000000 then 'V' else 'X' end from ds1_job),
c as (select ds_time_id, ds_source, col_name, cell, count(*) n from r group by all),
b as (select ds_time_id, ds_source, col_name, sum(n) n_rows, coalesce(sum(n) filter (cell = 'M'), 0) n_missing,
    coalesce(sum(n) filter (cell = 'X'), 0) n_invalid from c group by all),
m as (select *, median(n_missing / n_rows) over (partition by ds_source, col_name) peer from b),
v as (select *, n / sum(n) over (partition by ds_time_id, ds_source, col_name) own from c where cell like 'V%' and col_name <> 'cls_bal_lcy'),
g as (select ds_source, col_name, cell, k / sum(k) over (partition by ds_source, col_name) pool from (select ds_source, col_name, cell, sum(n) k from v group by all)),
l as (select distinct ds_time_id, ds_source, col_name from v),
d as (select l.ds_time_id, l.ds_source, l.col_name, sum(abs(coalesce(v.own, 0) - g.pool)) / 2 distance
    from l join g using (ds_source, col_name) left join v using (ds_time_id, ds_source, col_name, cell) group by all),
q as (select ds_time_id, ds_source, count(cls_bal_lcy) n_values, count(distinct cls_bal_lcy) n_distinct,
    median(abs(cls_bal_lcy)::double) filter (cls_bal_lcy between -1000000000000 and 10000000000000) med from ds1_job group by all),
p as (select *, median(med) over (partition by ds_source) peer from q)
"""

SQL = {
    "p1_found": _P1
    + """
select ds_time_id, ds_source, col_name, 'missing' issue from m where n_missing / n_rows > peer + 0.10
union all
select ds_time_id, ds_source, col_name, case when col_name = 'cls_bal_lcy' then 'range' else 'pattern' end
  from m where n_invalid > 0.10 * (n_rows - n_missing)
union all
select ds_time_id, ds_source, 'cls_bal_lcy', 'distinct' from p where n_distinct < 0.30 * n_values
union all
select ds_time_id, ds_source, col_name, 'shift' from d where distance > 0.30
union all
select ds_time_id, ds_source, 'cls_bal_lcy', 'shift' from p where med > 5 * peer or med * 5 < peer""",
    "p1_profile": _P1
    + """
select b.*, case when col_name = 'cls_bal_lcy' then n_distinct else -1 end n_distinct,
  case when col_name = 'cls_bal_lcy' then lo else '' end least, case when col_name = 'cls_bal_lcy' then hi else '' end greatest
from (select ds_time_id, ds_source, col_name, n_rows::bigint n_rows, n_missing::bigint n_missing, n_invalid::bigint n_invalid from b) b
join (select ds_time_id, ds_source, count(distinct cls_bal_lcy) n_distinct, min(cls_bal_lcy)::varchar lo, max(cls_bal_lcy)::varchar hi
      from ds1_job group by all) using (ds_time_id, ds_source)""",
    "p2_found": f"""
with s0 as (select * from read_dfs qualify row_number() over (partition by customer_id, src_stm_id, ppn_dt order by ds_load_time desc) = 1),
d as (select src_stm_id, ppn_dt, row_number() over (partition by src_stm_id order by ppn_dt) i,
    lead(ppn_dt) over (partition by src_stm_id order by ppn_dt) nx from (select distinct src_stm_id, ppn_dt from read_dfs)),
s as (select customer_id, src_stm_id, ppn_dt, i, nx, (coalesce(try_cast(trim(fn) as double), -1)::varchar || '|' || coalesce(try_cast(trim(active) as double), -1)::varchar
    || '|' || coalesce({_S("club_member_status")}, '') || '|' || coalesce({_S("fashion_news_frequency")}, '')) a
    from s0 join d using (src_stm_id, ppn_dt) where rec_st is distinct from 0 and (end_dt is null or end_dt > ppn_dt)),
f0 as (select *, case when lag(i) over w = i - 1 and lag(a) over w = a then 0 else 1 end st from s window w as (partition by customer_id, src_stm_id order by i)),
f as (select *, sum(st) over (partition by customer_id, src_stm_id order by i) g from f0),
u0 as (select customer_id, eff_st_dt, case when ds_record_is_deleted = 1 then null else
    coalesce({_S("mnemonic")}, '') || '|' || coalesce({_S("sector_id")}, '') || '|' || coalesce({_S("rm_id")}, '') end a
    from cob_hist_feed qualify row_number() over (partition by customer_id, eff_st_dt order by ds_load_time desc) = 1),
u1 as (select * from u0 window w as (partition by customer_id order by eff_st_dt) qualify row_number() over w = 1 or lag(a) over w is distinct from a),
u as (select *, lead(eff_st_dt) over (partition by customer_id order by eff_st_dt) nx from u1)
select 'read_dfs' tbl, src_stm_id, customer_id, strftime(min(ppn_dt), '%Y-%m-%d') valid_from,
  coalesce(strftime(arg_max_null(nx, i), '%Y-%m-%d'), '3000-11-08') valid_to
from (select customer_id, src_stm_id, g, i, ppn_dt, nx from f) group by customer_id, src_stm_id, g
union all
select 'cob_hist_feed', '', customer_id, strftime(eff_st_dt, '%Y-%m-%d %H:%M:%S'), coalesce(strftime(nx, '%Y-%m-%d %H:%M:%S'), '3000-11-08 00:00:00')
from u where a is not null""",
    "p3_found": "",
    "p3_report": "",
    "p3_composite": """
with j as (select ds_time_id, ds_row_id, nullif(upper(trim(arr_id)), '') a, customer_id c, nullif(upper(trim(pd_id)), '') p from ds1_job),
r as (select distinct upper(trim(arr_id)) a, customer_id c, upper(trim(pd_id)) p from arrangement)
select ds_time_id::bigint ds_time_id, count(*) n_rows from j
where (a is not null or c is not null or p is not null) and not case
  when a is not null and c is not null and p is not null then (a, c, p) in (select (a, c, p) from r where a is not null and c is not null and p is not null)
  when a is not null and c is not null then (a, c) in (select (a, c) from r where a is not null and c is not null)
  when a is not null and p is not null then (a, p) in (select (a, p) from r where a is not null and p is not null)
  when c is not null and p is not null then (c, p) in (select (c, p) from r where c is not null and p is not null)
  when a is not null then a in (select a from r where a is not null)
  when c is not null then c in (select c from r where c is not null)
  else p in (select p from r where p is not null) end
group by 1""",
    "p5_found": f"""
with s0 as (select * from read_dfs qualify row_number() over (partition by customer_id, src_stm_id, ppn_dt order by ds_load_time desc) = 1),
d as (select src_stm_id, ppn_dt, row_number() over (partition by src_stm_id order by ppn_dt) i,
    lead(ppn_dt) over (partition by src_stm_id order by ppn_dt) nx from (select distinct src_stm_id, ppn_dt from read_dfs)),
s as (select customer_id, src_stm_id, ppn_dt, i, nx, try_cast(trim(fn) as double) fn, try_cast(trim(active) as double) active,
    {_S("club_member_status")} club, {_S("fashion_news_frequency")} news
    from s0 join d using (src_stm_id, ppn_dt) where rec_st is distinct from 0 and (end_dt is null or end_dt > ppn_dt)),
o as (select n.*, p.customer_id is not null held, p.fn fn0, p.active active0, p.club club0, p.news news0
    from s n left join s p on p.customer_id = n.customer_id and p.src_stm_id = n.src_stm_id and p.i = n.i - 1)
select src_stm_id, customer_id, strftime(ppn_dt, '%Y-%m-%d') ppn_dt, 'new' status, '' diff_key from o where not held and i > 1
union all
select a.src_stm_id, a.customer_id, strftime(a.nx, '%Y-%m-%d'), 'deleted', '' from s a
  where nx is not null and not exists (select 1 from s b where b.customer_id = a.customer_id and b.src_stm_id = a.src_stm_id and b.i = a.i + 1)
union all select src_stm_id, customer_id, strftime(ppn_dt, '%Y-%m-%d'), 'updated', 'fn' from o where held and fn is distinct from fn0
union all select src_stm_id, customer_id, strftime(ppn_dt, '%Y-%m-%d'), 'updated', 'active' from o where held and active is distinct from active0
union all select src_stm_id, customer_id, strftime(ppn_dt, '%Y-%m-%d'), 'updated', 'club_member_status' from o where held and club is distinct from club0
union all select src_stm_id, customer_id, strftime(ppn_dt, '%Y-%m-%d'), 'updated', 'fashion_news_frequency' from o where held and news is distinct from news0""",
}

_P3 = " union all ".join(
    f"""select '{t}' ref_table, ds_time_id::bigint ds_time_id, ds_row_id, case when p.k is null then 'missing'
  when strftime(p.insert_date, '%Y%m%d')::bigint > ds_time_id then 'late'
  when p.rec_status = 0 and strftime(p.update_date, '%Y%m%d')::bigint <= ds_time_id then 'deleted' end ref_reason
from (select ds_time_id, ds_row_id, nullif(upper(regexp_replace({k}::varchar, '^\\s+|\\s+$', '', 'g')), '') k from ds1_job) j
left join (select distinct upper(trim({k}::varchar)) k, insert_date, update_date, rec_status from {t}) p on p.k = j.k where j.k is not null"""
    for t, k in (("customers", "customer_id"), ("arrangement", "arr_id"), ("product_tree", "pd_id"))
)
SQL["p3_found"] = f"select * from ({_P3}) where ref_reason is not null"
SQL["p3_report"] = f"select ref_table, ds_time_id, ref_reason, count(*) n_rows from ({_P3}) where ref_reason is not null group by all"

_P4 = """
with c as (select distinct on (change_id) *, lower(trim(cdc_type)) op, list_transform(cdc_fields, lambda x: lower(trim(x))) named from cdc_feed),
e as (select *, coalesce(ds_record_is_deleted = 1 or op in ('cdc_delete', 'delete'), false) del,
    coalesce(op in ('cdc_insert', 'insert', 'load', 't24_1tm'), false) ins, coalesce(op in ('cdc_update', 'update'), false) upd from c),
k as (select ld_id, pos, sub_pos, arg_max(not del, (commit_ts, ds_cdc_index)) live from e where del or ins group by all),
f as (select e.*, u.field_name, case u.field_name when 'from_date' then from_date when 'to_date' then to_date
    when 'repayment_rate' then repayment_rate else repayment_type end val
    from e, (values ('from_date'), ('to_date'), ('repayment_rate'), ('repayment_type')) u(field_name)
    where not del and (ins or (upd and (named is null or len(named) = 0 or list_contains(named, u.field_name))))),
l as (select * from f join k using (ld_id, pos, sub_pos) where live
    qualify row_number() over (partition by ld_id, pos, sub_pos, field_name order by commit_ts desc, ds_cdc_index desc) = 1)
select ld_id, pos::varchar || '.' || sub_pos::varchar rec_position, field_name, """
SQL["p4_found"] = _P4 + "change_id from l"
SQL["p4_state"] = _P4 + "coalesce(val, '') as value from l"

_LISTS = """
  select 'ds1_job' parent_table, ds_row_id parent_id, 'info_detail.' || e.key elem_path, p::int elem_pos, e.value elem_text
  from (select ds_row_id, p - 1 p, unnest(map_entries(info_detail[p])) e from (select ds_row_id, info_detail, unnest(range(1, len(info_detail) + 1)) p from ds1_job))
  union all
  select 'moviedata', rec_id, path, (p - 1)::int, v[p] from (select rec_id, path, v, unnest(range(1, len(v) + 1)) p from (
    select rec_id, 'info.actors' path, info.actors v from moviedata union all select rec_id, 'info.genres', info.genres from moviedata
    union all
    select rec_id, 'info.' || f, case json_type(x) when 'VARCHAR' then [x ->> '$'] when 'ARRAY' then
      list_transform(json_extract(x, '$[*]'), lambda y: case json_type(y) when 'OBJECT' then y ->> '$.name' when 'NULL' then null else y ->> '$' end) end
    from (select rec_id, f, json_extract(r, '$.' || f) x from (
      select rec_id, case when json_type(info_json, '$.info') = 'OBJECT' then json_extract(info_json, '$.info') else info_json::json end r
      from moviedata where info is null and info_json is not null and json_valid(info_json)), (values ('actors'), ('genres')) t(f))))"""
SQL["p6_found"] = f"select * replace (regexp_replace(elem_text, '^\\s+|\\s+$', '', 'g') as elem_text) from ({_LISTS}) where regexp_replace(elem_text, '\\s', '', 'g') <> ''"

#: As _LISTS, with the kind of every element; an object counts by its name, if that is no object or list itself.
_TYPED = """
  select 'ds1_job' parent_table, ds_row_id parent_id, 'info_detail.' || e.key elem_path, e.value elem_text, 'entry' subtype
  from (select ds_row_id, unnest(map_entries(m)) e from (select ds_row_id, unnest(info_detail) m from ds1_job))
  union all
  select 'moviedata', rec_id, path, v, 'text' from (select rec_id, 'info.actors' path, unnest(info.actors) v from moviedata
    union all select rec_id, 'info.genres', unnest(info.genres) from moviedata)
  union all
  select 'moviedata', rec_id, path, case json_type(y) when 'OBJECT' then y ->> '$.name' else y ->> '$' end,
    case json_type(y) when 'VARCHAR' then 'text' when 'OBJECT' then 'named' else 'scalar' end
  from (select rec_id, 'info.' || f path, unnest(case json_type(x) when 'ARRAY' then json_extract(x, '$[*]') else [x] end) y
    from (select rec_id, f, json_extract(r, '$.' || f) x from (
      select rec_id, case when json_type(info_json, '$.info') = 'OBJECT' then json_extract(info_json, '$.info') else info_json::json end r
      from moviedata where info is null and info_json is not null and json_valid(info_json)), (values ('actors'), ('genres')) t(f)))
  where json_type(y) not in ('NULL', 'ARRAY') and (json_type(y) <> 'OBJECT' or json_type(y, '$.name') not in ('NULL', 'OBJECT', 'ARRAY'))"""
SQL["p6_subtypes"] = f"""select parent_table, elem_path, subtype, count(*) n_rows, count(distinct parent_id) n_parents from ({_TYPED})
  where regexp_replace(elem_text, '\\s', '', 'g') <> '' group by all"""
SQL["p6_named"] = """select 'moviedata' parent_table, rec_id parent_id, path elem_path, (p - 1)::int elem_pos, regexp_replace(y ->> '$.name', '^\\s+|\\s+$', '', 'g') as "name",
    (len(json_keys(y)) - 1)::int n_fields
  from (select rec_id, path, v[p] y, p from (select rec_id, path, v, unnest(range(1, len(v) + 1)) p from (
    select rec_id, 'info.' || f path, case json_type(x) when 'ARRAY' then json_extract(x, '$[*]') else [x] end v
    from (select rec_id, f, json_extract(r, '$.' || f) x from (
      select rec_id, case when json_type(info_json, '$.info') = 'OBJECT' then json_extract(info_json, '$.info') else info_json::json end r
      from moviedata where info is null and info_json is not null and json_valid(info_json)), (values ('actors'), ('genres')) t(f)))))
  where json_type(y) = 'OBJECT' and json_type(y, '$.name') not in ('NULL', 'OBJECT', 'ARRAY')"""
