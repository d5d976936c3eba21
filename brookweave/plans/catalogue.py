"""Queries of the library's general operators over the star-schema tables, each beside its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.functions import dates
from brookweave.functions.ids import uuid5
from brookweave.operators import casting as C
from brookweave.operators import dedupe as D
from brookweave.operators import joins as J
from brookweave.operators import jobs as G
from brookweave.operators import masking as Q
from brookweave.operators import merge as M
from brookweave.operators import projections as P
from brookweave.operators import reshaping as N
from brookweave.operators import textual as X
from brookweave.operators import validations as V
from brookweave.registry import run_pipeline
from brookweave.session import scratch, table
from brookweave.sources import readers, sinks
from brookweave.sources.tables import VersionedTable
from brookweave.streaming import microbatch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DAY = "2022-04-24"
OPEN = "3000-11-08"
SECRET = "a key for tests only"


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def texts(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text, so that both engines give the same values."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal"):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- sources and partitions ------------------------------------------------------------------------------------------


@query("scan_parquet", "select o_orderkey, o_custkey, o_orderstatus from orders where o_orderpriority = '1-URGENT'")
def _(s, d):
    spec = readers.Input("raw", uri_list=[f"{d}/orders.parquet"], serde=readers.Serde("PARQUET"))
    return readers.read(s, spec).where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("csv_roundtrip", "select c_custkey, c_name, c_nationkey, c_mktsegment from customer")
def _(s, d):
    path = scratch(s, "csv")
    sinks.write_files(table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), path, "overwrite", fmt="csv")
    schema = [{"name": "c_custkey", "type": "bigint"}, {"name": "c_name"}, {"name": "c_nationkey", "type": "int"}, {"name": "c_mktsegment"}]
    return readers.read(s, readers.Input("raw", uri_list=[path], serde=readers.Serde("CSV"), schema=schema))


@query("json_roundtrip", "select n_nationkey::bigint n_nationkey, n_name from nation")
def _(s, d):
    path = scratch(s, "json")
    table(s, d, "nation").select("n_nationkey", "n_name").write.json(path)
    return readers.read(s, readers.Input("raw", uri_list=[path], serde=readers.Serde("JSON"))).select("n_nationkey", "n_name")


def _events(s, d):
    return table(s, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


@query("partition_predicate_range", "select event_id, strftime(ts, '%Y-%m-%d') as day from events where strftime(ts, '%Y-%m-%d') between '2024-01-08' and '2024-01-12'")
def _(s, d):
    p = readers.Partition("day", data_date=["2024-01-10", "2024-01-12"], data_date_type="range", extend_range=2)
    return readers.in_partitions(_events(s, d), p).select("event_id", "day")


@query("partition_predicate_list", "select event_id, strftime(ts, '%Y-%m-%d') as day from events where strftime(ts, '%Y-%m-%d') in ('2024-01-03', '2024-01-20')")
def _(s, d):
    p = readers.Partition("day", data_date=["2024-01-03", "2024-01-20"], data_date_type="list")
    return readers.in_partitions(_events(s, d), p).select("event_id", "day")


@query("nearest_partition", """select event_id, strftime(ts, '%Y-%m-%d') as day from events where strftime(ts, '%Y-%m-%d') =
  (select max(strftime(ts, '%Y-%m-%d')) from events where strftime(ts, '%Y-%m-%d') between '2024-01-25' and '2024-02-24')""")
def _(s, d):
    p = readers.Partition("day", data_date="2024-02-24", max_offset=30)
    return readers.in_partitions(_events(s, d), p).select("event_id", "day")


@query("partition_overwrite", """select o_orderkey, year(o_orderdate)::int as y, case when year(o_orderdate) = 1996 then 'new' else 'old' end as tag
  from orders where year(o_orderdate) <> 1996 or o_orderkey % 2 = 0""")
def _(s, d):
    path = scratch(s, "overwrite")
    rows = table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    sinks.write_files(rows.withColumn("tag", F.lit("old")), path, "overwrite", ["y"])
    sinks.write_files(rows.where("y = 1996 and o_orderkey % 2 = 0").withColumn("tag", F.lit("new")), path, "overwrite_partition", ["y"])
    return s.read.parquet(path).select("o_orderkey", F.col("y").cast("int").alias("y"), "tag")


@query("sql_source", "select n.n_name, count(*) as n from customer c join nation n on c.c_nationkey = n.n_nationkey group by 1")
def _(s, d):
    table(s, d, "customer").createOrReplaceTempView("bw_customer")
    table(s, d, "nation").createOrReplaceTempView("bw_nation")
    return readers.read(s, readers.Input("spark_sql", query="select n.n_name, count(*) as n from bw_customer c join bw_nation n on c.c_nationkey = n.n_nationkey group by 1"))


# --- dimensions ------------------------------------------------------------------------------------------------------

_DIM = "c_custkey, c_name, c_nationkey, (c_acctbal::decimal(18,2)) as c_acctbal, c_mktsegment"
_S2 = f"""with t as (select {_DIM}, case when c_custkey % 3 = 0 then 'CRM' else 'CUS' end as src from customer),
s as (select c_custkey, c_name, c_nationkey, c_acctbal + case when c_custkey % 10 = 0 then 1 else 0 end as c_acctbal, c_mktsegment, src from t where c_custkey % 17 <> 0
  union all select c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment, src from t where c_custkey % 25 = 0),
j as (select t.*, s.c_custkey is null as gone, s.c_acctbal is distinct from t.c_acctbal as changed from t left join s on s.c_custkey = t.c_custkey and s.src = t.src)"""


def scd2_target(s, d):
    return table(s, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), "c_mktsegment",
        F.when(F.col("c_custkey") % 3 == 0, "CRM").otherwise("CUS").alias("src"),
        F.lit("2022-01-01").cast("date").alias("eff_dt"), F.lit(OPEN).cast("date").alias("end_dt"),
        F.lit(1).alias("rec_st"), F.lit("2022-01-01").cast("date").alias("ppn_dt"),
    )


def scd2_snapshot(s, d):
    t = scd2_target(s, d).drop(*M.TECHNICAL)
    up = F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0)
    kept = t.where("c_custkey % 17 <> 0").withColumn("c_acctbal", (F.col("c_acctbal") + up).cast("decimal(18,2)"))
    return kept.unionByName(t.where("c_custkey % 25 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000)).withColumn("eff_dt", F.lit(DAY).cast("date"))


_S2_OUT = "c_custkey, c_name, c_nationkey, c_acctbal::varchar as c_acctbal, c_mktsegment, src"
_S2_SQL = f"""{_S2}
select {_S2_OUT}, '2022-01-01' as eff_dt, case when gone or changed then '{DAY}' else '{OPEN}' end as end_dt,
  case when gone or changed then 0 else 1 end as rec_st, case when gone or changed then '{DAY}' else '2022-01-01' end as ppn_dt from j
union all
select {_S2_OUT}, '{DAY}', '{OPEN}', 1, '{DAY}' from s where (c_custkey, src) not in (select (c_custkey, src) from j where not gone and not changed)"""


@query("scd2_merge", _S2_SQL)
def scd2_merge(s, d):
    return texts(M.scd2_merge(scd2_target(s, d), scd2_snapshot(s, d), ["c_custkey", "src"], DAY))


@query("scd2_rerun_idempotent", _S2_SQL)
def _(s, d):
    once = M.scd2_merge(scd2_target(s, d), scd2_snapshot(s, d), ["c_custkey", "src"], DAY)
    return texts(M.scd2_merge(once, scd2_snapshot(s, d), ["c_custkey", "src"], DAY))


@query("table_versions", _S2_SQL)
def _(s, d):
    t = VersionedTable(s, scratch(s, "table"))
    t.merge(scd2_target(s, d), "scd2")
    t.merge(scd2_snapshot(s, d), "scd2", keys=["c_custkey", "src"], date=DAY)
    t.merge(scd2_snapshot(s, d), "scd2", keys=["c_custkey", "src"], date=DAY)
    return texts(t.read())


@query("fact_periodic", """select o_orderkey, year(o_orderdate)::int as y, case when year(o_orderdate) = 1997 then 'new' else 'old' end as tag
  from orders where year(o_orderdate) <> 1997 or o_orderkey % 3 = 0""")
def _(s, d):
    rows = table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    t = VersionedTable(s, scratch(s, "table"))
    t.merge(rows.withColumn("tag", F.lit("old")), "fact_periodic")
    t.merge(rows.where("y = 1997 and o_orderkey % 3 = 0").withColumn("tag", F.lit("new")), "fact_periodic", partition="y")
    return t.read()


@query("scd2_merge_src_scoped", f"""{_S2}
select {_S2_OUT}, '2022-01-01' as eff_dt, case when src = 'CUS' and (gone or changed) then '{DAY}' else '{OPEN}' end as end_dt,
  case when src = 'CUS' and (gone or changed) then 0 else 1 end as rec_st, case when src = 'CUS' and (gone or changed) then '{DAY}' else '2022-01-01' end as ppn_dt from j
union all
select {_S2_OUT}, '{DAY}', '{OPEN}', 1, '{DAY}' from s where src = 'CUS' and (c_custkey, src) not in (select (c_custkey, src) from j where not gone and not changed)""")
def _(s, d):
    return texts(M.scd2_merge(scd2_target(s, d), scd2_snapshot(s, d).where("src = 'CUS'"), ["c_custkey", "src"], DAY, sources=["src"]))


@query("scd2_statuses", f"{_S2} select case when gone then 'deleted' when changed then 'updated' else 'unchanged' end as status, count(*) as n from j group by 1")
def _(s, d):
    rows = M.scd2_statuses(scd2_target(s, d), scd2_snapshot(s, d), ["c_custkey", "src"], DAY)
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("scd2_dedup_hash", """with e as (select *, lag(event_type) over (partition by user_id order by ts, event_id) as p from events)
select event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') as created from e where p is null or p <> event_type""")
def _(s, d):
    e = table(s, d, "events").select("event_id", "user_id", "event_type", F.struct("ts", "event_id").alias("at"))
    out = D.scd2_dedup_by_hash(e, "event_type", "at", "created", ["user_id"])
    return texts(out.withColumn("created", F.col("created.ts")))


@query("scd2_fill_updated", """select event_id, user_id, strftime(coalesce(lead(ts) over (partition by user_id order by ts, event_id),
  timestamp '3000-11-07 17:00:00'), '%Y-%m-%d %H:%M:%S') as updated from events""")
def _(s, d):
    e = table(s, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("created"))
    filled = D.scd2_fill_updated_time(e, ["user_id"], "created", "updated")
    return texts(filled.select("event_id", "user_id", "updated"))


@query("scd2_fill_status", """with e as (select event_id, lead(ts) over (partition by user_id order by ts) as nx from (select user_id, ts, min(event_id) as event_id from events group by 1, 2))
select event_id, case when nx is null then 1 else 0 end as status from e""")
def _(s, d):
    e = table(s, d, "events").groupBy("user_id", F.col("ts").cast("timestamp").alias("ts")).agg(F.min("event_id").alias("event_id"))
    return D.scd2_fill_status(D.scd2_fill_updated_time(e, ["user_id"], "ts", "updated"), "status", "updated").select("event_id", "status")


@query("scd2_asof", """select user_id, event_id from (select *, lead(ts) over (partition by user_id order by ts, event_id) as nx from events)
  where ts::date <= date '2024-01-15' and coalesce(nx::date, date '3000-11-08') > date '2024-01-15'
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def _(s, d):
    w = D.Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(s, d, "events").select("user_id", "event_id", "ts", F.coalesce(F.lead("ts").over(w), F.lit("3000-11-08").cast("timestamp_ntz")).alias("nx"))
    return D.latest_as_of(e, ["user_id"], "ts", "nx", "2024-01-15").select("user_id", "event_id")


@query("scd2_snapshot", f"select {_DIM.replace('(c_acctbal::decimal(18,2))', '(c_acctbal::decimal(18,2))::varchar')}, case when c_custkey % 3 = 0 then 'CRM' else 'CUS' end as src, '2022-04-23' as ds_process_date from customer")
def _(s, d):
    return texts(D.scd2_to_snapshot(scd2_target(s, d), M.TECHNICAL, "2022-04-23"))


@query("cdc_scd2_columns", """select event_id, strftime(coalesce(case when event_id % 3 = 0 then null else ts end, ts + interval 1 day), '%Y-%m-%d %H:%M:%S') as created,
  -1 as ds_cdc_index, 'CDC_UPDATE' as ds_record_change_type from events""")
def _(s, d):
    far = F.lit("9999-12-31 00:00:00")
    e = table(s, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, far).otherwise(F.col("ts").cast("string")).alias("a"),
        (F.col("ts") + F.expr("interval 1 day")).cast("string").alias("b"),
    )
    return texts(D.cdc_to_scd2_columns(e, ["a", "b"], created_field="created").drop("a", "b"))


@query("scd_identifiers", """with e as (select event_id, strftime(ts, '%Y-%m-%d') = '2024-01-10' as new, event_type = 'error' as gone, event_id % 4 = 0 as changed from events)
select event_id, 'CDC_INSERT' as change_type, 1 as cdc_index from e where new
union all select event_id, 'CDC_DELETE', case when new then 2 else 1 end from e where gone
union all select event_id, 'CDC_UPDATE', 1 from e where not new and not gone and changed""")
def _(s, d):
    e = table(s, d, "events").select(
        "event_id", F.col("ts").alias("created"), F.when(F.col("event_id") % 4 == 0, F.lit("2024-01-10").cast("date")).alias("updated"),
        (F.col("event_type") == "error").alias("gone"),
    )
    out = D.add_scd_identifiers(e, "created", "updated", "gone", "2024-01-10")
    return out.select("event_id", F.col("ds_record_change_type").alias("change_type"), F.col("ds_cdc_index").alias("cdc_index"))


_S4 = f"""with t as (select {_DIM}, case when c_custkey % 7 = 0 then 0 else 1 end as rec_st from customer),
s as (select c_custkey, c_name, c_nationkey, c_acctbal + case when c_custkey % 10 = 0 then 1 else 0 end as c_acctbal, c_mktsegment from t where c_custkey % 17 <> 0
  union all select c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment from t where c_custkey % 25 = 0)"""


@query("scd4_current", f"""{_S4}
select coalesce(t.c_custkey, s.c_custkey) as c_custkey, coalesce(s.c_acctbal, t.c_acctbal)::varchar as c_acctbal,
  case when s.c_custkey is null then 0 else 1 end as rec_st,
  case when (s.c_custkey is null and t.rec_st = 1) or (s.c_custkey is not null and (t.c_custkey is null or t.rec_st = 0 or s.c_acctbal <> t.c_acctbal)) then '{DAY}' else '2022-01-01' end as ppn_dt
from t full join s on t.c_custkey = s.c_custkey""")
def _(s, d):
    t = scd2_target(s, d).drop("src", "eff_dt", "end_dt").withColumn("rec_st", F.when(F.col("c_custkey") % 7 == 0, 0).otherwise(1))
    return texts(M.scd4_current(t, scd2_snapshot(s, d).drop("src", "eff_dt"), ["c_custkey"], DAY).select("c_custkey", "c_acctbal", "rec_st", "ppn_dt"))


@query("scd4_base_upsert", """with s as (select c_custkey + case when c_custkey % 3 = 0 then 1000000 else 0 end as k, c_name || '!' as c_name, c_custkey % 5 = 0 as dead from customer where c_custkey % 2 = 0)
select coalesce(c.c_custkey, s.k) as c_custkey, case when s.k is not null and not s.dead then s.c_name else c.c_name end as c_name,
  case when c.c_custkey is null then '2022-04-24 10:00:00' else '2022-01-01 00:00:00' end as insert_date,
  case when c.c_custkey is not null and s.k is not null and not s.dead then '2022-04-24 10:00:00' else '' end as update_date,
  case when c.c_custkey is not null and s.dead then 0 else 1 end as rec_status
from customer c full join s on c.c_custkey = s.k where c.c_custkey is not null or not s.dead""")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_name")
    t = c.withColumns({"insert_date": F.lit("2022-01-01").cast("timestamp"), "update_date": F.lit(None).cast("timestamp"), "rec_status": F.lit(1)})
    src = c.where("c_custkey % 2 = 0").select(
        (F.col("c_custkey") + F.when(F.col("c_custkey") % 3 == 0, 1000000).otherwise(0)).alias("c_custkey"), F.concat("c_name", F.lit("!")).alias("c_name"),
        (F.col("c_custkey") % 5 == 0).cast("int").alias("ds_record_is_deleted"),
    )
    return texts(M.scd4_base_upsert(t, src, ["c_custkey"], "2022-04-24 10:00:00")).fillna("", ["update_date"])


@query("scd4_history", """with r as (select o_custkey, o_orderdate, max(o_orderkey) as k from orders group by 1, 2),
l as (select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as nx from r)
select o_custkey, strftime(o_orderdate, '%Y-%m-%d') as eff_st_dt, k, coalesce(strftime(nx, '%Y-%m-%d'), '') as eff_end_dt, case when nx is null then 1 else 0 end as rec_status from l""")
def _(s, d):
    o = table(s, d, "orders").groupBy("o_custkey", F.col("o_orderdate").alias("eff_st_dt")).agg(F.max("o_orderkey").alias("k"))
    old = o.where("year(eff_st_dt) < 1999")
    w = D.Window.partitionBy("o_custkey").orderBy("eff_st_dt")
    old = old.withColumn("eff_end_dt", F.lead("eff_st_dt").over(w)).withColumn("rec_status", F.col("eff_end_dt").isNull().cast("int"))
    out = M.scd4_history(old, o.where("year(eff_st_dt) >= 1999"), ["o_custkey"])
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("")).alias(c)
    return out.select("o_custkey", day("eff_st_dt"), "k", day("eff_end_dt"), "rec_status")


@query("scd4_close", """select c_custkey, case when c_custkey % 4 = 0 then '2022-04-24 00:00:00' else '' end as eff_end_dt, case when c_custkey % 4 = 0 then 0 else 1 end as rec_status from customer""")
def _(s, d):
    t = table(s, d, "customer").select("c_custkey", F.lit("2022-01-01").cast("timestamp").alias("eff_st_dt"), F.lit(None).cast("timestamp").alias("eff_end_dt"), F.lit(1).alias("rec_status"))
    gone = t.where("c_custkey % 4 = 0").select("c_custkey", F.lit(DAY).cast("timestamp").alias("at"))
    return texts(M.scd4_close(t, gone, ["c_custkey"], "at").drop("eff_st_dt")).fillna("", ["eff_end_dt"])


# --- facts -----------------------------------------------------------------------------------------------------------


@query("fact_dedup", """with s as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as m, o_totalprice::decimal(18,2) + 1 as p from orders where o_orderkey % 4 = 0 and year(o_orderdate) = 1997)
select * replace (p::varchar as p) from s union all
select o_orderkey, strftime(o_orderdate, '%Y-%m'), (o_totalprice::decimal(18,2))::varchar from orders
where strftime(o_orderdate, '%Y-%m') in (select m from s) and o_orderkey not in (select o_orderkey from s)""")
def _(s, d):
    t = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    src = t.where("o_orderkey % 4 = 0 and m like '1997%'").withColumn("p", (F.col("p") + 1).cast("decimal(18,2)"))
    return texts(M.fact_dedup(t, src.unionByName(src), ["o_orderkey"], "m"))


@query("fact_latest_wins", """with r as (select user_id, event_type, ts, event_id, case when event_id % 3 = 0 then 'DWH_1TM' when event_id % 3 = 1 then 'T24_1TM' else 'CDC_UPDATE' end as kind from events)
select user_id, event_type, event_id, kind from r qualify row_number() over (partition by user_id, event_type
  order by ts::date desc, case kind when 'DWH_1TM' then 1 when 'T24_1TM' then 2 else 3 end desc, event_id desc) = 1""")
def _(s, d):
    kind = F.when(F.col("event_id") % 3 == 0, "DWH_1TM").when(F.col("event_id") % 3 == 1, "T24_1TM").otherwise("CDC_UPDATE")
    e = table(s, d, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), kind.alias("ds_record_change_type"))
    out = M.fact_latest(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id", "event_type"], "day")
    return out.select("user_id", "event_type", "event_id", F.col("ds_record_change_type").alias("kind"))


_CM = """with t as (select c_custkey as k, c_name as v, case when c_custkey % 6 = 0 then null else c_mktsegment end as w, '2022-01-01' as ins from customer where c_custkey % 5 <> 0),
s as (select c_custkey as k, upper(c_name) as v, case when c_custkey % 4 = 0 then null else 'S' end as w, '2022-04-24' as ins from customer where c_custkey % 2 = 0)"""


def _change(s, d):
    c = table(s, d, "customer")
    seg = F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment"))
    t = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), seg.alias("w"), F.lit("2022-01-01").alias("ins"))
    flag = F.when(F.col("c_custkey") % 4 != 0, "S")
    src = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.upper("c_name").alias("v"), flag.alias("w"), F.lit("2022-04-24").alias("ins"))
    return t, src


@query("change_merge_3way", _CM + """ select coalesce(s.k, t.k) as k, case when s.k is not null then s.v else t.v end as v,
  coalesce(case when s.k is not null then s.w else t.w end, '') as w, case when t.k is not null then t.ins else s.ins end as ins from t full join s on t.k = s.k""")
def _(s, d):
    return M.change_merge(*_change(s, d), ["k"], "ins").fillna("", ["w"])


@query("change_merge_full_outer", _CM + """ select coalesce(s.k, t.k) as k, coalesce(s.v, t.v) as v, coalesce(s.w, t.w, '') as w, coalesce(t.ins, s.ins) as ins from t full join s on t.k = s.k""")
def _(s, d):
    return M.change_merge_coalesce(*_change(s, d), ["k"], "ins").fillna("", ["w"])


@query("keyed_replace", """select c_custkey, case when c_custkey % 9 = 0 then 'X' else c_mktsegment end as c_mktsegment from customer""")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    return M.keyed_replace(c, c.where("c_custkey % 9 = 0").withColumn("c_mktsegment", F.lit("X")), ["c_custkey"])


# --- windows, duplicates, joins --------------------------------------------------------------------------------------


@query("max_row_per_group", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def _(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return D.get_row_with_max_value_for_each_group(o, ["o_custkey"], ["o_orderdate"]).select("o_custkey", "o_orderkey")


@query("drop_dup_pk", "select user_id, event_type, event_id from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def _(s, d):
    e = table(s, d, "events").select("user_id", "event_type", "ts", "event_id")
    return D.drop_duplicate_primarykey_order_by(e, ["user_id", "event_type"], "ts").drop("ts")


@query("distinct_rows", "select distinct l_returnflag, l_linestatus, l_quantity::int as q from lineitem")
def _(s, d):
    return D.distinct(table(s, d, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("q")))


@query("unique_ids_only", "select l_orderkey, l_partkey from lineitem qualify count(*) over (partition by l_partkey, l_suppkey) = 1 and count(*) over (partition by l_partkey * 1000000 + l_suppkey) = 1")
def _(s, d):
    rows = table(s, d, "lineitem").withColumn("pair_id", F.col("l_partkey") * 1000000 + F.col("l_suppkey"))
    return V.remove_duplicate_customer_id(rows, ["pair_id"]).select("l_orderkey", "l_partkey")


@query("union_golden", """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as process_date from orders where o_orderkey % 2 = 0
  union all select o_orderkey, 'golden' from orders where o_orderkey % 2 = 1""")
def _(s, d):
    o = table(s, d, "orders")
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("process_date"))
    old = o.where("o_orderkey % 2 = 1").select("o_orderkey", F.lit("golden").alias("ds_partition_date"), F.lit(1).alias("ds_cdc_index"))
    return J.union_with_golden_if_existed(new, {"orders": old}, "orders", ["ds_cdc_index"])


@query("left_join_golden", """select c.c_custkey, c.c_nationkey, coalesce(n.n_name, '') as n_name from (select c_custkey, c_nationkey + 5 as c_nationkey from customer) c left join nation n on c.c_nationkey = n.n_nationkey""")
def _(s, d):
    n = table(s, d, "nation").select("n_nationkey", "n_name", F.lit(1).alias("c_custkey"))
    c = table(s, d, "customer").select("c_custkey", (F.col("c_nationkey") + 5).alias("c_nationkey"))
    out = J.left_join_with_golden_if_existed(c, {"nation": n.unionByName(n)}, "nation", ["c_nationkey"], ["n_nationkey"], ["n_nationkey", "n_name"], ["n_nationkey"])
    return out.drop("n_nationkey").fillna("", ["n_name"])


@query("missing_keys", "select distinct l_partkey from lineitem where l_partkey not in (select p_partkey from part where p_size > 25)")
def _(s, d):
    part = table(s, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    return J.missing_keys(table(s, d, "lineitem"), part, ["l_partkey"])


# --- jobs ------------------------------------------------------------------------------------------------------------

#: The whole of lineitem: a job is an order, its dependencies are the order's lines, its group the order's priority.
_JOBS = """with wt as (select distinct 'job' || l_orderkey as job_name, o_orderpriority as job_grp, 'S' || l_linestatus || '.line' || l_orderkey || '-' || l_linenumber as job_dependency
  from lineitem join orders on l_orderkey = o_orderkey),
lg as (select distinct case when l_returnflag = 'N' then 0 else 1 end as status, 'S' || l_linestatus as system_type, 'line' || l_orderkey || '-' || l_linenumber as job_name from lineitem
  union all select distinct case when o_orderstatus = 'F' then 1 else 0 end, 'S' || o_orderstatus, 'job' || o_orderkey from orders where o_orderstatus <> 'O')"""


def job_tables(s, d):
    lines, orders = table(s, d, "lineitem"), table(s, d, "orders")
    line = F.concat(F.lit("line"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    system = lambda c: F.concat(F.lit("S"), c)
    job = lambda c: F.concat(F.lit("job"), F.col(c).cast("string"))
    day = F.lit("2024-01-31").cast("date").alias("cob_dt")
    wt = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        job("l_orderkey").alias("job_name"), F.col("o_orderpriority").alias("job_grp"), F.concat(system(F.col("l_linestatus")), F.lit("."), line).alias("job_dependency")
    ).distinct()
    done = lines.select(F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("status"), system(F.col("l_linestatus")).alias("system_type"), line.alias("job_name"), day)
    begun = orders.where("o_orderstatus <> 'O'").select(
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("status"), system(F.col("o_orderstatus")).alias("system_type"), job("o_orderkey").alias("job_name"), day
    )
    return wt, done.distinct().unionByName(begun.distinct())


def _available(extra: str) -> str:
    return f"""{_JOBS} select wt.job_name from wt left join lg l1 on split_part(wt.job_dependency, '.', 1) = l1.system_type and split_part(wt.job_dependency, '.', 2) = l1.job_name and l1.status = 1
where wt.job_grp = '1-URGENT' and not exists (select 1 from lg l2 where l2.job_name = wt.job_name{extra}) group by 1 having count(wt.job_name) = count(l1.job_name)"""


@query("jobs_available", _available(""))
def _(s, d):
    return G.available_jobs(*job_tables(s, d), "1-URGENT", "2024-01-31")


@query("jobs_available_waiting", _available(" and l2.system_type = 'SP'"))
def _(s, d):
    wt, lg = job_tables(s, d)
    return G.available_jobs(wt.withColumn("wait_status", F.lit("Y")), lg, "1-URGENT", "2024-01-31", "SP", "wait_status")


@query("group_pending", f"""{_JOBS} select count(*) as n_unfinished from (select wt.job_name from wt left join lg on wt.job_name = lg.job_name and lg.status = 1
  where wt.job_grp = '2-HIGH' group by 1 having count(wt.job_name) <> count(lg.job_name))""")
def _(s, d):
    return G.unfinished_jobs(*job_tables(s, d), "2-HIGH", "2024-01-31")


_RUNS = "with r as (select 'u' || user_id as job_name, ts, case event_type when 'error' then 'FAILED' when 'view' then 'SKIPPED' else 'SUCCEEDED' end as status, event_id from events)"


def runs(s, d):
    state = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "SKIPPED").otherwise("SUCCEEDED")
    return table(s, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("job_name"), "ts", state.alias("status"), "event_id")


@query("last_success", f"""{_RUNS}, l as (select * from r where status <> 'SKIPPED' qualify row_number() over (partition by job_name order by ts desc, status desc, event_id desc) = 1)
select j.job_name, (l.status is null or l.status = 'SUCCEEDED')::int as ok from (select distinct job_name from r union select 'none') j left join l using (job_name)""")
def _(s, d):
    r = runs(s, d)
    jobs = r.select("job_name").union(s.createDataFrame([("none",)], "job_name string"))
    return G.last_run_succeeded(r, jobs, "ts").withColumn("ok", F.col("ok").cast("int"))


@query("all_succeeded", f"""{_RUNS}, l as (select * from r where status <> 'SKIPPED' and job_name in ('u1', 'u2', 'u3') qualify row_number() over (partition by job_name order by ts desc, status desc, event_id desc) = 1)
select count(*) filter (status = 'SUCCEEDED') as n_succeeded, (count(*) filter (status = 'SUCCEEDED') = 3)::int as all_succeeded from l""")
def _(s, d):
    out = G.all_succeeded(runs(s, d), ["u1", "u2", "u3"], "ts")
    return out.select("n_succeeded", F.col("all_succeeded").cast("int").alias("all_succeeded"))


@query("job_status", f"{_JOBS} select job_name, case when status = 1 then 'COMPLETED' else 'FAIL' end as job_status from lg where job_name = 'line7-1'")
def _(s, d):
    return G.job_status(job_tables(s, d)[1], "line7-1", "2024-01-31")


@query("job_finish", f"{_JOBS} select job_name, case when job_name like 'job%' then 1 else status end as status from lg")
def _(s, d):
    lg = job_tables(s, d)[1]
    done = lg.where("job_name like 'job%'").withColumn("status", F.lit(1))
    return G.log_finish(lg, done).select("job_name", "status")


@query("job_start", f"{_JOBS} select job_name, status, system_type from lg union all select distinct 'job' || o_orderkey, 0, 'DS' from orders where o_orderstatus = 'O'")
def _(s, d):
    lg = job_tables(s, d)[1]
    waiting = table(s, d, "orders").where("o_orderstatus = 'O'").select(F.concat(F.lit("job"), F.col("o_orderkey").cast("string")).alias("job_name")).distinct()
    return G.log_start(lg, waiting, "2024-01-31", "DS").select("job_name", "status", "system_type")


# --- projections -----------------------------------------------------------------------------------------------------


@query("rename_snake", "select c_custkey as customer_key, c_name as full_name from customer")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("CustomerKey"), F.col("c_name").alias("Full-Name"))
    return P.snake_case_column_name(c, [".*"])


@query("rename_strip", "select c_custkey as id, c_name as name from customer")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id_x_x"), F.col("c_name").alias("name_x"))
    return P.strip_trailing_chars(c, "_x")


@query("rename_pairs", "select n_nationkey as key, n_name as \"name\" from nation")
def _(s, d):
    n = table(s, d, "nation").select(F.col("n_nationkey").alias("KEY"), F.col("n_name").alias("N_NAME"))
    return P.rename_column(P.lower_case_column_name(n, ["K.*"]), [{"origin": "N_NAME", "new": "name"}])


@query("project_cast", "select l_orderkey::varchar as k, l_quantity::int as q from lineitem")
def _(s, d):
    return P.apply_mapping(table(s, d, "lineitem"), [("l_orderkey", "bigint", "k", "string"), ("l_quantity", "double", "q", "int")])


@query("constant_columns", "select n_nationkey, 'CUS' as src, '2022-04-24' as cob, '2022-04-26' as part, '202203' as mon, n_name as n_name_2 from nation")
def _(s, d):
    n = table(s, d, "nation").select("n_nationkey", "n_name")
    steps = [
        {"name": "add_constant_column", "column_name": "src", "value": "CUS"},
        {"name": "add_constant_column_from_cob_date", "column_name": "cob"},
        {"name": "add_ds_partition_date_by_data_date", "column_name": "part", "raw_partition": "load=20220424", "offset_date": 2},
        {"name": "get_lst_mth_from_date", "column_name": "mon", "raw_partition": "load=20220424", "offset_date": -1},
        {"name": "copy_column", "new_column": "n_name_2", "copied_column": "n_name"},
        {"name": "drop_columns", "column_list": ["n_name"]},
    ]
    return texts(run_pipeline(n, steps, context={"cob_date": "20220424"}))


@query("coalesce_columns", "select c_custkey, coalesce(case when c_custkey % 3 <> 0 then c_mktsegment end, c_name) as v, '' as extra from customer")
def _(s, d):
    c = table(s, d, "customer").withColumn("a", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    out = P.drop_all_column_except(P.copy_column_ifnull(c, "v", "a", "c_name"), ["c_custkey", "v"])
    return P.payload_handle_missing_fields(out, ["v", "extra"]).fillna("", ["extra"])


@query("pyspark_function", "select n_nationkey, upper(n_name) as n from nation where n_regionkey = 1")
def _(s, d):
    call = lambda f, *a: {"__function_name__": f, "args": list(a)}
    steps = [
        {"name": "pyspark_df_function", "function_name": "where", "args": ["n_regionkey = 1"]},
        {"name": "pyspark_df_function", "function_name": "withColumn", "args": ["n", call("upper", call("col", "n_name"))]},
        {"name": "pyspark_df_function", "function_name": "select", "args": ["n_nationkey", "n"]},
    ]
    return run_pipeline(table(s, d, "nation"), steps)


@query("condition_loan", """select l_orderkey::varchar as ar_ctr_nbr, strftime(l_shipdate, '%Y-%m-%d') as from_dt, (l_discount::decimal(38,6))::varchar as repymt_rate,
  l_linenumber::varchar || '.1' as rec_position, 'T24' as src_stm_id from lineitem where l_shipdate::date = date '1998-09-01'""")
def _(s, d):
    rows = V.filter_partition_date(table(s, d, "lineitem"), "l_shipdate", "1998-09-01")
    return texts(rows.select(
        F.col("l_orderkey").cast("string").alias("ar_ctr_nbr"), dates.parse_date(F.date_format("l_shipdate", "yyyyMMdd"), ["yyyyMMdd"]).alias("from_dt"),
        F.col("l_discount").cast("decimal(38,6)").alias("repymt_rate"), P.concat_position(F.col("l_linenumber"), F.lit(1)).alias("rec_position"), F.lit("T24").alias("src_stm_id"),
    ))


# --- casts and dates -------------------------------------------------------------------------------------------------


@query("cast_decimal", "select o_orderkey, ((o_totalprice::decimal(21,6)))::varchar as p from orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.format_number(F.col("o_totalprice"), 6).alias("p"))
    return texts(C.cast_to_decimaltype(o, ["p"]))


@query("cast_integers", "select p_partkey, try_cast(case when p_partkey % 5 = 0 then 'x' else p_size::varchar end as int) is null as bad, coalesce(try_cast(case when p_partkey % 5 = 0 then 'x' else p_size::varchar end as smallint), -1)::int as v from part")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("p_size").cast("string")).alias("v"))
    out = C.cast_to_shorttype(p, ["v"])
    return out.select("p_partkey", F.col("v").isNull().alias("bad"), F.coalesce(F.col("v").cast("int"), F.lit(-1)).alias("v"))


@query("cast_boolean_int", "select event_id, case when event_type in ('click', 'view') then 1 else 0 end as b from events where event_type <> 'error' union all select event_id, -1 from events where event_type = 'error'")
def _(s, d):
    text = F.when(F.col("event_type").isin("click", "view"), "True").when(F.col("event_type") == "error", "?").otherwise("false")
    return C.boolean_to_int(table(s, d, "events").select("event_id", text.alias("b")), "b").fillna(-1, ["b"])


@query("cast_array", "select c_custkey, len(string_split(c_name, '#'))::int as n, string_split(c_name, '#')[1] as head from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.concat(F.lit("["), F.replace("c_name", F.lit("#"), F.lit(",")), F.lit("]")).alias("a"))
    out = C.cast_to_arraytype(c, ["a"])
    return out.select("c_custkey", F.size("a").alias("n"), F.get("a", F.lit(0)).alias("head"))


@query("cast_epoch_ms", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as a, strftime(ts, '%Y-%m-%d %H:%M:%S') as b from events")
def _(s, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    e = table(s, d, "events").select("event_id", ms.alias("a"), ms.alias("b"))
    return texts(C.cast_unix_timestamp_to_timestamp_v2(C.cast_epoch_ms_to_timestamp(e, ["a"]), ["b"]))


@query("cast_zone", "select o_orderkey, strftime(o_orderdate - interval 7 hour, '%Y-%m-%d %H:%M:%S') as t from orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss").alias("t"))
    return texts(C.cast_string_to_timestamp(o, ["t"], "dd/MM/yyyy HH:mm:ss", "Etc/GMT-7"))


_MIXED = "case o_orderkey % 4 when 0 then strftime(o_orderdate, '%d/%m/%Y') when 1 then strftime(o_orderdate, '%Y%m%d') when 2 then strftime(o_orderdate, '%Y-%m-%d') else 'none' end"


def mixed_dates(s, d):
    k = F.col("o_orderkey") % 4
    day = lambda f: F.date_format("o_orderdate", f)
    text = F.when(k == 0, day("dd/MM/yyyy")).when(k == 1, day("yyyyMMdd")).when(k == 2, day("yyyy-MM-dd")).otherwise("none")
    return table(s, d, "orders").select("o_orderkey", text.alias("t"))


@query("cast_multi_date", "select o_orderkey, case when o_orderkey % 4 = 3 then '' else strftime(o_orderdate, '%Y-%m-%d') end as t from orders")
def _(s, d):
    return texts(C.cast_to_date(mixed_dates(s, d), ["t"])).fillna("", ["t"])


@query("cast_multi_ts", "select o_orderkey, case when o_orderkey % 4 in (1, 3) then '' else strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' end as t from orders")
def _(s, d):
    return texts(C.cast_multiple_fmt_to_timestamp(mixed_dates(s, d), ["t"], ["dd/MM/yyyy"])).fillna("", ["t"])


@query("partition_month", "select o_orderkey, strftime(o_orderdate, '%Y-%m') || '-01' as p from orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    return C.create_partition_by_column(o, [{"type": "month_string", "source_column": "m", "partition_column": "p"}]).drop("m")


@query("partition_auto", "select o_orderkey, case when o_orderkey % 4 = 3 then '' else strftime(o_orderdate, '%Y-%m-%d') end as p from orders")
def _(s, d):
    out = C.create_partition_by_column(mixed_dates(s, d), [{"type": "date", "source_column": "t", "partition_column": "p"}])
    return out.drop("t").fillna("", ["p"])


@query("last_day", "select distinct strftime(o_orderdate, '%m/%Y') as m, strftime(last_day(o_orderdate), '%Y-%m-%d') as t from orders")
def _(s, d):
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "MM/yyyy").alias("m")).distinct().withColumn("t", F.col("m"))
    return texts(C.get_last_day_of_month(o, ["t"]))


@query("next_month_bounds", """select distinct strftime(o_orderdate, '%Y-%m-%d') as day, strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y-%m-%d') as a,
  strftime(last_day(date_trunc('month', o_orderdate) + interval 1 month), '%Y-%m-%d') as b, strftime(o_orderdate::date - interval 3 month + interval 1 day, '%Y-%m-%d') as c from orders""")
def _(s, d):
    o = table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    c = F.col("day")
    return texts(o.select("day", dates.first_of_next_month(c).alias("a"), dates.last_of_next_month(c).alias("b"), dates.three_months_back(c).alias("c")))


@query("date_series", """select n_nationkey, strftime(x, '%Y-%m-%d') as day from (select n_nationkey, unnest(generate_series(date '2024-01-30', date '2024-01-30' + n_nationkey::int, interval 1 day)) as x from nation)""")
def _(s, d):
    start = F.lit("2024-01-30").cast("date")
    return texts(table(s, d, "nation").select("n_nationkey", F.explode(dates.days(start, F.date_add(start, F.col("n_nationkey")))).alias("day")))


# --- text, hashes ----------------------------------------------------------------------------------------------------


@query("sub_string", "select p_partkey, substring(p_name, 2, 4) as n, trim(p_brand) as b from part")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", F.col("p_name").alias("n"), F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("b"))
    return X.trim_all_trailing_space(X.sub_string(p, ["n"], "2:4"), ["b"])


@query("split_element", "select p_partkey, string_split(p_type, ' ')[-1] as last, coalesce(string_split(p_type, ' ')[2], '') as two from part")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", "p_type")
    out = X.split_string_get_element(X.split_string_get_element(p, "p_type", "last", " ", -1), "p_type", "two", " ", 2)
    return out.drop("p_type").fillna("", ["two"])


@query("hash_index", "select c_custkey, sha256(concat_ws('||', c_custkey::varchar, case when c_custkey % 3 = 0 then null else c_name end, c_nationkey::varchar)) as h from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("n"), "c_nationkey", F.lit("x").alias("ds_x"))
    return X.add_ds_hash_index(c, "h").select("c_custkey", "h")


@query("hash_key", "select o_orderkey, sha256(concat_ws('||', o_orderkey::varchar, o_orderstatus)) as pk, sha256(concat_ws('||', o_orderkey::varchar)) as h from orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    return X.add_pk_from_columns(X.calculate_hash_index(o, "h", ["o_orderstatus"]), "pk", ["o_orderstatus", "o_orderkey"]).select("o_orderkey", "pk", "h")


@query("uuid_key", """with h as (select c_custkey, sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode('k' || c_custkey)) as x from customer)
select c_custkey, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab', ((('0x' || substr(x, 17, 1))::int) & 3) + 1, 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12) as u from h""")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("s"))
    return X.create_uuid(c, "u", "s").drop("s")


@query("base64_decode", "select event_id, case when event_id % 5 = 0 then '' else props end as p from events")
def _(s, d):
    e = table(s, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, "%%%").otherwise(F.base64(F.encode("props", "UTF-8"))).alias("p"))
    return X.decode_base64_payload(e, "p").fillna("", ["p"])


@query("text_upper", "select p_partkey, upper(regexp_replace(trim(p_name), '\\s+', ' ', 'g')) as n from part")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" ")).alias("n"))
    return X.da_text_with_unicode(p, ["n"])


@query("text_ascii", "select c_custkey, 'DANG ' || upper(c_mktsegment) as n from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.concat(F.lit("Đặng "), "c_mktsegment").alias("n"))
    return X.da_text_non_unicode(c, ["n"])


@query("replace_values", "select o_orderkey, case o_orderstatus when 'F' then 'done' else o_orderstatus end as o_orderstatus from orders")
def _(s, d):
    return X.replace_values(table(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "done"})


@query("mark_substring", "select c_custkey, substr(c_name, 1, 3) as a, substr(c_mktsegment, 2, greatest(length(c_mktsegment) - 2, 0)) as b from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.col("c_name").alias("a"), F.col("c_mktsegment").alias("b"))
    return X.mark_by_substring(X.mark_by_substring(c, ["a"], 0, 3), ["b"], 1, -1)


@query("mark_const", "select c_custkey, 'MASK ' || c_custkey as m from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.array("c_name").alias("a"))
    return X.mark_by_combine_with_const(c, ["a"], "MASK", "c_custkey").select("c_custkey", F.get("a", F.lit(0)).alias("m"))


# --- nested ----------------------------------------------------------------------------------------------------------


@query("json_path", "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k, '' as z from events")
def _(s, d):
    return N.parse_json_cols(table(s, d, "events"), "props", ["k", "z"]).select("event_id", "k", "z").fillna("")


@query("json_tuple", "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k, '' as none from events")
def _(s, d):
    return N.json_tuple(table(s, d, "events").select("event_id", "props"), "props", ["k", "none"]).drop("props").fillna("")


@query("json_array_struct", "select c_custkey, c_custkey as id, c_name as val from customer")
def _(s, d):
    text = F.to_json(F.array(F.struct(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Value"))))
    c = N.structs["structstatement_constant"](table(s, d, "customer").select("c_custkey", text.alias("j")), ["j"])
    return c.select("c_custkey", F.explode("j").alias("e")).select("c_custkey", F.col("e.Id").alias("id"), F.col("e.Value").alias("val"))


@query("json_to_map", "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k from events")
def _(s, d):
    e = N.json_string_to_map_string(table(s, d, "events").select("event_id", "props"), ["props"])
    return N.get_value_of_key(e, "props", "k", "k").drop("props").fillna("")


@query("json_pivot", """select event_id as "KAFKA_OFFSET", case when event_type in ('signup', 'view') then 'CDC_INSERT' when event_type = 'click' then 'CDC_UPDATE' else 'CDC_DELETE' end as operation, user_id::varchar as user_id from events""")
def _(s, d):
    kind = F.when(F.col("event_type") == "signup", "load").when(F.col("event_type") == "view", "Insert").when(F.col("event_type") == "click", "update").otherwise("delete")
    body = F.to_json(F.struct(F.struct(kind.alias("operation")).alias("head"), F.struct(F.col("user_id").cast("string").alias("user_id")).alias("data")))
    e = table(s, d, "events").select(F.col("event_id").alias("KAFKA_OFFSET"), F.base64(F.encode(body, "UTF-8")).alias("p"))
    return N.extract_json_payload(X.decode_base64_payload(e, "p"), "p", fields=["operation", "user_id"])


@query("maps_to_columns", "select c_custkey, c_name as a, case when c_custkey % 2 = 0 then c_mktsegment else '' end as b from customer")
def _(s, d):
    one = F.create_map(F.lit("a"), F.col("c_name"))
    two = F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("b"), F.col("c_mktsegment")))
    return N.maps_to_columns(table(s, d, "customer").select("c_custkey", one.alias("m1"), two.alias("m2")), ["m1", "m2"], ["a", "b"]).fillna("")


@query("explode_maps", """select c_custkey, 1 as pos, 1 as sub_pos, c_name as m1, c_mktsegment as m2 from customer
  union all select c_custkey, 2, 1, '', 'x' from customer where c_custkey % 2 = 0 union all select c_custkey, 1, 2, c_name, 'y' from customer where c_custkey % 3 = 0""")
def _(s, d):
    key = F.col("c_custkey")
    m1 = F.create_map(F.lit("1.1"), F.col("c_name"))
    m2 = F.map_concat(
        F.create_map(F.lit("1.1"), F.col("c_mktsegment")),
        F.when(key % 2 == 0, F.create_map(F.lit("2.1"), F.lit("x"))).otherwise(F.create_map().cast("map<string,string>")),
        F.when(key % 3 == 0, F.create_map(F.lit("1.2"), F.lit("y"))).otherwise(F.create_map().cast("map<string,string>")),
    )
    rows = table(s, d, "customer").select("c_custkey", m1.alias("m1"), m2.alias("m2"))
    return N.explode_map_columns(rows, {"multi_cols": ["m1"], "sub_multi_cols": ["m2"]}, drop_nulls=True).fillna("", ["m1"])


@query("map_value_replace", "select c_custkey, replace(replace(c_name, 'C', 'K'), '0', '') as v from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.create_map(F.lit("n"), F.col("c_name")).alias("m"))
    out = X.replace_value_in_map_type_column(c, "m", [{"pattern": "C", "replacement": "K"}, {"pattern": "0", "replacement": ""}])
    return N.get_value_of_key(out, "m", "n", "v").drop("m")


@query("list_first", "select rec_id, coalesce(info.actors[1], '') as actor, coalesce(info.genres[1], '') as genre from moviedata")
def _(s, d):
    m = table(s, d, "moviedata").select("rec_id", F.col("info.actors").alias("a"), F.col("info.genres").alias("g"))
    return N.get_first_value_of_list(N.get_first_value_of_list(m, "a", "actor"), "g", "genre").drop("a", "g").fillna("")


@query("map_lookup", "select ds_row_id, coalesce(info_detail[1]['coll_tp'], '') as v from ds1_job where len(info_detail) > 0")
def _(s, d):
    j = table(s, d, "ds1_job").where(F.size("info_detail") > 0).select("ds_row_id", F.get("info_detail", F.lit(0)).alias("m"))
    return N.get_value_of_key(j, "m", "coll_tp", "v").drop("m").fillna("")


@query("count_differences", "select l_orderkey, l_linenumber, ((l_partkey <> l_suppkey)::int + (l_returnflag <> l_linestatus)::int) as n from lineitem")
def _(s, d):
    return N.count_differences(table(s, d, "lineitem"), "n", [("l_partkey", "l_suppkey"), ("l_returnflag", "l_linestatus")]).select("l_orderkey", "l_linenumber", "n")


@query("nest_fields", "select n_regionkey, count(*) as n, string_agg(n_name, ',' order by n_name) as names from nation group by 1")
def _(s, d):
    out = N.nest_fields(table(s, d, "nation"), ["n_regionkey"], ["n_name"], "names")
    names = F.array_join(F.transform("names", lambda x: x["n_name"]), ",")
    return out.select("n_regionkey", F.size("names").cast("bigint").alias("n"), names.alias("names"))


@query("xml_flatten", """select c_custkey::varchar as stt, c_name as name, case when c_custkey % 2 = 0 then 'P' || c_custkey else '' end as paper_1, 'Q' || c_custkey as paper_3 from customer""")
def _(s, d):
    c = table(s, d, "customer")
    tag = lambda n, *v: F.concat(F.lit(f"<{n}>"), *v, F.lit(f"</{n}>"))
    key = F.col("c_custkey").cast("string")
    paper = lambda k, p: tag("ROW_GIAYTO", tag("LOAI_GIAYTO", F.lit(k)), tag("TEN_LOAI_GIAYTO", F.lit("x")), tag("SO_GIAYTO", F.lit(p), key))
    one = F.when(F.col("c_custkey") % 2 == 0, paper("1", "P")).otherwise(paper("9", "Z"))
    row = tag("ROW_CTIET", tag("STT", key), tag("TEN_NNT", F.col("c_name")), tag("TTIN_GIAYTO", one, paper("3", "Q")))
    xml = c.select(tag("ROOT", tag("ND_DS_NNT", tag("ND_DS_CTIET", row))).alias("x"))
    out = N.parse_tax_documents(xml, "x")
    return out.select(F.col("STT").alias("stt"), F.col("TEN_NNT").alias("name"), F.col("SO_GIAYTO_1").alias("paper_1"), F.col("SO_GIAYTO_3").alias("paper_3"))


@query("lineage_join", """select 'job_' || r_regionkey as job, n_name as input_column, 'out_' || r_name as output_table from region join nation on n_regionkey = r_regionkey""")
def _(s, d):
    side = lambda tb: {"database": F.lit("db"), "table": tb, "path": F.lit("p"), "source": F.lit("s")}
    st = lambda m: F.struct(*[v.alias(k) for k, v in m.items()])
    names = table(s, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("cols"))
    r = table(s, d, "region").join(names, F.col("r_regionkey") == F.col("n_regionkey"))
    inputs = F.array(st(side(F.lit("nation")) | {"columns": F.col("cols")}))
    output = st(side(F.concat(F.lit("out_"), "r_name")) | {"column": F.lit("c")})
    docs = r.select(F.concat(F.lit("job_"), F.col("r_regionkey").cast("string")).alias("job"), F.lit("").alias("description"), F.array(F.struct(inputs.alias("inputs"), output.alias("output"))).alias("logics"))
    return N.lineage_rows(docs).select("job", "input_column", "output_table")


# --- filters and validations -----------------------------------------------------------------------------------------

_PART = "select p_partkey from part where "


@query("regex_filter", _PART + "regexp_matches(p_name, 'ring|gear')")
def _(s, d):
    return V.filter_with_regex_pattern(table(s, d, "part"), "p_name", "ring|gear").select("p_partkey")


@query("regex_filter_inverse", _PART + "not regexp_matches(p_name, 'ring|gear')")
def _(s, d):
    return V.filter_with_regex_pattern(table(s, d, "part"), "p_name", "ring|gear", inverse=True).select("p_partkey")


@query("not_null_keys", "select ds_row_id from ds1_job where customer_id is not null and arr_id is not null")
def _(s, d):
    return V.drop_record_if_none_in_primary_column(table(s, d, "ds1_job"), ["customer_id", "arr_id"]).select("ds_row_id")


@query("mandatory_input", "select ds_row_id from ds1_job where trim(arr_id) <> '' and trim(pd_id) <> '' and customer_id is not null")
def _(s, d):
    return V.mandatory_input(table(s, d, "ds1_job"), ["arr_id", "pd_id", "customer_id"]).select("ds_row_id")


@query("valid_customer_id", "select ds_row_id from ds1_job where customer_id between 0 and 9999999999")
def _(s, d):
    return V.valid_customer_id(table(s, d, "ds1_job"), ["customer_id"]).select("ds_row_id")


@query("numeric_range_drop", _PART + "p_size between 10 and 30")
def _(s, d):
    return V.valid_numeric(table(s, d, "part"), ["p_size"], 10, 30, True).select("p_partkey")


@query("numeric_range_null", "select p_partkey, case when p_size >= 10 then p_size else -1 end as p_size from part")
def _(s, d):
    return V.valid_numeric(table(s, d, "part"), ["p_size"], min_value=10).select("p_partkey", "p_size").fillna(-1, ["p_size"])


@query("alphanumeric", "select p_partkey, case when regexp_full_match(p_brand, '[A-Za-z0-9]+') then p_brand else '' end as p_brand from part")
def _(s, d):
    return V.valid_alphanumeric(table(s, d, "part"), ["p_brand"]).select("p_partkey", "p_brand").fillna("", ["p_brand"])


@query("numeric_string", "select ds_row_id from ds1_job where regexp_full_match(sector_id, '[0-9]+')")
def _(s, d):
    return V.valid_numeric_string(table(s, d, "ds1_job"), ["sector_id"], True).select("ds_row_id")


def phones(s, d):
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("(+84) 9"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("09."), k.cast("string"))).otherwise("abc")
    return table(s, d, "customer").select("c_custkey", text.alias("p"))


@query("phone_array", "select c_custkey, case c_custkey % 3 when 0 then '849' || c_custkey when 1 then '09' || c_custkey else '' end as p from customer")
def _(s, d):
    out = V.valid_phone_number(phones(s, d).select("c_custkey", F.array("p", F.lit(None).cast("string")).alias("p")), ["p"])
    return out.select("c_custkey", F.coalesce(F.get("p", F.lit(0)), F.lit("")).alias("p"))


@query("phone_clean", "select c_custkey, case c_custkey % 3 when 0 then '(+84)9' || c_custkey when 1 then '09' || c_custkey else '' end as p from customer")
def _(s, d):
    return V.validate_phone(phones(s, d), "p")


@query("email_array", "select c_custkey, case c_custkey % 3 when 0 then 'u' || c_custkey || '@bank.example' else '' end as e from customer")
def _(s, d):
    k = F.col("c_custkey").cast("string")
    e = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("u"), k, F.lit("@bank.example"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("u"), k)).otherwise("a@b")
    out = V.valid_email(table(s, d, "customer").select("c_custkey", F.array(e).alias("e")), ["e"])
    return out.select("c_custkey", F.coalesce(F.get("e", F.lit(0)), F.lit("")).alias("e"))


@query("email_clean", "select c_custkey, case when c_custkey % 2 = 0 then 'u_' || c_custkey || '@bank.example' else '' end as e from customer")
def _(s, d):
    k = F.col("c_custkey").cast("string")
    e = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("U-"), k, F.lit("@Bank.example"))).otherwise("none")
    return V.validate_email(table(s, d, "customer").select("c_custkey", e.alias("e")), "e")


@query("mnemonic", "select customer_id, mnemonic, rec_status from customers where length(mnemonic) between 3 and 10 and regexp_full_match(mnemonic, '[A-Z]+[A-Z0-9.]+')")
def _(s, d):
    return V.valid_mnemonic(table(s, d, "customers"), ["mnemonic"]).select("customer_id", "mnemonic", "rec_status")


@query("drop_all_blank", "select ds_row_id from ds1_job where coalesce(nullif(loan_pps_cl_id, ''), nullif(gl_tnr_tp_id, '')) is not null")
def _(s, d):
    return V.drop_all_blank(table(s, d, "ds1_job"), ["loan_pps_cl_id", "gl_tnr_tp_id"]).select("ds_row_id")


# --- masking (no SQL form) -------------------------------------------------------------------------------------------


@query("mask_text", "select c_custkey, c_name as restored, 1 as same_shape from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.col("c_name").alias("n"), F.col("c_name").alias("m"))
    masked = Q.mask_pii(c, ["m"], key=SECRET)
    shape = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "[0-9]", "9"), "[a-z]", "a"), "[A-Z]", "A")
    same = (shape(F.col("n")) == shape(F.col("m"))).cast("int").alias("same_shape")
    return Q.unmask_pii(masked.select("c_custkey", F.col("m").alias("restored"), same), ["restored"], key=SECRET)


@query("mask_phone", "select c_custkey, case c_custkey % 3 when 0 then '(+84) 9' when 1 then '09.' else '' end as head, length(p) as n from (select c_custkey, case c_custkey % 3 when 0 then '(+84) 9' || c_custkey when 1 then '09.' || c_custkey else 'abc' end as p from customer)")
def _(s, d):
    out = Q.fpe_mask_phone_number(phones(s, d), ["p"], key=SECRET)
    k = F.col("c_custkey") % 3
    head = F.when(k == 0, F.concat(F.substring("p", 1, 6), F.lit("9"))).when(k == 1, F.concat(F.lit("09"), F.substring("p", 3, 1))).otherwise("")
    return out.select("c_custkey", head.alias("head"), F.length("p").cast("bigint").alias("n"))


@query("mask_email", "select c_custkey, '@bank.example' as domain, length(c_custkey::varchar)::bigint + 1 as n from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@bank.example")).alias("e"))
    out = Q.fpe_mask_email(c, ["e"], key=SECRET)
    at = F.instr("e", "@")
    return out.select("c_custkey", F.substr("e", at).alias("domain"), (at - 1).cast("bigint").alias("n"))


@query("mask_date", "select o_orderkey, year(o_orderdate)::int as y, day(last_day(o_orderdate))::int as month_days from orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("t"))
    out = Q.fpe_mask_datetime(o, ["t"], key=SECRET)
    day = dates.parse_date(F.col("t"), ["yyyy-MM-dd"])
    return out.select("o_orderkey", F.year(day).alias("y"), F.dayofmonth(F.last_day(day)).alias("month_days"))


@query("mask_condition", "select c_custkey, (c_custkey % 2 = 0)::int as kept from customer")
def _(s, d):
    c = table(s, d, "customer").select("c_custkey", F.col("c_name").alias("a"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("other").alias("b"), F.col("c_name").alias("v"))
    out = Q.mask_pii_with_condition(c, ["v"], {"not_equal": {"source_column": "a", "destination_column": "b"}}, key=SECRET)
    return out.select("c_custkey", (F.col("v") == F.col("a")).cast("int").alias("kept"))


# --- items -----------------------------------------------------------------------------------------------------------


@query("kv_get", "select rec_id, year, title from moviedata where rec_id = 7")
def _(s, d):
    return readers.get_item(table(s, d, "moviedata"), {"rec_id": 7}).select("rec_id", "year", "title")


@query("kv_range_project", "select year, title, len(info.genres)::int as n_genres, coalesce(info.actors[1], '') as lead_actor from moviedata where year = 1984 and title between 'A' and 'Q' and info.genres is not null")
def _(s, d):
    rows = readers.query_items(table(s, d, "moviedata"), {"year": 1984}, ("title", "A", "Q"), ["year", "title", "info.genres", F.get("info.actors", F.lit(0)).alias("lead_actor")])
    return rows.where("genres is not null").select("year", "title", F.size("genres").alias("n_genres"), F.coalesce("lead_actor", F.lit("")).alias("lead_actor"))


@query("kv_scan", "select rec_id, year, coalesce(info.rating::varchar, '') as rating from moviedata where year between 1950 and 1960")
def _(s, d):
    return readers.scan_items(table(s, d, "moviedata"), "year between 1950 and 1960", ["rec_id", "year", F.coalesce(F.col("info.rating").cast("string"), F.lit("")).alias("rating")])


@query("kv_conditional_delete", "select rec_id from moviedata where not coalesce(year >= 1990 and info.rating <= 5, false)")
def _(s, d):
    return sinks.delete_items(table(s, d, "moviedata"), F.col("year") >= 1990, F.col("info.rating") <= 5).select("rec_id")


@query("kv_nested_update", "select rec_id, case when info is null then '' when year = 1984 then 'seen' else coalesce(info.plot, '') end as plot from moviedata")
def _(s, d):
    out = sinks.update_nested(table(s, d, "moviedata"), (F.col("year") == 1984) & F.col("info").isNotNull(), "info", {"plot": F.lit("seen")})
    return out.select("rec_id", F.coalesce(F.col("info.plot"), F.lit("")).alias("plot"))


@query("kv_put", "select rec_id, case when rec_id % 3 = 0 then 'new' else coalesce(title, '') end as title from moviedata")
def _(s, d):
    m = table(s, d, "moviedata").select("rec_id", F.coalesce("title", F.lit("")).alias("title"))
    return sinks.put_items(m, m.where("rec_id % 3 = 0").withColumn("title", F.lit("new")), ["rec_id"])


# --- streams and pipelines -------------------------------------------------------------------------------------------


@query("stream_microbatch", "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k, '2024-02-01' as ingested from events where event_type = 'purchase'")
def _(s, d):
    out, mark = scratch(s, "stream"), scratch(s, "stream-checkpoint")
    source = table(s, d, "events")
    stream = s.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
    steps = [
        {"name": "filter_with_regex_pattern", "column": "event_type", "pattern": "^purchase$"},
        {"name": "json_tuple", "column_name": "props", "fields": ["k"]},
    ]
    microbatch.run_stream(stream, microbatch.parquet_sink(out, steps), mark, interval=None).awaitTermination()
    return s.read.parquet(out).select("event_id", F.coalesce("k", F.lit("")).alias("k"), F.lit("2024-02-01").alias("ingested"))


@query("stream_windows", "select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n from events group by 1, 2")
def _(s, d):
    mark, out = scratch(s, "windows-checkpoint"), scratch(s, "windows")
    source = table(s, d, "events")
    stream = s.readStream.schema(source.schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = microbatch.windowed_counts(stream, "ts", "1 day", None, "40 days", ["event_type"])
    counts.writeStream.outputMode("complete").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(out)).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("pipeline_fold", "select o_orderkey as order_key, upper(o_orderstatus) as status, o_totalprice::double as price, sha256(concat_ws('||', o_orderkey::varchar, upper(o_orderstatus))) as h from orders where o_totalprice between 1000 and 450000")
def _(s, d):
    steps = [
        {"name": "drop_all_column_except", "column_list": ["o_orderkey", "o_orderstatus", "o_totalprice"]},
        {"name": "rename_column", "rename_list": [{"origin": "o_orderkey", "new": "order_key"}, {"origin": "o_orderstatus", "new": "status"}, {"origin": "o_totalprice", "new": "price"}]},
        {"name": "da_text_with_unicode", "column_patterns": ["status"]},
        {"name": "calculate_hash_index", "column_name": "h", "exclusive_columns": ["price"]},
    ]
    checks = [{"name": "valid_numeric", "column_patterns": ["price"], "min_value": 1000, "max_value": 450000, "is_mandatory": True}]
    return run_pipeline(table(s, d, "orders"), steps, checks)


def flagship(s: SparkSession, d: str) -> DataFrame:
    """Read, derive keys, merge: the shape of a curated job from end to end."""
    merged = M.scd2_merge(scd2_target(s, d), scd2_snapshot(s, d), ["c_custkey", "src"], DAY)
    return merged.withColumn("customer_uuid", uuid5(F.concat_ws("|", "src", F.col("c_custkey").cast("string"))))
