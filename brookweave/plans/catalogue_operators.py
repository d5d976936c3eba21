"""Further queries over the star-schema tables: operators that the first catalogue leaves out, and inputs of odd forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.functions import dates
from brookweave.operators import casting as C
from brookweave.operators import dedupe as D
from brookweave.operators import jobs as G
from brookweave.operators import masking as Q
from brookweave.operators import merge as M
from brookweave.operators import projections as P
from brookweave.operators import reshaping as N
from brookweave.operators import textual as X
from brookweave.operators import validations as V
from brookweave.plans import pipeline
from brookweave.plans.catalogue import DAY, OPEN, SECRET, query, runs, texts
from brookweave.session import scratch, table
from brookweave.sources import readers, sinks
from brookweave.streaming import microbatch

# --- readers ---------------------------------------------------------------------------------------------------------


def stored(s: SparkSession, df: DataFrame, name: str, partition_columns=()) -> str:
    """The rows as a catalog table on shared files, replacing one of that name."""
    sinks.drop_table(s, name)
    sinks.create_or_write(df, name, partition_columns, location=scratch(s, name))
    return name


def order_years(s, d):
    return table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("y"))


@query("catalog_partitions", "select o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') as y from orders where year(o_orderdate) between 1996 and 1997")
def _(s, d):
    """The predicate is on the folder column, so only two years' folders are listed and read."""
    name = stored(s, order_years(s, d), "bw_orders_by_year", ["y"])
    return readers.read(s, readers.Input("catalog", table=name, partition=readers.Partition(predicate="y in ('1996', '1997')")))


@query("catalog_many", "select 'n' as src, n_nationkey::bigint as k from nation where n_regionkey = 2 union all select 'r', r_regionkey::bigint from region")
def _(s, d):
    specs = [
        readers.Input("catalog", name="n", table=stored(s, table(s, d, "nation"), "bw_cat_nation"), partition=readers.Partition("n_regionkey", data_date=2)),
        readers.Input("catalog", name="r", table=stored(s, table(s, d, "region"), "bw_cat_region")),
        readers.Input("catalog", name="none", table="bw_no_such_table", empty_allow=True),
    ]
    found = readers.read_all(s, specs)
    assert found["none"] is None
    key = lambda name, c: found[name].select(F.lit(name).alias("src"), F.col(c).cast("bigint").alias("k"))
    return key("n", "n_nationkey").unionByName(key("r", "r_regionkey"))


@query("catalog_staging", "select n_nationkey, n_name from nation")
def _(s, d):
    readers.forget_staging()
    spec = readers.Input("t24_staging", table=stored(s, table(s, d, "nation").select("n_nationkey", "n_name"), "bw_staging_nation"))
    first = readers.read(s, spec)
    assert readers.read(s, spec) is first
    return first


@query("source_and_target", "select s.c_custkey, t.c_custkey is not null as held from customer s left join (select c_custkey from customer where c_nationkey < 10) t on s.c_custkey = t.c_custkey")
def _(s, d):
    table(s, d, "customer").select("c_custkey").createOrReplaceTempView("bw_source_customer")
    name = stored(s, table(s, d, "customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("t_key")), "bw_target_customer")
    source, target = readers.source_and_target(s, readers.Input("spark_sql", query="select c_custkey from bw_source_customer"), name)
    return source.join(target, F.col("c_custkey") == F.col("t_key"), "left").select("c_custkey", F.col("t_key").isNotNull().alias("held"))


@query("xml_files", "select c_custkey::varchar as stt, c_name as name, '' as paper_1, 'Q' || c_custkey as paper_3 from customer")
def _(s, d):
    """Tax documents written as XML files by the built-in source and read back by the reader."""
    path = scratch(s, "xml")
    paper = F.array(*[F.struct(F.lit(k).alias("LOAI_GIAYTO"), F.lit("x").alias("TEN_LOAI_GIAYTO"), F.concat(F.lit(p), F.col("c_custkey").cast("string")).alias("SO_GIAYTO")) for k, p in (("9", "Z"), ("3", "Q"))])
    rows = table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("STT"), F.col("c_name").alias("TEN_NNT"), F.struct(paper.alias("ROW_GIAYTO")).alias("TTIN_GIAYTO"))
    rows.write.format("xml").options(rowTag="ROW_CTIET", rootTag="ND_DS_CTIET").save(path)
    out = readers.read(s, readers.Input("xml_tax", uri_list=[path]))
    return out.select(F.col("STT").alias("stt"), F.col("TEN_NNT").alias("name"), F.col("SO_GIAYTO_1").alias("paper_1"), F.col("SO_GIAYTO_3").alias("paper_3"))


def lineage_documents(s, d):
    side = lambda t: [F.lit("db").alias("database"), t.alias("table"), F.lit("p").alias("path"), F.lit("s").alias("source")]
    names = table(s, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("cols"))
    r = table(s, d, "region").join(names, F.col("r_regionkey") == F.col("n_regionkey"))
    inputs = F.array(F.struct(*side(F.lit("nation")), F.col("cols").alias("columns")))
    output = F.struct(*side(F.concat(F.lit("out_"), "r_name")), F.lit("c").alias("column"))
    return r.select(F.concat(F.lit("job_"), F.col("r_regionkey").cast("string")).alias("job"), F.lit("").alias("description"), F.array(F.struct(inputs.alias("inputs"), output.alias("output"))).alias("logics"))


@query("lineage_reader", "select 'job_' || r_regionkey as job, n_name as input_column, 'out_' || r_name as output_table from region join nation on n_regionkey = r_regionkey")
def _(s, d):
    """Documents stored as JSON, read by the lineage reader; the fields are chosen by name."""
    path = scratch(s, "lineage")
    lineage_documents(s, d).write.json(path)
    rows = readers.read(s, readers.Input("dynamo_datalineage", uri_list=[path]))
    return P.select_fields(rows, ["job", "input_column", "output_table"])


@query("lineage_document", "select '1.0' as version, count(*) as n_rows from nation")
def _(s, d):
    """The output document: version, and all lineage rows as one array in one file."""
    path = scratch(s, "lineage-document")
    rows = N.lineage_rows(lineage_documents(s, d))
    sinks.write_document(rows.agg(F.lit("1.0").alias("version"), F.collect_list(F.struct("job", "input_column", "output_table")).alias("lineages")), path)
    return s.read.json(path).select("version", F.size("lineages").cast("bigint").alias("n_rows"))


@query("lineage_paths", "select 'job_' || r_regionkey as job, 'out_' || r_name as output_table, string_agg(n_name, ',' order by n_name) as path from region join nation on n_regionkey = r_regionkey group by 1, 2")
def _(s, d):
    out = N.lineage_paths(N.lineage_rows(lineage_documents(s, d)))
    return out.select("job", "output_table", F.array_join(F.transform("src_path", lambda x: x["input_column"]), ",").alias("path"))


@query("sample_items", "select case when count(*) > 250 then 250 else count(*) end as n from moviedata where title is not null")
def _(s, d):
    """The first 250 items of a list of movies: the limit is the feature."""
    path = scratch(s, "movies")
    table(s, d, "moviedata").where("title is not null").select("year", "title").coalesce(1).write.json(path)
    return readers.sample_items(s, path, multi_line=False).agg(F.count(F.lit(1)).alias("n"))


@query("small_result", "select n_regionkey::bigint as n_regionkey, count(*) as n from nation group by 1")
def _(s, d):
    """A bounded result through pandas and back."""
    table(s, d, "nation").createOrReplaceTempView("bw_small_nation")
    return s.createDataFrame(readers.to_pandas(s, "select cast(n_regionkey as bigint) n_regionkey, count(*) n from bw_small_nation group by 1"))


# --- writers ---------------------------------------------------------------------------------------------------------


@query("write_sized", "select count(*) as n_rows, true as within from orders")
def _(s, d):
    path = scratch(s, "sized")
    sinks.write_files(table(s, d, "orders"), path, "overwrite", max_rows_per_task=1000)
    files = s.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).alias("within"))


@query("table_create_then_replace", """select o_orderkey, strftime(o_orderdate, '%Y') as y, case when year(o_orderdate) = 1996 then 'new' else 'old' end as tag
  from orders where year(o_orderdate) <> 1996 or o_orderstatus = 'F'""")
def _(s, d):
    rows = order_years(s, d)
    name = stored(s, rows.select("o_orderkey", F.lit("old").alias("tag"), "y"), "bw_created_orders", ["y"])
    sinks.create_or_write(rows.where("y = '1996' and o_orderstatus = 'F'").select("o_orderkey", F.lit("new").alias("tag"), "y"), name, ["y"])
    return s.table(name)


@query("table_ddl_insert", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'P' union all select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def _(s, d):
    """Created by its columns at a location, twice without harm; two filtered inserts; emptied in between."""
    name = "bw_ddl_orders"
    sinks.drop_table(s, name)
    for _ in range(2):
        sinks.create_if_not_exists(s, name, "o_orderkey bigint, o_totalprice double", location=scratch(s, name))
    o = table(s, d, "orders")
    sinks.insert_select(o, name)
    sinks.delete_all(s, name)
    sinks.insert_select(o, name, F.col("o_orderstatus") == "P")
    sinks.insert_select(o, name, F.col("o_orderstatus") == "F")
    assert name in sinks.list_tables(s)
    return s.table(name)


@query("uuid_append", "select count(*) as n, count(distinct c_custkey) as keys, min(length('123e4567-e89b-12d3-a456-426614174000')) as width from customer")
def _(s, d):
    """The key replaced by its name-based identifier and appended."""
    name = "bw_uuid_customers"
    sinks.drop_table(s, name)
    sinks.create_if_not_exists(s, name, "k string, c_name string", location=scratch(s, name))
    rows = X.create_uuid(table(s, d, "customer").withColumn("s", F.col("c_custkey").cast("string")), "k", "s")
    sinks.insert_select(rows.select("k", "c_name"), name)
    return s.table(name).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("k").alias("keys"), F.min(F.length("k")).cast("bigint").alias("width"))


@query("kv_tables", "select 'bw_kv_items' as name, count(*) as n from moviedata")
def _(s, d):
    """Create, list, test and drop."""
    name = stored(s, table(s, d, "moviedata").select("rec_id"), "bw_kv_items")
    held = s.table(name).agg(F.lit([t for t in sinks.list_tables(s) if t == name][0]).alias("name"), F.count(F.lit(1)).alias("n"))
    out = s.createDataFrame(held.collect(), held.schema)  # one row
    assert sinks.drop_table(s, name) and not sinks.drop_table(s, name)
    return out


@query("kv_get_required", "select rec_id, year from moviedata where rec_id = 7")
def _(s, d):
    m = table(s, d, "moviedata")
    try:
        readers.get_item(m, {"rec_id": -1}, required=True)
        raise AssertionError("a missing item must be an error")
    except KeyError:
        return readers.get_item(m, {"rec_id": 7}, required=True).select("rec_id", "year")


# --- the curated job -------------------------------------------------------------------------------------------------

_UUID5 = lambda name: (
    f"(select substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab', ((('0x' || substr(x, 17, 1))::int) & 3) + 1, 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12)"
    f" from (select sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode({name})) as x))"
)
_LOAN_DAY = "19980901"
_LOANS = f"""with r as (select l_orderkey::varchar as ld, l_linenumber::varchar || '.' || l_suppkey as pos, min((l_discount::decimal(38,6))::varchar) as rate, max(l_returnflag) as tp from lineitem
    where strftime(l_shipdate, '%Y%m%d') = '{_LOAN_DAY}' group by 1, 2),
  n as (select {_UUID5("ld")} as ar_id, {_UUID5("ld || '|' || pos")} as cd_id, ld as ar_ctr_nbr, rate as repymt_rate, tp as repymt_tp, pos as rec_position from r),
  j as (select n.*, case right(ar_ctr_nbr, 1) when '1' then 'new' when '2' then 'updated' else 'unchanged' end as state from n)"""


def loans(s, d):
    """Raw repayment rows of a day: date filter, identifiers by name, projection to the target's columns."""
    rows = table(s, d, "lineitem").withColumn("ds_partition_date", F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = V.filter_partition_date(rows, "ds_partition_date", "1998-09-01")
    rows = rows.groupBy(F.col("l_orderkey").cast("string").alias("ld_id"), P.concat_position(F.col("l_linenumber"), F.col("l_suppkey")).alias("rec_position")).agg(
        F.min(F.col("l_discount").cast("decimal(38,6)")).alias("repayment_rate"), F.max("l_returnflag").alias("repayment_type")
    )
    rows = X.create_uuid(X.create_uuid(rows.withColumn("_name", F.concat_ws("|", "ld_id", "rec_position")), "ar_id", "ld_id"), "cd_id", "_name")
    day = dates.parse_date(F.lit(_LOAN_DAY), ["yyyyMMdd"])
    return rows.select(
        "ar_id", "cd_id", F.col("ld_id").alias("ar_ctr_nbr"), F.col("repayment_rate").alias("repymt_rate"), F.col("repayment_type").alias("repymt_tp"), "rec_position",
        day.alias("eff_dt"), F.lit(OPEN).cast("date").alias("end_dt"), F.lit(1).alias("rec_st"), F.lit("T24").alias("src_stm_id"), day.alias("ppn_dt"),
    )


@query("condition_loan_merge", f"""{_LOANS}
select ar_id, cd_id, ar_ctr_nbr, case when state = 'updated' then '9.000000' else repymt_rate end as repymt_rate, repymt_tp, rec_position, 'T24' as src_stm_id,
  '1998-08-01' as eff_dt, case when state = 'updated' then '1998-09-01' else '{OPEN}' end as end_dt, case when state = 'updated' then 0 else 1 end as rec_st,
  case when state = 'updated' then '1998-09-01' else '1998-08-01' end as ppn_dt from j where state <> 'new'
union all select ar_id, cd_id, ar_ctr_nbr, repymt_rate, repymt_tp, rec_position, 'T24', '1998-09-01', '{OPEN}', 1, '1998-09-01' from j where state <> 'unchanged'
union all select 'gone', 'gone', 'gone', '1.000000', 'N', '1.1', 'T24', '1998-08-01', '1998-09-01', 0, '1998-09-01'
union all select 'other', 'other', 'other', '1.000000', 'N', '1.1', 'CRM', '1998-08-01', '{OPEN}', 1, '1998-08-01'""")
def _(s, d):
    """The whole job: a day's repayment rows merged into a dimension that holds older versions, one that is gone and one
    of another source."""
    new = loans(s, d)
    last = F.substring("ar_ctr_nbr", -1, 1)
    old = new.where(last != "1").withColumns(
        {"repymt_rate": F.when(last == "2", F.lit(9)).otherwise(F.col("repymt_rate")).cast("decimal(38,6)"), "eff_dt": F.lit("1998-08-01").cast("date"), "ppn_dt": F.lit("1998-08-01").cast("date")}
    )
    extra = [(k, k, k, "N", "1.1", src) for k, src in (("gone", "T24"), ("other", "CRM"))]
    more = s.createDataFrame(extra, "ar_id string, cd_id string, ar_ctr_nbr string, repymt_tp string, rec_position string, src_stm_id string").withColumns(
        {"repymt_rate": F.lit(1).cast("decimal(38,6)"), "eff_dt": F.lit("1998-08-01").cast("date"), "end_dt": F.lit(OPEN).cast("date"), "rec_st": F.lit(1), "ppn_dt": F.lit("1998-08-01").cast("date")}
    )
    return texts(M.scd2_merge(old.unionByName(more), new, ["ar_ctr_nbr", "rec_position", "src_stm_id"], "1998-09-01", sources=["src_stm_id"]))


# --- columns ---------------------------------------------------------------------------------------------------------


@query("rename_positional", "select n_nationkey as a, n_name as b, '' as c, '2024-03-05' as d, '2021-01-01 17:00:00' as e, '2024-01-02 03:04:05' as f, '2024-01-02' as g from nation")
def _(s, d):
    n = P.to_df(table(s, d, "nation").select("n_nationkey", "n_name"), ["A", "B"])
    n = P.fill_col_if_not_exist(P.fill_col_if_not_exist(P.cast_to_lower_by_list(n, ["A", "B"]), "b"), "c").fillna("", ["c"])
    n = P.from_uat_date(P.add_data_date_from_event(n, "d", "2024-03-05"), "e")
    n = P.add_current_date_column(P.get_processing_date(n, "f", "2024-01-02 03:04:05"), "g", "2024-01-02")
    assert P.columns_of_type(n, "timestamp") == ["e", "f"] and P.columns_of_type(n, "date") == ["d", "g"]
    return texts(n)


@query("current_times", "select count(*) as n, true as now from nation")
def _(s, d):
    n = P.add_current_timestamp_column(P.add_current_date_column(table(s, d, "nation"), "d"), "t")
    close = F.abs(F.unix_timestamp("t") - F.unix_timestamp(F.current_timestamp())) < 3600
    return n.agg(F.count(F.lit(1)).alias("n"), F.min(close & (F.datediff(F.current_date(), "d") <= 1)).alias("now"))


@query("empty_input", "select n_nationkey, n_name from nation where n_nationkey < 3")
def _(s, d):
    """A frame that holds rows is passed on; an empty one becomes one of text columns, or an error where required."""
    n = table(s, d, "nation").select("n_nationkey", "n_name")
    empty = P.main_or_empty(P.like(n), ["n_nationkey", "n_name"])
    assert empty.dtypes == [("n_nationkey", "string"), ("n_name", "string")] and P.like(n).schema == n.schema
    try:
        P.main_or_empty(P.like(n), [], required=True)
        raise AssertionError("an empty main input must be an error")
    except ValueError:
        return P.main_or_empty(n, []).where("n_nationkey < 3").unionByName(P.like(n))


@query("change_type_fill", "select o_orderkey, 'T24_1TM' as kind from orders")
def _(s, d):
    return D.fill_change_type(table(s, d, "orders").select("o_orderkey"), "kind", "T24_1TM")


# --- casts and dates -------------------------------------------------------------------------------------------------

_WORDS = "case o_orderkey % 4 when 0 then o_orderkey::varchar when 1 then 'x' when 2 then 'true' else '3000000000' end"


def words(s, d):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.col("o_orderkey").cast("string")).when(k == 1, "x").when(k == 2, "true").otherwise("3000000000")
    return table(s, d, "orders").select("o_orderkey", *[text.alias(c) for c in "ilbs"])


@query("cast_scalars", f"""select o_orderkey, coalesce(case when o_orderkey % 4 = 0 then o_orderkey::int end, -1)::int as i, coalesce(try_cast({_WORDS} as bigint), -1)::bigint as l,
  case when o_orderkey % 4 = 2 then 'true' else '' end as b, {_WORDS} as s from orders""")
def _(s, d):
    w = C.cast_to_booleantype(C.cast_to_longtype(C.cast_to_integertype(words(s, d), ["i"]), ["l"]), ["b"])
    w = C.cast_to_stringtype(w, ["s", "b"])
    # a text of one digit other than 0 and 1 is no truth value in either engine
    b = F.when(F.col("o_orderkey") % 4 == 2, F.col("b")).otherwise("")
    return w.withColumn("b", b).fillna(-1, ["i", "l"])


@query("cast_seconds", """select event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as t, epoch(date_trunc('second', ts) - interval 7 hour)::bigint as u, strftime(ts, '%d-%m') as f,
  strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%d') as of_text, strftime(ts, '%Y-%m-%d') as of_time from events""")
def _(s, d):
    ts = F.col("ts").cast("timestamp")
    day = F.date_format(ts, "yyyy/MM/dd")
    e = table(s, d, "events").select(
        "event_id", F.unix_timestamp(ts).alias("t"), F.date_format(ts, "dd/MM/yyyy HH:mm:ss").alias("u"), ts.cast("date").alias("f"),
        day.alias("day"), day.alias("of_text"), ts.alias("of_time"),
    )
    e = C.cast_string_to_unix_timestamp(C.cast_unix_timestamp_to_timestamp(e, ["t"]), ["u"], "dd/MM/yyyy HH:mm:ss")
    e = C.cast_string_to_dateformat(C.cast_string_to_date(e, ["day"], "yyyy/MM/dd"), "dd-MM", column_paterns=["f"])
    return texts(C.da_date(C.da_date(e, ["of_text"], "yyyy/MM/dd"), ["of_time"]))


_DEFAULT = "case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' when 1 then strftime(o_orderdate, '%Y-%m-%d') || 'T10:00:00' when 2 then strftime(o_orderdate, '%-d/%-m/%Y') else year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) end"


@query("dates_of_default_form", """select o_orderkey, case when o_orderkey % 4 = 2 then '' else strftime(o_orderdate, '%Y-%m-%d') end as t, case when o_orderkey % 4 = 2 then '' else strftime(o_orderdate, '%Y%m%d') end as n,
  case when o_orderkey % 4 = 2 then '' else strftime(o_orderdate, '%Y-%m-%d') end as p from orders""")
def _(s, d):
    """Dates with a time and without leading zeros are read by the default form; one-digit days with slashes by none."""
    k, at = F.col("o_orderkey") % 4, F.col("o_orderdate")
    iso = F.date_format(at, "yyyy-MM-dd")
    text = F.when(k == 0, F.concat(iso, F.lit(" 12:30:00"))).when(k == 1, F.concat(iso, F.lit("T10:00:00"))).when(k == 2, F.concat_ws("/", F.dayofmonth(at), F.lit("x"), F.year(at)))
    text = text.otherwise(F.concat_ws("-", F.year(at), F.month(at), F.dayofmonth(at)))
    o = table(s, d, "orders").select("o_orderkey", text.alias("t"))
    o = C.create_partition_by_column(o, [{"type": "date", "source_column": "t", "partition_column": "p"}])
    return texts(C.cast_to_date(o.withColumn("n", dates.date_digits(F.col("t"))), ["t"])).fillna("")


@query("date_parts", """select o_orderkey, year(o_orderdate) || '|' || month(o_orderdate) || '|' || day(o_orderdate) as parts, (o_orderdate::date - date '1998-01-01')::int as diff,
  strftime(o_orderdate - interval 7 hour, '%Y-%m-%d') as part, strftime(o_orderdate + interval 7 hour, '%Y-%m-%d %H:%M:%S') as local from orders""")
def _(s, d):
    at = F.col("o_orderdate").cast("timestamp")
    o = table(s, d, "orders").select(
        "o_orderkey", F.array_join(dates.year_month_day(F.date_format(at, "yyyyMMdd")), "|").alias("parts"),
        dates.day_difference(at.cast("date"), F.lit("1998-01-01").cast("date")).alias("diff"), at.alias("ds_record_created_timestamp"), dates.local_time(at).alias("local"),
    )
    return texts(C.add_partition_date_column(o, "part").drop("ds_record_created_timestamp"))


# --- nested ----------------------------------------------------------------------------------------------------------


@query("json_map_date", "select event_id, strftime(ts, '%Y-%m-%d') as day, coalesce(json_extract_string(props, '$.k'), '') as k from events")
def _(s, d):
    text = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("d")))
    e = N.json_string_to_map_date(table(s, d, "events").select("event_id", text.alias("m"), "props"), ["m"])
    e = N.json_string_to_array_map_string(e, ["props"])
    return texts(e.select("event_id", F.col("m")["d"].alias("day"), F.coalesce(F.get("props", F.lit(0))["k"], F.lit("")).alias("k")))


@query("maps_to_found_columns", "select c_custkey, c_name as a, case when c_custkey % 2 = 0 then c_mktsegment else '' end as b from customer")
def _(s, d):
    """The columns are the keys that the maps hold."""
    one, two = F.create_map(F.lit("a"), F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("b"), F.col("c_mktsegment")))
    return N.maps_to_columns(table(s, d, "customer").select("c_custkey", one.alias("m1"), two.alias("m2")), ["m1", "m2"]).fillna("")


@query("explode_maps_by_dictionary", "select c_custkey, 1 as pos, 1 as sub_pos, c_name as m1, c_mktsegment as m2 from customer union all select c_custkey, 1, 2, c_name, 'y' from customer where c_custkey % 3 = 0")
def _(s, d):
    """The groups of columns come from a dictionary table; rows of other tables, states and groups are left out."""
    key = F.col("c_custkey")
    m2 = F.map_concat(F.create_map(F.lit("1.1"), F.col("c_mktsegment")), F.when(key % 3 == 0, F.create_map(F.lit("1.2"), F.lit("y"))).otherwise(F.create_map().cast("map<string,string>")))
    rows = table(s, d, "customer").select("c_custkey", F.create_map(F.lit("1.1"), F.col("c_name")).alias("m1"), m2.alias("m2"))
    entries = [("T", "Y", "g", None, "M1"), ("T", "Y", "g", "s", "M2"), ("T", "N", "g", None, "m3"), ("U", "Y", "g", None, "m4"), ("T", "Y", "h", None, "m5"), ("T", "Y", "g", "z", "m6")]
    dictionary = s.createDataFrame(entries, "TABLE_NAME string, STATUS string, MULTI_VALUE string, SUB_VALUE string, FIELD_NAME string")
    return N.explode_map_columns(rows, dictionary=dictionary, dictionary_filter={"table_name": "T", "multi_value": "g", "sub_value": "s"})


# --- validations on other types --------------------------------------------------------------------------------------


@query("blank_of_other_types", "select ds_row_id from ds1_job where customer_id is not null or coalesce(arr_id, '') <> '' or ds_load_time is not null")
def _(s, d):
    return V.drop_all_blank(table(s, d, "ds1_job"), ["customer_id", "arr_id", "ds_load_time"]).select("ds_row_id")


@query("numeric_range_of_text", "select p_partkey, case when p_partkey % 3 = 1 and p_size + 0.5 between 10 and 30 then (p_size + 0.5)::varchar else '' end as t from part")
def _(s, d):
    """Texts that read as no number are no valid numbers; fractions are compared as such."""
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, "x").when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    return V.valid_numeric(table(s, d, "part").select("p_partkey", text.alias("t")), ["t"], 10, 30).fillna("", ["t"])


@query("email_top_domains", "select c_custkey, case when c_custkey % 4 in (0, 3) then 'u' || c_custkey || case c_custkey % 4 when 0 then '@bank.co' else '@10.1.2.34' end else '' end as e from customer")
def _(s, d):
    k = F.concat(F.lit("u"), F.col("c_custkey").cast("string"))
    n = F.col("c_custkey") % 4
    e = F.when(n == 0, F.concat(k, F.lit("@Bank.co"))).when(n == 1, F.concat(k, F.lit("@b.c"))).when(n == 2, F.concat(k, F.lit("@bank"))).otherwise(F.concat(k, F.lit("@10.1.2.34")))
    return V.validate_email(table(s, d, "customer").select("c_custkey", e.alias("e")), "e")


# --- masking ---------------------------------------------------------------------------------------------------------


@query("mask_numbers", "select o_orderkey, true as same_size, (o_orderkey + 2000000000)::int as i, o_orderkey * -1000003 as l, (o_totalprice::decimal(12,3))::varchar as m from orders")
def _(s, d):
    """Whole numbers near the end of their type, negative ones and decimals keep their count of digits and come back."""
    plain = table(s, d, "orders").select(
        "o_orderkey", (F.col("o_orderkey") + 2000000000).cast("int").alias("i"), (F.col("o_orderkey") * -1000003).alias("l"), F.col("o_totalprice").cast("decimal(12,3)").alias("m")
    )
    kept = plain.withColumns({f"_{c}": F.length(F.col(c).cast("string")) for c in "ilm"})
    masked = Q.mask_pii(kept, ["i", "l", "m"], key=SECRET)
    same = F.coalesce(F.length(F.col("i").cast("string")) == F.col("_i"), F.lit(False)) & F.coalesce(F.length(F.col("l").cast("string")) == F.col("_l"), F.lit(False)) & F.col("m").isNotNull()
    return texts(Q.unmask_pii(masked.select("o_orderkey", same.alias("same_size"), "i", "l", "m"), ["i", "l", "m"], key=SECRET))


@query("mask_parts", """select c_custkey, '#' || string_split(c_name, '#')[2] as last_kept, string_split(c_name, '#')[1] as first_kept, true as words_apart from customer""")
def _(s, d):
    """Keep-last masks what a pattern finds at the start, keep-first what follows it; texts are masked word by word."""
    c = table(s, d, "customer").select("c_custkey", F.col("c_name").alias("a"), F.col("c_name").alias("b"), F.concat(F.lit("  "), "c_mktsegment", F.lit("   Ab 12 ")).alias("w"))
    c = Q.fpe_mask_pattern(Q.fpe_mask_pattern(c, ["a"], "[^#]+", key=SECRET), ["b"], "[^#]+", keep="first", key=SECRET)
    c = Q.fpe_mask_words(c, ["w"], key=SECRET)
    return c.select("c_custkey", F.concat(F.lit("#"), F.split_part("a", F.lit("#"), F.lit(2))).alias("last_kept"), F.split_part("b", F.lit("#"), F.lit(1)).alias("first_kept"), F.col("w").rlike("^[A-Z]+ [A-Z][a-z] [0-9]{2}$").alias("words_apart"))


# --- jobs ------------------------------------------------------------------------------------------------------------


@query("all_succeeded_on_workday", """with r as (select 'u' || user_id as job_name, ts, case event_type when 'error' then 'FAILED' when 'view' then 'SKIPPED' else 'SUCCEEDED' end as status, event_id from events),
l as (select * from r where status <> 'SKIPPED' qualify row_number() over (partition by job_name order by ts desc, status desc, event_id desc) = 1)
select 'workday' as kind, count(*) filter (status = 'SUCCEEDED') as n from l where job_name in ('u1', 'u2', 'u5') union all select 'other', count(*) filter (status = 'SUCCEEDED') from l where job_name in ('u1', 'u2')""")
def _(s, d):
    """Close-of-business jobs count on workdays only; conditions are tried in order until one fails."""
    one = lambda kind, workday: G.all_succeeded_on(runs(s, d), ["u1", "u2"], ["u5"], workday, "ts").select(F.lit(kind).alias("kind"), F.col("n_succeeded").alias("n"))
    assert G.run_conditions([("a", True, lambda: True), ("b", False, lambda: False), ("c", True, lambda: False), ("d", True, lambda: 1 / 0)]) == (False, "c")
    return one("workday", True).unionByName(one("other", False))


@query("configured_job", "select n_nationkey::int as key, upper(n_name) as \"name\" from nation where n_regionkey = 1")
def _(s, d):
    """A job from one definition: a reader, steps, a validation and a merge target, run twice."""
    path = scratch(s, "job-target")
    config = {
        "input": [{"reader_type": "raw", "name": "n", "uri_list": [f"{d}/nation.parquet"], "serde": {"format": "PARQUET"}}],
        "output": [{
            "name": "out", "input_name": "n",
            "transformations": [
                {"name": "pyspark_df_function", "function_name": "where", "args": ["n_regionkey = 1"]},
                {"name": "apply_mapping", "mappings": [["n_nationkey", "int", "key", "int"], ["n_name", "string", "name", "string"]]},
                {"name": "da_text_with_unicode", "column_patterns": ["name"]},
            ],
            "validations": [{"name": "mandatory_input", "column_patterns": ["name"]}],
            "target": {"path": path, "kind": "replace", "params": {"keys": ["key"]}},
        }],
    }
    for _ in range(2):
        pipeline.run(s, pipeline.parse(config))
    from brookweave.sources.tables import VersionedTable

    return VersionedTable(s, path).read()


# --- streams ---------------------------------------------------------------------------------------------------------


def _event_stream(s, d):
    return s.readStream.schema(table(s, d, "events").schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(s, stream, label, mode="append") -> DataFrame:
    """What a stream gives once it has read all there is."""
    out, mark = scratch(s, label), scratch(s, f"{label}-checkpoint")
    keep = lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")
    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return s.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


@query("stream_sessions", """with e as (select user_id, ts, case when ts < lag(ts) over w + interval 6 hour then 0 else 1 end as st from events window w as (partition by user_id order by ts)),
  g as (select user_id, ts, sum(st) over (partition by user_id order by ts rows unbounded preceding) as g from e)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, count(*) as n from g group by user_id, g""")
def _(s, d):
    counts = microbatch.session_counts(_event_stream(s, d), "ts", "6 hours", "40 days", ["user_id"])
    out = _drained(s, counts, "sessions", "complete")
    return out.select("user_id", F.date_format("session.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("stream_dedup", "select event_type, count(distinct user_id) as n from events group by 1")
def _(s, d):
    """One row per user and type: all rows lie within the watermark."""
    out = _drained(s, microbatch.deduplicated(_event_stream(s, d), "ts", "40 days", ["user_id", "event_type"]), "dedup")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_join", "select a.event_id, b.event_id as next_id from events a join events b on a.user_id = b.user_id and b.ts between a.ts and a.ts + interval 2 hour where a.event_type = 'signup' and b.event_type = 'purchase'")
def _(s, d):
    left = _event_stream(s, d).where("event_type = 'signup'").select("user_id", "event_id", "ts")
    right = _event_stream(s, d).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("next_id"), F.col("ts").alias("next_ts"))
    return _drained(s, microbatch.joined_within(left, right, ["user_id"], "ts", "next_ts", "40 days", "2 hours"), "joined").select("event_id", "next_id")


@query("stream_rate", "select 10 as n, 45 as total, 1 as hours")
def _(s, d):
    """A rate source whose rows come in fixed batches, with ingest columns of the processing time."""
    rows = s.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).option("startTimestamp", 0).load()
    out, mark = scratch(s, "rate"), scratch(s, "rate-checkpoint")
    started = microbatch.run_stream(rows, microbatch.parquet_sink(out), mark, interval="0 seconds")
    while not started.recentProgress:
        started.processAllAvailable() if False else started.awaitTermination(0.2)
    started.stop()
    first = s.read.parquet(f"{out}/batch=0")
    stamp = F.concat_ws("-", *[F.col(c).cast("string") for c in microbatch.INGEST])
    return first.agg(F.count(F.lit(1)).cast("int").alias("n"), F.sum("value").cast("int").alias("total"), F.countDistinct(stamp).cast("int").alias("hours"))
