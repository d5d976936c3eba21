"""General operators on inline rows: nulls, blanks, bad values, ties, clashing names; merges by their invariants."""

import datetime as dt
import json
import uuid
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookweave import columns, registry
from brookweave.functions import dates
from brookweave.functions.ids import uuid5
from brookweave.operators import casting, dedupe, joins, jobs, masking, merge, projections, reshaping, textual, validations
from brookweave.plans import catalogue, pipeline
from brookweave.sources import readers, sinks, tables
from brookweave.streaming import microbatch


def one(df):
    return [tuple(r) for r in df.collect()]


def test_columns_are_picked_in_schema_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b_x int, a_x int, `c.d` int")
    assert columns.pick(df, [".*_x"]) == ["b_x", "a_x"] and columns.pick(df, ["none"]) == []
    assert one(columns.apply(df, [r"c\.d"], lambda c: c + 1)) == [(1, 2, 4)]


def test_pipeline_refuses_bad_steps(spark):
    df = spark.range(1)
    for step in ({"name": "nope"}, {"name": "cast", "column_patterns": [], "target_type": "int", "x": 1}, {"name": "cast"}):
        with pytest.raises(ValueError):
            registry.run_pipeline(df, [step])
    with pytest.raises(ValueError):
        projections.pyspark_df_function(df, "write")
    named = registry.run_pipeline(spark.createDataFrame([("ab", 1)], "a string, b int"), [{"name": "calculate_hash_index", "exclusive_columns": ["b"]}, {"name": "mark_by_substring", "fields_lst": ["a"], "index": "1:"}])
    assert one(named.select("a")) == [("b",)] and len(named.first().hash_index) == 64
    operators, rules = registry.names()
    assert len(operators) > 90 and "valid_mnemonic" in rules


@pytest.mark.parametrize("name, wanted", [("CustomerID", "customer_id"), ("already_snake", "already_snake"), ("Full-Name", "full_name"), ("aB", "a_b")])
def test_snake(name, wanted):
    assert projections.snake(name) == wanted


def test_casts_give_null_not_errors(spark):
    df = spark.createDataFrame([("x", "1,234.5", "TRUE", "[a, b]"), (None, None, None, None), ("7", "1", "f", "")], "i string, d string, b string, a string")
    out = casting.cast_to_integertype(df, ["i"])
    out = casting.boolean_to_int(casting.cast_to_arraytype(casting.cast_to_decimaltype(out, ["d"], 10, 2), ["a"]), "b")
    rows = one(out)
    assert [r[0] for r in rows] == [None, None, 7] and str(rows[0][1]) == "1234.50" and rows[0][3] == ["a", " b"]
    assert [r[2] for r in rows] == [1, None, None]


@pytest.mark.parametrize(
    "value, wanted",
    [("2024-01-31", "2024-01-31"), ("03/04/2024", "2024-04-03"), ("13/12/2024", "2024-12-13"), ("12/13/2024", "2024-12-13"), ("20240131", "2024-01-31"), ("31-12-24", "2024-12-31"), ("junk", None), ("", None), (None, None)],
)
def test_dates_of_unknown_form(spark, value, wanted):
    df = spark.createDataFrame([(value,)], "t string").select(dates.parse_date(F.col("t")).cast("string"))
    assert one(df) == [(wanted,)]


def test_cast_to_date_of_nested_values(spark):
    df = spark.createDataFrame([(["2024-01-02", "x"], {"k": "01/02/2024"})], "a array<string>, m map<string,string>")
    assert one(casting.cast_to_date(df, ["a", "m"])) == [([dt.date(2024, 1, 2), None], {"k": dt.date(2024, 2, 1)})]
    with pytest.raises(TypeError):
        casting.cast_to_date(spark.range(1), ["id"])


def test_uuid5_is_the_standard_one(spark):
    names = ["", "a", "Đặng 🙂", "x" * 300]
    got = [r[0] for r in one(spark.createDataFrame([(n,) for n in names], "s string").select(uuid5(F.col("s"))))]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_OID, n)) for n in names]
    assert one(spark.createDataFrame([(None,)], "s string").select(uuid5(F.col("s")))) == [(None,)]


def test_text_operators(spark):
    df = spark.createDataFrame([("  Nguyễn   Văn Đ ", ["ơ", None], {"k": "Ư"})], "t string, a array<string>, m map<string,string>")
    assert one(textual.da_text_non_unicode(df, ["t", "a", "m"])) == [("NGUYEN VAN D", ["O", None], {"k": "U"})]
    h = textual.calculate_hash_index(spark.createDataFrame([("a", None), (None, "a")], "x string, y string"))
    assert len({r.hash_index for r in h.collect()}) == 1  # nulls are skipped
    assert len(textual.ACCENTED) == len(textual.PLAIN)


def test_validations(spark):
    df = spark.createDataFrame([("AB1", 5), ("A1", 500), ("ABCDEFGHIJK", None), ("ab1", 1), ("A.B", 9), (None, 3)], "m string, n int")
    assert [r.m for r in validations.valid_mnemonic(df, ["m"]).collect()] == ["AB1", "A.B"]
    assert [r.n for r in validations.valid_numeric(df, ["n"], max_value=10).collect()] == [5, None, None, 1, 9, 3]
    assert validations.valid_numeric(df, ["n"], 2, 10, True).count() == 3
    with pytest.raises(ValueError):
        validations.valid_numeric(df, ["n"])
    ids = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert one(validations.remove_duplicate_customer_id(ids, ["id"])) == [(2,)]
    phones = spark.createDataFrame([(["(+84) 91", "abc", None],), (None,)], "p array<string>")
    assert one(validations.valid_phone_number(phones, ["p"])) == [(["8491", None, None],), (None,)]
    assert validations.filter_with_regex_pattern(df, "m", "A", inverse=True).count() == 1


def test_top_one_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, "c"), (None, 1, "d")], "k int, o int, v string")
    for rows in (df, df.orderBy(F.desc("v"))):
        assert sorted(one(dedupe.drop_duplicate_primarykey_order_by(rows, ["k"], "o")), key=str) == [(1, 5, "b"), (2, None, "c"), (None, 1, "d")]


def test_explode_maps(spark):
    df = spark.createDataFrame([(1, {"1.1": "a", "2.1": "b"}, {"1.1": "x", "1.2": " "}), (2, None, None)], "id int, m map<string,string>, s map<string,string>")
    out = reshaping.explode_map_columns(df, {"multi_cols": ["m"], "sub_multi_cols": ["s"]})
    assert {(r.id, r.pos, r.sub_pos, r.m, r.s) for r in out.collect()} == {(1, 1, 1, "a", "x"), (1, 2, 1, "b", None), (1, 1, 2, "a", " "), (2, None, None, None, None)}
    assert reshaping.explode_map_columns(df, {"multi_cols": ["m"]}, drop_nulls=True).count() == 2
    d = spark.createDataFrame([("T", "Y", "G", None, "M"), ("T", "Y", "G", "S", "S"), ("T", "N", "G", None, "Z"), ("U", "Y", "G", None, "Q")], "TABLE_NAME string, status string, multi_value string, sub_value string, field_name string")
    groups = reshaping.dictionary_groups(d, "T", "G", "S")
    assert groups == {"multi_cols": ["m"], "sub_multi_cols": ["s"]}
    details = {"table": "dic", "t24_table_name": "T", "multi_value_group": "G", "sub_value_group": "S", "columns_selection": ["m"]}
    step = {"name": "explode_map_columns", "use_groupings_from_tbl_dic_t24": True, "tbl_dic_t24_load_details": details}
    assert registry.run_pipeline(df, [step], context={"tables": {"dic": d}}).where("id = 1").count() == 2
    assert reshaping.explode_map_columns(df, dictionary=d, dictionary_filter={"table_name": "T", "multi_value": "G"}).count() == 4


def test_lineage_rows(spark):
    doc = {"job": "j", "description": "", "logics": [{"inputs": [{"database": "d", "table": "t", "path": "p", "source": "s", "columns": ["a", "b"]}], "output": {"database": "d", "table": "o", "column": "c", "path": "p", "source": "s"}}]}
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(doc)]))
    rows = reshaping.lineage_rows(df)
    assert [r.input_column for r in rows.orderBy("column_pos").collect()] == ["a", "b"]
    assert len(reshaping.lineage_paths(rows).first().src_path) == 2


# --- merges ----------------------------------------------------------------------------------------------------------


def test_scd2_invariants(spark, sf):
    target, snapshot = catalogue.scd2_target(spark, sf), catalogue.scd2_snapshot(spark, sf)
    keys = ["c_custkey", "src"]
    once = merge.scd2_merge(target, snapshot, keys, "2022-04-24").cache()
    open_ = once.where("rec_st = 1").groupBy(*keys).count()
    assert open_.where("count > 1").count() == 0 and open_.count() == snapshot.count()
    twice = merge.scd2_merge(once, snapshot, keys, "2022-04-24")
    assert once.exceptAll(twice).count() == 0 and twice.count() == once.count()
    # a closed version ends where its successor begins
    closed = once.where("rec_st = 0").alias("a").join(once.where("rec_st = 1").alias("b"), keys)
    assert closed.where("a.end_dt <> b.eff_dt").count() == 0
    empty = merge.scd2_merge(target.where("false"), snapshot, keys, "2022-04-24")
    assert empty.count() == snapshot.count()
    assert merge.scd2_merge(target, snapshot.where("false"), keys, "2022-04-24").where("rec_st = 1").count() == 0


def test_scd2_null_equals_blank_and_repeated_keys_fail(spark):
    d = dt.date
    target = spark.createDataFrame([(1, None, d(2020, 1, 1), d(3000, 11, 8), 1, d(2020, 1, 1))], "k int, v string, eff_dt date, end_dt date, rec_st int, ppn_dt date")
    same = spark.createDataFrame([(1, "")], "k int, v string")
    assert merge.scd2_merge(target, same, ["k"], "2021-01-01").count() == 1
    assert merge.scd2_merge(target, same, ["k"], "2021-01-01", null_safe=True).count() == 2
    with pytest.raises(Exception, match="more than once"):
        merge.scd2_merge(target, same.union(same), ["k"], "2021-01-01").count()
    nulls = spark.createDataFrame([(None, "x"), (None, "y"), (1, "")], "k int, v string")
    assert merge.scd2_merge(target, nulls, ["k"], "2021-01-01").count() == 3


def test_scd4_revives_and_base_keeps_status(spark):
    d = dt.date(2020, 1, 1)
    t = spark.createDataFrame([(1, "a", 0, d), (2, "b", 1, d), (3, "c", 1, d)], "k int, v string, rec_st int, ppn_dt date")
    s = spark.createDataFrame([(1, "a"), (2, "b"), (4, "n")], "k int, v string")
    got = {(r.k, r.rec_st, str(r.ppn_dt)) for r in merge.scd4_current(t, s, ["k"], "2021-01-01").collect()}
    assert got == {(1, 1, "2021-01-01"), (2, 1, "2020-01-01"), (3, 0, "2021-01-01"), (4, 1, "2021-01-01")}


def test_golden_joins_are_no_ops_without_golden(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    empty = df.where("false")
    assert joins.left_join_with_golden_if_existed(df, {"g": empty}, "g", ["k"], ["k_2"]).columns == ["k", "v"]
    joined = joins.left_join_with_golden_if_existed(df, {"g": df}, "g", ["k"], ["k_2"])
    assert joined.columns == ["k", "v", "k_2", "v_2"]
    assert joins.union_with_golden_if_existed(df, {}, "g").count() == 1


# --- masking ---------------------------------------------------------------------------------------------------------

KEY = b"test key"


@pytest.mark.parametrize("text", ["", "a", "Z", "7", "hello World 2024", "0912345678", "đặc biệt", "A1b2C3", "9" * 40])
def test_masking_keeps_shape_and_inverts(text):
    masked = masking.mask_value(KEY, text)
    kind = lambda c: next((i for i, (b, n) in enumerate(masking.CLASSES) if ord(b) <= ord(c) < ord(b) + n), c)
    assert [kind(c) for c in masked] == [kind(c) for c in text]
    assert masking.mask_value(KEY, masked, back=True) == text and masking.mask_value(KEY, text) == masked


def test_masking_is_a_permutation_and_keyed():
    assert len({masking.mask_value(KEY, f"{i:03d}") for i in range(1000)}) == 1000
    assert masking.mask_value(KEY, "123456789012") != masking.mask_value(b"other", "123456789012")
    assert masking.mask_phone_value(KEY, "(+84) 912345678").startswith("(+84) 91")
    assert masking.mask_phone_value(KEY, "0912345678")[:3] == "091"
    assert masking.mask_email_value(KEY, "me@x.example").endswith("@x.example")
    assert masking.mask_date_value(KEY, "2024-02-29", "%Y-%m-%d")[:7] == "2024-02" and masking.mask_date_value(KEY, "bad", "%Y-%m-%d") is None
    assert masking.mask_value(KEY, None) is None


def test_masking_columns(spark):
    df = spark.createDataFrame([(12, "ab", ["x1", None], {"k": "v9"}), (None, None, None, None)], "n bigint, s string, a array<string>, m map<string,string>")
    masked = masking.mask_pii(df, [".*"], key=KEY)
    assert masked.dtypes == df.dtypes
    assert one(masking.unmask_pii(masked, ["s", "a", "m"], key=KEY).select("s", "a", "m")) == one(df.select("s", "a", "m"))
    with pytest.raises(ValueError):
        masking.mask_pii(df, [".*"])


# --- sources, sinks, streams -----------------------------------------------------------------------------------------


def test_csv_projection(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id;name;at\n 1 ;"a;b";2024-01-01 00:00:00\nx;;\n', encoding="utf-8")
    schema = [{"name": "id", "type": "int"}, {"name": "name"}, {"name": "at", "type": "timestamp"}]
    spec = readers.Input("raw", uri_list=[str(tmp_path)], serde=readers.Serde("CSV", delimiter=";"), schema=schema)
    assert one(readers.read(spark, spec)) == [(1, "a;b", dt.datetime(2024, 1, 1, 7)), (None, None, None)]


def test_readers_guard_missing_inputs(spark, tmp_path):
    spec = lambda **k: readers.Input("raw", uri_list=[str(tmp_path / "none")], serde=readers.Serde("PARQUET"), **k)
    assert readers.read(spark, spec(empty_allow=True)) is None
    with pytest.raises(FileNotFoundError):
        readers.read(spark, spec())
    for bad in ({"reader_type": "nope"}, {"reader_type": "raw", "uri_list": ["a"], "entry_file": "b"}):
        with pytest.raises(ValueError):
            readers.Input(**bad)


def test_tax_files(spark, tmp_path):
    paper = "<ROW_GIAYTO><LOAI_GIAYTO>2</LOAI_GIAYTO><TEN_LOAI_GIAYTO>ID</TEN_LOAI_GIAYTO><SO_GIAYTO>9</SO_GIAYTO></ROW_GIAYTO>"
    rows = f"<ROW_CTIET><STT>1</STT><MST>m</MST><TTIN_GIAYTO>{paper}</TTIN_GIAYTO></ROW_CTIET><ROW_CTIET><STT>2</STT></ROW_CTIET>"
    (tmp_path / "t.xml").write_text(f"<D><ND_DS_NNT><ND_DS_CTIET>{rows}</ND_DS_CTIET></ND_DS_NNT></D>")
    got = readers.read(spark, readers.Input("xml_tax", entry_file=str(tmp_path / "t.xml"))).orderBy("STT").collect()
    assert (got[0].SO_GIAYTO_2, got[0].SO_GIAYTO_1, got[1].SO_GIAYTO_2, len(got[0])) == ("9", "", "", 21)


def test_writers(spark, tmp_path):
    df = spark.range(10).withColumn("p", (F.col("id") % 2).cast("int"))
    with pytest.raises(ValueError):
        sinks.write_files(df, str(tmp_path / "a"), "overwrite_partition")
    sinks.write_files(df, str(tmp_path / "a"), "overwrite", ["p"], max_records_per_file=2)
    sinks.write_files(df.where("p = 1").limit(1), str(tmp_path / "a"), "overwrite_partition", ["p"])
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6
    assert sinks.sized(df, 3).rdd.getNumPartitions() == 4 and sinks.sized(df, 100).rdd.getNumPartitions() == 1


def test_stream_restart_repeats_nothing(spark, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    spark.range(5).write.parquet(source)

    def go():
        stream = spark.readStream.schema("id bigint").parquet(source)
        microbatch.run_stream(stream, microbatch.parquet_sink(out), mark, interval=None).awaitTermination()
        return spark.read.parquet(out).count()

    assert go() == 5 and go() == 5
    spark.range(5, 8).write.mode("append").parquet(source)
    assert go() == 8


def test_configured_job(spark, tmp_path):
    spark.createDataFrame([(1, " a "), (2, None)], "id int, Name string").write.parquet(str(tmp_path / "in"))
    config = {
        "input": [{"name": "x", "reader_type": "raw", "uri_list": [str(tmp_path / "in")], "serde": {"format": "PARQUET"}}],
        "output": [{
            "name": "o", "input_name": "x", "target": {"path": str(tmp_path / "out"), "mode": "overwrite"},
            "transformations": [{"name": "snake_case_column_name", "column_patterns": [".*"]}, {"name": "add_constant_column_from_cob_date", "column_name": "cob"}],
            "validations": [{"name": "mandatory_input", "column_patterns": ["name"]}],
        }],
        "cob_date": "20240131",
    }
    pipeline.run(spark, pipeline.parse(json.dumps(config)))
    assert one(spark.read.parquet(str(tmp_path / "out"))) == [(1, " a ", "2024-01-31")]


def test_job_conditions(spark):
    assert jobs.run_conditions([("a", True, lambda: True), ("b", False, lambda: False), ("c", True, lambda: False)]) == (False, "c")
    wt = spark.createDataFrame([("x", "g", "S.a"), ("x", "g", None), ("y", "g", "S.a")], "job_name string, job_grp string, job_dependency string")
    lg = spark.createDataFrame([(1, "S", "a", dt.date(2024, 1, 1))], "status int, system_type string, job_name string, cob_dt date")
    assert one(jobs.available_jobs(wt, lg, "g", "2024-01-01")) == [("y",)]


def test_versioned_table(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ValueError):
        t.read()
    assert t.merge(df, "replace") == 1
    assert t.merge(df.where("k = 1").withColumn("v", F.lit("z")), "replace", keys=["k"]) == 2
    spark.range(3).write.parquet(str(tmp_path / "t" / "v=3"))
    (tmp_path / "t" / "v=3" / "_SUCCESS").unlink()  # a version that was never completed
    assert sorted(one(t.read())) == [(1, "z"), (2, "b")] and sorted(one(t.read(1))) == [(1, "a"), (2, "b")]
    assert t.merge(df, "replace", keys=["k"]) == 3 and t.versions() == [1, 2, 3]
    t.vacuum()
    assert t.versions() == [3]
    with pytest.raises(ValueError):
        t.merge(df, "nope")
    assert tables.data_columns(df.withColumn("ds_cdc_index", F.lit(1)), "scd2") == ["k", "v"]


def test_job_queries_read_every_line(spark, sf):
    wt, _ = catalogue.job_tables(spark, sf)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_linestatus").distinct()
    assert wt.count() == lines.count()
    for name in ("jobs_available", "jobs_available_waiting"):
        assert catalogue.QUERIES[name](spark, sf).count() > 0
        assert "%" not in catalogue.SQL[name]


def test_pipeline_reads_every_order(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = {r.order_key for r in catalogue.QUERIES["pipeline_fold"](spark, sf).collect()}
    assert got == {r.o_orderkey for r in orders.collect() if 1000 <= r.o_totalprice <= 450000}
    assert 0.8 * orders.count() < len(got) < orders.count() and min(got) < 100


# --- values of odd forms ---------------------------------------------------------------------------------------------


def test_masked_numbers_keep_their_kind():
    from brookweave.operators.masking import mask_decimal, mask_number

    for top in (2**31 - 1, 2**63 - 1):
        values = [0, 1, 9, 10, 99, 1000, 1234567890, 1100000000, 2000000000, 2**31 - 1, -1, -9, -10, -(2**31), top, -top - 1]
        masks = [mask_number(b"k", v, top) for v in values]
        for v, m in zip(values, masks):
            assert len(str(m)) == len(str(v)) and (m < 0) == (v < 0) and -top - 1 <= m <= top
            assert mask_number(b"k", m, top, back=True) == v
    assert len({mask_number(b"k", v, 2**31 - 1) for v in range(100, 1000)}) == 900
    for text, scale in (("12.340000", 6), ("-0.05", 2), ("0E-8", 8), ("0.000000", 6), ("123", 0), ("-7", 0)):
        masked = mask_decimal(b"k", text, scale)
        assert float(mask_decimal(b"k", masked, scale, back=True)) == float(text) and len(masked.partition(".")[2]) == scale


def test_masked_columns_of_numbers(spark):
    from brookweave.operators.masking import mask_pii, unmask_pii

    df = spark.createDataFrame([(1, 2000000000, -5), (2, 1234567890, 2**63 - 1), (3, None, None)], "id int, i int, l bigint")
    masked = mask_pii(df, ["i", "l"], key="k")
    assert masked.dtypes == df.dtypes and masked.where("id < 3 and (i is null or l is null)").count() == 0
    assert sorted(unmask_pii(masked, ["i", "l"], key="k").collect()) == sorted(df.collect())


def test_numbers_masked_by_the_batch_are_those_masked_one_by_one(monkeypatch):
    values = [0, 1, -1, 9, -9, 10, 99, 12345678, 2000000000, 2**31 - 1, -(2**31), 10**12, 10**13 - 1, -(10**17), 10**18 - 1, 10**18, 2**63 - 1, -(2**63)]
    for top in (2**31 - 1, 2**63 - 1):
        held = [v for v in values if -top - 1 <= v <= top]
        for back in (False, True):
            for key in (b"k", b"long" * 20):
                assert masking.mask_numbers(key, np.array(held), top, back).tolist() == [masking.mask_number(key, v, top, back) for v in held]
    # numbers near the end of int are permuted nine times on the average: the shifts of the halves are made once
    made = []
    monkeypatch.setattr(masking, "_prfs", lambda key, tag, halves, m, f=masking._prfs: made.append(len(halves)) or f(key, tag, halves, m))
    numbers = np.arange(2_000_000_000, 2_000_040_000)
    for _ in range(2):
        assert (masking.mask_numbers(b"new", masking.mask_numbers(b"new", numbers, 2**31 - 1), 2**31 - 1, back=True) == numbers).all()
    assert sum(made) <= 10 * 10**5


def test_masked_decimals_of_any_precision(spark):
    """Beside the plain function, null, least and longest values too, with ANSI mode on and off."""
    kinds = {"a": (12, 3), "b": (18, 18), "c": (18, 0), "d": (21, 6), "e": (38, 10), "f": (38, 38)}
    texts = {n: [None, "0", f"{'0.' if s else ''}{'0' * max(s - 1, 0)}1", "-" + "9" * (p - s) + ("." + "9" * s if s else ""), "-" + ("." if s else "") + "5" * (s or 1)] for n, (p, s) in kinds.items()}
    df = spark.createDataFrame([(k, *[texts[n][k] for n in kinds]) for k in range(5)], "k int, " + ", ".join(f"{n} string" for n in kinds))
    df = df.withColumns({n: F.col(n).cast(f"decimal({p},{s})") for n, (p, s) in kinds.items()})
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            m = masking.mask_pii(df, list(kinds), key=KEY)
            plain, masked, back = (
                [{n: v if v is None else f"{Decimal(v):f}" for n, v in r.asDict().items()} for r in x.orderBy("k").select([F.col(n).cast("string").alias(n) for n in kinds]).collect()]
                for x in (df, m, masking.unmask_pii(m, list(kinds), key=KEY))
            )
            assert m.dtypes == df.dtypes and back == plain
            assert masked == [{n: v if v is None else masking.mask_decimal(KEY, v, kinds[n][1]) for n, v in r.items()} for r in plain]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_kept_parts_and_words():
    from brookweave.operators.masking import keep_first, keep_last, mask_words

    assert keep_last(b"k", "ab@cd", "[^@]+")[2:] == "@cd" and keep_last(b"k", "ab@cd", "[^@]+")[:2] != "ab"
    assert keep_first(b"k", "+84 12345", r"\+\d\d")[:3] == "+84"
    assert keep_first(b"k", "12345", r"\+\d\d") != "12345" and keep_last(b"k", None, ".") is None
    assert len(mask_words(b"k", "  ab  cd ").split(" ")) == 2 and mask_words(b"k", None) is None


def test_snake_case():
    from brookweave.operators.projections import snake

    cases = {
        "CustomerKey": "customer_key", "customerKey": "customer_key", "HTTPServer": "http_server", "userID": "user_id", "userID2Name": "user_id2_name",
        "Full-Name": "full_name", "full name": "full_name", " A  B ": "a_b", "already_snake": "already_snake", "ABC": "abc", "aBC": "a_bc", "x2Y": "x2_y",
        "": "", "-": "", "Ngày-Sinh": "ngày_sinh", "My_Name": "my__name",
    }
    assert {k: snake(k) for k in cases} == cases


def test_validations_on_other_types(spark):
    import datetime as dt

    from brookweave.operators import validations as V

    df = spark.createDataFrame([(1, None, None, ""), (2, 5, None, ""), (3, None, dt.date(2024, 1, 1), None), (4, None, None, "x")], "id int, n bigint, d date, t string")
    assert {r.id for r in V.drop_all_blank(df, ["n", "d", "t"]).collect()} == {2, 3, 4}
    texts = spark.createDataFrame([("x",), ("5.5",), ("11",), (None,), (" 7 ",)], "v string")
    assert {r.v for r in V.valid_numeric(texts, ["v"], 5, 10, True).collect()} == {"5.5", " 7 "}
    assert [r.v for r in V.valid_numeric(texts, ["v"], max_value=10).where("v is not null").collect()] == ["5.5", " 7 "]
    mails = ["A-b@C.com", "a@b.c", "a@b", "no", None, "(Some Name) a@x.vn", "a b@x.org"]
    got = [r.e for r in V.validate_email(spark.createDataFrame([(m,) for m in mails], "e string"), "e").collect()]
    assert got == ["a_b@c.com", "", "", "", "", "(some name) a@x.vn", "a b@x.org"]


def test_dates_of_unknown_form(spark):
    from brookweave.functions import dates

    cases = {
        "2024-01-05": "20240105", "2024-01-05 12:30:00": "20240105", "2024-01-05T10:00:00": "20240105", "2024-1-5": "20240105", "2024-03": "20240301",
        "03/04/2024": "20240403", "31/12/24": "20241231", "12/31/2024": "20241231", "20240131": "20240131", "31122024": "20241231", "240131": "20240131",
        "2024/01/05": "20240105", "5-1": None, "garbage": None, "": None, "2024-13-01": None,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string").withColumn("got", dates.date_digits(F.col("t")))
    assert [(r.t, r.got) for r in df.collect() if r.got != r.want] == []


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from brookweave import session

    def other(master, held=None, conf=None):
        context = SimpleNamespace(applicationId=f"app-{master}", master=master, getCheckpointDir=lambda: held)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf), sparkContext=context)

    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"):
        with pytest.raises(RuntimeError):
            session.checkpoint_root(other(master))
        assert session.checkpoint_root(other(master, held="hdfs:/ck/1")) == "hdfs:/ck/1"
        assert session.checkpoint_root(other(master, conf="file:///shared/")) == "file:///shared"


def test_repeated_source_keys_fail_and_null_keys_do_not(spark):
    from brookweave.operators.merge import unique_keys

    rows = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (None, "a", "y"), (None, "a", "z")], "k int, l string, v string")
    assert unique_keys(rows, ["k", "l"]).count() == 4 and unique_keys(rows, ["k", "l"]).columns == ["k", "l", "v"]
    with pytest.raises(Exception, match="more than once"):
        unique_keys(rows, ["k"]).collect()


def test_targets_are_checked_before_a_job_runs():
    from brookweave.plans import pipeline

    output = lambda target: pipeline.Output("o", input_name="i", target=target)
    output({"path": "p", "kind": "replace", "params": {"keys": ["k"]}})
    for target in ({"path": "p", "kind": "none"}, {"path": "p", "kind": "scd2", "params": {"keys": ["k"]}}, {"kind": "replace", "params": {"keys": ["k"]}}):
        with pytest.raises(ValueError):
            output(target)


def test_found_keys_are_bounded_and_payload_fields_are_settled(spark):
    from brookweave.operators import reshaping as N

    df = spark.createDataFrame([(1, {"b": "1", "a": "2"}), (2, None)], "id int, m map<string,string>")
    assert N.maps_to_columns(df, ["m"]).columns == ["id", "a", "b"]
    with pytest.raises(ValueError):
        N.maps_to_columns(df, ["m"], most_keys=1)
    p = spark.createDataFrame([(1, '{"x": {"f": "1"}, "y": {"f": "2"}}'), (2, '{"x": {"f": "1"}}')], "KAFKA_OFFSET int, p string")
    assert [tuple(r) for r in N.extract_json_payload(p, "p", fields=["f"]).collect()] == [(1, "2")]


def test_versions_of_partition_kinds_write_their_partitions_only(spark):
    import os

    from brookweave.session import scratch

    path = scratch(spark, "parts")
    t = tables.VersionedTable(spark, path)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, y int, v string")
    t.merge(rows((1, 2020, "a"), (2, 2021, "a"), (3, None, "a"), (4, 2022, "a")), "fact_periodic", partition="y")
    t.merge(rows((5, 2021, "b"), (6, None, "b")), "fact_periodic", partition="y")
    assert sorted(f for f in os.listdir(f"{path}/v=2") if f.startswith("y=")) == ["y=2021", "y=__HIVE_DEFAULT_PARTITION__"]
    want = {(1, 2020, "a"), (5, 2021, "b"), (6, None, "b"), (4, 2022, "a")}
    assert {(r.k, r.y, r.v) for r in t.read().collect()} == want and t.read().columns == ["k", "v", "y"]
    t.merge(rows((4, 2022, "c"), (7, 2022, "c"), (7, 2022, "c")), "fact_dedup", keys=["k"], partition="y")
    want = want - {(4, 2022, "a")} | {(4, 2022, "c"), (7, 2022, "c")}
    assert {(r.k, r.y, r.v) for r in tables.VersionedTable(spark, path).read().collect()} == want and t.read().count() == 5
    # a version that failed half way left a note and files: the next one replaces them
    t._noted(4, {"base": 1, "partition": "y", "replaced": ["2020"], "schema": {}, "depth": 9})
    assert t.versions() == [1, 2, 3]
    t.vacuum()
    assert t.versions() == [1, 2, 3]
    t.CHAIN = 2
    t.merge(rows((8, 2023, "d")), "fact_periodic", partition="y")
    want |= {(8, 2023, "d")}
    assert {(r.k, r.y, r.v) for r in t.read().collect()} == want and t.note(4) is None
    t.vacuum()
    assert t.versions() == [4] and {(r.k, r.y, r.v) for r in t.read().collect()} == want


@pytest.mark.parametrize("kind", ["timestamp", "date", "int", "struct"])
def test_neighbours_of_a_key_against_a_loop(spark, kind):
    import random

    from brookweave.operators.chains import neighbours

    rng = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    times = {"timestamp": lambda n: t0 + dt.timedelta(hours=5 * n), "date": lambda n: t0.date() + dt.timedelta(days=n), "int": lambda n: n, "struct": lambda n: (t0 + dt.timedelta(hours=5 * n), n)}
    n_of = list(range(120))
    rng.shuffle(n_of)
    # one key has most rows, one is null; an order is null
    rows = [(rng.choice(["hot"] * 6 + ["b", None]), times[kind](n), n) for n in n_of] + [("b", None, -1)]
    sql = {"timestamp": "timestamp", "date": "date", "int": "int", "struct": "struct<t:timestamp,i:int>"}[kind]
    df = spark.createDataFrame(rows, f"k string, at {sql}, n int")
    got = {r.n: (r.prev, r.next) for r in neighbours(df, ["k"], "at", after={"next": F.col("n")}, before={"prev": F.col("n")}).collect()}
    by = {}
    for k, _, n in sorted(rows, key=lambda r: r[2]):
        by.setdefault(k, []).append(n)
    want = {n: (ns[i - 1] if i else None, ns[i + 1] if i + 1 < len(ns) else None) for ns in by.values() for i, n in enumerate(ns)}
    assert got == want
    assert neighbours(df.where("false"), ["k"], "at", after={"next": F.col("n")}).count() == 0
