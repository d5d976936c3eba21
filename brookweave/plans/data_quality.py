"""Queries of problems 1 to 6 over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.functions.scalars import as_number_text, blank_to_null
from brookweave.operators import deletion_vectors, flatten, history, orphans, profile, snapshots
from brookweave.session import scratch, table

JOB_COLUMNS = (
    profile.ProfiledColumn("cls_bal_lcy", "number", low=-1e12, high=1e13),
    profile.ProfiledColumn("ccy_code", "category", pattern="[A-Z]{3}"),
    profile.ProfiledColumn("amount_ind", "category", allowed=(0, 1, 2)),
)
SNAPSHOT_FIELDS = ("fn", "active", "club_member_status", "fashion_news_frequency")
FEED_FIELDS = ("from_date", "to_date", "repayment_rate", "repayment_type")


def job_profile(spark: SparkSession, sf: str, row_id: str | None = None) -> DataFrame:
    jobs = table(spark, sf, "ds1_job").select("ds_row_id", "ds_time_id", "ds_source", *[c.name for c in JOB_COLUMNS])
    return profile.quality_profile(jobs, period="ds_time_id", source="ds_source", row_id=row_id, columns=JOB_COLUMNS)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return profile.quality_issues(job_profile(spark, sf), "ds_time_id", "ds_source")


def p1_profile(spark: SparkSession, sf: str) -> DataFrame:
    return job_profile(spark, sf).select(
        "ds_time_id", "ds_source", "col_name", "n_rows", "n_missing", "n_invalid",
        F.coalesce("n_distinct", F.lit(-1)).alias("n_distinct"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("least", "greatest")],
    )


def p1_pointed(spark: SparkSession, sf: str) -> DataFrame:
    """The loads that the two-sample test tells from their peers, with the columns that it points at."""
    return job_profile(spark, sf, row_id="ds_row_id").where("pointed").select("ds_time_id", "ds_source", "col_name")


def customer_states(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "read_dfs")
    attributes = {
        f: as_number_text(F.col(f)) if f in ("fn", "active") else blank_to_null(F.col(f)) for f in SNAPSHOT_FIELDS
    }
    return snapshots.snapshot_states(
        rows, key="customer_id", source="src_stm_id", date="ppn_dt", load_time="ds_load_time", attributes=attributes,
        absent=F.coalesce(F.col("rec_st") == 0, F.lit(False)) | F.coalesce(F.col("end_dt") <= F.col("ppn_dt"), F.lit(False)),
    )


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    versions = snapshots.snapshot_history(customer_states(spark, sf)).select(
        F.lit("read_dfs").alias("tbl"), F.col("_source").alias("src_stm_id"), F.col("_key").alias("customer_id"),
        day("valid_from").alias("valid_from"), F.coalesce(day("valid_to"), F.lit(snapshots.OPEN_DATE)).alias("valid_to"),
    )
    updates = customer_updates(spark, sf).select(
        F.lit("cob_hist_feed").alias("tbl"), F.lit("").alias("src_stm_id"), F.col("_key").alias("customer_id"),
        time("valid_from").alias("valid_from"),
        F.coalesce(time("valid_to"), F.lit(f"{snapshots.OPEN_DATE} 00:00:00")).alias("valid_to"),
    )
    return versions.unionByName(updates)


def customer_updates(spark: SparkSession, sf: str) -> DataFrame:
    return history.update_history(
        table(spark, sf, "cob_hist_feed"), key="customer_id", effective="eff_st_dt", load_time="ds_load_time",
        attributes={c: blank_to_null(F.col(c)) for c in ("mnemonic", "sector_id", "rm_id")},
        deleted=F.col("ds_record_is_deleted") == 1,
    )


def job_orphans(spark: SparkSession, sf: str) -> DataFrame:
    life = {"opened": "insert_date", "closed": "update_date", "live": "rec_status"}
    refs = [
        orphans.Reference(t, table(spark, sf, t), [k], [k], **life)
        for t, k in (("customers", "customer_id"), ("arrangement", "arr_id"), ("product_tree", "pd_id"))
    ]
    return orphans.orphan_references(table(spark, sf, "ds1_job"), "ds_row_id", "ds_time_id", refs)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return job_orphans(spark, sf).select("ref_table", F.col("_day").alias("ds_time_id"), F.col("_row").alias("ds_row_id"), "ref_reason")


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.orphan_report(job_orphans(spark, sf)).withColumnRenamed("_day", "ds_time_id")


def p3_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose arrangement, customer and product do not occur together, on whichever of the three are given."""
    three = ["arr_id", "customer_id", "pd_id"]
    ref = orphans.Reference("arrangement", table(spark, sf, "arrangement"), three, three, match="partial")
    return (
        orphans.orphan_references(table(spark, sf, "ds1_job"), "ds_row_id", "ds_time_id", [ref])
        .groupBy(F.col("_day").alias("ds_time_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def repayment_feed() -> deletion_vectors.ChangeFeed:
    return deletion_vectors.change_feed(
        keys=("ld_id", "pos", "sub_pos"), fields=FEED_FIELDS, order=("commit_ts", "ds_cdc_index", "change_id"),
        operation="cdc_type", named="cdc_fields", deleted="ds_record_is_deleted",
        inserts=("cdc_insert", "insert", "load", "t24_1tm"), updates=("cdc_update", "update"), removes=("cdc_delete", "delete"),
    )


def repayment_state(spark: SparkSession, sf: str) -> DataFrame:
    spec = repayment_feed()
    feed = table(spark, sf, "cdc_feed")
    images = deletion_vectors.apply_feed(feed, spec, scratch(spark, "vectors"), arrival="ds_load_time")
    position = F.concat_ws(".", "pos", "sub_pos").alias("rec_position")
    return deletion_vectors.current_fields(images, spec).select("ld_id", position, "field_name", "change_id", "value")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return repayment_state(spark, sf).drop("value")


def p4_state(spark: SparkSession, sf: str) -> DataFrame:
    """The values of the records, one row per field."""
    return repayment_state(spark, sf).drop("change_id").withColumn("value", F.coalesce("value", F.lit("")))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_changes(customer_states(spark, sf), SNAPSHOT_FIELDS).select(
        F.col("_source").alias("src_stm_id"), F.col("_key").alias("customer_id"),
        F.date_format("_date", "yyyy-MM-dd").alias("ppn_dt"), "status", "diff_key",
    )


def nested_children(spark: SparkSession, sf: str) -> DataFrame:
    movies = table(spark, sf, "moviedata")
    typed = flatten.flatten_struct_lists(movies, parent="moviedata", row_id="rec_id", record="info", paths=("actors", "genres"))
    texts = movies.where("info is null and info_json is not null").select("rec_id", flatten.parse_strict(F.col("info_json")).alias("_doc"))
    parsed = flatten.flatten_variant_lists(
        texts, parent="moviedata", row_id="rec_id", document=F.col("_doc"), wrapper="info", paths=("actors", "genres")
    )
    maps = flatten.flatten_map_list(table(spark, sf, "ds1_job"), parent="ds1_job", row_id="ds_row_id", column="info_detail")
    return typed.unionByName(parsed).unionByName(maps)


def child_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return flatten.write_subtypes(nested_children(spark, sf))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.supertype(child_tables(spark, sf)).drop("subtype")


def p6_subtypes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and parents of every subtype table by path."""
    return flatten.supertype(child_tables(spark, sf)).groupBy("parent_table", "elem_path", "subtype").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("parent_id").alias("n_parents")
    )


def p6_named(spark: SparkSession, sf: str) -> DataFrame:
    """The typed table of named objects, with the number of their fields besides the name."""
    named = child_tables(spark, sf)["named"]
    return named.select(*flatten.KEYS[:4], "name", F.size("fields").alias("n_fields"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_profile, p1_pointed, p2_found, p3_found, p3_report, p3_composite, p4_found, p4_state, p5_found, p6_found, p6_subtypes, p6_named)
}
