"""Windows, deduplication and slowly-changing-dimension columns.

Ties are broken by all remaining columns, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookweave.columns import col, pick, type_of
from brookweave.functions.dates import OPEN_EPOCH
from brookweave.registry import operator


def open_time() -> Column:
    return F.timestamp_seconds(F.lit(OPEN_EPOCH))


def sortable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns as tie-breakers; maps cannot be ordered and count as their JSON text."""
    return [(F.to_json(col(c)) if "map<" in type_of(df, c) or "variant" in type_of(df, c) else col(c)).desc_nulls_last() for c in names]


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "_rn") -> DataFrame:
    """The first row of every key. The planner keeps only the best row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in set(keys)]
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order, *sortable(df, rest))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


@operator()
def get_row_with_max_value_for_each_group(df: DataFrame, cols_to_group_by: Sequence[str], cols_to_get_max: Sequence[str]) -> DataFrame:
    return top_one(df, cols_to_group_by, [col(c).desc_nulls_last() for c in cols_to_get_max])


@operator()
def drop_duplicate_primarykey_order_by(df: DataFrame, primary_column: Sequence[str], col_order: str) -> DataFrame:
    keys = [primary_column] if isinstance(primary_column, str) else primary_column
    return top_one(df, keys, [col(col_order).desc_nulls_last()])


@operator("distinct_dataframe")
def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


@operator("scd_type2_dedup_by_hash_index")
def scd2_dedup_by_hash(df: DataFrame, hash_index: str, base_field: str, created_field: str, primary_columns: Sequence[str]) -> DataFrame:
    """Drops rows that repeat the hash of the row before (per key, by ``base_field``); the base field becomes the
    created field. A first row stays; a null hash never repeats."""
    from brookweave.operators.chains import neighbours

    rows = neighbours(df, primary_columns, base_field, before={"_was": col(hash_index)})
    kept = rows.where(~F.coalesce(F.col("_was") == col(hash_index), F.lit(False))).drop("_was")
    return kept.withColumn(created_field, col(base_field)).drop(base_field)


@operator("scd_type2_fill_record_update_time")
def scd2_fill_updated_time(df: DataFrame, partition_key: Sequence[str], created_field: str, updated_field: str) -> DataFrame:
    """The next row's created time, or the open end."""
    from brookweave.operators.chains import neighbours

    rows = neighbours(df, partition_key, created_field, after={"_then": col(created_field)})
    return rows.withColumn(updated_field, F.coalesce("_then", open_time().cast(type_of(df, created_field)))).drop("_then")


@operator("fill_record_status_1tm")
def scd2_fill_status(df: DataFrame, column_name: str, base_field: str) -> DataFrame:
    open_ = open_time().cast(type_of(df, base_field))
    return df.withColumn(column_name, F.when(col(base_field) == open_, 1).otherwise(0))


@operator("fill_record_change_type_1tm")
def fill_change_type(df: DataFrame, column_name: str, change_type: str) -> DataFrame:
    return df.withColumn(column_name, F.lit(change_type))


def latest_as_of(df: DataFrame, keys: Sequence[str], created: str, updated: str, date: str) -> DataFrame:
    """The version in force at the end of a day: created by then and not updated by then; the latest per key."""
    day = F.lit(date).cast("date")
    alive = df.where((col(created).cast("date") <= day) & (col(updated).cast("date") > day))
    return top_one(alive, keys, [col(created).desc_nulls_last()])


@operator("da_get_snapshot_from_scd_type_2")
def scd2_to_snapshot(df: DataFrame, technical_columns: Sequence[str] = (), process_date: str | None = None) -> DataFrame:
    """Drops the technical columns; ``ds_process_date`` is the given day, or yesterday."""
    day = F.lit(process_date).cast("date") if process_date else F.date_sub(F.current_date(), 1)
    return df.drop(*technical_columns).withColumn("ds_process_date", day)


@operator("cdc_1_3_scd2_columns")
def cdc_to_scd2_columns(df: DataFrame, timestamp_columns: Sequence[str], inf_year: int = 9999, created_field: str = "ds_record_created_timestamp") -> DataFrame:
    """Time columns to timestamps, null from ``inf_year`` on; created is the first that is not null."""
    times = {c: col(c).try_cast("timestamp") for c in timestamp_columns}
    times = {c: F.when(F.year(t) < inf_year, t) for c, t in times.items()}
    df = df.withColumns(times)
    return df.withColumns(
        {
            created_field: F.coalesce(*[col(c) for c in timestamp_columns]),
            "ds_cdc_index": F.lit(-1),
            "ds_record_change_type": F.lit("CDC_UPDATE"),
        }
    )


@operator("add_indentifier_for_scd_operation")
def add_scd_identifiers(
    df: DataFrame, created: str = "ds_record_created_timestamp", updated: str = "ds_record_updated_timestamp", deleted: str = "isdeleted",
    date: str | None = None, golden_is_empty: bool = False, golden_catalog: str | None = None,
    tables: Mapping[str, DataFrame] | None = None, cob_date: str | None = None,
) -> DataFrame:
    """Change type of every row on a day. Against an empty target all are inserts. Otherwise, first match: created on
    the day CDC_INSERT, deleted flag CDC_DELETE, not updated on the day no change (left out), else CDC_UPDATE; a row
    created and deleted on one day is given as an insert (index 1) and a delete (index 2)."""
    if golden_catalog is not None:
        golden = (tables or {}).get(golden_catalog)
        golden_is_empty = golden is None or golden.isEmpty()
    if date is None and cob_date:
        date = f"{cob_date[:4]}-{cob_date[4:6]}-{cob_date[6:8]}"
    if golden_is_empty:
        return df.withColumns({"ds_record_change_type": F.lit("CDC_INSERT"), "ds_cdc_index": F.lit(1)})
    day = F.lit(date).cast("date")
    gone = F.coalesce(F.lower(col(deleted).cast("string")).isin("true", "1"), F.lit(False))
    new = F.coalesce(col(created).cast("date") == day, F.lit(False))
    changed = F.coalesce(col(updated).cast("date") == day, F.lit(False))
    step = lambda kind, i: F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("i"))
    acts = (
        F.when(new & gone, F.array(step("CDC_INSERT", 1), step("CDC_DELETE", 2)))
        .when(new, F.array(step("CDC_INSERT", 1)))
        .when(gone, F.array(step("CDC_DELETE", 1)))
        .when(changed, F.array(step("CDC_UPDATE", 1)))
    )
    return df.withColumn("_act", F.explode(acts)).withColumns(
        {"ds_record_change_type": F.col("_act.kind"), "ds_cdc_index": F.col("_act.i")}
    ).drop("_act")
