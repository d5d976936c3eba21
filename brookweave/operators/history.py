"""Validity periods from a feed of updates (one full image per row)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookweave.functions.scalars import attribute_hash


def update_history(
    df: DataFrame,
    *,
    key: str,
    effective: str,
    load_time: str,
    attributes: Mapping[str, Column],
    deleted: Column,
    bucket: str = "day",
) -> DataFrame:
    """Gaps and islands over updates: ``_key, valid_from, valid_to`` (null while open) and ``attributes``.

    Of the rows of one key and effective time the latest ``load_time`` counts (ties by value); consecutive rows of
    equal attributes are one version; a deletion ends the version and starts none. Rows without an effective time
    have no place in the history and are left out. A null key is a key of its own.

    A key may hold a third of all rows, so no window runs over a whole key. Rows are windowed per key and calendar
    ``bucket`` of the effective time; one summary row per key and bucket (first and last state, number of inner
    starts) is then chained per key, which is bounded by the calendar, and joined back on the same partitioning to
    settle the first row of each bucket, to offset the running sum and to find the next start across buckets.
    """
    # the key in a struct: it is never null then and null keys are equal, so the join below is on plain equality and keeps the
    # partitioning of the windows; what a join would infer about the bucket is said here, so that both sides share one shuffle
    picked = df.where(F.col(effective).isNotNull() & F.date_trunc(bucket, F.col(effective)).isNotNull()).select(
        F.struct(F.col(key).alias("key")).alias("_key"),
        F.col(effective).alias("_at"),
        F.date_trunc(bucket, F.col(effective)).alias("_bucket"),
        F.col(load_time).alias("_load"),
        F.when(~F.coalesce(deleted, F.lit(False)), F.struct(*[c.alias(n) for n, c in attributes.items()])).alias("_attrs"),
    )
    top = Window.partitionBy("_key", "_bucket", "_at").orderBy(F.col("_load").desc_nulls_last(), F.col("_attrs").desc_nulls_last())
    rows = (
        picked.withColumn("_rn", F.row_number().over(top))
        .where("_rn = 1")
        .drop("_rn", "_load")
        .withColumn("_hash", F.when(F.col("_attrs").isNotNull(), attribute_hash("_attrs", attributes)))
    )
    w = Window.partitionBy("_key", "_bucket").orderBy("_at")
    inner = ~(F.lag("_hash").over(w).eqNullSafe(F.col("_hash")) & F.lag("_attrs").over(w).eqNullSafe(F.col("_attrs")))
    rows = rows.withColumns({"_first": F.row_number().over(w) == 1, "_inner": inner}).withColumn(
        "_inner", (F.col("_inner") & ~F.col("_first")).cast("int")
    )
    # one row per key and bucket: its last, which the same window has told about the ones before
    summary = rows.select(
        "_key", "_bucket", F.col("_attrs").alias("_tail"),
        F.first("_attrs").over(w).alias("_head"),
        F.first("_at").over(w).alias("_head_at"),
        F.min(F.when(F.col("_inner") == 1, F.col("_at"))).over(w).alias("_inner_at"),
        F.sum("_inner").over(w).alias("_inners"),
        F.lead("_at").over(w).isNull().alias("_ends"),
    ).where("_ends")
    chain = Window.partitionBy("_key").orderBy("_bucket")
    ahead = chain.rowsBetween(1, Window.unboundedFollowing)
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        summary.withColumn("_opens", (~F.lag("_tail").over(chain).eqNullSafe(F.col("_head"))).cast("int"))
        .withColumn("_start_at", F.when(F.col("_opens") == 1, F.col("_head_at")).otherwise(F.col("_inner_at")))
        .select(
            F.col("_key").alias("_k"),
            F.col("_bucket").alias("_b"),
            "_opens",
            F.coalesce(F.sum(F.col("_inners") + F.col("_opens")).over(before), F.lit(0)).alias("_offset"),
            F.first("_start_at", ignorenulls=True).over(ahead).alias("_later"),
        )
    )
    starts = (
        rows.join(summary, (F.col("_key") == F.col("_k")) & (F.col("_bucket") == F.col("_b")))
        .drop("_k", "_b")
        .withColumn("_start", F.when(F.col("_first"), F.col("_opens")).otherwise(F.col("_inner")))
        .withColumn("_island", F.col("_offset") + F.sum("_start").over(w))
        .where("_start = 1")
    )
    return (
        starts.withColumn("valid_to", F.coalesce(F.lead("_at").over(w), F.col("_later")))
        .where(F.col("_attrs").isNotNull())
        .select(F.col("_key.key").alias("_key"), F.col("_island").alias("version"), F.col("_at").alias("valid_from"), "valid_to", F.col("_attrs").alias("attributes"))
    )
