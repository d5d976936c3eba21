"""Full snapshots delivered periodically: states, histories and differences.

All three operators share :func:`snapshot_states`. Conflicting rows of one key and delivery are reduced before any
window runs, with a map-side top-1, so a key that holds a third of all rows leaves at most one row per delivery:
the key windows below are bounded by the number of deliveries, not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookweave.functions.scalars import attribute_hash

OPEN_DATE = "3000-11-08"


def deliveries(df: DataFrame, source: str, date: str) -> DataFrame:
    """One row per source and date on which the source delivered anything: its index and the next such date."""
    days = df.select(source, date).where(F.col(date).isNotNull()).distinct()
    w = Window.partitionBy(source).orderBy(date)
    return days.select(
        F.col(source).alias("_source"),
        F.col(date).alias("_date"),
        F.row_number().over(w).alias("_idx"),
        F.lead(date).over(w).alias("_next"),
    )


def snapshot_states(
    df: DataFrame,
    *,
    key: str,
    source: str,
    date: str,
    load_time: str,
    attributes: Mapping[str, Column],
    absent: Column,
) -> DataFrame:
    """The state of every record at every delivery.

    Result: ``_key, _source, _date, _idx, _next, _attrs`` (struct of the normalised attributes), ``_hash``. Of the
    rows of one key and date the latest ``load_time`` counts; a tie is broken by the values, so the result does not
    depend on row order. Rows for which ``absent`` is true after that choice are left out. Rows without a date belong
    to no delivery. A null key is a key of its own; a null source is a source of its own.
    """
    picked = df.where(F.col(date).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        F.col(date).alias("_date"),
        F.col(load_time).alias("_load"),
        F.struct(*[c.alias(n) for n, c in attributes.items()]).alias("_attrs"),
        F.coalesce(absent, F.lit(False)).alias("_absent"),
    )
    w = Window.partitionBy("_key", "_source", "_date").orderBy(
        F.col("_load").desc_nulls_last(), F.col("_absent"), F.col("_attrs").desc_nulls_last()
    )
    latest = picked.withColumn("_rn", F.row_number().over(w)).where("_rn = 1 and not _absent").drop("_rn", "_load", "_absent")
    days = deliveries(df, source, date).withColumnsRenamed({"_source": "_s", "_date": "_d"})
    return (
        latest.join(days, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_date") == F.col("_d")))
        .drop("_s", "_d")
        .withColumn("_hash", attribute_hash("_attrs", attributes))
    )


def snapshot_history(states: DataFrame) -> DataFrame:
    """Gaps and islands: every run of equal states at consecutive deliveries is one version.

    A row starts an island if the delivery before it lacks the key or its attribute hash differs (equal hashes are
    confirmed on the values). The running sum of the starts numbers the islands; an island begins at its least date
    and ends at the delivery after its last one, null if there is none.
    """
    w = Window.partitionBy("_key", "_source").orderBy("_idx")
    starts = (
        F.coalesce(F.lag("_idx").over(w) != F.col("_idx") - 1, F.lit(True))
        | ~F.lag("_hash").over(w).eqNullSafe(F.col("_hash"))
        | ~F.lag("_attrs").over(w).eqNullSafe(F.col("_attrs"))
    )
    return (
        states.withColumn("_start", starts.cast("int"))
        .withColumn("_island", F.sum("_start").over(w))
        .groupBy("_key", "_source", "_island")
        .agg(
            F.min("_date").alias("valid_from"),
            F.max_by("_next", "_idx").alias("valid_to"),
            F.min_by("_attrs", "_idx").alias("attributes"),
        )
        .drop("_island")
    )


def snapshot_changes(states: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """What changed between consecutive deliveries: ``_key, _source, _date`` (the later delivery), ``status``, ``diff_key``.

    One window per key over the delivery index. The row before at a distance of one is compared by hash (equal hashes are confirmed on
    the values), and where they differ field by field; a larger distance is a removal after the earlier row and an addition at the
    later one. The first delivery of a source has no cases, the last no removals.
    """
    w = Window.partitionBy("_key", "_source").orderBy("_idx")
    seen = states.withColumns(
        {
            "_was": F.lag("_idx").over(w),
            "_then": F.lead("_idx").over(w),
            "_old_hash": F.lag("_hash").over(w),
            "_old": F.lag("_attrs").over(w),
        }
    )
    follows = F.col("_was") == F.col("_idx") - 1
    case = lambda date, status, diff: F.struct(
        date.alias("_on"), F.lit(status).alias("status"), diff.alias("diff_key")
    )
    here = F.col("_date")
    added = F.when((F.col("_idx") > 1) & ~F.coalesce(follows, F.lit(False)), case(here, "new", F.lit("")))
    gone = F.when(
        F.col("_next").isNotNull() & ~F.coalesce(F.col("_then") == F.col("_idx") + 1, F.lit(False)),
        case(F.col("_next"), "deleted", F.lit("")),
    )
    differs = follows & ((F.col("_old_hash") != F.col("_hash")) | ~F.col("_old").eqNullSafe(F.col("_attrs")))
    fields = [
        F.when(differs & ~F.col(f"_old.{a}").eqNullSafe(F.col(f"_attrs.{a}")), case(here, "updated", F.lit(a)))
        for a in attributes
    ]
    return (
        seen.withColumn("_case", F.explode(F.array_compact(F.array(added, gone, *fields))))
        .select("_key", "_source", F.col("_case._on").alias("_date"), "_case.status", "_case.diff_key")
    )
