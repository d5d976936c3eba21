"""Dimension and fact merges as functions of (target, source) to the new target: one result frame, no partial commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.columns import col
from brookweave.functions.dates import OPEN_DATE
from brookweave.operators.chains import neighbours
from brookweave.operators.dedupe import top_one
from brookweave.operators.joins import restrict_to_sources

#: Technical columns of a dimension.
TECHNICAL = ("eff_dt", "end_dt", "rec_st", "ppn_dt")
#: Precedence of change types where the ordering column ties.
CHANGE_RANK = {"DWH_1TM": 1, "T24_1TM": 2, "CDC_INSERT": 3, "CDC_UPDATE": 3, "CDC_DELETE": 3}


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing in the job that reads it if a key occurs twice (nulls excepted: they match nothing)."""
    # keys alone are counted, combined before the shuffle; what occurs twice is next to nothing, so it is no wide window
    held = df
    for k in keys:
        held = held.where(col(k).isNotNull())
    named = {k: f"_u{i}" for i, k in enumerate(keys)}
    twice = held.groupBy(*[col(k).alias(u) for k, u in named.items()]).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    on = F.lit(True)
    for k, u in named.items():
        on = on & (col(k) == F.col(u))
    fail = F.raise_error(F.concat(F.lit("a source key occurs more than once: "), F.concat_ws(",", *[col(k).cast("string") for k in keys])))
    seen = df.join(twice, on, "left")
    return seen.where(F.when(F.col("_times").isNotNull(), fail.cast("boolean")).otherwise(True)).select(*[col(c) for c in df.columns])


def differs(columns: Sequence[str], left: str, right: str, null_safe: bool = False) -> Column:
    """Whether any column differs. As text, where null equals '' - or null-safe on the values."""
    if not columns:
        return F.lit(False)
    a, b = [[F.col(f"{side}.`{c}`") for c in columns] for side in (left, right)]
    if null_safe:
        out = [~x.eqNullSafe(y) for x, y in zip(a, b)]
    else:
        text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
        out = [text(x) != text(y) for x, y in zip(a, b)]
    whole = out[0]
    for c in out[1:]:
        whole = whole | c
    return whole


def _on(keys: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`"))
    return out


def scd2_statuses(target: DataFrame, snapshot: DataFrame, keys: Sequence[str], date: str, sources: Sequence[str] = (), null_safe: bool = False) -> DataFrame:
    """Keys of the versions in force with ``status``: deleted, updated or unchanged."""
    day = F.lit(date).cast("date")
    current = target.where((F.to_date("end_dt") > day) & (F.to_date("eff_dt") <= day))
    current = restrict_to_sources(current, snapshot, sources)
    data = [c for c in target.columns if c not in TECHNICAL and c in snapshot.columns]
    joined = current.alias("t").join(snapshot.alias("s"), _on(keys, "t", "s"), "left")
    status = F.when(F.col(f"s.`{keys[0]}`").isNull(), "deleted").when(differs(data, "t", "s", null_safe), "updated").otherwise("unchanged")
    return joined.select(*[F.col(f"t.`{k}`").alias(k) for k in keys], status.alias("status"))


def scd2_merge(
    target: DataFrame, snapshot: DataFrame, keys: Sequence[str], date: str, sources: Sequence[str] = (), null_safe: bool = False
) -> DataFrame:
    """Full-snapshot merge on a day: closes deleted and updated versions, opens new and updated ones, keeps the rest.

    A version is in force if it began by the day and ends after it; only sources that the snapshot delivers are
    touched. A source key must be unique. Null keys match nothing. Running a day again changes nothing.

    One full outer join on the key decides everything, so target and snapshot are each shuffled once.
    """
    day = F.lit(date).cast("date")
    columns = target.columns
    data = [c for c in columns if c not in TECHNICAL]
    shared = [c for c in data if c in snapshot.columns]
    force = (F.to_date("end_dt") > day) & (F.to_date("eff_dt") <= day)
    flagged = target.withColumn("_force", F.coalesce(force, F.lit(False)))
    current, settled = flagged.where("_force").drop("_force"), flagged.where("not _force").drop("_force")
    kept = None
    if sources:
        delivered = snapshot.select(*sources).distinct()
        kept = current.join(delivered, list(sources), "left_anti").select(*columns)
        current = current.join(delivered, list(sources), "left_semi").select(*columns)
    had = F.lit(not current.isEmpty())
    source = unique_keys(snapshot, keys).withColumn("_in", F.lit(True))
    both = current.withColumn("_cur", F.lit(True)).alias("t").join(source.alias("s"), _on(keys, "t", "s"), "full_outer")
    there, came = F.col("t._cur").isNotNull(), F.col("s._in").isNotNull()
    changed = there & came & differs(shared, "t", "s", null_safe)
    closing = there & (~came | changed) & (F.col("t.end_dt").cast("date") == F.lit(OPEN_DATE).cast("date"))
    old = F.struct(
        *[F.col(f"t.`{c}`").alias(c) for c in data],
        F.col("t.eff_dt").alias("eff_dt"),
        F.when(closing, day).otherwise(F.col("t.end_dt").cast("date")).alias("end_dt"),
        F.when(closing, F.lit(0)).otherwise(F.col("t.rec_st").cast("int")).alias("rec_st"),
        F.when(closing, day).otherwise(F.col("t.ppn_dt").cast("date")).alias("ppn_dt"),
    )
    given = lambda c, default: F.col(f"s.`{c}`") if c in snapshot.columns else default
    new = F.struct(
        *[given(c, F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in data],
        given("eff_dt", day).cast("date").alias("eff_dt"),
        given("end_dt", F.lit(OPEN_DATE)).cast("date").alias("end_dt"),
        given("rec_st", F.lit(1)).cast("int").alias("rec_st"),
        given("ppn_dt", day).cast("date").alias("ppn_dt"),
    )
    rows = both.select(F.array_compact(F.array(F.when(there, old), F.when(came & (~there | changed), new))).alias("_rows"), there.alias("_was"))
    rows = rows.select(F.posexplode("_rows").alias("_i", "_r"), "_was")
    fresh = (F.col("_i") == 1) | ~F.col("_was")
    # with versions in force the day replaces the snapshot's own dates (a null start stays null)
    rows = rows.select(
        *[F.col(f"_r.`{c}`").alias(c) for c in data],
        F.when(fresh & had & F.col("_r.eff_dt").isNotNull(), day).otherwise(F.col("_r.eff_dt")).alias("eff_dt"),
        "_r.end_dt", "_r.rec_st",
        F.when(fresh & had, day).otherwise(F.col("_r.ppn_dt")).alias("ppn_dt"),
    )
    out = rows.select(*columns).unionByName(settled.select(*columns))
    return out.unionByName(kept) if kept is not None else out


def scd4_current(target: DataFrame, snapshot: DataFrame, keys: Sequence[str], date: str, null_safe: bool = False) -> DataFrame:
    """Current-state table: keys gone from the snapshot become ``rec_st`` 0, changed ones take its values, new ones and
    soft-deleted ones that come back are (re)opened; unchanged rows stay."""
    day = F.lit(date).cast("date")
    columns = target.columns
    data = [c for c in columns if c not in ("rec_st", "ppn_dt", "eff_dt", "end_dt")]
    source = unique_keys(snapshot, keys).withColumn("_in", F.lit(True))
    both = target.withColumn("_cur", F.lit(True)).alias("t").join(source.alias("s"), _on(keys, "t", "s"), "full_outer")
    there, came, live = F.col("t._cur").isNotNull(), F.col("s._in").isNotNull(), F.coalesce(F.col("t.rec_st") == 1, F.lit(False))
    take = came & (~there | ~live | differs([c for c in data if c in snapshot.columns], "t", "s", null_safe))
    gone = there & live & ~came

    def value(c: str) -> Column:
        old = F.col(f"t.`{c}`")
        if c == "rec_st":
            return F.when(take, 1).when(gone, 0).otherwise(old)
        if c == "ppn_dt":
            return F.when(take | gone, day).otherwise(old)
        return F.when(take, F.col(f"s.`{c}`")).otherwise(old) if c in snapshot.columns else old

    return both.select(*[value(c).alias(c) for c in columns])


def scd4_base_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], now: str, deleted: str = "ds_record_is_deleted") -> DataFrame:
    """Base table: active source rows update (status kept) or insert (status 1), deleted ones set status 0 of their key."""
    at = F.lit(now).cast("timestamp")
    columns = target.columns
    both = target.withColumn("_cur", F.lit(True)).alias("t").join(
        unique_keys(source, keys).withColumn("_in", F.lit(True)).alias("s"), _on(keys, "t", "s"), "full_outer"
    )
    there, came = F.col("t._cur").isNotNull(), F.col("s._in").isNotNull()
    dead = came & F.coalesce(F.col(f"s.`{deleted}`") == 1, F.lit(False))
    live = came & ~dead

    def value(c: str) -> Column:
        old = F.col(f"t.`{c}`")
        if c == "insert_date":
            return F.when(there, old).otherwise(at.cast(target.schema[c].dataType))
        if c == "update_date":
            return F.when(there & live, at.cast(target.schema[c].dataType)).otherwise(old)
        if c == "rec_status":
            return F.when(there & dead, 0).when(there, old).otherwise(1)
        return F.when(live, F.col(f"s.`{c}`")).otherwise(old) if c in source.columns else old

    return both.where(there | live).select(*[value(c).alias(c) for c in columns])


def scd4_history(target: DataFrame, source: DataFrame, keys: Sequence[str], start: str = "eff_st_dt", end: str = "eff_end_dt") -> DataFrame:
    """History table: the rows of touched keys, old and new, are chained again by start; the last one is open."""
    touched = source.select(*keys).distinct()
    old = target.join(touched, list(keys), "left_semi")
    rest = target.join(touched, list(keys), "left_anti")
    data = [c for c in target.columns if c not in (end, "rec_status")]
    # a start that is delivered again replaces the row
    rows = old.select(*data, F.lit(0).alias("_new")).unionByName(source.select(*data, F.lit(1).alias("_new")))
    rows = top_one(rows, [*keys, start], [F.col("_new").desc()]).drop("_new")
    chained = neighbours(rows, keys, start, after={"_then": col(start)})
    chained = chained.withColumns({end: F.col("_then"), "rec_status": F.col("_then").isNull().cast("int")})
    return chained.select(*target.columns).unionByName(rest.select(*target.columns))


def scd4_close(target: DataFrame, deletes: DataFrame, keys: Sequence[str], at: str, start: str = "eff_st_dt", end: str = "eff_end_dt") -> DataFrame:
    """Closes the active row of every deleted key at the given column of ``deletes``."""
    gone = deletes.groupBy(*[col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(col(at)).alias("_at"))
    on = F.lit(True)
    for k in keys:
        on = on & (col(k) == F.col(f"_k_{k}"))
    closing = F.col("_at").isNotNull() & (F.col("rec_status") == 1)
    rows = target.join(gone, on, "left")
    return rows.withColumns({end: F.when(closing, F.col("_at")).otherwise(col(end)), "rec_status": F.when(closing, 0).otherwise(F.col("rec_status"))}).select(*target.columns)


def fact_dedup(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """The source's partitions rewritten: its rows, one per key, and the old rows of other keys. Other partitions are not
    part of the result: it is made for a dynamic partition overwrite."""
    pk = list(dict.fromkeys([*keys, partition]))
    fresh = top_one(source, pk, [])
    old = target.join(source.select(partition).distinct(), partition, "left_semi").join(fresh.select(*pk), pk, "left_anti")
    return fresh.unionByName(old.select(*fresh.columns))


def fact_latest(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str, change_type: str = "ds_record_change_type") -> DataFrame:
    """The latest row per key of both, by the ordering column, then by the precedence of change types."""
    rank = F.lit(0)
    for kind, r in CHANGE_RANK.items():
        rank = F.when(col(change_type) == kind, r).otherwise(rank)
    both = target.unionByName(source)
    return top_one(both, keys, [col(order).desc_nulls_last(), rank.desc()])


def change_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], insert_date: str) -> DataFrame:
    """Updated (source values, the target's insert date), new and unchanged rows."""
    both = target.withColumn("_cur", F.lit(True)).alias("t").join(source.withColumn("_in", F.lit(True)).alias("s"), _on(keys, "t", "s"), "full_outer")
    came = F.col("s._in").isNotNull()

    def value(c: str) -> Column:
        if c == insert_date:
            return F.when(F.col("t._cur").isNotNull(), F.col(f"t.`{c}`")).otherwise(F.col(f"s.`{c}`"))
        return F.when(came, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`"))

    return both.select(*[value(c).alias(c) for c in target.columns])


def change_merge_coalesce(target: DataFrame, source: DataFrame, keys: Sequence[str], insert_date: str) -> DataFrame:
    """Full outer merge by value: the source's value where it is not null, for the insert date the target's."""
    both = target.alias("t").join(source.alias("s"), _on(keys, "t", "s"), "full_outer")
    pair = lambda c, a, b: F.coalesce(F.col(f"{a}.`{c}`"), F.col(f"{b}.`{c}`")).alias(c)
    return both.select(*[pair(c, *(("t", "s") if c == insert_date else ("s", "t"))) for c in target.columns])


def keyed_replace(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete by key and insert, as one result."""
    return target.join(rows.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that do not satisfy the condition (unknown counts as not satisfied)."""
    return target.where(~F.coalesce(condition, F.lit(False)))


