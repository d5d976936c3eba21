"""References to records that do not exist, by null mask of composite keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.functions.scalars import day_number, fold_key


@dataclass(frozen=True)
class Reference:
    """A (composite) reference from child columns to the columns of a parent table.

    ``match``: ``simple`` - a reference with a null part is not checked; ``partial`` - its non-null parts must occur
    together in some parent; ``full`` - a reference must be wholly null or wholly present, a mixture is an orphan.
    ``opened``/``closed``/``live``: the parent's columns for the life of a record (all optional).
    """

    name: str
    parent: DataFrame
    child_columns: Sequence[str]
    parent_columns: Sequence[str]
    match: str = "simple"
    opened: str | None = None
    closed: str | None = None
    live: str | None = None

    def __post_init__(self) -> None:
        if self.match not in ("simple", "partial", "full"):
            raise ValueError(f"unknown match semantics {self.match}")
        if not self.child_columns or len(self.child_columns) != len(self.parent_columns):
            raise ValueError("child_columns and parent_columns must pair up")


def orphan_references(child: DataFrame, row_id: str, day: str, references: Sequence[Reference]) -> DataFrame:
    """Orphans of every reference: ``ref_table, day, row_id, ref_reason`` (``missing``, ``late``, ``deleted``).

    Keys are compared without letter case and outer space; a blank part counts as null. The references of a row are
    grouped by null mask, a column beside the keys; ``missing`` is what an anti-join of a mask's group with the parent's
    distinct keys leaves, on the mask's non-null columns. A key that exists has one life, from the first opening to the last
    closing of its records: ``late`` if it opens after the row's day, else ``deleted`` if it closed on or before it. ``day``
    is yyyyMMdd; a null day can be neither late nor deleted. A null opening date is open from the start; a record closes
    only with a live flag of 0 and a closing date.

    Shuffle: one exchange per reference of (row id, day, mask, key) only, which the anti-join and the join for the lives
    share, whatever the number of masks; parents are reduced to one row per mask and key before it. Hot keys stay on the
    child side, where adaptive execution splits them; a parent is broadcast only where the planner has measured it as small.
    """
    found = None
    for ref in references:
        for part in _orphans(child, row_id, day, ref):
            found = part if found is None else found.unionByName(part)
    return found


def null_mask(keys: Sequence[str]) -> Column:
    """Bit i is set where key i is not null."""
    return _all_sum([F.when(F.col(k).isNotNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)])


def _all_sum(parts: Sequence[Column]) -> Column:
    return sum(parts[1:], parts[0])


def _orphans(child: DataFrame, row_id: str, day: str, ref: Reference) -> list[DataFrame]:
    n = len(ref.child_columns)
    whole = (1 << n) - 1
    keys, theirs = [f"_k{i}" for i in range(n)], [f"_p{i}" for i in range(n)]
    rows = child.select(
        F.col(row_id).alias("_row"), F.col(day).cast("bigint").alias("_day"),
        *[fold_key(F.col(c)).alias(k) for c, k in zip(ref.child_columns, keys)],
    ).withColumn("_mask", null_mask(keys)).where("_mask > 0")
    opened = F.coalesce(day_number(F.col(ref.opened)), F.lit(0)) if ref.opened else F.lit(0)
    dead = F.coalesce(F.col(ref.live) == 0, F.lit(False)) if ref.live else F.lit(False)
    closed = F.when(dead, day_number(F.col(ref.closed))) if ref.closed else F.lit(None)
    parents = ref.parent.select(
        *[fold_key(F.col(c)).alias(p) for c, p in zip(ref.parent_columns, theirs)],
        opened.cast("bigint").alias("_opened"), closed.cast("bigint").alias("_closed"),
    )
    out = []
    if ref.match == "full":
        mixed = rows.where(F.col("_mask") != whole)
        out.append(mixed.select(F.lit(ref.name).alias("ref_table"), "_day", "_row", F.lit("missing").alias("ref_reason")))
    if ref.match == "partial" and n > 1:
        # a parent is met on every mask that its own null parts allow, with the columns outside the mask as nulls
        masks = F.explode(F.array(*[F.lit(m) for m in range(1, whole + 1)])).alias("_m")
        parents = parents.withColumn("_held", null_mask(theirs)).select("*", masks).where(F.col("_m").bitwiseAND(F.col("_held")) == F.col("_m"))
        parents = parents.withColumns({p: F.when(F.col("_m").bitwiseAND(F.lit(1 << i)) > 0, F.col(p)) for i, p in enumerate(theirs)})
        lives = parents.groupBy("_m", *theirs)
        on = (F.col("_mask") == F.col("_m")) & _all([F.col(k).eqNullSafe(F.col(p)) for k, p in zip(keys, theirs)])
    else:
        rows = rows.where(F.col("_mask") == whole)
        lives = parents.where(_all([F.col(p).isNotNull() for p in theirs])).groupBy(*theirs)
        on = _all([F.col(k) == F.col(p) for k, p in zip(keys, theirs)])
    lives = lives.agg(F.min("_opened").alias("_opens"), F.max(F.coalesce("_closed", F.lit(99991231))).alias("_closes"))
    result = lambda df, reason: df.select(F.lit(ref.name).alias("ref_table"), "_day", "_row", reason.alias("ref_reason"))
    out.append(result(rows.join(lives, on, "left_anti"), F.lit("missing")))
    if ref.opened or ref.closed:
        reason = F.when(F.col("_opens") > F.col("_day"), "late").when(F.col("_closes") <= F.col("_day"), "deleted")
        out.append(result(rows.join(lives, on), reason).where(F.col("ref_reason").isNotNull()))
    return out


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans counted per table, period and reason (pre-aggregated before its shuffle)."""
    return orphans.groupBy("ref_table", "_day", "ref_reason").agg(F.count(F.lit(1)).alias("n_rows"))
