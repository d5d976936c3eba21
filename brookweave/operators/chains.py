"""The row before and after in the order of a key, without a window over a whole key.

A key may hold a third of all rows. Rows are windowed per key and day of the order; one row per key and day, which has the
first and the last value of that day, is chained per key (bounded by the calendar) and joined back to settle the first and
the last row of each day. The join keeps the partitioning of the windows, so the rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookweave.columns import col
from brookweave.operators.dedupe import sortable


def day_of(df: DataFrame, order: str) -> Column | None:
    """The day of an ordering column: of a time, or of a struct's first field if that is one; None for other types."""
    from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

    kind, c = df.schema[order].dataType, col(order)
    if isinstance(kind, StructType) and kind.fields:
        kind, c = kind.fields[0].dataType, c[kind.fields[0].name]
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.to_date(c)
    return None


def neighbours(df: DataFrame, keys: Sequence[str], order: str, after: Mapping[str, Column] | None = None, before: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with the named values of the next (``after``) and the previous row (``before``) of its key by ``order``; null where
    there is none. Ties are broken by all remaining columns; null keys are one key; null orders come first. An order
    without days (a number, a text) is one window per key."""
    after, before = dict(after or {}), dict(before or {})
    ties = sortable(df, [c for c in df.columns if c != order and c not in set(keys)])
    day = day_of(df, order)
    # in structs, so that nulls are equal and a plain join meets them
    rows = df.withColumns(
        {
            "_chain": F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)]),
            "_day": F.struct((F.lit(None).cast("date") if day is None else day).alias("d")),
            "_mine_a": F.struct(*[c.alias(n) for n, c in after.items()]) if after else F.struct(F.lit(1).alias("_")),
            "_mine_b": F.struct(*[c.alias(n) for n, c in before.items()]) if before else F.struct(F.lit(1).alias("_")),
        }
    )
    w = Window.partitionBy("_chain", "_day").orderBy(col(order).asc_nulls_first(), *ties)
    rows = rows.withColumns(
        {
            "_next": F.lead("_mine_a").over(w), "_prev": F.lag("_mine_b").over(w),
            "_head": F.first("_mine_a").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    if day is not None:
        chain = Window.partitionBy("_c").orderBy("_d")
        days = rows.where(F.col("_next").isNull()).select(
            F.col("_chain").alias("_c"), F.col("_day").alias("_d"), F.col("_head").alias("_h"), F.col("_mine_b").alias("_t")
        )
        days = days.select("_c", "_d", F.lead("_h").over(chain).alias("_later"), F.lag("_t").over(chain).alias("_earlier"))
        rows = rows.join(days, (F.col("_chain") == F.col("_c")) & (F.col("_day") == F.col("_d")))
        rows = rows.withColumns({"_next": F.coalesce("_next", "_later"), "_prev": F.coalesce("_prev", "_earlier")})
    values = {n: F.col(f"_next.`{n}`") for n in after} | {n: F.col(f"_prev.`{n}`") for n in before}
    return rows.select(*[col(c) for c in df.columns], *[c.alias(n) for n, c in values.items()])
