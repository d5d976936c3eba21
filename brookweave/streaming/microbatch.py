"""Micro-batch pipelines with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brookweave.registry import run_pipeline

INGEST = ("ingest_year", "ingest_month", "ingest_day", "ingest_hour")


def with_ingest_time(df: DataFrame, at: Any = None) -> DataFrame:
    """Year, month, day and hour of processing time, for partitioned output."""
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    parts = {"ingest_year": "yyyy", "ingest_month": "MM", "ingest_day": "dd", "ingest_hour": "HH"}
    return df.withColumns({c: F.date_format(now, f) for c, f in parts.items()})


def run_stream(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = "60 seconds",
) -> StreamingQuery:
    """Hands every non-empty micro-batch to ``handle(batch, batch_id)``; ``interval`` None takes what is there and ends."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            handle(batch, batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()


def parquet_sink(path: str, steps: Sequence[Mapping[str, Any]] = (), context: Mapping[str, Any] | None = None) -> Callable[[DataFrame, int], None]:
    """Applies a pipeline and writes below ``batch=<id>/ingest_year=...``. A batch that is retried overwrites its own
    folder, so every row is written once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = with_ingest_time(run_pipeline(batch, steps, context=context))
        out.write.mode("overwrite").partitionBy(*INGEST).parquet(f"{path}/batch={batch_id}")

    return handle


def feed_sink(target: Any, summarise: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Applies change batches to a :class:`~brookweave.operators.deletion_vectors.VectorTable`. Its images are maxima,
    so a batch that is retried changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        target.apply(summarise(batch))

    return handle


def session_counts(stream: DataFrame, time: str, gap: str, late: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sessions per key: a session ends where no event follows within ``gap``. Late rows as in :func:`windowed_counts`."""
    return stream.withWatermark(time, late).groupBy(F.session_window(F.col(time), gap).alias("session"), *keys).agg(F.count(F.lit(1)).alias("n"))


def deduplicated(stream: DataFrame, time: str, late: str, keys: Sequence[str]) -> DataFrame:
    """The first row of every key; its state is dropped once the watermark has passed, so it stays bounded."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def joined_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, late: str, within: str) -> DataFrame:
    """Inner join of two streams on equal keys where the right row follows the left one within an interval; both sides' state is
    bounded by the watermarks. The columns of both sides must differ but for the keys."""
    a, b = left.withWatermark(left_time, late).alias("a"), right.withWatermark(right_time, late).alias("b")
    on = F.expr(f"b.`{right_time}` >= a.`{left_time}` and b.`{right_time}` <= a.`{left_time}` + interval {within}")
    for k in keys:
        on = on & (F.col(f"a.`{k}`") == F.col(f"b.`{k}`"))
    return a.join(b, on).select("a.*", *[F.col(f"b.`{c}`") for c in right.columns if c not in keys])


def windowed_counts(stream: DataFrame, time: str, size: str, slide: str | None, late: str, keys: Sequence[str] = ()) -> DataFrame:
    """Event-time windows with a watermark: rows later than ``late`` behind the greatest time seen are dropped."""
    frame = F.window(F.col(time), size, slide) if slide else F.window(F.col(time), size)
    return stream.withWatermark(time, late).groupBy(frame, *keys).agg(F.count(F.lit(1)).alias("n"))
