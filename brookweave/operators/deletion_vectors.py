"""A change feed applied with deletion vectors.

Table layout below one folder, a part being what one attempt at a version writes: ``data/<part>`` (images, never
rewritten), ``index/<part>/b=K`` (key, file and position of every image of the part, by hash bucket of the key),
``dv/<part>`` (the bits that it sets: file, bucket of 32,768 positions, bitmap) and ``commits/N.json`` (keys, buckets,
schema and the parts in force). A version counts once its commit exists; that is written last and in one piece, so what
a failed attempt left is in no part in force, and another process that opens the folder finds the same table.

Applying a batch reads the index of the buckets that the batch's keys fall into, the files that hold a superseded image,
and nothing else. A read filters positions by bit. Nothing is updated in place, so a task or an executor that is lost
repeats its own files only. :meth:`VectorTable.compact` writes the live images as a version that stands alone.

An image is the foldable summary of all changes of a key seen so far. Every part of it is a maximum over changes
ordered by (commit time, index, change id), so batches may come late, out of order or twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from brookweave.session import persist_table

BITS = 32768


@dataclass(frozen=True)
class ChangeFeed:
    """How to read a feed. ``operation``: upper-case words by meaning. ``order``: columns of the commit order, the
    last of which is the change id."""

    keys: Sequence[str]
    fields: Sequence[str]
    order: Sequence[str]
    removes: Column
    inserts: Column
    updates: Column
    names: Column  # array<string> of the fields an update sets, null or empty for all


def summarise(feed: DataFrame, spec: ChangeFeed) -> DataFrame:
    """One image per key: ``_reset`` - the last insert or delete; ``_set_<field>`` - the last change that set a field.

    The record exists iff its last reset is an insert, and all later changes are updates then, so the last setter of a
    field is the greatest change among the inserts and the updates that name it. That is a plain maximum: it is
    combined before the shuffle, whatever share of the rows one key has. Rows that are no change have no effect.
    """
    named = F.coalesce(F.size(spec.names) > 0, F.lit(False))
    acts = feed.select(
        *[F.col(k) for k in spec.keys],
        F.struct(*[F.col(c) for c in spec.order]).alias("_at"),
        *[F.col(f).alias(f"_v_{f}") for f in spec.fields],
        F.coalesce(spec.removes, F.lit(False)).alias("_removes"),
        F.coalesce(spec.inserts, F.lit(False)).alias("_inserts"),
        F.coalesce(spec.updates, F.lit(False)).alias("_updates"),
        *[(~named | F.array_contains(spec.names, f)).alias(f"_n_{f}") for f in spec.fields],
    ).withColumn("_inserts", F.col("_inserts") & ~F.col("_removes"))
    reset = F.when(F.col("_removes") | F.col("_inserts"), F.struct(F.col("_at").alias("at"), F.col("_inserts").alias("live")))
    sets = {
        f: F.when(
            F.col("_inserts") | (F.col("_updates") & ~F.col("_removes") & F.coalesce(F.col(f"_n_{f}"), F.lit(False))),
            F.struct(F.col("_at").alias("at"), F.col(f"_v_{f}").alias("value")),
        )
        for f in spec.fields
    }
    return acts.groupBy(*spec.keys).agg(F.max(reset).alias("_reset"), *[F.max(c).alias(f"_set_{f}") for f, c in sets.items()])


class VectorTable:
    """A keyed table with deletion vectors below ``path`` (a folder that all executors share). An existing table keeps its
    own keys and buckets. One writer at a time: of two, the later commit fails."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), index_buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.index_buckets = list(keys), index_buckets
        self.version, self.parts, self.schema = 0, [], None
        self.refresh()

    # storage

    def _file(self, name: str) -> tuple[Any, Any]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def refresh(self) -> None:
        """Takes the state of the last commit."""
        fs, folder = self._file("commits")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        done = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
        if done:
            state = json.loads(self.spark.read.text(f"{self.path}/commits/{done[-1]}.json", wholetext=True).first()[0])
            self.version, self.parts, self.keys = state["version"], state["parts"], state["keys"]
            self.index_buckets, self.schema = state["buckets"], StructType.fromJson(state["schema"])

    def _commit(self, version: int, parts: list[str], schema: StructType) -> None:
        state = {"version": version, "parts": parts, "keys": self.keys, "buckets": self.index_buckets, "schema": json.loads(schema.json())}
        fs, draft = self._file(f"commits/.{parts[-1]}.draft")
        _, final = self._file(f"commits/{version}.json")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {version} of {self.path} was committed by another writer")
        self.version, self.parts, self.schema = version, parts, schema

    def _folders(self, kind: str) -> list[str]:
        """Folders of a kind of the parts in force. The first part supersedes nothing."""
        return [f"{self.path}/{kind}/{part}" for part in (self.parts[1:] if kind == "dv" else self.parts)]

    # reading

    def _images(self, at: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*at).select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
        )

    def vectors(self) -> DataFrame | None:
        """The bits in force: ``file, bucket, bitmap``."""
        at = self._folders("dv")
        if not at:
            return None
        return self.spark.read.parquet(*at).groupBy("file", "bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap"))

    def _bucket_key(self) -> Column:
        return F.pmod(F.hash(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.index_buckets)).cast("int")

    def read(self) -> DataFrame:
        """The live images with ``_file`` and ``_at``: positions whose bit is set are filtered out."""
        if not self.version:
            raise ValueError(f"no table at {self.path}")
        data, dv = self._images(self._folders("data")), self.vectors()
        if dv is None:
            return data
        bits = dv.select(F.col("file").alias("_f"), F.col("bucket").alias("_b"), "bitmap")
        on = (F.col("_file") == F.col("_f")) & (F.expr(f"_at div {BITS}") == F.col("_b"))
        within = F.pmod(F.col("_at"), F.lit(BITS)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        gone = F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(within, F.lit(8)))), F.lit(2)) == 1
        return data.join(bits, on, "left").where(~F.coalesce(gone, F.lit(False))).drop("_f", "_b", "bitmap")

    # writing

    def locate(self, images: DataFrame) -> DataFrame:
        """Where the live images of the keys of ``images`` are: ``_in_file, _in_row``. Of a key the latest version counts. Only the
        index of the keys' buckets is read."""
        buckets = [r[0] for r in images.select(self._bucket_key()).distinct().collect()]  # at most ``index_buckets``
        held, held_keys = None, [f"k{i}" for i in range(len(self.keys))]
        for v, folder in enumerate(self._folders("index")):
            part = self.spark.read.schema(self._index_schema()).parquet(folder).where(F.col("b").isin(buckets))
            part = part.select(*held_keys, "b", F.struct(F.lit(v).alias("v"), "file", "row").alias("_place"))
            held = part if held is None else held.unionByName(part)
        wanted = images.select(self._bucket_key().alias("_wb"), *[F.col(k).alias(f"_w{i}") for i, k in enumerate(self.keys)])
        on = F.col("_wb") == F.col("b")
        for i, k in enumerate(held_keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_w{i}"))
        places = held.join(wanted, on, "left_semi").groupBy(*held_keys).agg(F.max("_place").alias("_place"))
        return places.select(F.col("_place.file").alias("_in_file"), F.col("_place.row").alias("_in_row"))

    def _index_schema(self) -> StructType:
        # keys by number: they may be named like the index's own columns
        keys = StructType([StructField(f"k{i}", self.schema[k].dataType) for i, k in enumerate(self.keys)])
        return keys.add("file", "string").add("row", "long").add("b", "integer")

    def _write(self, images: DataFrame) -> str:
        """Data of a new part, and its index in one file per bucket; returns the part's name."""
        part = f"{self.version + 1}-{uuid.uuid4().hex[:12]}"
        images.write.parquet(f"{self.path}/data/{part}")
        written = self.spark.read.schema(images.schema).parquet(f"{self.path}/data/{part}")
        written.select(
            self._bucket_key().alias("b"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)],
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        ).repartition("b").write.partitionBy("b").parquet(f"{self.path}/index/{part}")
        return part

    def apply(self, images: DataFrame) -> None:
        """Merge one image per key into the table as the next version. Null keys match each other."""
        if not self.version:
            self._commit(1, [self._write(images)], images.schema)
            return
        images = persist_table(images.select(*self.schema.names), "batch")
        located = persist_table(self.locate(images), "located")
        files = [r["_in_file"] for r in located.select("_in_file").distinct().collect()]  # names of files, not rows
        merged = images
        if files:
            theirs = self._images(files).join(located, (F.col("_file") == F.col("_in_file")) & (F.col("_at") == F.col("_in_row")), "left_semi")
            parts = [c for c in self.schema.names if c not in self.keys]
            merged = images.unionByName(theirs.drop("_file", "_at")).groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in parts])
        part = self._write(merged.select(*self.schema.names))
        fresh = located.groupBy(F.col("_in_file").alias("file"), F.expr(f"_in_row div {BITS}").alias("bucket"))
        fresh = fresh.agg(F.expr(f"bitmap_construct_agg(_in_row % {BITS})").alias("bitmap"))
        fresh.write.parquet(f"{self.path}/dv/{part}")
        self._commit(self.version + 1, [*self.parts, part], self.schema)

    def compact(self) -> None:
        """The live images as one part that stands alone; earlier ones are no longer read."""
        self._commit(self.version + 1, [self._write(self.read().select(*self.schema.names))], self.schema)


def apply_feed(feed: DataFrame, spec: ChangeFeed, path: str, *, arrival: str, batches: int = 3) -> DataFrame:
    """Apply the feed in ``batches`` of equal arrival time and return the live images (:func:`summarise` columns).

    The number of batches changes the work, never the result. Rows without an arrival time come first. An empty feed
    gives an empty table.
    """
    low, high = feed.agg(F.min(arrival), F.max(arrival)).first()
    target = VectorTable(feed.sparkSession, path, list(spec.keys))
    edges = [] if low is None or low == high else [low + (high - low) * i / batches for i in range(1, batches)]
    at = F.col(arrival)
    for i in range(len(edges) + 1):
        part = feed
        if edges:
            lower = F.lit(True) if i == 0 else at > F.lit(edges[i - 1])
            upper = F.lit(True) if i == len(edges) else at <= F.lit(edges[i])
            part = feed.where((lower & upper) | (at.isNull() if i == 0 else F.lit(False)))
        target.apply(summarise(part, spec))
    return target.read().drop("_file", "_at")


def current_fields(images: DataFrame, spec: ChangeFeed) -> DataFrame:
    """One row per field of every record that exists: keys, ``field_name``, the change that last set it and its value."""
    change = spec.order[-1]
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("field_name"), F.col(f"_set_{f}.at.{change}").alias(change), F.col(f"_set_{f}.value").cast("string").alias("value"))
            for f in spec.fields
        ]
    )
    return images.where("_reset.live").select(*spec.keys, F.explode(cells).alias("_c")).select(*spec.keys, "_c.*")


def change_feed(
    *, keys: Sequence[str], fields: Sequence[str], order: Sequence[str], operation: str, named: str, deleted: str,
    inserts: Sequence[str], updates: Sequence[str], removes: Sequence[str],
) -> ChangeFeed:
    """A feed whose operation and field names are compared without letter case and outer space."""
    from brookweave.functions.scalars import strip

    op = F.lower(strip(F.col(operation)))
    return ChangeFeed(
        keys=keys, fields=fields, order=order,
        removes=F.coalesce(F.col(deleted) == 1, F.lit(False)) | F.coalesce(op.isin(*removes), F.lit(False)),
        inserts=op.isin(*inserts), updates=op.isin(*updates),
        names=F.transform(F.col(named), lambda n: F.lower(strip(n))),
    )


