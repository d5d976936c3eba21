"""Tables on plain files whose every change is one atomic new version.

A version is a folder ``v=N``; it counts once its ``_SUCCESS`` marker exists, so a job that dies half way leaves the last
version in force, and readers of it are not disturbed. The merge kinds are the families of
:mod:`brookweave.operators.merge`; the partition kinds write only the partitions that the new rows hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brookweave.operators import merge as M
from brookweave.session import persist_table

#: Change types by group.
CHANGES = ("CDC_UPDATE", "CDC_INSERT", "CDC_DELETE", "CDC_TRUNCATE")
UPSERTS = ("CDC_UPDATE", "CDC_INSERT")
ONE_TIME = ("T24_1TM", "DWH_1TM")
#: Technical columns by kind of table; everything else is data.
TECHNICAL = {
    "scd2": ("ds_record_created_timestamp", "ds_record_updated_timestamp", "ds_record_status", "ds_record_change_type", "ds_partition_date", "ds_cdc_index"),
    "scd4_history": ("ds_record_created_timestamp", "ds_partition_date", "ds_record_change_type", "ds_cdc_index"),
    "scd4_current": ("ds_record_created_timestamp", "ds_partition_date", "ds_record_is_deleted", "ds_cdc_index", "ds_partition_recid"),
    "snapshot": ("ds_record_created_timestamp", "ds_process_date"),
    "fact": ("ds_record_change_type", "ds_partition_date"),
    "fact_upsert": ("ds_record_updated_timestamp", "ds_partition_date"),
}


def data_columns(df: DataFrame, kind: str) -> list[str]:
    return [c for c in df.columns if c not in TECHNICAL[kind]]


def replace_partitions(target: DataFrame, rows: DataFrame, partition: str) -> DataFrame:
    """The periodic fact: the rows of all partitions that are replaced."""
    return rows.select(*target.columns)


def dedup_partitions(target: DataFrame, rows: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """The rows of all partitions that ``rows`` touches, after the merge."""
    return M.fact_dedup(target, rows, keys, partition).select(*target.columns)


#: Kinds that give the rows of the touched partitions only; the others give the whole table.
PARTITIONED = ("fact_dedup", "fact_periodic")
KINDS: dict[str, Callable[..., DataFrame]] = {
    "scd2": M.scd2_merge, "scd4_current": M.scd4_current, "scd4_base": M.scd4_base_upsert, "scd4_history": M.scd4_history,
    "fact_dedup": dedup_partitions, "fact_latest": M.fact_latest, "fact_periodic": replace_partitions,
    "change_merge": M.change_merge, "change_merge_coalesce": M.change_merge_coalesce, "replace": M.keyed_replace,
}


class VersionedTable:
    """Versions below ``path``. A version of a partition kind holds the partitions it replaces, and a note
    (``notes/N.json``) of the version that it carries the others on from; it is read as both. After ``CHAIN`` of them in a
    row the next one is written whole."""

    CHAIN = 16

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, name: str) -> tuple[Any, Any]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        """Complete versions in order."""
        fs, p = self._file("v=*/_SUCCESS")
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in fs.globStatus(p) or [])

    def exists(self) -> bool:
        return bool(self.versions())

    def note(self, version: int) -> dict[str, Any] | None:
        """``base, partition, replaced, schema, depth`` of a version that carries others on."""
        fs, p = self._file(f"notes/{version}.json")
        if not fs.exists(p):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/notes/{version}.json", wholetext=True).first()[0])

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"no such version of {self.path}")
        version = known[-1] if version is None else version
        note = self.note(version)
        if note is None:
            return self.spark.read.parquet(f"{self.path}/v={version}")
        schema = StructType.fromJson(note["schema"])
        own = self.spark.read.schema(schema).parquet(f"{self.path}/v={version}").select(*schema.names)
        kept = self.read(note["base"]).where(~_named(note["partition"]).isin(note["replaced"]))
        return kept.select(*schema.names).unionByName(own)

    def _noted(self, version: int, note: dict[str, Any] | None) -> None:
        """The note is there before the version counts; one that a failed attempt left is replaced."""
        fs, p = self._file(f"notes/{version}.json")
        if note is None:
            fs.delete(p, False)
            return
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(note).encode()))
        out.close()

    def write(self, df: DataFrame, partition: str | None = None) -> int:
        """The whole table as the next version."""
        version = (self.versions() or [0])[-1] + 1
        self._noted(version, None)
        w = df.write.mode("overwrite")  # remains of a failed attempt are replaced
        (w.partitionBy(partition) if partition else w).parquet(f"{self.path}/v={version}")
        return version

    def write_partitions(self, df: DataFrame, partition: str) -> int:
        """The next version: the partitions that ``df`` holds are replaced by it, nothing else is read or written."""
        base = self.versions()[-1]
        before = self.note(base)
        depth = before["depth"] + 1 if before else 1
        df = persist_table(df, "partitions")
        replaced = [r[0] for r in df.select(_named(partition)).distinct().collect()]  # names of partitions
        if depth > self.CHAIN:
            kept = self.read(base).where(~_named(partition).isin(replaced))
            return self.write(kept.unionByName(df), partition)
        schema = StructType([f for f in df.schema.fields if f.name != partition] + [df.schema[partition]])
        self._noted(base + 1, {"base": base, "partition": partition, "replaced": replaced, "schema": json.loads(schema.json()), "depth": depth})
        df.write.mode("overwrite").partitionBy(partition).parquet(f"{self.path}/v={base + 1}")
        return base + 1

    def merge(self, rows: DataFrame, kind: str, **params: Any) -> int:
        """Creates the table from the rows if it does not exist, else merges them by kind, as one new version."""
        if kind not in KINDS:
            raise ValueError(f"unknown kind of table {kind}")
        if not self.exists():
            return self.write(rows, params.get("partition") if kind in PARTITIONED else None)
        merged = KINDS[kind](self.read(), rows, **params)
        return self.write_partitions(merged, params["partition"]) if kind in PARTITIONED else self.write(merged)

    def vacuum(self, keep: int = 1) -> None:
        """Removes all but the latest versions and those that they carry on; nobody may be reading them."""
        known = self.versions()
        needed = set(known[-keep:])
        for v in list(needed):
            while (note := self.note(v)) is not None:
                v = note["base"]
                needed.add(v)
        for v in set(known) - needed:
            for name in (f"v={v}", f"notes/{v}.json"):
                fs, p = self._file(name)
                fs.delete(p, True)


def _named(partition: str) -> Column:
    """The text of a partition's value; null has one of its own."""
    return F.coalesce(F.col(partition).cast("string"), F.lit("\0null"))


#: Parameters without which a kind of target cannot be merged.
NEEDED = {
    "scd2": ("keys", "date"), "scd4_current": ("keys", "date"), "scd4_base": ("keys", "now"), "scd4_history": ("keys",), "fact_dedup": ("keys", "partition"),
    "fact_latest": ("keys", "order"), "fact_periodic": ("partition",), "change_merge": ("keys", "insert_date"),
    "change_merge_coalesce": ("keys", "insert_date"), "replace": ("keys",),
}


def check_target(target: Mapping[str, Any]) -> None:
    """Refuses a target before anything runs: an unknown kind, or one without its path or parameters."""
    if target.get("kind") not in KINDS:
        raise ValueError(f"unknown kind of table {target.get('kind')}")
    lacks = [p for p in NEEDED[target["kind"]] if p not in target.get("params", {})] + ([] if target.get("path") else ["path"])
    if lacks:
        raise ValueError(f"a target of kind {target['kind']} needs {', '.join(lacks)}")


def merge_output(spark: SparkSession, df: DataFrame, target: Mapping[str, Any]) -> int:
    """A pipeline's merge target: ``{path, kind, params}``."""
    check_target(target)
    return VersionedTable(spark, target["path"]).merge(df, target["kind"], **target.get("params", {}))
