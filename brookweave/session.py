"""Session helpers: shared scratch space, table loading and input spreading."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Folder that every executor shares.

    It is the cluster's ``spark.checkpoint.dir``, or the directory that was set on the context. Where both are missing
    and the master runs in this process (tests, a laptop), a temporary folder is made and registered with the context.
    On several machines such a folder would be another one on each, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN and (held := spark.sparkContext.getCheckpointDir()):
        return held.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="brookweave-")
        atexit.register(shutil.rmtree, _OWN[app], True)
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; it is removed when the driver ends."""
    path = f"{checkpoint_root(spark)}/brookweave/{label}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the context may be gone already
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and the files survive an executor."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Even out a scan that has fewer partitions than the cluster has cores (one shuffle of the rows), for
    operators whose work per row is large. A scan that is split finely enough is returned as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * per_core)
