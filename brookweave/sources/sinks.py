"""Writers. They raise on failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.operators.merge import delete_where, keyed_replace

MODES = ("append", "overwrite", "overwrite_partition")


def write_files(
    df: DataFrame, path: str, mode: str = "append", partition_columns: Sequence[str] = (), fmt: str = "parquet",
    header: bool = True, max_records_per_file: int = 0, max_rows_per_task: int = 0,
) -> None:
    """Partitioned files. ``overwrite_partition`` replaces only the partitions that ``df`` holds (a writer option, so the
    session's setting is not touched). ``max_records_per_file`` caps files within a task; ``max_rows_per_task`` also evens
    out the tasks first."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if mode == "overwrite_partition" and not partition_columns:
        raise ValueError("overwrite_partition needs partition columns")
    if max_rows_per_task:
        df, max_records_per_file = balanced(df), max_records_per_file or max_rows_per_task
    w = df.write.format(fmt).mode("append" if mode == "append" else "overwrite")
    if partition_columns:
        w = w.partitionBy(*partition_columns)
    if mode == "overwrite_partition":
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w = w.options(header=header, escape='"')
    w.save(path)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Partitions of at most about ``rows`` rows, at least one. Counts once, which computes the input an extra time; writers use
    :func:`balanced` with a cap on records per file instead."""
    wanted = max(1, -(-df.count() // rows))
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df.coalesce(wanted)


def balanced(df: DataFrame) -> DataFrame:
    """Partitions of even size: small ones are joined and large ones split at run time, so nothing is counted before."""
    return df.hint("rebalance")


def create_or_write(
    df: DataFrame, table: str, partition_columns: Sequence[str] = (), provider: str = "parquet", overwrite_partitions: bool = True,
    location: str | None = None,
) -> None:
    """Creates the table from the rows (at ``location``) if it does not exist; otherwise replaces the partitions they hold,
    or appends."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        w = df.write.format(provider)
        w = w.option("path", location) if location else w
        (w.partitionBy(*partition_columns) if partition_columns else w).saveAsTable(table)
    elif overwrite_partitions and partition_columns:
        # a table takes this from the session only, not from the writer
        name = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(name)
        spark.conf.set(name, "dynamic")
        try:
            df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(name, before)
    else:
        df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def create_if_not_exists(spark: SparkSession, table: str, ddl: str, provider: str = "parquet", partition_columns: Sequence[str] = (), location: str | None = None) -> None:
    parts = f" PARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {provider}{parts}{place}")


def insert_select(source: DataFrame, table: str, condition: Column | None = None) -> None:
    df = source if condition is None else source.where(condition)
    df.select(*source.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def drop_table(spark: SparkSession, table: str) -> bool:
    """Whether there was such a table; its files stay where it was given a location."""
    there = spark.catalog.tableExists(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return there


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def delete_all(spark: SparkSession, table: str) -> None:
    spark.createDataFrame([], spark.table(table).schema).write.mode("overwrite").insertInto(table)


def write_document(df: DataFrame, path: str) -> None:
    """One small JSON document (a single file by its purpose)."""
    df.coalesce(1).write.mode("overwrite").json(path)


# --- items: functions of the table --------------------------------------------------------------------------------


def put_items(table: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keyed_replace(table, items, keys)


def update_nested(table: DataFrame, condition: Column, struct: str, values: dict[str, Column]) -> DataFrame:
    """Sets fields of a struct in the rows of the condition."""
    new = F.col(struct)
    for k, v in values.items():
        new = new.withField(k, v)
    return table.withColumn(struct, F.when(condition, new).otherwise(F.col(struct)))


def delete_items(table: DataFrame, key: Column, condition: Column | None = None) -> DataFrame:
    return delete_where(table, key if condition is None else key & condition)
