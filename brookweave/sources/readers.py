"""Readers. A reader returns one DataFrame; many inputs are a dict of them."""

from __future__ import annotations

import datetime as dt
from collections import OrderedDict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookweave.columns import col
from brookweave.operators.reshaping import TAX_FIELDS, TAX_PAPERS, flatten_tax_rows


@dataclass(frozen=True)
class Serde:
    format: str = "CSV"
    encoding: str = "utf-8"
    delimiter: str = ","
    escape: str = '"'
    quote: str = '"'
    header: bool = True
    multi_line: bool = False
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Partition:
    """Which partitions of a table to read: a ready predicate, one date, a list or a range, or all."""

    column: str | None = None
    predicate: str | None = None
    data_date: Any = None
    data_date_type: str | None = None
    extend_range: int = 0
    max_offset: int = 0


@dataclass(frozen=True)
class Input:
    """One input of a pipeline."""

    reader_type: str
    name: str = "input"
    uri_list: Sequence[str] = ()
    entry_file: str | None = None
    table: str | None = None
    query: str | None = None
    serde: Serde = Serde()
    schema: Sequence[Mapping[str, str]] = ()
    partition: Partition = Partition()
    empty_allow: bool = False
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.entry_file and self.uri_list:
            raise ValueError("give entry_file or uri_list, not both")
        if self.reader_type not in READERS:
            raise ValueError(f"unknown reader {self.reader_type}")

    def paths(self) -> list[str]:
        return [self.entry_file] if self.entry_file else list(self.uri_list)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p))


def project_schema(df: DataFrame, schema: Sequence[Mapping[str, str]], zone: str | None = "Asia/Ho_Chi_Minh") -> DataFrame:
    """Text columns to configured types in one projection: trimmed, empty to null, cast (unreadable: null); timestamps
    are shifted from UTC to ``zone``."""
    out = []
    for f in schema:
        text = F.nullif(F.trim(col(f["name"])), F.lit(""))
        value = text.try_cast(f.get("type", "string"))
        if f.get("type") == "timestamp" and zone:
            value = F.from_utc_timestamp(value, zone)
        out.append(value.alias(f.get("new_name", f["name"])))
    return df.select(*out)


def read_csv(spark: SparkSession, spec: Input) -> DataFrame:
    s = spec.serde
    df = spark.read.options(
        header=s.header, sep=s.delimiter, encoding=s.encoding, escape=s.escape, quote=s.quote, multiLine=s.multi_line, inferSchema=False, **s.options
    ).csv(spec.paths())
    return project_schema(df, spec.schema) if spec.schema else df


def read_parquet(spark: SparkSession, spec: Input) -> DataFrame | None:
    """Parquet with partition discovery; None where no path exists and that is allowed."""
    there = [p for p in spec.paths() if path_exists(spark, p)]
    if not there:
        if spec.empty_allow:
            return None
        raise FileNotFoundError(f"no such path: {spec.paths()}")
    return in_partitions(spark.read.options(**spec.options).parquet(*there), spec.partition)


def read_json(spark: SparkSession, spec: Input) -> DataFrame:
    return spark.read.options(multiLine=spec.serde.multi_line, encoding=spec.serde.encoding, **spec.serde.options).json(spec.paths())


def read_raw(spark: SparkSession, spec: Input) -> DataFrame | None:
    kind = spec.serde.format.upper()
    by_format = {"CSV": read_csv, "PARQUET": read_parquet, "JSON": read_json}
    if kind not in by_format:
        raise ValueError(f"unknown format {kind}")
    return by_format[kind](spark, spec)


def partition_predicate(p: Partition) -> Column | None:
    """The filter for the chosen dates, as an ordinary condition that prunes partitions; None for all."""
    if p.predicate:
        return F.expr(p.predicate)
    if p.data_date is None or not p.column:
        return None
    if p.data_date_type == "list":
        return col(p.column).isin(list(p.data_date))
    if p.data_date_type == "range":
        ranges = p.data_date if isinstance(p.data_date[0], (list, tuple)) else [p.data_date]
        if len(ranges) != 1:
            raise ValueError("one range of dates at a time")
        start, end = map(dt.date.fromisoformat, ranges[0])
        return col(p.column).between(str(start - dt.timedelta(days=p.extend_range)), str(end))
    return col(p.column) == p.data_date


def in_partitions(df: DataFrame, p: Partition) -> DataFrame:
    """Filter by partition; an empty single date falls back to the nearest one within ``max_offset`` days before it."""
    condition = partition_predicate(p)
    if condition is None:
        return df
    chosen = df.where(condition)
    if not p.max_offset or p.data_date_type is not None or not chosen.isEmpty():
        return chosen
    return nearest_partition(df, p.column, p.data_date, p.max_offset)


def nearest_partition(df: DataFrame, column: str, date: str, max_offset: int) -> DataFrame:
    """The rows of the greatest partition from ``max_offset`` days before ``date`` up to it; the greatest value is found
    by a partition-only aggregate."""
    low = str(dt.date.fromisoformat(date) - dt.timedelta(days=max_offset))
    best = df.where(col(column).cast("string").between(low, date)).agg(F.max(col(column).cast("string"))).first()[0]
    return df.where(col(column).cast("string") == best) if best is not None else df.where(F.lit(False))


def read_catalog(spark: SparkSession, spec: Input) -> DataFrame | None:
    if not spark.catalog.tableExists(spec.table):
        if spec.empty_allow:
            return None
        raise ValueError(f"no such table: {spec.table}")
    return in_partitions(spark.table(spec.table), spec.partition)


def read_sql(spark: SparkSession, spec: Input) -> DataFrame:
    return spark.sql(spec.query)


def read_jdbc(spark: SparkSession, spec: Input) -> DataFrame:
    """Table, or a query pushed to the database; ``options`` hold url, credentials and the partitioned-read settings."""
    target = f"({spec.query}) pushed" if spec.query else spec.table
    return spark.read.format("jdbc").options(**spec.options).option("dbtable", target).load()


def read_xml_tax(spark: SparkSession, spec: Input) -> DataFrame:
    """Tax payer rows of XML files (row tag by option ``rowTag``), parsed by the built-in source."""
    papers = ",".join(f"{c}:string" for c in TAX_PAPERS)
    tag = spec.options.get("paperTag", "ROW_GIAYTO")
    schema = ", ".join(f"{c} string" for c in TAX_FIELDS) + f", TTIN_GIAYTO struct<{tag}:array<struct<{papers}>>>"
    df = spark.read.format("xml").options(rowTag=spec.options.get("rowTag", "ROW_CTIET")).schema(schema).load(spec.paths())
    return flatten_tax_rows(df, F.col(f"TTIN_GIAYTO.{tag}"))


def read_lineage(spark: SparkSession, spec: Input) -> DataFrame:
    from brookweave.operators.reshaping import lineage_rows

    return lineage_rows(read_json(spark, spec))


_STAGED: OrderedDict[Any, DataFrame | None] = OrderedDict()


def read_staging(spark: SparkSession, spec: Input, most: int = 128) -> DataFrame | None:
    """A catalog read that is remembered by session, table and predicate (the ``most`` latest ones, until
    :func:`forget_staging`); None where there is nothing."""
    key = (spark.sparkContext.applicationId, spec.table, str(spec.partition))
    if key not in _STAGED:
        df = read_catalog(spark, spec)
        _STAGED[key] = None if df is None or df.isEmpty() else df
        while len(_STAGED) > most:
            _STAGED.popitem(last=False)
    _STAGED.move_to_end(key)
    return _STAGED[key]


def forget_staging() -> None:
    _STAGED.clear()


READERS: dict[str, Callable[[SparkSession, Input], DataFrame | None]] = {
    "raw": read_raw, "catalog": read_catalog, "catalog_sql": read_sql, "spark_sql": read_sql, "jdbc": read_jdbc,
    "xml_tax": read_xml_tax, "dynamo_datalineage": read_lineage, "t24_staging": read_staging,
}


def read(spark: SparkSession, spec: Input) -> DataFrame | None:
    return READERS[spec.reader_type](spark, spec)


def read_all(spark: SparkSession, specs: Sequence[Input]) -> dict[str, DataFrame | None]:
    return {s.name: read(spark, s) for s in specs}


# --- key/value access on a table of items ---------------------------------------------------------------------------


def get_item(df: DataFrame, key: Mapping[str, Any], required: bool = False) -> DataFrame:
    """The item of a full key (one row). A missing one gives no row, or a KeyError where it is ``required``."""
    found = query_items(df, key).limit(1)
    if required and found.isEmpty():
        raise KeyError(dict(key))
    return found


def query_items(df: DataFrame, key: Mapping[str, Any], between: tuple[str, Any, Any] | None = None, project: Sequence[Column | str] = ()) -> DataFrame:
    """All items of a hash key, optionally in a range of the sort key, projected."""
    for k, v in key.items():
        df = df.where(col(k) == v)
    if between:
        df = df.where(col(between[0]).between(between[1], between[2]))
    return df.select(*project) if project else df


def scan_items(df: DataFrame, condition: Column | str, project: Sequence[Column | str] = ()) -> DataFrame:
    df = df.where(condition)
    return df.select(*project) if project else df


def sample_items(spark: SparkSession, path: str, n: int = 250, multi_line: bool = True) -> DataFrame:
    """The first ``n`` items of a JSON list, or of a file of one item per line (the feature is the limit)."""
    return spark.read.json(path, multiLine=multi_line).limit(n)


def source_and_target(spark: SparkSession, source: Input, target: str) -> tuple[DataFrame | None, DataFrame]:
    """The frames of a merge: an input and the catalog table it goes to."""
    return read(spark, source), spark.table(target)


def to_pandas(spark: SparkSession, query: str, most_rows: int = 100_000):
    """A small result as pandas; a larger one is refused rather than brought to the driver."""
    rows = spark.sql(query).limit(most_rows + 1).toPandas()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    return rows
