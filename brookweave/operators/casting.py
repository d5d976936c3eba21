"""Casts. What cannot be read becomes null."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookweave.columns import apply, col, pick, type_of
from brookweave.functions import dates
from brookweave.registry import operator

Patterns = Sequence[str]


@operator()
def cast(df: DataFrame, column_patterns: Patterns, target_type: str) -> DataFrame:
    return apply(df, column_patterns, lambda c: c.try_cast(target_type))


def _fixed(name: str, kind: str):
    @operator(name)
    def f(df: DataFrame, column_patterns: Patterns) -> DataFrame:
        return cast(df, column_patterns, kind)

    f.__name__ = name
    return f


cast_to_integertype = _fixed("cast_to_integertype", "int")
cast_to_shorttype = _fixed("cast_to_shorttype", "smallint")
cast_to_longtype = _fixed("cast_to_longtype", "bigint")
cast_to_stringtype = _fixed("cast_to_stringtype", "string")
cast_to_booleantype = _fixed("cast_to_booleantype", "boolean")


@operator("cast_to_decimaltype", "cast_to_decimaltype_v2", "cast_to_decimaltype_v3")
def cast_to_decimaltype(df: DataFrame, column_patterns: Patterns, precision: int = 21, scale: int = 6) -> DataFrame:
    return apply(df, column_patterns, lambda c: F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast(f"decimal({precision},{scale})"))


@operator()
def cast_to_arraytype(df: DataFrame, column_patterns: Patterns) -> DataFrame:
    """Text ``[a,b]`` to an array: one outer bracket on each side goes, elements are not trimmed."""
    return apply(df, column_patterns, lambda c: F.split(F.regexp_replace(c, r"^\[|\]$", ""), ","))


@operator()
def boolean_to_int(df: DataFrame, column_name: str) -> DataFrame:
    text = F.upper(col(column_name).cast("string"))
    return df.withColumn(column_name, F.when(text == "TRUE", 1).when(text == "FALSE", 0))


@operator("cast_string_to_timestamp", "cast_string_to_timestamp_type", "da_date_time")
def cast_string_to_timestamp(df: DataFrame, column_patterns: Patterns, timestamp_format: str, timezone: str = "Etc/GMT-7") -> DataFrame:
    """The instant whose wall clock in ``timezone`` reads as the text, independent of the session's zone being UTC."""
    return apply(df, column_patterns, lambda c: dates.in_zone(F.try_to_timestamp(c, F.lit(timestamp_format)), timezone))


@operator()
def cast_string_to_unix_timestamp(df: DataFrame, column_patterns: Patterns, timestamp_format: str, timezone: str = "Etc/GMT-7") -> DataFrame:
    return apply(df, column_patterns, lambda c: F.unix_timestamp(dates.in_zone(F.try_to_timestamp(c, F.lit(timestamp_format)), timezone)))


@operator()
def cast_epoch_ms_to_timestamp(df: DataFrame, column_patterns: Patterns, timezone: str | None = None) -> DataFrame:
    """Milliseconds since the epoch, fraction kept. An instant has no zone: ``timezone`` is accepted and changes nothing."""
    return apply(df, column_patterns, lambda c: F.timestamp_millis(c.try_cast("bigint")))


@operator()
def cast_unix_timestamp_to_timestamp(df: DataFrame, column_patterns: Patterns, timezone: str | None = None) -> DataFrame:
    return apply(df, column_patterns, lambda c: F.timestamp_seconds(c.try_cast("bigint")))


@operator()
def cast_unix_timestamp_to_timestamp_v2(df: DataFrame, column_patterns: Patterns, timezone: str | None = None) -> DataFrame:
    """Milliseconds since the epoch to whole seconds."""
    return apply(df, column_patterns, lambda c: F.timestamp_seconds(F.floor(c.try_cast("bigint") / 1000)))


@operator()
def cast_string_to_date(df: DataFrame, column_patterns: Patterns, date_format: str = "yyyy-MM-dd") -> DataFrame:
    return apply(df, column_patterns, lambda c: dates.parse_date(c, [date_format]))


@operator()
def cast_to_date(df: DataFrame, column_patterns: Patterns, date_format_list: Sequence[str] = dates.DATE_FORMATS) -> DataFrame:
    """Text, arrays and maps of text to dates, by the first format that reads a value."""
    read = lambda c: dates.parse_date(c, date_format_list)
    out = {}
    for name in pick(df, column_patterns):
        kind = type_of(df, name)
        if kind == "string":
            out[name] = read(col(name))
        elif kind == "array<string>":
            out[name] = F.transform(col(name), read)
        elif kind.startswith("map<") and kind.endswith(",string>"):
            out[name] = F.transform_values(col(name), lambda _, v: read(v))
        else:
            raise TypeError(f"{name} is {kind}; dates are read from text")
    return df.withColumns(out)


@operator()
def cast_string_to_dateformat(df: DataFrame, date_format: str, column_patterns: Patterns = (), column_paterns: Patterns = ()) -> DataFrame:
    return apply(df, [*column_patterns, *column_paterns], lambda c: F.date_format(c, date_format))


@operator()
def cast_multiple_fmt_to_timestamp(df: DataFrame, column_patterns: Patterns, timestamp_format_list: Sequence[str] = ()) -> DataFrame:
    """The first of the given formats and of the ISO ones that reads the text; other types are left alone."""
    formats = [*timestamp_format_list, "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"]
    names = [c for c in pick(df, column_patterns) if type_of(df, c) == "string"]
    return df.withColumns({c: dates.parse_time(col(c), formats) for c in names})


@operator()
def da_date(df: DataFrame, column_patterns: Patterns, date_format: str | None = None) -> DataFrame:
    out = {}
    for name in pick(df, column_patterns):
        kind = type_of(df, name)
        if kind.startswith("timestamp"):
            out[name] = col(name).cast("date")
        elif kind == "string":
            out[name] = dates.parse_date(col(name), [date_format]) if date_format else col(name).try_cast("date")
        else:
            raise TypeError(f"{name} is {kind}")
    return df.withColumns(out)


@operator()
def create_partition_by_column(df: DataFrame, rule_list: Sequence[Mapping[str, str]]) -> DataFrame:
    """Partition columns ``yyyy-MM-dd`` by rule: ``month_string`` (yyyyMM), ``timestamp`` or ``date`` of unknown form."""
    out = {}
    for rule in rule_list:
        source = col(rule["source_column"])
        if rule["type"] == "month_string":
            day = dates.parse_date(F.concat(source.cast("string"), F.lit("01")), ["yyyyMMdd"])
        elif rule["type"] == "timestamp":
            day = source.cast("date")
        elif rule["type"] == "date":
            day = dates.parse_date(source.cast("string"))
        else:
            raise ValueError(f"unknown partition rule {rule['type']}")
        out[rule["partition_column"]] = F.date_format(day, "yyyy-MM-dd")
    return df.withColumns(out)


@operator()
def add_partition_date_column(df: DataFrame, column_name: str = "ds_partition_date", source_column: str = "ds_record_created_timestamp") -> DataFrame:
    return df.withColumn(column_name, F.to_utc_timestamp(col(source_column), "UTC+7").cast("date"))


@operator(synonyms={"column_name": "column_patterns"})
def get_last_day_of_month(df: DataFrame, column_patterns: Patterns, date_format: str = "MM/yyyy") -> DataFrame:
    return apply(df, column_patterns, lambda c: F.last_day(dates.parse_date(c, [date_format])))
