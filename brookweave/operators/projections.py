"""Naming, adding and dropping columns."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.columns import col, pick
from brookweave.registry import operator

#: DataFrame methods and functions that a configured step may call; nothing that runs a job or writes.
METHODS = frozenset(
    "select selectExpr filter where withColumn withColumnRenamed drop dropDuplicates distinct limit orderBy sort groupBy fillna dropna alias repartition coalesce toDF".split()
)
FUNCTIONS = frozenset(
    "col lit expr when coalesce upper lower trim concat concat_ws to_date date_format current_date substring regexp_replace split element_at sha2 md5 round abs length cast".split()
)
CAPITALS, SMALL = frozenset(ascii_uppercase), frozenset(ascii_lowercase)


def snake(name: str) -> str:
    """CamelCase, hyphens and blanks to snake_case.

    A capital begins a word after anything but a capital, or where a small letter follows it: a run of capitals is one
    word, whose last letter belongs to the next word if that goes on in small letters.
    """
    found = [""]
    before = ""
    for letter, after in zip(name, [*name[1:], ""]):
        if letter == "-" or letter.isspace():
            found.append("")
        elif letter in ascii_uppercase and (before not in CAPITALS or after in SMALL):
            found.append(letter)
        else:
            found[-1] += letter
        before = letter
    return "_".join(word for word in found if word).lower()


@operator()
def lower_case_column_name(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: c.lower() for c in pick(df, column_patterns)})


@operator()
def snake_case_column_name(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: snake(c) for c in pick(df, column_patterns)})


@operator()
def cast_to_lower_by_list(df: DataFrame, column_list: Sequence[str]) -> DataFrame:
    """Lower-cases the names of the listed columns (not their values)."""
    return df.withColumnsRenamed({c: c.lower() for c in column_list})


@operator()
def rename_column(df: DataFrame, rename_list: Sequence[Mapping[str, str]]) -> DataFrame:
    return df.withColumnsRenamed({r["origin"]: r["new"] for r in rename_list})


@operator("column_name_standardize", "strip_trailing_chars")
def strip_trailing_chars(df: DataFrame, pattern: str) -> DataFrame:
    """Strips all trailing characters of the *set* ``pattern`` from every name."""
    return df.toDF(*[c.rstrip(pattern) for c in df.columns])


@operator("filter_df")
def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The listed fields, in that order; nested ones by their dotted path, under their last name."""
    return df.select(*[F.col(f) for f in fields])


@operator()
def to_df(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.toDF(*columns)


@operator()
def copy_column(df: DataFrame, new_column: str, copied_column: str) -> DataFrame:
    return df.withColumn(new_column, col(copied_column))


@operator()
def copy_column_ifnull(df: DataFrame, new_column: str, copied_column_1: str, copied_column_2: str) -> DataFrame:
    return df.withColumn(new_column, F.coalesce(col(copied_column_1), col(copied_column_2)))


@operator()
def drop_columns(df: DataFrame, column_list: Sequence[str]) -> DataFrame:
    return df.drop(*column_list)


@operator()
def drop_all_column_except(df: DataFrame, column_list: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c in set(column_list)])


@operator()
def add_constant_column(df: DataFrame, column_name: str, value: Any = None, target_type: str = "string", skip_if_exist: bool = False) -> DataFrame:
    if skip_if_exist and column_name in df.columns:
        return df
    return df.withColumn(column_name, F.lit(value).cast(target_type))


@operator()
def fill_col_if_not_exist(df: DataFrame, column: str) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast("string"))


@operator()
def payload_handle_missing_fields(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    """Adds the listed names (not patterns) that are missing as null strings."""
    return df.withColumns({c: F.lit(None).cast("string") for c in column_patterns if c not in df.columns})


def _day(text: str, fmt: str = "%Y%m%d") -> dt.date:
    return dt.datetime.strptime(text, fmt).date()


@operator()
def add_constant_column_from_cob_date(df: DataFrame, column_name: str, cob_date: str | None = None) -> DataFrame:
    if not cob_date:
        raise ValueError("the pipeline has no cob_date")
    return df.withColumn(column_name, F.lit(_day(cob_date).isoformat()))


@operator()
def add_data_date_from_event(df: DataFrame, column_name: str, event_date: str) -> DataFrame:
    return df.withColumn(column_name, F.lit(event_date).cast("date"))


@operator()
def add_ds_partition_date_by_data_date(
    df: DataFrame, column_name: str, raw_partition: str, date_regex: str = r"\d{8}", date_format: str = "%Y%m%d", offset_date: int = 0
) -> DataFrame:
    """The date found in the raw partition's name, moved by days."""
    return df.withColumn(column_name, F.date_add(F.lit(_found(raw_partition, date_regex, date_format)), offset_date))


@operator()
def get_lst_mth_from_date(
    df: DataFrame, column_name: str, raw_partition: str, date_regex: str = r"\d{8}", date_format: str = "%Y%m%d", offset_date: int = -1
) -> DataFrame:
    """The date found in the raw partition's name, moved by months, as yyyyMM."""
    day = F.lit(_found(raw_partition, date_regex, date_format))
    return df.withColumn(column_name, F.date_format(F.add_months(day, offset_date), "yyyyMM"))


def _found(text: str, regex: str, fmt: str) -> dt.date:
    m = re.search(regex, text)
    if not m:
        raise ValueError(f"no date in {text!r}")
    return _day(m.group(0), fmt)


@operator()
def pyspark_df_function(df: DataFrame, function_name: str, args: Sequence[Any] = (), kwargs: Mapping[str, Any] | None = None) -> DataFrame:
    """Calls an allowed DataFrame method; ``{"__function_name__": f, "args": [...]}`` inside the arguments is an allowed function."""
    if function_name not in METHODS:
        raise ValueError(f"{function_name} is not allowed in a pipeline")

    def value(x: Any) -> Any:
        if isinstance(x, Mapping) and "__function_name__" in x:
            name = x["__function_name__"]
            if name not in FUNCTIONS:
                raise ValueError(f"function {name} is not allowed in a pipeline")
            return getattr(F, name)(*map(value, x.get("args", ())), **{k: value(v) for k, v in x.get("kwargs", {}).items()})
        return [value(v) for v in x] if isinstance(x, list) else x

    return getattr(df, function_name)(*map(value, args), **{k: value(v) for k, v in (kwargs or {}).items()})


@operator("apply_mapping")
def apply_mapping(df: DataFrame, mappings: Sequence[Sequence[str]]) -> DataFrame:
    """Select, rename and cast by ``(source, source type, target, target type)``."""
    return df.select(*[col(source).try_cast(kind).alias(target) for source, _, target, kind in mappings])


@operator()
def get_processing_date(df: DataFrame, column_name: str, now: str | None = None) -> DataFrame:
    """The current time, or the given one."""
    return df.withColumn(column_name, F.lit(now).cast("timestamp") if now else F.current_timestamp())


@operator()
def add_current_date_column(df: DataFrame, column_name: str, now: str | None = None) -> DataFrame:
    return df.withColumn(column_name, F.lit(now).cast("date") if now else F.current_date())


@operator()
def add_current_timestamp_column(df: DataFrame, column_name: str, now: str | None = None) -> DataFrame:
    return get_processing_date(df, column_name, now)


@operator()
def from_uat_date(df: DataFrame, column_name: str) -> DataFrame:
    return df.withColumn(column_name, F.lit("2021-01-01 17:00:00").cast("timestamp"))


def columns_of_type(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns whose type name starts with ``prefix``."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(prefix)]


def main_or_empty(df: DataFrame | None, columns: Sequence[str], required: bool = False) -> DataFrame:
    """``df``; if it is missing or empty, an error where required, else an empty frame of string columns."""
    if df is not None and not df.isEmpty():
        return df
    if required:
        raise ValueError("the main input is empty")
    if df is None:
        raise ValueError("an empty frame needs a session: give an empty frame instead of none")
    return df.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def like(df: DataFrame) -> DataFrame:
    """An empty frame of the same schema."""
    return df.where(F.lit(False))


def concat_position(pos: Column, sub_pos: Column) -> Column:
    return F.concat(pos.cast("string"), F.lit("."), sub_pos.cast("string"))
