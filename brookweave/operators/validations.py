"""Filters and validations: drop the row, or null the value."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookweave.columns import col, pick, type_of
from brookweave.registry import operator, rule

#: Simple address form: a local part, one @, a domain of at least two labels.
EMAIL = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z0-9]$"
#: Any local part of letters, digits, blanks and the allowed signs; labels; the start of a top domain.
ADDRESS = r"^(?:\([\w .+]+\) )?[\w !#$%&'*+/=?^`{|}~.]+@(?:\w+\.)+(?:[a-z]{2,24}|[0-9]{1,3})"


def keep(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """Rows for which all conditions hold (one filter, so it reaches the scan as a whole)."""
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return df.where(out) if conditions else df


def check(df: DataFrame, names: Sequence[str], condition: Callable[[Column], Column], mandatory: bool) -> DataFrame:
    if mandatory:
        return keep(df, [condition(col(c)) for c in names])
    return df.withColumns({c: F.when(condition(col(c)), col(c)) for c in names})


@operator()
def filter_with_regex_pattern(df: DataFrame, column: str, pattern: str, inverse: bool = False) -> DataFrame:
    """Rows whose text contains (``inverse``: does not contain) the pattern; nulls go either way."""
    found = col(column).rlike(pattern)
    return df.where(~found if inverse else found)


@operator()
def drop_record_if_none_in_primary_column(df: DataFrame, primary_columns: Sequence[str]) -> DataFrame:
    return keep(df, [col(c).isNotNull() for c in primary_columns])


@rule()
def mandatory_input(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    conditions = []
    for name in pick(df, column_patterns):
        there = col(name).isNotNull()
        conditions.append(there & (F.trim(col(name)) != "") if type_of(df, name) == "string" else there)
    return keep(df, conditions)


@rule()
def valid_customer_id(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    df = mandatory_input(df, column_patterns)
    return keep(df, [col(c).try_cast("decimal(38,0)").between(0, 9999999999) for c in pick(df, column_patterns)])


@rule()
def valid_numeric(
    df: DataFrame, column_patterns: Sequence[str], min_value: float | None = None, max_value: float | None = None, is_mandatory: bool = False
) -> DataFrame:
    """Values from ``min_value`` to ``max_value``. A text is compared by the number it reads as; one that reads as none is
    no valid value."""
    if min_value is None and max_value is None:
        raise ValueError("valid_numeric needs min_value or max_value")
    names = pick(df, column_patterns)
    texts = {c for c in names if type_of(df, c) == "string"}

    def inside(name: str) -> Column:
        c = col(name).try_cast("double") if name in texts else col(name)
        out = F.lit(True)
        if min_value is not None:
            out = out & (c >= min_value)
        return out & (c <= max_value) if max_value is not None else out

    if is_mandatory:
        return keep(df, [inside(c) for c in names])
    return df.withColumns({c: F.when(inside(c), col(c)) for c in names})


@rule()
def valid_alphanumeric(df: DataFrame, column_patterns: Sequence[str], is_mandatory: bool = False) -> DataFrame:
    return check(df, pick(df, column_patterns), lambda c: c.rlike(r"^[A-Za-z0-9]+\z"), is_mandatory)


@rule()
def valid_numeric_string(df: DataFrame, column_patterns: Sequence[str], is_mandatory: bool = False) -> DataFrame:
    return check(df, pick(df, column_patterns), lambda c: c.rlike(r"^[0-9]+\z"), is_mandatory)


@rule()
def remove_duplicate_customer_id(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    """Keeps the rows whose id occurs exactly once; all copies of a repeated id go, and null ids.

    The ids that occur once are counted with a partial aggregate and met by a semi join: a hot id is one row there.
    """
    for name in pick(df, column_patterns):
        once = df.where(col(name).isNotNull()).groupBy(col(name).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
        df = df.join(once, col(name) == F.col("_id"), "left_semi")
    return df


def _arrays(df: DataFrame, patterns: Sequence[str], build: Callable[[Column], Column]) -> DataFrame:
    names = pick(df, patterns)
    for name in names:
        if type_of(df, name) != "array<string>":
            raise TypeError(f"{name} is {type_of(df, name)}, not array<string>")
    return df.withColumns({c: F.transform(col(c), build) for c in names})


@rule()
def valid_phone_number(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    """Elements of digits and ``+(). `` keep their digits; others become null."""
    return _arrays(df, column_patterns, lambda e: F.when(e.rlike(r"^[0-9+(). ]+\z"), F.regexp_replace(e, r"[+(). ]+", "")))


@rule()
def valid_email(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    return _arrays(df, column_patterns, lambda e: F.when(e.rlike(EMAIL), e))


@rule()
def valid_mnemonic(df: DataFrame, column_patterns: Sequence[str]) -> DataFrame:
    """3 to 10 characters, capitals first, then capitals, digits and dots; rows with another value go."""
    good = lambda c: F.length(c).between(3, 10) & c.rlike(r"^[A-Z]+[A-Z0-9.]+\z")
    return keep(df, [good(col(c)) for c in pick(df, column_patterns)])


@operator()
def validate_phone(df: DataFrame, column_name: str) -> DataFrame:
    """Keeps digits, parentheses, plus and hyphen."""
    return df.withColumn(column_name, F.regexp_replace(col(column_name), r"[^(0-9)+-]", ""))


@operator()
def validate_email(df: DataFrame, column_name: str) -> DataFrame:
    """Lower case with hyphens as underscores if that is an address, with or without a name in parentheses before it;
    else an empty text (null too). The top domain has 2 to 24 letters, or is the last part of a numeric address."""
    text = F.translate(F.lower(col(column_name)), "-", "_")
    return df.withColumn(column_name, F.when(text.rlike(ADDRESS), text).otherwise(""))


@operator()
def filter_partition_date(df: DataFrame, column_name: str, date: str) -> DataFrame:
    return df.where(col(column_name).try_cast("date") == F.lit(date).cast("date"))


@operator()
def drop_all_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty texts become null; rows in which all the columns are null go. Columns of other types are only tested for null."""
    df = df.withColumns({c: F.when(col(c) != "", col(c)) for c in columns if type_of(df, c) == "string"})
    return df.where(F.coalesce(*[col(c).cast("string") for c in columns]).isNotNull())
