"""Choosing columns by pattern."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, patterns: str | Iterable[str]) -> list[str]:
    """Names that match any pattern in full, in the order of the schema. A pattern that matches nothing is no error."""
    found = [re.compile(p) for p in ([patterns] if isinstance(patterns, str) else patterns)]
    return [c for c in df.columns if any(p.fullmatch(c) for p in found)]


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def apply(df: DataFrame, patterns: str | Iterable[str], build: Callable[[Column], Column]) -> DataFrame:
    """Replace all matching columns in one projection."""
    return df.withColumns({c: build(col(c)) for c in pick(df, patterns)})


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
