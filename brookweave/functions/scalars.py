"""Normalisation of dirty scalar values, shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters with the Unicode property White_Space, and the controls Python counts as space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """The text without outer white space."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    """Stripped text; null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def fold_key(c: Column) -> Column:
    """A key compared without regard to letter case and outer space; null where blank."""
    return F.upper(blank_to_null(c.cast("string")))


def as_number_text(c: Column) -> Column:
    """Canonical text of a number so that 1, 1.0 and 1.00 agree; other text stays as stripped; null where blank."""
    text = blank_to_null(c.cast("string"))
    return F.coalesce(text.try_cast("decimal(38,18)").cast("string"), text)


def day_number(c: Column) -> Column:
    """yyyyMMdd of a date or timestamp as a number."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def attribute_hash(struct: str, names) -> Column:
    """64-bit hash of a struct's fields; a null counts, so that a value that moves to another field changes the hash."""
    parts = []
    for n in names:
        parts += [F.col(f"{struct}.{n}"), F.col(f"{struct}.{n}").isNull()]
    return F.xxhash64(*parts)
