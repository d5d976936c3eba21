"""Dates and times out of text; unreadable text gives null, never an error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The formats tried for a date of unknown form, in this order. None is the default reading of a date.
DATE_FORMATS = (
    None,
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "yyyy/MM/dd",
    "dd-MM-yyyy",
    "MM-dd-yyyy",
    "yyyy-MM-dd",
    "dd/MM/yy",
    "MM/dd/yy",
    "dd-MM-yy",
    "MM-dd-yy",
    "yyyyMMdd",
    "ddMMyyyy",
    "yyMMdd",
    "ddMMyy",
)
#: Texts that the default reading takes: a year of four digits, perhaps a month and a day, perhaps a time after the day.
ISO_DATE = r"^\s*\d{4}(?:-\d{1,2}(?:-\d{1,2}(?:[T ].*)?)?)?\s*\z"
#: The end of an open period.
OPEN_DATE, OPEN_EPOCH = "3000-11-08", 32530525200


def shape(fmt: str) -> str | None:
    """Pattern of the texts that a numeric format can read; None for formats with names, zones or fractions."""
    out = ""
    for m in re.finditer(r"([A-Za-z])\1*|'[^']*'|.", fmt):
        part = m.group(0)
        if part[0] in "yMdHms" and len(part) in (1, 2, 4):
            out += r"\d{1,2}" if len(part) == 1 else rf"\d{{{len(part)}}}"
        elif part[0].isalpha() or part[0] == "'":
            return None
        else:
            out += re.escape(part)
    return rf"^{out}\z"


def parse_date(c: Column, formats: Sequence[str | None] = DATE_FORMATS) -> Column:
    """The first format that reads the text. A format is tried only on texts of its shape: a failed attempt costs an
    exception, a pattern does not."""
    tried = []
    for f in formats:
        if f is None:
            tried.append(F.when(c.rlike(ISO_DATE), c.try_cast("date")))
            continue
        read = F.try_to_timestamp(c, F.lit(f)).cast("date")
        tried.append(F.when(c.rlike(shape(f)), read) if shape(f) else read)
    return F.coalesce(*tried)


def parse_time(c: Column, formats: Sequence[str | None]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) if f else F.try_to_timestamp(c) for f in formats])


def date_digits(c: Column, fmt: str | None = None) -> Column:
    """The date as yyyyMMdd, read by the format or, without one, by the first that fits."""
    return F.date_format(parse_date(c, [fmt] if fmt else DATE_FORMATS), "yyyyMMdd")


def in_zone(c: Column, zone: str) -> Column:
    """An instant from a wall-clock timestamp read in ``zone`` (whatever the session's zone is)."""
    return F.to_utc_timestamp(c, zone)


def day_difference(end: Column, start: Column) -> Column:
    """Days from start to end; negative if the end is earlier, null where either is."""
    return F.datediff(end, start)


def first_of_next_month(c: Column) -> Column:
    return F.add_months(F.trunc(c, "month"), 1)


def last_of_next_month(c: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(c, "month"), 1))


def three_months_back(c: Column) -> Column:
    """Three months earlier, that day excluded."""
    return F.date_add(F.add_months(c, -3), 1)


def days(start: Column, end: Column) -> Column:
    """All days from start to end, both included; empty if the end is earlier."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def year_month_day(c: Column) -> Column:
    """``[year, month, day]`` as text without leading zeros, null where no date can be read."""
    day = parse_date(c)
    return F.when(day.isNotNull(), F.array(*[f(day).cast("string") for f in (F.year, F.month, F.dayofmonth)]))


def local_time(c: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """The wall clock in ``zone`` of an instant given in UTC."""
    return F.from_utc_timestamp(c, zone)
