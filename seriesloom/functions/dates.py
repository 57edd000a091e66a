"""Date text to dates, and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = (("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"), ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"), ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "d-M-yyyy"), ("^[0-9]{8}$", "yyyyMMdd"))


def parse_date(text: Column) -> Column:
    """The first format that fits decides; ISO text is never turned round; five digits are
    spreadsheet days from 1899-12-30; days that don't exist give null."""
    t = F.trim(text)
    found = [F.when(t.rlike(shape), F.try_to_date(t, form)) for shape, form in FORMATS]
    serial = F.when(t.rlike("^[0-9]{5}$"), F.date_add(F.lit("1899-12-30").cast("date"), t.try_cast("int")))
    return F.coalesce(*found, serial)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_index(day: Column) -> Column:
    """Months since year 0."""
    return F.year(day) * 12 + F.month(day) - 1


def day_index(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))
