"""Text projections used by the reports: blanks, flags, dates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """PRJ-1 / STR-4: value as text, null -> ''. Booleans print true/false."""
    return F.coalesce(c.cast("string"), F.lit(""))


def yn_equals(c: Column, value: str) -> Column:
    """PRJ-2: 'Y' when c equals value, else 'N' (null -> 'N')."""
    return F.when(c == value, F.lit("Y")).otherwise(F.lit("N"))


def yn_present(c: Column) -> Column:
    """PRJ-3: 'Y' when c is not null."""
    return F.when(c.isNotNull(), F.lit("Y")).otherwise(F.lit("N"))


def yn_nonblank(c: Column) -> Column:
    """PRJ-4: 'Y' when c is neither null nor ''."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.lit("Y")).otherwise(F.lit("N"))


def left4(c: Column) -> Column:
    """STR-1: first four characters (may overlap with right4)."""
    return F.left(c, F.lit(4))


def right4(c: Column) -> Column:
    return F.right(c, F.lit(4))


def dmy(c: Column) -> Column:
    """DT-4/5: date (or timestamp, as a date in the session zone) as DD/MM/YYYY, null -> ''."""
    return F.coalesce(F.date_format(F.to_date(c), "dd/MM/yyyy"), F.lit(""))


def dmy_local(ts: Column, zone: str = "Europe/London") -> Column:
    """DT-6: ``ts AT TIME ZONE zone`` then DD/MM/YYYY (session zone must be UTC)."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "dd/MM/yyyy")


def canonical_area(area: Column) -> Column:
    """PRJ-6: CRIME LOWER -> CRIME, LEGAL HELP -> CIVIL (any case), else upper."""
    up = F.upper(area)
    return F.upper(F.when(up == "CRIME LOWER", F.lit("CRIME"))
                   .when(up == "LEGAL HELP", F.lit("CIVIL"))
                   .otherwise(area))


def pack_rowkey(area: Column, office: Column) -> Column:
    """STR-5: concat_ws('|', area, office)."""
    return F.concat_ws("|", area, office)


def rowkey_part(key: Column, n: int) -> Column:
    """STR-6: split_part(key, '|', n); an office containing '|' is cut."""
    return F.split_part(key, F.lit("|"), F.lit(n))
