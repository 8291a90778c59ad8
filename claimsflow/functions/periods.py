"""Submission-period parsing and formatting (column expressions only).

Periods arrive as free text.  The reports read them three different ways on
(the raw text becomes a column name and is only ordered).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the reference reports.  Java regex: \z is the true end of
# input, "$" would also accept a trailing newline.
STRICT_YEAR_MONTH = r"^\d{4}-(0[1-9]|1[0-2])\z"
ANY_YEAR_MONTH = r"^\d{4}-\d{2}\z"
YEAR_MONTH_DAY = r"^\d{4}-\d{2}-\d{2}\z"
MON_YEAR = r"^[A-Za-z]{3}-\d{4}\z"


def _to_date(text: Column, fmt: str, on_bad_period: str) -> Column:
    if on_bad_period == "error":
        return F.to_date(text, fmt)
    if on_bad_period == "null":
        return F.try_to_date(text, fmt)
    raise ValueError(f"on_bad_period must be 'error' or 'null', not {on_bad_period!r}")


def month_start_strict(period: Column, on_bad_period: str = "error") -> Column:
    """DT-1: ``YYYY-MM`` (month 01-12) or ``Mon-YYYY`` in any case; else null."""
    return (
        F.when(period.rlike(STRICT_YEAR_MONTH),
               _to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd", on_bad_period))
        .when(period.rlike(MON_YEAR), _to_date(F.initcap(period), "MMM-yyyy", on_bad_period))
    )


def period_date_wide(period: Column, on_bad_period: str = "error") -> Column:
    """DT-2: ``YYYY-MM-DD`` (day kept), ``YYYY-MM`` (any two digits), ``MON-YYYY``.

    An out-of-range month or day, or an unknown month name, fails the job as
    the database would; ``on_bad_period='null'`` turns such rows into nulls.
    """
    return (
        F.when(period.rlike(YEAR_MONTH_DAY), _to_date(period, "yyyy-MM-dd", on_bad_period))
        .when(period.rlike(ANY_YEAR_MONTH),
              _to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd", on_bad_period))
        .when(period.rlike(MON_YEAR), _to_date(F.initcap(period), "MMM-yyyy", on_bad_period))
    )


def mon_yyyy(day: Column) -> Column:
    """DT-3: date -> ``APR-2025``."""
    return F.upper(F.date_format(day, "MMM-yyyy"))


def yyyymm_key(mon_text: Column) -> Column:
    """DT-8: sort key of a ``MON-YYYY`` text; blank or unparsable -> null (D6)."""
    return F.date_format(F.try_to_date(F.initcap(mon_text), "MMM-yyyy"), "yyyyMM")


def month_order(period: Column) -> Column:
    """DT-9 / UDF-1: month number of the first three letters, 99 if none."""
    first3 = F.initcap(F.substring(period, 1, 3))
    return F.coalesce(
        F.month(F.try_to_date(F.concat(first3, F.lit("-2000")), "MMM-yyyy")),
        F.lit(99))


def year_order(period: Column, on_bad_period: str = "error") -> Column:
    """DT-10: ``SUBSTRING(p, 5)::INTEGER``.  ``2025-04`` gives -4; ``2025-04-01``
    fails like the database unless ``on_bad_period='null'`` (D7)."""
    tail = F.substr(period, F.lit(5))
    if on_bad_period == "error":
        return tail.cast("int")
    return tail.try_cast("int")
