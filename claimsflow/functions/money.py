"""Money arithmetic on NUMERIC text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Working type for amounts read from NUMERIC text: exact, 20 digits before the
# point and 18 after it.
AMOUNT = "decimal(38,18)"
MONEY = "decimal(38,2)"
# Types of the two VAT factors: their exact product (with 1/100) has 38 digits.
VAT_AMOUNT = "decimal(25,8)"
VAT_RATE = "decimal(9,4)"
# Fixed pattern of the reference: a plain decimal number, optional sign.
NUMBER_TEXT = r"^[\s+-]?\d+(\.\d+)?\z"


# A digit other than 0 behind the 18th decimal place.
_BEYOND = r"\.\d{18}\d*[1-9]"


def num(c: Column) -> Column:
    """NUMERIC text -> exact decimal.  Text that is no number, ``NaN`` and numbers
    that do not fit (more than 18 decimal places, too) raise: an amount never
    silently becomes null or 0, nor is it rounded."""
    lost = F.concat(F.lit("more than 18 decimal places: "), c)
    return F.when(c.cast("string").rlike(_BEYOND), F.raise_error(lost).cast(AMOUNT)).otherwise(c.cast(AMOUNT))


def _cut(text: Column) -> Column:
    """``text`` without the digits behind the 18th decimal place: towards zero, so
    that rounding to fewer places gives what the whole number gives."""
    return F.regexp_replace(text, r"(\.\d{18})\d+", "$1")


def _exactly(text: Column, kind: str) -> Column:
    """``text`` as ``kind``; raises where that would lose a digit."""
    narrow = text.cast(kind)
    return F.when(text.isNull() | (num(text) == narrow), narrow).otherwise(
        F.raise_error(F.concat(F.lit(f"not exact as {kind}: "), text)).cast(kind))


def money2(c: Column) -> Column:
    """MTH-1: ROUND(x, 2), half away from zero (decimal HALF_UP), 2-dp type."""
    return F.round(c, 2).cast(MONEY)


def guarded_money(text: Column) -> Column:
    """STR-3: the text of ROUND(x,2) if the text looks numeric, else ''."""
    return F.coalesce(
        F.when(text.rlike(NUMBER_TEXT), money2(num(_cut(text))).cast("string")), F.lit(""))


def vat_text(amount_text: Column, rate_text: Column) -> Column:
    """MTH-2: ROUND(amount * rate / 100, 2) as text when both are present."""
    amount = _exactly(amount_text, VAT_AMOUNT)
    share = _exactly(rate_text, VAT_RATE) * F.lit("0.01").cast("decimal(2,2)")
    return F.coalesce(
        F.when(rate_text.isNotNull() & amount_text.isNotNull(),
               money2(amount * share).cast("string")),
        F.lit(""))


def month_total(is_nil: Column, total: Column) -> Column:
    """PRJ-7: a nil submission is worth 0.00 whatever its claims; null is not nil."""
    return F.when(is_nil, F.lit(0).cast(MONEY)).otherwise(money2(F.coalesce(total, F.lit(0))))


def cell_text(value: Column) -> Column:
    """MTH-4/5: COALESCE(ROUND(v,2)::TEXT, ''), the matrix cell as NUMERIC(12,2)
    (a larger value raises, as there)."""
    return F.coalesce(F.round(value, 2).cast("decimal(12,2)").cast("string"), F.lit(""))
