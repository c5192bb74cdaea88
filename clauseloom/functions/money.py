"""Amounts and currencies in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv

_MARKS = "".join(m for m in fv.CURRENCY_MARKS if len(m) == 1)
_CODES = "|".join(m for m in fv.CURRENCY_MARKS if len(m) > 1)
_NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"
_UNIT = rf"(?: ?(?i:{'|'.join(fv.AMOUNT_UNITS)})\b)?"
AMOUNT = rf"(?:[{_MARKS}]|\b(?:{_CODES})) ?{_NUMBER}{_UNIT}|(?<![0-9.,]){_NUMBER}{_UNIT} ?(?:{_CODES})\b"
PERCENT = r"[0-9]+(?:\.[0-9]+)? ?%"


def amounts(text: Column) -> Column:
    """All amounts with a currency mark before or a currency code behind the number, as written."""
    return F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0))


def number(amount: Column) -> Column:
    """Numeric value of one amount as ``amounts`` gives it; null when there is no number."""
    digits = F.replace(F.regexp_extract(amount, _NUMBER, 0), F.lit(","), F.lit(""))
    unit = F.lower(F.regexp_extract(amount, rf"{_NUMBER} ?((?i:{'|'.join(fv.AMOUNT_UNITS)})\b)", 1))
    factor = F.lit(1)
    for word, times in fv.AMOUNT_UNITS.items():
        factor = F.when(unit == word, F.lit(times)).otherwise(factor)
    return (digits.try_cast("decimal(20,4)") * factor).try_cast("decimal(20,4)")


def currency(amount: Column) -> Column:
    mark = F.regexp_extract(amount, rf"([{_MARKS}]|{_CODES})", 1)
    code = F.lit(None).cast("string")
    for written, name in fv.CURRENCY_MARKS.items():
        code = F.when(mark == written, F.lit(name)).otherwise(code)
    return code


def largest(found: Column, code: str | None = None) -> Column:
    """The (value, text) of the largest amount, of the currency ``code`` alone if given; the last text on a tie."""
    kept = found if code is None else F.filter(found, lambda a: currency(a) == code)
    return F.array_max(F.transform(kept, lambda a: F.struct(number(a).alias("value"), a.alias("text"))))


def largest_each(found: Column) -> Column:
    """The (currency, value, text) of the largest amount of each currency, in the order in which the currencies are first named."""
    codes = F.array_distinct(F.transform(found, currency))
    return F.transform(codes, lambda code: F.array_max(F.transform(
        F.filter(found, lambda a: currency(a) == code), lambda a: F.struct(code.alias("currency"), number(a).alias("value"), a.alias("text")))))
