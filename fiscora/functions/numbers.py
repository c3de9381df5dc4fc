"""Safe casts and exact arithmetic: bad input or overflow is NULL, never an error."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscora.catalog import SENTINELS

# A BIGINT fits in 19 digits, so this is exact for every stored amount.
_EXACT_INTEGER = "decimal(20,0)"
_RATIO = "decimal(38,9)"
_LEAST, _GREATEST = Decimal(-(2**63)), Decimal(2**63 - 1)


def null_if_sentinel(text: Column) -> Column:
    """NULL for the texts the source uses in place of a missing number."""
    return F.when(~text.isin(*SENTINELS), text)


def safe_integer(text: Column) -> Column:
    """Whole number as BIGINT.

    Sentinels need no test of their own here: none of them reads as a number.
    """
    return text.try_cast("bigint")


def safe_numeric(text: Column) -> Column:
    """Decimal number with nine digits after the point, rounded half up.

    Sentinels are common, and the cast would reject each by way of an exception.
    """
    return null_if_sentinel(text).try_cast(_RATIO)


def _if_bigint(exact: Column) -> Column:
    """A whole decimal as BIGINT, NULL where it does not fit. A range test, since ``try_add`` raises
    and catches an exception for every overflowing row."""
    return F.when(exact.between(F.lit(_LEAST), F.lit(_GREATEST)), exact.cast("bigint"))


def safe_add(a: Column, b: Column) -> Column:
    return _if_bigint(promote(a) + promote(b))


def safe_subtract(a: Column, b: Column) -> Column:
    return _if_bigint(promote(a) - promote(b))


def promote(amount: Column) -> Column:
    """Integer amount as an exact decimal, wide enough to subtract without overflow."""
    return amount.cast(_EXACT_INTEGER)


def _quotient(numerator: Column, denominator: Column) -> Column:
    """Guarded quotient. The guard is a test and not ``try_divide``, which would raise
    and catch an exception for every zero; nothing else can fail at these widths."""
    return F.when(denominator != 0, numerator / denominator).cast(_RATIO)


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two integer amounts with nine digits; NULL on a zero or NULL denominator.

    The operands stay integers in DECIMAL form: dividing DECIMAL(38,9) by
    DECIMAL(38,9) would leave Spark only six digits.
    """
    return _quotient(promote(numerator), promote(denominator))


def growth(current: Column, prior: Column) -> Column:
    """Relative change. The difference is taken in decimals: it may not fit a BIGINT."""
    change = (promote(current) - promote(prior)).cast("decimal(21,0)")
    return _quotient(change, promote(prior))


def first_or_sum(reported: Column, a: Column, b: Column) -> Column:
    """The reported amount, else the sum of its two parts when both exist and fit."""
    return F.coalesce(reported, safe_add(a, b))


def cents_to_dollars(cents: Column) -> Column:
    """Cents as an exact two-digit amount."""
    return F.round(F.try_divide(cents.cast("decimal(38,0)"), F.lit(100)), 2).cast("decimal(38,2)")
