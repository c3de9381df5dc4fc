"""Dates: strict parsing, ingestion dates, and the business calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone in which runs are dated.
BUSINESS_TIMEZONE = "America/Sao_Paulo"

_YEAR_MONTH_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def safe_date(text: Column) -> Column:
    """Year-month-day text as DATE, else NULL.

    The shape test matters: a bare cast would read ``2025`` as a date.
    """
    return F.when(text.rlike(_YEAR_MONTH_DAY), text.try_cast("date"))


def ingest_date(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def business_date(instant_utc: Column) -> Column:
    """Business date of a zone-less timestamp that holds UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(BUSINESS_TIMEZONE), instant_utc)
    return F.to_date(local)


def days_since_monday(day: Column) -> Column:
    """Days since a fixed Monday, so that the weekday is the remainder by seven."""
    return F.date_diff(day, F.to_date(F.lit("1970-01-05")))


def weekday(day: Column) -> Column:
    """Day of the week, Monday = 0."""
    return F.weekday(day)
