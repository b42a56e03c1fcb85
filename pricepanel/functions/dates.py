"""Business-calendar expressions.  Monday to Friday are business days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_business_day(day: Column) -> Column:
    return F.weekday(day) < 5


def expected_data_date(as_of: Column) -> Column:
    """Last weekday before ``as_of``: the newest date a fresh table must hold."""
    back = F.when(F.weekday(as_of) == 0, 3).when(F.weekday(as_of) == 6, 2).otherwise(1)
    return F.date_sub(as_of, back)


def next_business_days(day: Column, n: int) -> Column:
    """Array of the ``n`` business days after ``day``."""
    span = F.sequence(F.date_add(day, 1), F.date_add(day, 2 * n + 4))
    return F.slice(F.filter(span, is_business_day), 1, n)


def years_before(day: Column, years: int) -> Column:
    return F.add_months(day, -12 * years)


def to_day(value: Column) -> Column:
    """Day of a date, timestamp or text column; NULL where the text is no date."""
    return F.to_date(F.try_to_timestamp(value.cast("string")))


def day_of(df: DataFrame, column: str) -> Column:
    """Day of a column of ``df``; only text is parsed, so a filter on a date column still reaches
    the scan."""
    kind = df.schema[column].dataType.typeName()
    day = F.col(column)
    return day if kind == "date" else F.to_date(day) if kind.startswith("timestamp") else to_day(day)
