"""Schemas of the tables the package reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from pricepanel.fixed_values import PANEL_COLUMNS, PANEL_DATE, TARGETS


NAMES = {
    "bigint": T.LongType, "date": T.DateType, "double": T.DoubleType, "string": T.StringType,
    "timestamp": T.TimestampType,
}


def columns_of(text: str) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session, unlike DDL parsing."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(n, NAMES[t]()) for n, t in pairs])


def _list(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


def _one(name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind)])


def panel_schema(columns: Sequence[str] = tuple(PANEL_COLUMNS), date: str = PANEL_DATE) -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in columns]
    return T.StructType([*fields, T.StructField(date, T.DateType())])


def stored_panel_schema(columns: Sequence[str]) -> T.StructType:
    """The cleaned panel on disk: partitioned by the first day of the month."""
    return T.StructType([
        T.StructField("date", T.DateType()),
        *[T.StructField(c, T.DoubleType()) for c in columns],
        T.StructField("month", T.DateType()),
    ])


def forecast_schema(targets: Sequence[str] = tuple(TARGETS)) -> T.StructType:
    fields = [T.StructField(t, T.DoubleType()) for t in targets]
    return T.StructType([
        T.StructField("forecast_date", T.DateType()), *fields, T.StructField("model", T.StringType(), False),
    ])


def history_schema(targets: Sequence[str] = tuple(TARGETS)) -> T.StructType:
    return T.StructType([*forecast_schema(targets).fields, T.StructField("run_date", T.DateType())])


ERRORS = columns_of(
    "run_date date, forecast_date date, model string, target string, previous_actual double, "
    "actual double, predicted double, abs_error double, ape double, predicted_direction bigint, "
    "actual_direction bigint, direction_hit bigint"
)
QUALITY = columns_of(
    "review_date date, review_ts timestamp, table_name string, metric_group string, metric string, "
    "series string, data_date date, value double, threshold double, status string, detail string"
)
RUN_LOG = columns_of(
    "run_date date, run_ts timestamp, stage string, status string, table_name string, n_rows bigint, "
    "min_date date, max_date date, expected_rows bigint, detail string"
)
# Dimensions: variable descriptions per target, and the days a market is open.
VARIABLES = columns_of(
    "target string, target_name string, forecast_frequency string, business_days bigint, "
    "variable string, variable_order bigint, long_name string, description string"
)
OPEN_DAYS = columns_of("key string, date date, target string")
FEATURES = columns_of("target string, variable string, used string")

# Payloads as they are landed.
QUOTES = _one("quote", _list(T.StructField("close", T.ArrayType(T.DoubleType()))))
CHART_PAYLOAD = _one("chart", _one("result", _list(
    T.StructField("timestamp", T.ArrayType(T.LongType())), T.StructField("indicators", QUOTES),
)))
ENERGY_PAYLOAD = _one("response", _one("data", T.ArrayType(columns_of("period string, value string"))))
COUNTRY_ROWS = T.ArrayType(columns_of("date string, countryiso3code string, value string"))
