"""Landed JSON payloads.  Fetching them is not done here.

Every parser takes a frame ``name, payload`` (one landed document per row), so documents are
parsed in parallel and never on the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricepanel.functions.dates import to_day
from pricepanel.functions.numbers import clean_number
from pricepanel.operators.panel import keep_last, to_wide
from pricepanel.schema import CHART_PAYLOAD, COUNTRY_ROWS, ENERGY_PAYLOAD


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``name, payload`` of a folder of JSON documents; the name is the file's stem."""
    files = spark.read.text(path, wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.json)?$", 1)
    # metadata holds the name URL-encoded; a plus sign is not encoded in paths
    name = F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    return files.select(name.alias("name"), F.col("value").alias("payload"))


def _named(names: Mapping[str, str]) -> Column:
    """Column name for a source name; NULL if the name is not listed."""
    listed = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return listed[F.col("name")]


def lookback(df: DataFrame, as_of: dt.date, days: int = 10, date: str = "date") -> DataFrame:
    """The days before ``as_of``, without it: a running day has no close yet."""
    return df.where((F.col(date) >= F.date_sub(F.lit(as_of), days)) & (F.col(date) < F.lit(as_of)))


def parse_charts(landed: DataFrame, symbols: Mapping[str, str], as_of: dt.date) -> DataFrame:
    """Long panel from price-chart payloads: closes by day, the last of a day, before ``as_of``."""
    doc = F.from_json("payload", CHART_PAYLOAD)["chart"]["result"]
    first = F.get(doc, F.lit(0))
    rows = landed.select(_named(symbols).alias("series"), first.alias("r")).where(F.col("series").isNotNull())
    pairs = F.arrays_zip(
        F.col("r.timestamp").alias("ts"),
        F.get(F.col("r.indicators.quote"), F.lit(0))["close"].alias("close"),
    )
    points = rows.select("series", F.posexplode(pairs).alias("pos", "p")).select(
        "series", "pos", F.to_date(F.timestamp_seconds("p.ts")).alias("date"), F.col("p.close").alias("value")
    )
    valid = points.where(F.col("date").isNotNull() & F.col("value").isNotNull() & (F.col("date") < F.lit(as_of)))
    return keep_last(valid, ["series", "date"], ["pos"]).select("series", "date", "value")


def parse_energy(landed: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Long panel from ``response.data`` payloads; periods may be days or months."""
    data = F.from_json("payload", ENERGY_PAYLOAD)["response"]["data"]
    points = landed.select(_named(names).alias("series"), F.posexplode(data).alias("pos", "p")).select(
        "series", "pos", to_day(F.col("p.period")).alias("date"), clean_number(F.col("p.value")).alias("value")
    )
    valid = points.where(F.col("series").isNotNull() & F.col("date").isNotNull())
    return keep_last(valid, ["series", "date"], ["pos"]).select("series", "date", "value")


def parse_country_years(landed: DataFrame, countries: Mapping[str, str]) -> DataFrame:
    """Wide panel from ``[meta, rows]`` payloads: one column per country, dated 31 December.

    The first non-null value per year and country counts.  Columns follow the country list.
    """
    rows = F.from_json(F.get_json_object("payload", "$[1]"), COUNTRY_ROWS)
    points = landed.select("name", F.posexplode(rows).alias("pos", "p")).select(
        F.make_date(F.expr("try_cast(p.date AS int)"), F.lit(12), F.lit(31)).alias("date"),
        F.upper("p.countryiso3code").alias("country"),
        clean_number(F.col("p.value")).alias("value"),
        F.struct("name", "pos").alias("at"),
    )
    valid = points.where(F.col("date").isNotNull() & F.col("country").isin(list(countries)))
    first = valid.groupBy("date", "country").agg(
        F.min_by("value", F.when(F.col("value").isNotNull(), F.col("at"))).alias("value")
    )
    wide = to_wide(first, list(countries), ["date"], series="country")
    return wide.select("date", *[F.col(c).alias(n) for c, n in countries.items()])


def named_series(landed: DataFrame, codes: Mapping[str, str], start: dt.date) -> DataFrame:
    """Long panel of coded macro series (``code, date, value``) from a start date on."""
    named = landed.withColumn("name", F.col("code")).select(
        _named(codes).alias("series"), to_day(F.col("date")).alias("date"),
        clean_number(F.col("value")).alias("value"),
    )
    return named.where(F.col("series").isNotNull() & (F.col("date") >= F.lit(start)))
