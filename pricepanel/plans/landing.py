"""Landing: from fetched documents to the raw panel the daily run starts from.

Fetching is not done here.  Documents are frames ``name, payload`` (``payloads.read_payloads``
reads a folder of them), coded macro series are rows ``code, date, value``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricepanel import fixed_values as fv
from pricepanel.operators import panel as P
from pricepanel.sinks.files import write_panel
from pricepanel.sources import payloads


@dataclass(frozen=True)
class Landed:
    """What was fetched; a source that brought nothing is None."""

    charts: DataFrame
    macro: DataFrame | None = None
    energy: DataFrame | None = None
    money: DataFrame | None = None


@dataclass(frozen=True)
class Names:
    """Source name -> panel column.  The target symbols define the calendar."""

    targets: Mapping[str, str] = field(default_factory=lambda: dict(fv.TARGET_SYMBOLS))
    charts: Mapping[str, str] = field(default_factory=lambda: {
        **fv.INDEX_SYMBOLS, **{s: s for s in (*fv.SHARE_SYMBOLS, *fv.PRODUCER_SYMBOLS)}})
    macro: Mapping[str, str] = field(default_factory=lambda: {**fv.RATE_CODES, **fv.GDP_CODES, **fv.UNEMPLOYMENT_CODES})
    energy: Mapping[str, str] = field(default_factory=lambda: dict(fv.ENERGY_SERIES))
    money: Mapping[str, str] = field(default_factory=lambda: dict(fv.MONEY_COUNTRIES))


def read_landed(spark: SparkSession, charts: str, macro: str | None = None, energy: str | None = None,
                money: str | None = None) -> Landed:
    """Folders of JSON documents, and of CSV files ``code, date, value`` for macro series."""
    rows = None if macro is None else spark.read.schema("code string, date string, value string").csv(macro, header=True)
    documents = [None if path is None else payloads.read_payloads(spark, path) for path in (energy, money)]
    return Landed(payloads.read_payloads(spark, charts), rows, *documents)


def raw_panel(landed: Landed, as_of: dt.date, names: Names | None = None, days: int = fv.LOOKBACK_DAYS) -> DataFrame:
    """``date`` and one column per name, on the dates of the last ``days`` days before ``as_of``
    on which some target has a price.

    Series of lower frequency hold NULL on the dates without a value of theirs; their other
    dates are lost.  A name that no document brings is a column of NULLs.
    """
    n = names or Names()

    def wide(long: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        # the calendar lies within the look-back, so nothing older need be shuffled
        return P.to_wide(payloads.lookback(long, as_of, days), list(dict.fromkeys(columns.values())), ["date"])

    first = wide(payloads.parse_charts(landed.charts, n.targets, as_of), n.targets)
    others = [wide(payloads.parse_charts(landed.charts, n.charts, as_of), n.charts)]
    if landed.macro is not None:
        start = as_of - dt.timedelta(days=days)
        others.append(wide(payloads.named_series(landed.macro, n.macro, start), n.macro))
    if landed.energy is not None:
        others.append(wide(payloads.parse_energy(landed.energy, n.energy), n.energy))
    if landed.money is not None:
        others.append(payloads.lookback(payloads.parse_country_years(landed.money, n.money), as_of, days))
    brought = {c for df in (first, *others) for c in df.columns}
    missing = [c for m in (n.macro, n.energy, n.money) for c in m.values() if c not in brought]
    panel = P.left_align(first, others)
    return panel.withColumns({c: F.lit(None).cast("double") for c in dict.fromkeys(missing)}) if missing else panel


def land(landed: Landed, as_of: dt.date, path: str, names: Names | None = None, days: int = fv.LOOKBACK_DAYS) -> None:
    """Write the raw panel.  Raises ``ValueError``, with the file untouched, if no target has a
    price in the look-back."""
    panel = raw_panel(landed, as_of, names, days)
    if not panel.take(1):
        raise ValueError("no prices of the targets")
    write_panel(panel, path)
