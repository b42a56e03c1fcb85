"""Input frames of the queries, derived from the given tables, and the same in SQL.

Each ``SQL[name]`` is the body of a common table expression; ``with_inputs`` puts the ones a
query names in front of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from pricepanel.operators.panel import by_series

TARGETS = ["gold", "silver", "copper", "brent", "gas"]
PRIORITY = {
    "gold": "1-URGENT", "silver": "2-HIGH", "copper": "3-MEDIUM", "brent": "4-NOT SPECIFIED", "gas": "5-LOW",
}
DRIVERS = ["af_px", "ao_px", "nf_px", "no_px", "rf_px", "ro_px"]
AS_OF = dt.date(2001, 8, 6)
MODELS = ["trend", "level"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def market_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Five targets: the price of the day's last order per priority.  Gaps, weekends included."""
    o = table(spark, sf, "orders")
    key = {t: F.when(F.col("o_orderpriority") == p, F.col("o_orderkey")) for t, p in PRIORITY.items()}
    return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        *[F.max_by("o_totalprice", key[t]).alias(t) for t in TARGETS]
    )


def market_long(spark: SparkSession, sf: str) -> DataFrame:
    return market_wide(spark, sf).unpivot(["date"], TARGETS, "series", "value")


def drivers_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Six covariates: the day's highest line price per return flag and line status."""
    li = table(spark, sf, "lineitem")
    name = F.lower(F.concat("l_returnflag", "l_linestatus", F.lit("_px")))
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        *[F.max(F.when(name == c, F.col("l_extendedprice"))).alias(c) for c in DRIVERS]
    )


def drivers_long(spark: SparkSession, sf: str) -> DataFrame:
    return drivers_wide(spark, sf).unpivot(["date"], DRIVERS, "series", "value")


def supplier_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Many series: quantity shipped per supplier and day (whole numbers)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("series"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("value")
    )


def supplier_series(spark: SparkSession, sf: str) -> DataFrame:
    """The supplier panel by whole series, as many tasks as its size asks for.  The table's number
    of rows, at least the panel's, comes from the footers of its files."""
    return by_series(supplier_panel(spark, sf), table(spark, sf, "lineitem").count())


def gappy_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The supplier panel with small quantities blanked."""
    p = supplier_panel(spark, sf)
    return p.withColumn("value", F.when(F.col("value") >= 20, F.col("value")))


def hourly_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Finer than daily: per event type and minute the value of the last event, blank if small."""
    e = table(spark, sf, "events")
    last = e.groupBy(F.col("event_type").alias("series"), F.date_trunc("minute", "ts").alias("ts")).agg(
        F.max_by("value", "event_id").alias("value")
    )
    return last.withColumn("value", F.when(F.col("value") >= 20, F.col("value")))


def supplier_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast history, long: on every date of a supplier two models forecast its next two
    dates.  The trend model publishes each forecast again a day later."""
    w = W.partitionBy("series").orderBy("date")
    p = supplier_series(spark, sf).withColumns({"d1": F.lead("date", 1).over(w), "d2": F.lead("date", 2).over(w)})
    steps = F.explode(F.array(*[
        F.struct(F.col(d).alias("forecast_date"), F.lit(m).alias("model"),
                 (F.col("value") * f).alias("predicted"), F.lit(late).alias("late"))
        for d, m, f, late in [
            ("d1", "trend", 1.125, 0), ("d1", "trend", 1.125, 1), ("d2", "trend", 0.875, 0),
            ("d1", "level", 1.0, 0), ("d2", "level", 1.0, 0),
        ]
    ])).alias("s")
    return (
        p.select("series", "date", steps).where(F.col("s.forecast_date").isNotNull())
        .select(F.expr("date_add(date, s.late)").alias("run_date"), "s.forecast_date", "s.model",
                F.col("series").alias("target"), "s.predicted")
    )


def forecast_history(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast history, wide: on every market day both models forecast the next two days;
    targets without a price that day are NULL."""
    steps = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(model).alias("model"), F.lit(f).alias("f"))
        for k, model, f in [(1, "trend", 1.125), (2, "trend", 0.875), (1, "level", 1.0), (2, "level", 1.0)]
    ])).alias("s")
    return market_wide(spark, sf).select("*", steps).select(
        F.expr("date_add(date, s.k)").alias("forecast_date"),
        *[(F.col(t) * F.col("s.f")).alias(t) for t in TARGETS], "s.model", F.col("date").alias("run_date"),
    )


def current_long(spark: SparkSession, sf: str) -> DataFrame:
    """Current forecasts per supplier: ten days after its last date, two models.  Steps go up
    and down, model b holds a zero, and a few days lack one model."""
    p = supplier_panel(spark, sf)
    last = p.groupBy("series").agg(F.max("date").alias("last"), F.max_by("value", "date").alias("base"))
    rows = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("k")).select(
        F.expr("date_add(last, k)").alias("forecast_date"), F.col("series").alias("target"), "base", "k"
    )
    a = F.col("base") * (1 + 0.125 * (F.pmod(F.col("k") * 7, F.lit(5)) - 2))
    b = F.col("base") * (1 + 0.0625 * (F.pmod(F.col("k") * 3, F.lit(7)) - 3)) * F.when(F.col("k") == 6, 0).otherwise(1)
    both = rows.select("*", F.explode(F.array(
        F.struct(F.lit("trend").alias("model"), a.alias("predicted")),
        F.struct(F.lit("level").alias("model"), b.alias("predicted")),
    )).alias("m"))
    lacks = (F.col("m.model") == "level") & (F.col("k") == 4) & (F.pmod(F.col("target"), F.lit(3)) == 0)
    return both.where(~lacks).select("forecast_date", "m.model", "target", "m.predicted")


def current_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Current forecasts, wide, from the last day of the market panel."""
    last = market_wide(spark, sf).agg(
        F.max("date").alias("last"),
        *[F.max_by(t, F.when(F.col(t).isNotNull(), F.col("date"))).alias(t) for t in TARGETS],
    )
    rows = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("k"))
    a = 1 + 0.125 * (F.pmod(F.col("k") * 7, F.lit(5)) - 2)
    b = 1 + 0.0625 * (F.pmod(F.col("k") * 3, F.lit(7)) - 3)
    both = rows.select("*", F.explode(F.array(
        F.struct(F.lit("trend").alias("model"), a.alias("f")), F.struct(F.lit("level").alias("model"), b.alias("f")),
    )).alias("m"))
    return both.select(
        F.expr("date_add(last, k)").alias("forecast_date"), *[(F.col(t) * F.col("m.f")).alias(t) for t in TARGETS],
        "m.model",
    )


def backtest_records(spark: SparkSession, sf: str) -> DataFrame:
    """Backtest records of two simple models per supplier over the last 63 rows in 9 windows."""
    from pricepanel.operators.backtest import naive_last

    naive = naive_last(supplier_series(spark, sf), keys=["series"])
    both = F.explode(F.array(
        F.struct("model", "y_pred"), F.struct(F.lit("half_way").alias("model"), (F.col("y_base") * 0.5 + 12.75).alias("y_pred")),
    )).alias("m")
    return naive.select("*", both).select(
        F.col("series").alias("target"), "m.model", "window_id", "date", "y_true", "m.y_pred", "y_base",
    )


# ---------------------------------------------------------------- the same in SQL


def _case(t: str) -> str:
    p = PRIORITY[t]
    return (f"max_by(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END, "
            f"CASE WHEN o_orderpriority = '{p}' THEN o_orderkey END) AS {t}")


def union_long(source: str, columns: list[str], ids: str = "date", name: str = "series", value: str = "value") -> str:
    """Wide to long as UNION ALL, NULLs kept."""
    return " UNION ALL ".join(f"SELECT {ids}, '{c}' AS {name}, {c} AS {value} FROM {source}" for c in columns)


SQL = {
    "market_wide": "SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(_case(t) for t in TARGETS)
    + " FROM orders GROUP BY CAST(o_orderdate AS DATE)",
    "market_long": union_long("market_wide", TARGETS),
    "drivers_wide": "SELECT CAST(l_shipdate AS DATE) AS date, " + ", ".join(
        f"max(CASE WHEN lower(l_returnflag || l_linestatus || '_px') = '{c}' THEN l_extendedprice END) AS {c}"
        for c in DRIVERS) + " FROM lineitem GROUP BY CAST(l_shipdate AS DATE)",
    "drivers_long": union_long("drivers_wide", DRIVERS),
    "supplier_panel": "SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS value "
    "FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "gappy_panel": "SELECT series, date, CASE WHEN value >= 20 THEN value END AS value FROM supplier_panel",
    "hourly_panel": "SELECT series, ts, CASE WHEN value >= 20 THEN value END AS value FROM ("
    "SELECT event_type AS series, date_trunc('minute', ts) AS ts, max_by(value, event_id) AS value "
    "FROM events GROUP BY event_type, date_trunc('minute', ts))",
    "supplier_next": "SELECT *, lead(date, 1) OVER (PARTITION BY series ORDER BY date) AS d1, "
    "lead(date, 2) OVER (PARTITION BY series ORDER BY date) AS d2 FROM supplier_panel",
    "supplier_forecasts": " UNION ALL ".join(
        f"SELECT CAST(date + {late} AS DATE) AS run_date, {d} AS forecast_date, '{m}' AS model, series AS target, "
        f"value * CAST({f} AS DOUBLE) AS predicted FROM supplier_next WHERE {d} IS NOT NULL"
        for d, m, f, late in [("d1", "trend", 1.125, 0), ("d1", "trend", 1.125, 1), ("d2", "trend", 0.875, 0),
                              ("d1", "level", 1.0, 0), ("d2", "level", 1.0, 0)]),
    "forecast_history": " UNION ALL ".join(
        f"SELECT CAST(date + {k} AS DATE) AS forecast_date, "
        + ", ".join(f"{t} * CAST({f} AS DOUBLE) AS {t}" for t in TARGETS)
        + f", '{m}' AS model, date AS run_date FROM market_wide"
        for k, m, f in [(1, "trend", 1.125), (2, "trend", 0.875), (1, "level", 1.0), (2, "level", 1.0)]),
    "supplier_last": "SELECT series, max(date) AS last, max_by(value, date) AS base FROM supplier_panel GROUP BY series",
    "current_long": """
        SELECT CAST(last + CAST(k AS INTEGER) AS DATE) AS forecast_date, m.model, series AS target,
               CASE m.model
                 WHEN 'trend' THEN base * (1 + CAST(0.125 AS DOUBLE) * ((k * 7) % 5 - 2))
                 ELSE base * (1 + CAST(0.0625 AS DOUBLE) * ((k * 3) % 7 - 3)) * CASE WHEN k = 6 THEN 0 ELSE 1 END
               END AS predicted
        FROM supplier_last, range(1, 11) AS r(k), (VALUES ('trend'), ('level')) AS m(model)
        WHERE NOT (m.model = 'level' AND k = 4 AND series % 3 = 0)""",
    "market_last": "SELECT max(date) AS last, " + ", ".join(
        f"max_by({t}, CASE WHEN {t} IS NOT NULL THEN date END) AS {t}" for t in TARGETS) + " FROM market_wide",
    "current_wide": "SELECT CAST(last + CAST(k AS INTEGER) AS DATE) AS forecast_date, " + ", ".join(
        f"{t} * CASE m.model WHEN 'trend' THEN (1 + CAST(0.125 AS DOUBLE) * ((k * 7) % 5 - 2)) "
        f"ELSE (1 + CAST(0.0625 AS DOUBLE) * ((k * 3) % 7 - 3)) END AS {t}" for t in TARGETS)
    + ", m.model FROM market_last, range(1, 11) AS r(k), (VALUES ('trend'), ('level')) AS m(model)",
    "from_end": "SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) - 1 AS e, "
    "count(*) OVER (PARTITION BY series) AS n FROM supplier_panel",
    "holdout": "SELECT series, date, value, (62 - e) // 7 + 1 AS window_id, n FROM from_end WHERE n >= 63 AND e < 63",
    "window_base": """
        SELECT w.series, w.window_id, max_by(p.value, p.date) AS y_base, count(*) AS train_rows
        FROM (SELECT series, window_id, min(date) AS window_start FROM holdout GROUP BY series, window_id) w
        JOIN supplier_panel p ON p.series = w.series AND p.date < w.window_start
        GROUP BY w.series, w.window_id""",
    "naive": """
        SELECT h.series AS target, 'naive_last' AS model, h.window_id, h.date, h.value AS y_true,
               b.y_base AS y_pred, b.y_base
        FROM holdout h JOIN window_base b ON b.series = h.series AND b.window_id = h.window_id
        WHERE b.train_rows >= 21""",
    "backtest_records": "SELECT * FROM naive UNION ALL SELECT target, 'half_way' AS model, window_id, date, y_true, "
    "y_base * CAST(0.5 AS DOUBLE) + CAST(12.75 AS DOUBLE) AS y_pred, y_base FROM naive",
}
NEEDS = {
    "market_long": ["market_wide"], "drivers_long": ["drivers_wide"], "gappy_panel": ["supplier_panel"],
    "supplier_next": ["supplier_panel"], "supplier_forecasts": ["supplier_next"],
    "forecast_history": ["market_wide"],
    "supplier_last": ["supplier_panel"], "current_long": ["supplier_last"], "market_last": ["market_wide"],
    "current_wide": ["market_last"], "from_end": ["supplier_panel"], "holdout": ["from_end"],
    "window_base": ["holdout"], "naive": ["window_base"], "backtest_records": ["naive"],
}


def with_inputs(names: list[str], body: str, more: dict[str, str] | None = None) -> str:
    """``body`` behind the named inputs, what those need, and the query's ``more`` steps."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = {**{n: SQL[n] for n in ordered}, **(more or {})}
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({q})" for n, q in ctes.items()) + " " + body
