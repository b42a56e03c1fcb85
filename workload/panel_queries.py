"""Shapes, calendars, fills, sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricepanel import fixed_values as fv
from pricepanel.operators import fill, panel as P
from pricepanel.schema import columns_of
from pricepanel.sinks import files as out
from pricepanel.sources import files, payloads
from workload.inputs import (
    AS_OF, DRIVERS, MODELS, TARGETS, drivers_long, drivers_wide, gappy_panel, hourly_panel, market_long,
    market_wide, supplier_forecasts, supplier_panel, table, union_long, with_inputs,
)
from workload.registry import q6, query, r6, scratch

# ---------------------------------------------------------------- rows and columns


@query("n1_sanitize", """
    SELECT CAST(ts AS DATE) AS date, max_by(value, event_id) AS value FROM events
    WHERE event_id % 10 <> 0 GROUP BY CAST(ts AS DATE)""")
def n1(spark, sf):
    e = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 0, "not a date").otherwise(F.col("ts").cast("string"))
    return P.sanitize(e.select(text.alias("date"), "event_id", "value"), order=["event_id"])


@query("n2_dedup_last", """
    SELECT user_id, CAST(ts AS DATE) AS date, max_by(event_type, event_id) AS event_type,
           max_by(value, event_id) AS value, max(event_id) AS event_id
    FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def n2(spark, sf):
    e = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("date"), "event_id", "event_type", "value")
    return P.keep_last(e, ["user_id", "date"], ["event_id"])


@query("n3_clean_numeric", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL
                            ELSE o_totalprice END AS price FROM orders""")
def n3(spark, sf):
    k = F.col("o_orderkey")
    text = (F.when(k % 7 == 0, "n/a").when(k % 11 == 0, "NaN").when(k % 13 == 0, "-Infinity")
            .otherwise(F.col("o_totalprice").cast("string")))
    return P.clean_numeric(table(spark, sf, "orders").select("o_orderkey", text.alias("price")), ["price"])


@query("n4_safe_cast", """
    SELECT o_orderkey, TRY_CAST(o_orderstatus AS BIGINT) AS o_orderstatus,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS o_orderpriority,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate
    FROM orders""")
def n4(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"),
        F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(
            F.to_date("o_orderdate").cast("string")).alias("o_orderdate"))
    schema = columns_of(
        "o_orderkey bigint, o_orderstatus bigint, o_orderpriority bigint, o_orderdate date")
    return P.safe_cast(o, schema)


@query("n5_reconcile", with_inputs(["market_wide"], """
    SELECT gold, silver, copper, brent AS brent_oil, CAST(NULL AS DOUBLE) AS gas, date AS "Date" FROM market_wide"""))
def n5(spark, sf):
    raw = market_wide(spark, sf).drop("gas").withColumnsRenamed(
        {"gold": "GOLD", "brent": "brent-oil", "date": "DATE"}).withColumn("extra", F.lit(1))
    schema = columns_of(
        "gold double, silver double, copper double, brent_oil double, gas double, Date date")
    return P.reconcile(raw, schema, {"brent_oil": "brent-oil"})


@query("n6a_outer_align", with_inputs(["market_wide", "drivers_wide"], """
    SELECT date, gold, silver, copper, brent, gas, af_px, ao_px, nf_px, no_px, rf_px, ro_px
    FROM market_wide FULL JOIN drivers_wide USING (date)"""))
def n6a(spark, sf):
    return P.outer_align([market_wide(spark, sf), drivers_wide(spark, sf)])


@query("n6b_left_align", with_inputs(["market_wide", "drivers_wide"], """
    SELECT date, gold, silver, copper, brent, gas, af_px, ao_px, nf_px, no_px, rf_px, ro_px
    FROM market_wide LEFT JOIN drivers_wide USING (date)"""))
def n6b(spark, sf):
    return P.left_align(market_wide(spark, sf), [drivers_wide(spark, sf)])


@query("n7_reindex", with_inputs(["market_wide", "drivers_wide"], """
    SELECT date, af_px, ao_px, nf_px, no_px, rf_px, ro_px
    FROM (SELECT date FROM market_wide WHERE gold IS NOT NULL) LEFT JOIN drivers_wide USING (date)"""))
def n7(spark, sf):
    return P.reindex(drivers_wide(spark, sf), market_wide(spark, sf).where(F.col("gold").isNotNull()))


@query("n8_to_long", with_inputs(["market_long"], "SELECT date, series, value FROM market_long WHERE value IS NOT NULL"))
def n8(spark, sf):
    return P.to_long(market_wide(spark, sf), TARGETS, keep_nulls=False)


@query("n9_to_long_nulls", with_inputs(["market_long"], "SELECT date, series, value FROM market_long"))
def n9(spark, sf):
    return P.to_long(market_wide(spark, sf), TARGETS, keep_nulls=True)


@query("n10_to_wide", with_inputs(["supplier_forecasts"], """
    SELECT run_date, forecast_date, target, max(CASE WHEN model = 'trend' THEN predicted END) AS trend,
           max(CASE WHEN model = 'level' THEN predicted END) AS level
    FROM supplier_forecasts GROUP BY run_date, forecast_date, target"""))
def n10(spark, sf):
    return P.to_wide(supplier_forecasts(spark, sf), MODELS, ["run_date", "forecast_date", "target"],
                     series="model", value="predicted")


@query("n11_business_days", with_inputs(["supplier_panel"], """
    SELECT series, date, value FROM supplier_panel WHERE isodow(date) <= 5"""))
def n11(spark, sf):
    return P.business_days_only(supplier_panel(spark, sf))


@query("n12_replicate", with_inputs(["supplier_panel"], """
    SELECT series, date, value, label FROM supplier_panel, (VALUES ('trend'), ('level')) AS m(label)"""))
def n12(spark, sf):
    return P.replicate(supplier_panel(spark, sf), MODELS)


@query("n13_calendar", with_inputs(["market_wide"], """
    SELECT CAST(d AS DATE) AS date FROM (SELECT min(date) AS lo, max(date) AS hi FROM market_wide),
    unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS g(d) WHERE isodow(d) <= 5"""))
def n13(spark, sf):
    return P.business_calendar(market_wide(spark, sf))


@query("n14_next_days", with_inputs(["gappy_panel"], """
    SELECT series, row_number() OVER (PARTITION BY series ORDER BY date) AS step, date FROM (
      SELECT series, CAST(last + CAST(k AS INTEGER) AS DATE) AS date
      FROM (SELECT series, max(date) AS last FROM gappy_panel WHERE value IS NOT NULL GROUP BY series),
           range(1, 25) AS r(k))
    WHERE isodow(date) <= 5 QUALIFY step <= 10"""))
def n14(spark, sf):
    return P.future_dates(gappy_panel(spark, sf), 10, ["series"])


@query("n15_rename", with_inputs(["supplier_forecasts"], """
    SELECT run_date AS data_date_part, forecast_date AS fecha_prediccion, model AS modelo, target, predicted
    FROM supplier_forecasts"""))
def n15(spark, sf):
    return P.rename(supplier_forecasts(spark, sf), fv.PUBLISHED_FORECAST_NAMES)


@query("n16_lookup", with_inputs(["supplier_panel"], """
    SELECT series, date, value, n_name AS market FROM supplier_panel
    LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    ON series = s_suppkey"""))
def n16(spark, sf):
    nation = table(spark, sf, "nation")
    market = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("series"), F.col("n_name").alias("market"))
    return P.look_up(supplier_panel(spark, sf), market, ["series"])


# ---------------------------------------------------------------- fills

FFILL = "last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY {o} ROWS UNBOUNDED PRECEDING)"


@query("f1_ffill", with_inputs(["gappy_panel"], f"""
    SELECT series, date, {FFILL.format(o="date")} AS value FROM gappy_panel"""))
def f1(spark, sf):
    return fill.forward_fill(gappy_panel(spark, sf))


@query("f1b_ffill_sliced", with_inputs(["hourly_panel"], f"""
    SELECT series, ts, {FFILL.format(o="ts")} AS value FROM hourly_panel"""))
def f1b(spark, sf):
    # one slice per day
    day = F.datediff(F.to_date("ts"), F.lit(dt.date(1970, 1, 1)))
    return fill.forward_fill_sliced(hourly_panel(spark, sf), day, order="ts")


@query("f2_seeded_fill", with_inputs(["market_wide"], "SELECT date, " + ", ".join(
    f"last_value({t} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {t}" for t in TARGETS)
    + """ FROM (SELECT * FROM market_wide WHERE date >= DATE '1999-06-01'
          UNION ALL (SELECT * FROM market_wide WHERE date < DATE '1999-06-01' ORDER BY date DESC LIMIT 1))
        QUALIFY date >= DATE '1999-06-01'"""))
def f2(spark, sf):
    m = market_wide(spark, sf)
    cut = F.col("date") < F.lit(dt.date(1999, 6, 1))
    return fill.seeded_fill(m.where(cut), m.where(~cut), TARGETS)


@query("f2b_seeded_fill_long", with_inputs(["gappy_panel"], f"""
    SELECT series, date, {FFILL.format(o="date")} AS value FROM (
      SELECT * FROM gappy_panel WHERE date >= DATE '1999-06-01'
      UNION ALL SELECT * FROM (SELECT * FROM gappy_panel WHERE date < DATE '1999-06-01'
        QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) = 1))
    QUALIFY date >= DATE '1999-06-01'"""))
def f2b(spark, sf):
    p = gappy_panel(spark, sf)
    cut = F.col("date") < F.lit(dt.date(1999, 6, 1))
    return fill.seeded_fill_long(p.where(cut), p.where(~cut))


@query("f3_range", with_inputs(["market_wide"], """
    SELECT min(date) AS lo, max(date) AS hi FROM market_wide WHERE brent IS NOT NULL"""))
def f3(spark, sf):
    return fill.reload_range(market_wide(spark, sf), "brent")


@query("f4_median_fill", with_inputs(["gappy_panel"], f"""
    SELECT series, date, coalesce(filled, mid, 0) AS value FROM (
      SELECT series, date, {FFILL.format(o="date")} AS filled, median(value) OVER (PARTITION BY series) AS mid
      FROM gappy_panel)"""))
def f4(spark, sf):
    return fill.median_fill(gappy_panel(spark, sf))


@query("f4b_median_fill_filled", with_inputs(["gappy_panel"], """
    SELECT series, date, coalesce(filled, median(filled) OVER (PARTITION BY series), 0) AS value FROM filled""",
    {"filled": f"SELECT series, date, {FFILL.format(o='date')} AS filled FROM gappy_panel"}))
def f4b(spark, sf):
    return fill.median_fill(gappy_panel(spark, sf), median_of="filled")


@query("f4c_median_fill_train", with_inputs(["gappy_panel"], f"""
    SELECT series, date, coalesce(filled, mid, 0) AS value FROM (
      SELECT series, date, {FFILL.format(o="date")} AS filled FROM gappy_panel)
    LEFT JOIN (SELECT series, median(value) AS mid FROM gappy_panel WHERE date < DATE '2000-01-01' GROUP BY series)
    USING (series)"""))
def f4c(spark, sf):
    p = gappy_panel(spark, sf)
    return fill.median_fill(p, train=p.where(F.col("date") < F.lit(dt.date(2000, 1, 1))))


@query("f5_ffill_bfill", with_inputs(["gappy_panel"], f"""
    SELECT series, date, coalesce({FFILL.format(o="date")}, first_value(value IGNORE NULLS)
      OVER (PARTITION BY series ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS value
    FROM gappy_panel"""))
def f5(spark, sf):
    return fill.fill_both_ways(gappy_panel(spark, sf))


@query("f5b_bfill", with_inputs(["gappy_panel"], """
    SELECT series, date, first_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY date
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM gappy_panel"""))
def f5b(spark, sf):
    return fill.backward_fill(gappy_panel(spark, sf))


DAYS = """
    SELECT row_number() OVER (ORDER BY date) AS step, date FROM (
      SELECT CAST(last + CAST(k AS INTEGER) AS DATE) AS date
      FROM (SELECT max(date) AS last FROM {p} WHERE value IS NOT NULL), range(1, 25) AS r(k))
    WHERE isodow(date) <= 5 QUALIFY step <= 10"""


@query("f6_future_last", with_inputs(["gappy_panel"], """
    SELECT series, value, step, date FROM (SELECT series, coalesce(max_by(value, date) FILTER (value IS NOT NULL), 0) AS value
      FROM gappy_panel GROUP BY series), days""", {"days": DAYS.format(p="gappy_panel")}))
def f6_last(spark, sf):
    return fill.future_values(gappy_panel(spark, sf), 10, "last")


@query("f6_future_median", with_inputs(["drivers_long"], """
    SELECT series, value, step, date FROM (SELECT series, coalesce(median(value), 0) AS value
      FROM drivers_long GROUP BY series), days""", {"days": DAYS.format(p="drivers_long")}))
def f6_median(spark, sf):
    return fill.future_values(drivers_long(spark, sf), 10, "median")


@query("f6_future_mode", with_inputs(["gappy_panel"], """
    SELECT series, value, step, date FROM best, days""", {
    "filled": f"SELECT series, coalesce({FFILL.format(o='date')}, median(value) OVER (PARTITION BY series), 0) AS value "
              "FROM gappy_panel",
    "best": "SELECT series, value FROM (SELECT series, value, count(*) AS n FROM filled GROUP BY series, value) "
            "QUALIFY row_number() OVER (PARTITION BY series ORDER BY n DESC, value) = 1",
    "days": DAYS.format(p="gappy_panel")}))
def f6_mode(spark, sf):
    return fill.future_values(gappy_panel(spark, sf), 10, "mode")


# ---------------------------------------------------------------- sources


@query("s1_charts", """
    SELECT series, date, value FROM (
      SELECT series, CAST(ts AS DATE) AS date, value, pos FROM (
        SELECT event_type AS series, ts, value, 0 AS pos FROM events
        UNION ALL SELECT event_type, ts + INTERVAL 1 DAY, value + 1, 1 FROM events))
    WHERE date < DATE '2024-01-20' AND series IN ('click', 'view', 'error')
    QUALIFY row_number() OVER (PARTITION BY series, date ORDER BY pos DESC, value DESC) = 1""")
def s1(spark, sf):
    """One landed document per event, with three points; the last has no close."""
    sec = F.unix_seconds(F.col("ts").cast("timestamp"))
    quote = F.struct(F.array("value", F.col("value") + 1, F.lit(None).cast("double")).alias("close"))
    result = F.struct(
        F.array(sec, sec + 86400, sec + 86400).alias("timestamp"),
        F.struct(F.array(quote).alias("quote")).alias("indicators"))
    landed = table(spark, sf, "events").select(
        F.col("event_type").alias("name"),
        F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart"))).alias("payload"))
    names = {"click": "click", "view": "view", "error": "error"}
    return payloads.parse_charts(landed, names, dt.date(2024, 1, 20))


@query("s2_lookback", with_inputs(["supplier_panel"], """
    SELECT series, date, value FROM supplier_panel WHERE date >= DATE '2001-07-27' AND date < DATE '2001-08-06'"""))
def s2(spark, sf):
    return payloads.lookback(supplier_panel(spark, sf), AS_OF, fv.LOOKBACK_DAYS)


@query("s3_energy", """
    SELECT series, date, value FROM (
      SELECT event_type || '_px' AS series, CAST(ts AS DATE) AS date, value, 0 AS pos FROM events
      UNION ALL SELECT event_type || '_px', CAST(date_trunc('month', ts) AS DATE), NULL, 1 FROM events)
    WHERE series IN ('click_px', 'error_px')
    QUALIFY row_number() OVER (PARTITION BY series, date ORDER BY pos DESC, value DESC NULLS LAST) = 1""")
def s3(spark, sf):
    """Documents with a daily and a monthly period; the monthly value is no number, and a
    third point has no valid period."""

    def point(period, value):
        return F.struct(period.alias("period"), value.alias("value"))

    data = F.array(
        point(F.date_format("ts", "yyyy-MM-dd"), F.col("value").cast("string")),
        point(F.date_format("ts", "yyyy-MM"), F.lit("W")),
        point(F.lit("someday"), F.lit("1")))
    landed = table(spark, sf, "events").select(
        F.col("event_type").alias("name"),
        F.to_json(F.struct(F.struct(data.alias("data")).alias("response"))).alias("payload"))
    return payloads.parse_energy(landed, {"click": "click_px", "error": "error_px"})


COUNTRIES = {"N1": "money_1", "N2": "money_2", "N15": "money_15", "N20": "money_20"}


@query("s4_country_years", """
    SELECT make_date(CAST(y AS INTEGER), 12, 31) AS date, """ + ", ".join(
        f"max(CASE WHEN c = '{c}' THEN v END) AS {n}" for c, n in COUNTRIES.items()) + """
    FROM (SELECT year(o_orderdate) AS y, 'N' || substr(n_name, 8) AS c, max(o_totalprice) AS v
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          GROUP BY year(o_orderdate), 'N' || substr(n_name, 8))
    WHERE c IN ('N1', 'N2', 'N15', 'N20') GROUP BY y""")
def s4(spark, sf):
    """One document per nation and year, whose first entry has no value."""
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    best = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.year("o_orderdate").cast("string").alias("y"), F.concat(F.lit("n"), F.substring("n_name", 8, 9)).alias("c"))
        .agg(F.max("o_totalprice").alias("v"))
    )

    def entry(value):
        return F.struct(F.col("y").alias("date"), F.col("c").alias("countryiso3code"), value.alias("value"))

    rows = F.to_json(F.array(entry(F.lit(None).cast("double")), entry(F.col("v"))))
    landed = best.select(
        F.concat("c", "y").alias("name"), F.concat(F.lit('[{"page": 1}, '), rows, F.lit("]")).alias("payload"))
    return payloads.parse_country_years(landed, COUNTRIES)


@query("s5_named_series", """
    SELECT CASE event_type WHEN 'click' THEN 'rate_a' ELSE 'rate_b' END AS series, CAST(ts AS DATE) AS date, value
    FROM events WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-10'""")
def s5(spark, sf):
    landed = table(spark, sf, "events").select(
        F.col("event_type").alias("code"), F.col("ts").cast("string").alias("date"),
        F.col("value").cast("string").alias("value"))
    return payloads.named_series(landed, {"click": "rate_a", "view": "rate_b"}, dt.date(2024, 1, 10))


@query("s6_s8_panel_file", with_inputs(["market_wide"], """
    SELECT date AS "Date", gold, silver, copper, brent, gas FROM market_wide"""))
def s6(spark, sf):
    path = scratch(spark)
    text = market_wide(spark, sf).withColumn("date", F.col("date").cast("string"))
    none = text.limit(1).withColumn("date", F.lit("unknown"))
    out.write_panel(text.unionByName(none), path)
    return files.read_panel(spark, path)


@query("s9_model_panel", with_inputs(["market_wide"], """
    SELECT date, gold, silver, copper FROM market_wide WHERE isodow(date) <= 5"""))
def s9(spark, sf):
    stored = market_wide(spark, sf).withColumnsRenamed({"date": "Date", "gold": "GOLD"})
    return files.model_panel(stored, ["gold", "silver", "copper"])


@query("s10_features", """
    SELECT lower(p_brand) AS target, string_agg(lower(p_type), '|' ORDER BY lower(p_type)) AS variables,
           count(*) AS n FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size % 2 = 1) GROUP BY lower(p_brand)""")
def s10(spark, sf):
    path = scratch(spark)
    raw = table(spark, sf, "part").select(
        F.concat(F.lit(" "), "p_brand").alias("Commodity "), F.concat("p_type", F.lit(" ")).alias("variable"),
        F.when(F.col("p_size") % 4 == 2, None).otherwise(F.col("p_size") % 2).alias("usada")).distinct()
    raw.write.csv(path, header=True)
    lists = files.feature_lists(files.read_features(spark, path))
    return lists.select("target", F.array_join(F.array_sort("variables"), "|").alias("variables"),
                        F.size("variables").cast("long").alias("n"))


@query("s11_features_melted", """
    SELECT lower(p_brand) AS target, p_type AS variable, CAST(0 AS BIGINT) AS position FROM part
    UNION ALL SELECT lower(p_brand), p_name, 1 FROM part WHERE p_size > 25""")
def s11(spark, sf):
    wide = table(spark, sf, "part").select(
        F.col("p_brand").alias("Asset"), F.col("p_type").alias("v1"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("v2"))
    return files.melt_features(wide)


@query("s12_features_csv", "SELECT DISTINCT p_brand AS target, p_type AS variable FROM part")
def s12(spark, sf):
    path = scratch(spark)
    chosen = table(spark, sf, "part").select(
        F.col("p_brand").alias("target"), F.col("p_type").alias("variable")).distinct()
    out.write_features(chosen, path)
    return spark.read.csv(path, header=True, schema="target string, variable string")
