"""Queries: scalar functions, daily and hourly features."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, RAW_FEATURES, TARGET_COLUMNS
from aerocast.functions import aqi_category, is_hazardous, pm25_to_aqi
from aerocast.operators import features as ft
from aerocast.plans.registry import finish, query
from aerocast.plans.sqlparts import (
    FEATURES, POLLUTANTS, TARGETS, daily_cte, dense_daily_features_cte, dense_daily_serving_cte,
    hourly_cte, obs_cte, r6, sql_aqi, sql_category,
)
from aerocast.session import prepare
from aerocast.sources.observations import events_observations, table

AVG_COLS = ["aqi", *RAW_FEATURES, "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_rolling_mean", *TARGET_COLUMNS]


# --- X1: PM2.5 -> AQI (value scaled to cross every segment and the cap, and
# shifted so some readings are negative) ------------------------------------
@query("pm25_aqi", f"""
SELECT event_id, value * 1.0625 - 5 AS pm2_5, {sql_aqi('(value * 1.0625 - 5)')} AS aqi FROM events
""")
def q_pm25_aqi(spark, sf_dir):
    prepare(spark)
    pm = F.col("value") * 1.0625 - 5
    return table(spark, sf_dir, "events").select("event_id", pm.alias("pm2_5"), pm25_to_aqi(pm).alias("aqi"))


# --- X2, X3: band and hazard flag ------------------------------------------
@query("aqi_category", f"""
SELECT event_id, a AS aqi, {sql_category('a')} AS category, a > 300 AS hazardous
FROM (SELECT event_id, {sql_aqi('value')} AS a FROM events)
""")
def q_aqi_category(spark, sf_dir):
    prepare(spark)
    a = pm25_to_aqi("value")
    return table(spark, sf_dir, "events").select(
        "event_id", a.alias("aqi"), aqi_category(a).alias("category"), is_hazardous(a).alias("hazardous"))


# --- A1, X7: daily mean ------------------------------------------------------
@query("daily_mean", f"""
WITH {obs_cte('user')}, {daily_cte()}
SELECT city, timestamp, {r6('aqi, ' + POLLUTANTS)} FROM daily
""")
def q_daily_mean(spark, sf_dir):
    prepare(spark)
    return finish(ft.daily_mean(events_observations(spark, sf_dir, "user")), AVG_COLS)


# --- J1: calendar gap fill -----------------------------------------------------
@query("daily_gap_fill", f"""
WITH {obs_cte('user')}, {daily_cte()},
span AS (SELECT city, min(timestamp) AS lo, max(timestamp) AS hi FROM daily GROUP BY city),
cal AS (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS timestamp FROM span)
SELECT c.city, c.timestamp, {r6('aqi, ' + POLLUTANTS, 'd.')}
FROM cal c LEFT JOIN daily d ON c.city = d.city AND c.timestamp = d.timestamp
""")
def q_daily_gap_fill(spark, sf_dir):
    prepare(spark)
    return finish(ft.gap_fill(ft.daily_mean(events_observations(spark, sf_dir, "user"))), AVG_COLS)


# --- W4, P4: gap-aware daily features with targets ---------------------------
@query("daily_features", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_features_cte()}
SELECT city, timestamp, {r6('aqi, ' + POLLUTANTS)}, hour, month, day, day_of_week,
       {r6('aqi_lag1, aqi_lag2, aqi_lag3, aqi_rolling_mean, ' + TARGETS)}
FROM dfeat
""")
def q_daily_features(spark, sf_dir):
    prepare(spark)
    return finish(ft.daily_features_from_obs(events_observations(spark, sf_dir, "user")), AVG_COLS)


# --- W4 on a second table: orders by priority --------------------------------
_ORD_P = "(o_totalprice * CAST('0.0001414213562373095' AS DOUBLE))"
_ORD_OBS = f"""obs AS (
  SELECT o_orderpriority AS city, o_orderdate AS timestamp, o_orderkey AS seq,
         {_ORD_P} AS pm10, {_ORD_P} AS pm2_5, {_ORD_P} AS carbon_monoxide,
         {_ORD_P} AS nitrogen_dioxide, {_ORD_P} AS sulphur_dioxide,
         {_ORD_P} AS ozone, {sql_aqi(_ORD_P)} AS aqi
  FROM orders)"""


@query("orders_daily_features", f"""
WITH {_ORD_OBS}, {daily_cte()}, {dense_daily_features_cte()}
SELECT city, timestamp, {r6('aqi, ' + POLLUTANTS)}, hour, month, day, day_of_week,
       {r6('aqi_lag1, aqi_lag2, aqi_lag3, aqi_rolling_mean, ' + TARGETS)}
FROM dfeat
""")
def q_orders_daily_features(spark, sf_dir):
    from aerocast.sources.observations import orders_observations
    prepare(spark)
    return finish(ft.daily_features_from_obs(orders_observations(spark, sf_dir)), AVG_COLS)


# --- W7, T4, X2, §7.5 #8: newest complete daily vector per key, band, staleness
@query("latest_daily_vector", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_serving_cte()},
last_day AS (SELECT city, max(timestamp) AS last_obs FROM daily GROUP BY city),
pick AS (SELECT * FROM dserve QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1)
SELECT p.city, p.timestamp, {r6('aqi, ' + FEATURES.replace('hour, month, day, day_of_week, ', ''), 'p.')},
       p.hour, p.month, p.day, p.day_of_week,
       {sql_category('round_even(p.aqi, 1)')} AS category,
       CAST(date_diff('day', p.timestamp, l.last_obs) AS BIGINT) AS days_stale
FROM pick p JOIN last_day l ON p.city = l.city
""")
def q_latest_daily_vector(spark, sf_dir):
    prepare(spark)
    daily = ft.daily_mean(events_observations(spark, sf_dir, "user"))
    rows = ft.daily_feature_rows(daily, include_targets=False)
    latest = ft.latest_vector(rows)
    last_day = daily.groupBy("city").agg(F.max("timestamp").alias("_last"))
    out = latest.join(last_day, "city").select(
        "city", "timestamp", "aqi", *FEATURE_COLUMNS,
        aqi_category(F.bround("aqi", 1)).alias("category"),
        F.datediff(F.to_date("_last"), F.to_date("timestamp")).cast("long").alias("days_stale"),
    )
    return finish(out, AVG_COLS)


# --- W1-W3, X6, F3, C5: hourly (positional) features -------------------------
@query("hourly_features", f"""
WITH {obs_cte('type')}, {hourly_cte()}
SELECT city, timestamp, aqi, {POLLUTANTS}, hour, month, day, day_of_week,
       aqi_lag1, aqi_lag2, aqi_lag3, round(aqi_rolling_mean, 6) AS aqi_rolling_mean, {TARGETS}
FROM hfeat
""")
def q_hourly_features(spark, sf_dir):
    prepare(spark)
    return finish(ft.hourly_feature_rows(events_observations(spark, sf_dir, "type")), ["aqi_rolling_mean"])
