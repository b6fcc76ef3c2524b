"""Queries: contract rules, coercions, timestamps, hourly feature parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, TARGET_COLUMNS
from aerocast.functions import (
    calendar_columns, json_field, nan_to_null, to_utc_naive, try_number, try_timestamp, version_stamp,
)
from aerocast.operators import features as ft
from aerocast.operators import quality as qc
from aerocast.operators.ordered import latest_per_key
from aerocast.plans.registry import finish, query
from aerocast.plans.sqlparts import TARGETS, hourly_cte, obs_cte
from aerocast.session import prepare
from aerocast.sources.observations import events_observations, table

# --- made-up defects, identical on both sides ------------------------------
# arrival order: originals at seq*10; copies of readings above 400 re-sent 50
# events later at (seq+50)*10+5; text timestamps, one bad number, ozone - 3.
_RAW_SQL = f"""raw AS (
  SELECT city, seq * 10 AS seq,
         CASE WHEN pm2_5 < 1 THEN 'not a time' ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp,
         CASE WHEN pm2_5 BETWEEN 100 AND 101 THEN 'n/a' ELSE CAST(pm10 AS VARCHAR) END AS pm10,
         pm2_5, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone - 3 AS ozone, aqi FROM obs
  UNION ALL
  SELECT city, (seq + 50) * 10 + 5, strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f'), CAST(pm10 AS VARCHAR),
         pm2_5, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, aqi FROM obs WHERE pm2_5 > 200),
p AS (SELECT city, seq, TRY_CAST(timestamp AS TIMESTAMP) AS ts, TRY_CAST(pm10 AS DOUBLE) AS pm10,
             pm2_5, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, aqi FROM raw),
f AS (SELECT *, ts IS NULL AS invalid_timestamp,
        (ts IS NOT NULL AND count(*) OVER (PARTITION BY city, ts) > 1) AS duplicate_timestamp,
        coalesce(ts < lag(ts) OVER (PARTITION BY city ORDER BY seq), false) AS out_of_order,
        (pm10 IS NULL OR pm2_5 IS NULL OR carbon_monoxide IS NULL OR nitrogen_dioxide IS NULL
           OR sulphur_dioxide IS NULL OR ozone IS NULL OR aqi IS NULL) AS invalid_value,
        coalesce(pm10 < 0 OR pm2_5 < 0 OR carbon_monoxide < 0 OR nitrogen_dioxide < 0
           OR sulphur_dioxide < 0 OR ozone < 0 OR aqi < 0, false) AS negative_value
      FROM p)"""


def _raw_defects(spark, sf_dir, by="type"):
    obs = events_observations(spark, sf_dir, by)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    a = obs.select(
        "city", (F.col("seq") * 10).alias("seq"),
        F.when(F.col("pm2_5") < 1, F.lit("not a time")).otherwise(F.date_format("timestamp", fmt)).alias("timestamp"),
        F.when(F.col("pm2_5").between(100, 101), F.lit("n/a")).otherwise(F.col("pm10").cast("string")).alias("pm10"),
        "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", (F.col("ozone") - 3).alias("ozone"), "aqi")
    b = obs.where(F.col("pm2_5") > 200).select(
        "city", ((F.col("seq") + 50) * 10 + 5).alias("seq"), F.date_format("timestamp", fmt).alias("timestamp"),
        F.col("pm10").cast("string").alias("pm10"),
        "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "aqi")
    return a.unionByName(b)


@query("quality_report", f"""
WITH {obs_cte('type')}, {_RAW_SQL}
SELECT city, count(*) AS n_rows,
       count(*) FILTER (WHERE invalid_timestamp) AS invalid_timestamp,
       count(*) FILTER (WHERE duplicate_timestamp) AS duplicate_timestamp,
       count(*) FILTER (WHERE out_of_order) AS out_of_order,
       count(*) FILTER (WHERE invalid_value) AS invalid_value,
       count(*) FILTER (WHERE negative_value) AS negative_value
FROM f GROUP BY city
""")
def q_quality_report(spark, sf_dir):
    prepare(spark)
    return qc.report(_raw_defects(spark, sf_dir))


@query("out_of_order_rows", f"""
WITH {obs_cte('type')}, {_RAW_SQL}
SELECT city, seq, ts AS timestamp FROM f WHERE out_of_order
""")
def q_out_of_order_rows(spark, sf_dir):
    prepare(spark)
    return finish(qc.out_of_order(_raw_defects(spark, sf_dir)))


@query("key_violations", f"""
WITH {obs_cte('user')}, {_RAW_SQL}
SELECT city, ts AS event_timestamp, count(*) AS n_rows FROM p WHERE ts IS NOT NULL
GROUP BY city, ts HAVING count(*) > 1
""")
def q_key_violations(spark, sf_dir):
    from aerocast.operators.store import key_violations
    prepare(spark)
    raw = _raw_defects(spark, sf_dir, "user")
    rows = qc.coerce(raw).where(F.col("timestamp").isNotNull()).withColumnRenamed("timestamp", "event_timestamp")
    return finish(key_violations(rows))


@query("coerce_or_null", """
SELECT event_id,
       TRY_CAST(CASE WHEN value < 1 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS TIMESTAMP) AS timestamp,
       TRY_CAST(CASE WHEN value > 200 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS pm2_5
FROM events
""")
def q_coerce_or_null(spark, sf_dir):
    prepare(spark)
    ev = table(spark, sf_dir, "events")
    ts_text = F.when(F.col("value") < 1, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    num_text = F.when(F.col("value") > 200, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return finish(ev.select("event_id", try_timestamp(ts_text).alias("timestamp"), try_number(num_text).alias("pm2_5")))


@query("nan_to_null", """
SELECT event_id, CASE WHEN value > 200 THEN NULL ELSE value END AS pm2_5 FROM events
""")
def q_nan_to_null(spark, sf_dir):
    prepare(spark)
    ev = table(spark, sf_dir, "events")
    raw = F.when(F.col("value") > 200, F.lit(float("nan"))).otherwise(F.col("value"))
    return ev.select("event_id", nan_to_null(raw).alias("pm2_5"))


@query("json_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.missing') AS missing_text
FROM events
""")
def q_json_extract(spark, sf_dir):
    prepare(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", json_field("props", "$.k").alias("k_text"),
                     json_field("props", "$.missing").alias("missing_text"))


_OFFSET_SQL = "CASE user_id % 3 WHEN 0 THEN '+05:00' WHEN 1 THEN '-03:30' ELSE '' END"


@query("utc_normalize", f"""
SELECT event_id, src,
       CAST(substr(src, 1, 19) AS TIMESTAMP)
         - CASE user_id % 3 WHEN 0 THEN INTERVAL 300 MINUTE WHEN 1 THEN INTERVAL (-210) MINUTE ELSE INTERVAL 0 MINUTE END
         AS utc_naive
FROM (SELECT event_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_OFFSET_SQL} AS src FROM events)
""")
def q_utc_normalize(spark, sf_dir):
    prepare(spark)
    ev = table(spark, sf_dir, "events")
    off = (F.when(F.col("user_id") % 3 == 0, F.lit("+05:00"))
           .when(F.col("user_id") % 3 == 1, F.lit("-03:30")).otherwise(F.lit("")))
    src = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), off)
    return ev.select("event_id", src.alias("src"), to_utc_naive(src).alias("utc_naive"))


@query("calendar_features", f"""
WITH {obs_cte('type')}
SELECT city, timestamp, CAST(hour(timestamp) AS BIGINT) AS hour, CAST(month(timestamp) AS BIGINT) AS month,
       CAST(day(timestamp) AS BIGINT) AS day, CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week
FROM obs
""")
def q_calendar_features(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "type")
    return finish(obs.select("city", "timestamp", *calendar_columns("timestamp")))


@query("version_stamp", f"""
WITH {obs_cte('user')}
SELECT city, strftime(max(timestamp), '%Y%m%dT%H%M%SZ') AS version FROM obs GROUP BY city
""")
def q_version_stamp(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "user")
    return obs.groupBy("city").agg(version_stamp(F.max("timestamp")).alias("version"))


# --- hourly contract parts ---------------------------------------------------
@query("targets", f"""
WITH {obs_cte('type')}, {hourly_cte(complete=False)}
SELECT city, timestamp, {TARGETS} FROM hfeat
""")
def q_targets(spark, sf_dir):
    prepare(spark)
    h = ft.hourly_feature_rows(events_observations(spark, sf_dir, "type"), complete_only=False)
    return finish(h.select("city", "timestamp", *TARGET_COLUMNS))


@query("rolling_mean_prev3", f"""
WITH {obs_cte('user')}, {hourly_cte(targets=False, complete=False)}
SELECT city, timestamp, round(aqi_rolling_mean, 6) AS aqi_rolling_mean FROM hfeat
""")
def q_rolling_mean_prev3(spark, sf_dir):
    prepare(spark)
    h = ft.hourly_feature_rows(events_observations(spark, sf_dir, "user"), include_targets=False, complete_only=False)
    return finish(h.select("city", "timestamp", "aqi_rolling_mean"), ["aqi_rolling_mean"])


@query("insufficient_history", f"""
WITH {obs_cte('user')}, {hourly_cte(targets=False, complete=False)}
SELECT city, timestamp, aqi_lag1, aqi_lag2, aqi_lag3, round(aqi_rolling_mean, 6) AS aqi_rolling_mean FROM hfeat
WHERE aqi_lag1 IS NULL OR aqi_lag2 IS NULL OR aqi_lag3 IS NULL OR aqi_rolling_mean IS NULL
""")
def q_insufficient_history(spark, sf_dir):
    prepare(spark)
    h = ft.hourly_feature_rows(events_observations(spark, sf_dir, "user"), include_targets=False, complete_only=False)
    return finish(qc.missing_lags(h).select("city", "timestamp", "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_rolling_mean"),
                  ["aqi_rolling_mean"])


@query("complete_feature_rows", f"""
WITH {obs_cte('user')}, {hourly_cte(complete=False)},
c AS (SELECT city, aqi IS NOT NULL AND aqi_lag1 IS NOT NULL AND aqi_lag2 IS NOT NULL AND aqi_lag3 IS NOT NULL
               AND aqi_rolling_mean IS NOT NULL AS serving_ok,
             day1_target IS NOT NULL AND day2_target IS NOT NULL AND day3_target IS NOT NULL AS target_ok FROM hfeat)
SELECT city, count(*) AS n_rows, count(*) FILTER (WHERE serving_ok) AS n_serving,
       count(*) FILTER (WHERE serving_ok AND target_ok) AS n_training
FROM c GROUP BY city
""")
def q_complete_feature_rows(spark, sf_dir):
    prepare(spark)
    h = ft.hourly_feature_rows(events_observations(spark, sf_dir, "user"), complete_only=False)
    counted = lambda targets: F.count(F.when(ft.is_complete(include_targets=targets), 1))
    return h.groupBy("city").agg(F.count(F.lit(1)).alias("n_rows"), counted(False).alias("n_serving"),
                                 counted(True).alias("n_training"))


# --- U1, R2, R3, F6: one serving row per key from history + a live row -------
@query("live_serving_row", f"""
WITH {obs_cte('user')},
live AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
hist AS (SELECT o.* FROM obs o WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.city = o.city AND l.timestamp = o.timestamp)),
hcount AS (SELECT city, count(*) AS n, max(timestamp) AS last_ts FROM hist GROUP BY city),
ok AS (SELECT l.* FROM live l JOIN hcount h ON l.city = h.city WHERE h.n >= 3 AND l.timestamp > h.last_ts),
u AS (SELECT * FROM hist UNION ALL SELECT * FROM ok),
{hourly_cte('u', targets=False, complete=False)}
SELECT h.city, h.timestamp, {', '.join('h.' + c for c in FEATURE_COLUMNS[:-1])},
       round(h.aqi_rolling_mean, 6) AS aqi_rolling_mean
FROM hfeat h JOIN ok ON h.city = ok.city AND h.timestamp = ok.timestamp
""")
def q_live_serving_row(spark, sf_dir):
    from aerocast.plans.serving import serving_rows
    prepare(spark)
    obs = events_observations(spark, sf_dir, "user")
    live = latest_per_key(obs, ["city"], ["timestamp"])
    history = obs.join(live.select("city", "timestamp"), ["city", "timestamp"], "left_anti")
    rows, _refused = serving_rows(history, live)
    return finish(rows.select("city", "timestamp", *FEATURE_COLUMNS), ["aqi_rolling_mean"])

