"""Queries: sources, backfill, status aggregates, splits, metrics, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, HORIZONS, RAW_FEATURES
from aerocast.functions import iso_date, version_stamp
from aerocast.operators import features as ft
from aerocast.operators import status as stt
from aerocast.plans.backfill import apply_backfill, backfill_summary, prepare_backfill
from aerocast.plans.registry import finish, query
from aerocast.plans.sqlparts import (
    FEATURES, POLLUTANTS, daily_cte, dense_daily_features_cte, dense_daily_serving_cte, hourly_cte,
    obs_cte, r6,
)
from aerocast.session import prepare, scratch_path
from aerocast.sources.files import flatten_payloads, read_csv_history, read_payloads
from aerocast.sources.history import city_history, history_page, page_after
from aerocast.sources.observations import events_observations
from aerocast.streaming.windows import late_after_close, run_daily_mean_stream, run_daily_mean_table

ISO_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# --- S1, F1: CSV history scan -------------------------------------------------
@query("scan_csv_observations", f"""
WITH {obs_cte('type')}
SELECT timestamp, {POLLUTANTS} FROM obs WHERE city = 'click'
""")
def q_scan_csv_observations(spark, sf_dir):
    prepare(spark)
    path = scratch_path(spark, "csv-history")
    obs = events_observations(spark, sf_dir, "type")
    (obs.select("city", F.date_format("timestamp", ISO_MICRO).alias("timestamp"), *RAW_FEATURES,
                F.lit("extra columns are tolerated").alias("note"))
     .write.option("header", True).csv(path))
    return finish(read_csv_history(spark, path, city="click").select("timestamp", *RAW_FEATURES))


# --- S2, X14: nested payloads landed as JSON, flattened ------------------------
@query("flatten_payload", f"""
WITH {obs_cte('type')}
SELECT city, timestamp, {POLLUTANTS}, aqi, sulphur_dioxide + 10 AS temperature, pm10 AS humidity,
       nitrogen_dioxide / 4 AS wind_speed, 'payload' AS source
FROM obs
""")
def q_flatten_payload(spark, sf_dir):
    prepare(spark)
    path = scratch_path(spark, "payloads")
    o = events_observations(spark, sf_dir, "type")
    comp = F.struct(
        F.col("carbon_monoxide").alias("co"), F.lit(None).cast("double").alias("no"),
        F.col("nitrogen_dioxide").alias("no2"), F.col("ozone").alias("o3"), F.col("sulphur_dioxide").alias("so2"),
        F.col("pm2_5").alias("pm2_5"), F.col("pm10").alias("pm10"), F.lit(None).cast("double").alias("nh3"))
    dt = F.unix_seconds("timestamp")
    payload = o.select(
        F.date_format("timestamp", ISO_MICRO).alias("timestamp"), "city",
        F.lit("31.5204").alias("latitude"), F.lit("74.3587").alias("longitude"),
        F.struct(F.struct(F.lit(74.3587).alias("lon"), F.lit(31.5204).alias("lat")).alias("coord"),
                 F.array(F.struct(F.struct(F.lit(1).alias("aqi")).alias("main"), comp.alias("components"),
                                  dt.alias("dt"))).alias("list")).alias("air_pollution"),
        F.struct(F.struct((F.col("sulphur_dioxide") + 10).alias("temp"), F.col("pm10").alias("humidity")).alias("main"),
                 F.struct((F.col("nitrogen_dioxide") / 4).alias("speed")).alias("wind"),
                 dt.alias("dt"), F.col("city").alias("name")).alias("weather"))
    payload.write.json(path)
    return finish(flatten_payloads(read_payloads(spark, path, multi_line=False)))


# --- S3, F1: one key's history ------------------------------------------------------
@query("scan_city_history", f"""
WITH {obs_cte('type')}
SELECT timestamp, aqi, {POLLUTANTS} FROM obs WHERE city = 'click'
""")
def q_scan_city_history(spark, sf_dir):
    prepare(spark)
    store = events_observations(spark, sf_dir, "type").withColumnRenamed("timestamp", "event_timestamp")
    return finish(city_history(store, "click"))


# --- S4, T5, U2: one ordered page ---------------------------------------------------
@query("history_page", f"""
WITH {obs_cte('type')}
SELECT city, timestamp, aqi, {POLLUTANTS} FROM obs ORDER BY city, timestamp LIMIT 250 OFFSET 500
""")
def q_history_page(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "type").select("city", "timestamp", "aqi", *RAW_FEATURES)
    return finish(history_page(obs, 500, 250))


@query("history_page_after", f"""
WITH {obs_cte('type')}
SELECT city, timestamp, aqi, {POLLUTANTS} FROM obs
WHERE city > 'click' OR (city = 'click' AND timestamp > TIMESTAMP '2024-01-20 00:00:00') ORDER BY city, timestamp LIMIT 250
""")
def q_history_page_after(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "type").select("city", "timestamp", "aqi", *RAW_FEATURES)
    return finish(page_after(obs, ("click", dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)), 250))


# --- C1, J2, P3: backfill payload (all rows, first three per key without lags) -----
_BF_SQL = f"""{obs_cte('type')}, {hourly_cte('obs', name='bf', targets=False, complete=False)}"""


@query("backfill_payload", f"""
WITH {_BF_SQL}
SELECT city, timestamp AS event_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS created_timestamp, aqi,
       {FEATURES.replace('aqi_rolling_mean', 'round(aqi_rolling_mean, 6) AS aqi_rolling_mean')}
FROM bf
""")
def q_backfill_payload(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "type").drop("aqi")
    return finish(prepare_backfill(obs, "2024-02-01 00:00:00"), ["aqi_rolling_mean"])


# --- C1, K1: the store after the payload is applied twice ----------------------------
@query("backfill_apply", f"""
WITH {_BF_SQL}
SELECT city, timestamp AS event_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS created_timestamp, aqi,
       {FEATURES.replace('aqi_rolling_mean', 'round(aqi_rolling_mean, 6) AS aqi_rolling_mean')}
FROM bf
""")
def q_backfill_apply(spark, sf_dir):
    prepare(spark)
    # as read from text files: times and numbers are strings
    obs = events_observations(spark, sf_dir, "type").drop("aqi").withColumns(
        {"timestamp": F.date_format("timestamp", ISO_MICRO), **{c: F.col(c).cast("string") for c in RAW_FEATURES}})
    store = scratch_path(spark, "backfill-store")
    payload = prepare_backfill(obs, "2024-02-01 00:00:00")
    for _ in range(2):
        apply_backfill(spark, store, payload)
    return finish(spark.read.parquet(store).drop("event_date"), ["aqi_rolling_mean"])


# --- A4: backfill dry-run summary -------------------------------------------------------
@query("backfill_summary", f"""
WITH {_BF_SQL}
SELECT city, count(*) AS n_rows, count(DISTINCT (city, timestamp)) AS n_keys,
       count(*) FILTER (WHERE {' AND '.join(c.strip() + ' IS NOT NULL' for c in FEATURES.split(','))}) AS n_complete
FROM bf GROUP BY city
""")
def q_backfill_summary(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "type").drop("aqi")
    return backfill_summary(prepare_backfill(obs, "2024-02-01 00:00:00", ))


# --- A2: history status (re-sent copies make some keys non-chronological) -----------
_RESENT_SQL = f"""{obs_cte('user')},
r AS (SELECT city, timestamp, seq * 10 AS seq FROM obs
      UNION ALL SELECT city, timestamp, (seq + 50) * 10 + 5 FROM obs WHERE pm2_5 > 200)"""


@query("history_status", f"""
WITH {_RESENT_SQL},
l AS (SELECT *, lag(timestamp) OVER (PARTITION BY city ORDER BY seq) AS prev FROM r)
SELECT city, count(*) AS n_rows, count(*) FILTER (WHERE timestamp < prev) = 0 AS chronological,
       max(timestamp) AS latest_timestamp
FROM l GROUP BY city
""")
def q_history_status(spark, sf_dir):
    prepare(spark)
    o = events_observations(spark, sf_dir, "user")
    r = o.select("city", "timestamp", (F.col("seq") * 10).alias("seq")).unionByName(
        o.where(F.col("pm2_5") > 200).select("city", "timestamp", ((F.col("seq") + 50) * 10 + 5).alias("seq")))
    return finish(stt.history_status(r))


# --- A3: training readiness --------------------------------------------------------------
@query("training_readiness", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_features_cte()},
n AS (SELECT city, count(*) AS n_rows FROM obs GROUP BY city),
u AS (SELECT city, count(*) AS usable_daily_rows FROM dfeat GROUP BY city)
SELECT n.city, n.n_rows, CAST(greatest(0, 30 - n.n_rows) AS BIGINT) AS missing_rows,
       coalesce(u.usable_daily_rows, 0) AS usable_daily_rows,
       n.n_rows >= 30 AND coalesce(u.usable_daily_rows, 0) >= 15 AS ready
FROM n LEFT JOIN u ON n.city = u.city
""")
def q_training_readiness(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "user")
    return stt.training_readiness(obs, ft.daily_features_from_obs(obs))


_LAST_TARGET_SQL = f"""{obs_cte('user')}, {daily_cte()}, {dense_daily_features_cte()},
lastrow AS (SELECT * FROM dfeat QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
fc AS (SELECT city, timestamp, 'day1' AS horizon, 1 AS h, day1_target AS aqi FROM lastrow
       UNION ALL SELECT city, timestamp, 'day2', 2, day2_target FROM lastrow
       UNION ALL SELECT city, timestamp, 'day3', 3, day3_target FROM lastrow)"""


def _last_target_rows(spark, sf_dir):
    rows = ft.daily_features_from_obs(events_observations(spark, sf_dir, "user"))
    last = ft.latest_vector(rows)
    return stt.long_horizons(last, ["city", "timestamp"], value_name="aqi")


# --- A7: any-hazard alert -------------------------------------------------------------------
@query("hazard_alert", f"""
WITH {_LAST_TARGET_SQL}
SELECT city, round(max(aqi), 6) AS max_aqi, bool_or(round_even(aqi, 1) > 300) AS any_hazard FROM fc GROUP BY city
""")
def q_hazard_alert(spark, sf_dir):
    prepare(spark)
    return finish(stt.hazard_alert(_last_target_rows(spark, sf_dir)), ["max_aqi"])


# --- X8, P6: forecast dates from the newest serving vector -----------------------------------
@query("forecast_dates", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_serving_cte()},
last AS (SELECT city, max(timestamp) AS ts FROM dserve GROUP BY city),
h AS (SELECT * FROM (VALUES ('day1', 1), ('day2', 2), ('day3', 3)) t(horizon, n))
SELECT last.city, h.horizon, strftime(last.ts + to_days(CAST(h.n AS INTEGER)), '%Y-%m-%d') AS date
FROM last, h
""")
def q_forecast_dates(spark, sf_dir):
    prepare(spark)
    rows = ft.daily_feature_rows(ft.daily_mean(events_observations(spark, sf_dir, "user")), include_targets=False)
    last = rows.groupBy("city").agg(F.max("timestamp").alias("ts"))
    fan = last.select("city", "ts", F.explode(F.array(*[
        F.struct(F.lit(n).alias("horizon"), F.lit(i).alias("n")) for i, n in enumerate(HORIZONS, 1)])).alias("_h"))
    return fan.select("city", F.col("_h.horizon").alias("horizon"),
                      iso_date(F.date_add(F.to_date("ts"), F.col("_h.n"))).alias("date"))


# --- R6: tumbling one-day window on a stream, closed days only ------------------------------
@query("stream_daily_mean", f"""
WITH {obs_cte('user')}, {daily_cte()}
SELECT city, timestamp, {r6('aqi, ' + POLLUTANTS)} FROM daily
WHERE timestamp + INTERVAL 1 DAY <= (SELECT max(timestamp) FROM obs) - INTERVAL 1 HOUR
""")
def q_stream_daily_mean(spark, sf_dir):
    prepare(spark)
    root = scratch_path(spark, "stream-daily")
    obs = events_observations(spark, sf_dir, "user").select("city", "timestamp", "aqi", *RAW_FEATURES)
    obs.write.parquet(f"{root}/landing")
    run_daily_mean_stream(spark, f"{root}/landing", obs.schema, f"{root}/out", f"{root}/ckpt")
    return finish(spark.read.parquet(f"{root}/out").drop("n_rows"), ["aqi", *RAW_FEATURES])


@query("stream_late_rows", f"""
WITH {obs_cte('user')},
late AS (SELECT * FROM obs WHERE timestamp < (SELECT max(timestamp) FROM obs) - INTERVAL 10 DAY AND pm2_5 > 50),
n AS (SELECT city, date_trunc('day', timestamp) AS timestamp, count(*) AS n_rows FROM obs GROUP BY 1, 2),
l AS (SELECT city, date_trunc('day', timestamp) AS timestamp, count(*) AS n_late FROM late GROUP BY 1, 2)
SELECT l.city, l.timestamp, n.n_rows + l.n_late AS n_landed, n.n_rows, l.n_late FROM l JOIN n ON l.city = n.city AND l.timestamp = n.timestamp
""")
def q_stream_late_rows(spark, sf_dir):
    prepare(spark)
    root = scratch_path(spark, "stream-late")
    obs = events_observations(spark, sf_dir, "user").select("city", "timestamp", "aqi", *RAW_FEATURES)
    last = obs.agg(F.max("timestamp")).first()[0]
    late = obs.where((F.col("timestamp") < F.lit(last) - F.expr("INTERVAL 10 DAY")) & (F.col("pm2_5") > 50))
    for part, rows in ((1, obs), (2, late)):  # re-sent after their days were closed
        rows.write.parquet(f"{root}/landing/part={part}")
        run_daily_mean_stream(spark, f"{root}/landing/part=*", obs.schema, f"{root}/out", f"{root}/ckpt")
    landed = spark.read.parquet(f"{root}/landing").drop("part")
    return finish(late_after_close(landed, spark.read.parquet(f"{root}/out")).select("city", "timestamp", "n_landed", "n_rows", "n_late"))


# --- R6: stored daily means that rows three days late and more correct ------------------------
@query("daily_mean_corrected", f"""
WITH {obs_cte('user', 'first')},
late AS (SELECT * REPLACE (timestamp - INTERVAL 3 DAY AS timestamp, aqi + 7 AS aqi) FROM first WHERE pm2_5 > 50),
obs AS (SELECT * FROM first UNION ALL SELECT * FROM late), {daily_cte()}
SELECT city, timestamp, {r6('aqi, ' + POLLUTANTS)}, n_rows FROM daily
JOIN (SELECT city AS c, date_trunc('day', timestamp) AS t, count(*) AS n_rows FROM obs GROUP BY 1, 2) ON c = city AND t = timestamp
""")
def q_daily_mean_corrected(spark, sf_dir):
    prepare(spark)
    root = scratch_path(spark, "daily-corrected")
    obs = events_observations(spark, sf_dir, "user").select("city", "timestamp", "aqi", *RAW_FEATURES)
    late = obs.where("pm2_5 > 50").withColumns({"timestamp": F.col("timestamp") - F.expr("INTERVAL 3 DAY"), "aqi": F.col("aqi") + 7})
    for part, rows in ((1, obs), (2, late)):
        rows.write.parquet(f"{root}/landing/part={part}")
        run_daily_mean_table(spark, f"{root}/landing/part=*", obs.schema, f"{root}/out", f"{root}/ckpt")
    return finish(spark.read.parquet(f"{root}/out").drop("event_date"), ["aqi", *RAW_FEATURES])


# --- W8: chronological 80/20 split -----------------------------------------------------------
@query("chrono_split", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_features_cte()}
SELECT city, timestamp,
       row_number() OVER (PARTITION BY city ORDER BY timestamp) <= (count(*) OVER (PARTITION BY city)) * 4 // 5 AS is_train
FROM dfeat
""")
def q_chrono_split(spark, sf_dir):
    prepare(spark)
    rows = ft.daily_features_from_obs(events_observations(spark, sf_dir, "user"))
    return finish(ft.chrono_split(rows).select("city", "timestamp", "is_train"))


# --- A5: metrics of the persistence forecast (prediction = lag 1) on the test part -----------
@query("regression_metrics", f"""
WITH {obs_cte('user')}, {daily_cte()}, {dense_daily_features_cte()},
s AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp) <= (count(*) OVER (PARTITION BY city)) * 4 // 5
               AS is_train FROM dfeat),
t AS (SELECT 'day1' AS horizon, day1_target AS y, aqi_lag1 AS prediction FROM s WHERE NOT is_train
      UNION ALL SELECT 'day2', day2_target, aqi_lag1 FROM s WHERE NOT is_train
      UNION ALL SELECT 'day3', day3_target, aqi_lag1 FROM s WHERE NOT is_train)
SELECT horizon, count(*) AS n, round(sqrt(avg((y - prediction) * (y - prediction))), 6) AS rmse,
       round(avg(abs(y - prediction)), 6) AS mae,
       round(1 - sum((y - prediction) * (y - prediction)) / (count(*) * var_pop(y)), 6) AS r2
FROM t GROUP BY horizon
""")
def q_regression_metrics(spark, sf_dir):
    prepare(spark)
    rows = ft.chrono_split(ft.daily_features_from_obs(events_observations(spark, sf_dir, "user")))
    test = rows.where(~F.col("is_train"))
    long = stt.long_horizons(test, ["aqi_lag1"], value_name="y").withColumnRenamed("aqi_lag1", "prediction")
    return finish(stt.regression_metrics(long), ["rmse", "mae", "r2"])


# --- P5, T2, A6, T3, K5 on centred daily features ----------------------------------------------
_CENTRED_SQL = f"""{obs_cte('user')}, {daily_cte()}, {dense_daily_serving_cte()},
longf AS (SELECT city, timestamp, feature, CAST(feature_value AS DOUBLE) AS feature_value
          FROM (SELECT city, timestamp, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURE_COLUMNS)} FROM dserve)
          UNPIVOT (feature_value FOR feature IN ({FEATURES}))),
means AS (SELECT feature, avg(feature_value) AS m FROM longf GROUP BY feature),
centred AS (SELECT l.city, l.timestamp, l.feature, round(l.feature_value - m.m, 6) AS centred
            FROM longf l JOIN means m ON l.feature = m.feature)"""


def _daily_rows(spark, sf_dir):
    return ft.daily_feature_rows(ft.daily_mean(events_observations(spark, sf_dir, "user")), include_targets=False)


def _long_features(spark, sf_dir):
    from aerocast.operators.attribution import to_long
    return to_long(_daily_rows(spark, sf_dir), ["city", "timestamp"])


def _centred(spark, sf_dir):
    from aerocast.operators.attribution import centre
    return centre(_long_features(spark, sf_dir)).withColumn("centred", F.round("centred", 6))


@query("unpivot_features", f"""
WITH {_CENTRED_SQL}
SELECT city, timestamp, feature, round(feature_value, 6) AS feature_value FROM longf
""")
def q_unpivot_features(spark, sf_dir):
    prepare(spark)
    return finish(_long_features(spark, sf_dir), ["feature_value"])


@query("rank_by_abs", f"""
WITH {_CENTRED_SQL}
SELECT city, timestamp, feature, centred,
       row_number() OVER (PARTITION BY city, timestamp ORDER BY abs(centred) DESC, feature) AS rank
FROM centred
""")
def q_rank_by_abs(spark, sf_dir):
    from aerocast.operators.attribution import rank_in_row
    prepare(spark)
    rows = _daily_rows(spark, sf_dir)
    means = rows.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURE_COLUMNS]).first()  # 14 numbers
    off = rows.withColumns({c: F.round(F.col(c) - F.lit(means[c]), 6) for c in FEATURE_COLUMNS})
    return finish(rank_in_row(off, ["city", "timestamp"], "centred"))


@query("mean_abs_by_feature", f"""
WITH {_CENTRED_SQL}
SELECT feature, round(avg(abs(centred)), 6) AS mean_abs,
       row_number() OVER (ORDER BY round(avg(abs(centred)), 6) DESC, feature) AS rank
FROM centred GROUP BY feature
""")
def q_mean_abs_by_feature(spark, sf_dir):
    from aerocast.operators.attribution import mean_abs_report
    prepare(spark)
    return finish(mean_abs_report(_centred(spark, sf_dir), "centred").withColumnRenamed("mean_abs_shap", "mean_abs"), ["mean_abs"])


@query("importance_report_csv", f"""
WITH {_CENTRED_SQL}, {obs_cte('user', 'o2')}
SELECT feature, round(avg(abs(centred)), 6) AS mean_abs_shap,
       (SELECT strftime(max(timestamp), '%Y%m%dT%H%M%SZ') FROM o2) AS model_version, 'day1' AS horizon
FROM centred GROUP BY feature
""")
def q_importance_report_csv(spark, sf_dir):
    from aerocast.operators.attribution import mean_abs_report, write_report_csv
    prepare(spark)
    version = events_observations(spark, sf_dir, "user").agg(version_stamp(F.max("timestamp"))).first()[0]
    rep = mean_abs_report(_centred(spark, sf_dir), "centred").select(
        "feature", "mean_abs_shap", F.lit(version).alias("model_version"), F.lit("day1").alias("horizon"))
    path = scratch_path(spark, "importance-report")
    write_report_csv(rep, path)
    back = spark.read.option("header", True).csv(path)
    return finish(back.select("feature", F.col("mean_abs_shap").cast("double").alias("mean_abs_shap"),
                              "model_version", "horizon"), ["mean_abs_shap"])

