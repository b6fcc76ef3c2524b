"""SQL building blocks for the DuckDB oracles (same constants as the code)."""

from __future__ import annotations

from aerocast.contract import AQI_CATEGORIES, AQI_CEILING, AQI_TOP_CATEGORY, PM25_AQI_BREAKPOINTS


def dbl(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def sql_aqi(x: str) -> str:
    whens = " ".join(
        f"WHEN {x} <= {dbl(high)} THEN round_even({dbl(a_high - a_low)} * ({x} - {dbl(low)}) / {dbl(high - low)} + {dbl(a_low)}, 1)"
        for low, high, a_low, a_high in PM25_AQI_BREAKPOINTS
    )
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR {x} < 0 OR isinf({x}) THEN NULL "
            f"{whens} ELSE {dbl(AQI_CEILING)} END)")


def sql_category(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {limit} THEN '{label}'" for limit, label in AQI_CATEGORIES)
    return f"(CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{AQI_TOP_CATEGORY}' END)"


K = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def obs_cte(by: str = "type", name: str = "obs") -> str:
    city = "event_type" if by == "type" else "CAST(user_id AS VARCHAR)"
    return f"""{name} AS (
  SELECT {city} AS city, ts AS timestamp, event_id AS seq,
         {K} AS pm10, value AS pm2_5, value * 4 + {K} AS carbon_monoxide,
         value / 2 AS nitrogen_dioxide, {K} / 4 AS sulphur_dioxide, value + {K} AS ozone,
         {sql_aqi('value')} AS aqi
  FROM events)"""


POLLUTANTS = "pm10, pm2_5, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone"
FEATURES = (POLLUTANTS + ", hour, month, day, day_of_week, aqi_lag1, aqi_lag2, aqi_lag3, aqi_rolling_mean")
TARGETS = "day1_target, day2_target, day3_target"


def r6(cols: str, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c.strip()}, 6) AS {c.strip()}" for c in cols.split(","))


def daily_cte(src: str = "obs", name: str = "daily") -> str:
    avgs = ", ".join(f"avg({c}) AS {c}" for c in ["aqi", *POLLUTANTS.split(", ")])
    return f"""{name} AS (
  SELECT city, date_trunc('day', timestamp) AS timestamp, {avgs}
  FROM {src} GROUP BY 1, 2)"""


def dense_daily_features_cte(daily: str = "daily", name: str = "dfeat") -> str:
    """Dense calendar per key, then positional shifts (an independent formulation)."""
    return f"""{name}_span AS (SELECT city, min(timestamp) AS lo, max(timestamp) AS hi FROM {daily} GROUP BY city),
{name}_cal AS (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS timestamp FROM {name}_span),
{name}_dense AS (SELECT c.city, c.timestamp, d.aqi, d.pm10, d.pm2_5, d.carbon_monoxide, d.nitrogen_dioxide,
                        d.sulphur_dioxide, d.ozone
                 FROM {name}_cal c LEFT JOIN {daily} d ON c.city = d.city AND c.timestamp = d.timestamp),
{name}_all AS (
  SELECT city, timestamp, aqi, {POLLUTANTS},
         CAST(0 AS BIGINT) AS hour, CAST(month(timestamp) AS BIGINT) AS month,
         CAST(day(timestamp) AS BIGINT) AS day, CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
         lag(aqi, 1) OVER w AS aqi_lag1, lag(aqi, 2) OVER w AS aqi_lag2, lag(aqi, 3) OVER w AS aqi_lag3,
         (lag(aqi, 3) OVER w + lag(aqi, 2) OVER w + lag(aqi, 1) OVER w) / 3 AS aqi_rolling_mean,
         lead(aqi, 1) OVER w AS day1_target, lead(aqi, 2) OVER w AS day2_target, lead(aqi, 3) OVER w AS day3_target
  FROM {name}_dense WINDOW w AS (PARTITION BY city ORDER BY timestamp)),
{name} AS (SELECT * FROM {name}_all
  WHERE aqi IS NOT NULL AND {' AND '.join(c.strip() + ' IS NOT NULL' for c in FEATURES.split(','))}
    AND day1_target IS NOT NULL AND day2_target IS NOT NULL AND day3_target IS NOT NULL)"""


def dense_daily_serving_cte(daily: str = "daily", name: str = "dserve") -> str:
    """As above without targets (serving rows)."""
    return f"""{name}_span AS (SELECT city, min(timestamp) AS lo, max(timestamp) AS hi FROM {daily} GROUP BY city),
{name}_cal AS (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS timestamp FROM {name}_span),
{name}_dense AS (SELECT c.city, c.timestamp, d.aqi, d.pm10, d.pm2_5, d.carbon_monoxide, d.nitrogen_dioxide,
                        d.sulphur_dioxide, d.ozone
                 FROM {name}_cal c LEFT JOIN {daily} d ON c.city = d.city AND c.timestamp = d.timestamp),
{name}_all AS (
  SELECT city, timestamp, aqi, {POLLUTANTS},
         CAST(0 AS BIGINT) AS hour, CAST(month(timestamp) AS BIGINT) AS month,
         CAST(day(timestamp) AS BIGINT) AS day, CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
         lag(aqi, 1) OVER w AS aqi_lag1, lag(aqi, 2) OVER w AS aqi_lag2, lag(aqi, 3) OVER w AS aqi_lag3,
         (lag(aqi, 3) OVER w + lag(aqi, 2) OVER w + lag(aqi, 1) OVER w) / 3 AS aqi_rolling_mean
  FROM {name}_dense WINDOW w AS (PARTITION BY city ORDER BY timestamp)),
{name} AS (SELECT * FROM {name}_all
  WHERE aqi IS NOT NULL AND {' AND '.join(c.strip() + ' IS NOT NULL' for c in FEATURES.split(','))})"""


def hourly_cte(src: str = "obs", name: str = "hfeat", targets: bool = True, complete: bool = True) -> str:
    tgt = (", lead(aqi, 1) OVER w AS day1_target, lead(aqi, 2) OVER w AS day2_target, "
           "lead(aqi, 3) OVER w AS day3_target") if targets else ""
    cond = " AND ".join(c.strip() + " IS NOT NULL" for c in FEATURES.split(","))
    if targets:
        cond += " AND day1_target IS NOT NULL AND day2_target IS NOT NULL AND day3_target IS NOT NULL"
    where = f"WHERE aqi IS NOT NULL AND {cond}" if complete else ""
    return f"""{name}_all AS (
  SELECT city, timestamp, aqi, {POLLUTANTS},
         CAST(hour(timestamp) AS BIGINT) AS hour, CAST(month(timestamp) AS BIGINT) AS month,
         CAST(day(timestamp) AS BIGINT) AS day, CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
         lag(aqi, 1) OVER w AS aqi_lag1, lag(aqi, 2) OVER w AS aqi_lag2, lag(aqi, 3) OVER w AS aqi_lag3,
         (lag(aqi, 3) OVER w + lag(aqi, 2) OVER w + lag(aqi, 1) OVER w) / 3 AS aqi_rolling_mean{tgt}
  FROM {src} WINDOW w AS (PARTITION BY city ORDER BY timestamp)),
{name} AS (SELECT * FROM {name}_all {where})"""
