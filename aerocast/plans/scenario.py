"""The store scenario shared by the store and ingest queries.

From the observation adapter (one key per user): rows before ``CUT`` are
stored; the arriving batch holds the later rows (``fresh``), exact copies of
fresh readings above 200 re-sent later (``twins``), already stored rows of
the last stored day (``replay``), the same rows one second earlier (``late``)
copies of fresh readings below 10 under new keys without history
(``newcomers``), and copies of fresh readings without a time, without a key,
with a negative pollutant or without PM2.5 and index (``broken``). ``seq`` offsets keep the arrival order unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.contract import RAW_FEATURES
from aerocast.plans.sqlparts import obs_cte
from aerocast.sources.observations import events_observations

CUT = "2024-01-26 00:00:00"
REPLAY_FROM = "2024-01-25 00:00:00"
BATCH_COLS = ["city", "event_timestamp", "seq", "aqi", *RAW_FEATURES]
_P = ", ".join(RAW_FEATURES)


def _ts(s: str):
    return F.to_timestamp(F.lit(s))


def observations(spark, sf_dir) -> DataFrame:
    return events_observations(spark, sf_dir, "user").withColumnRenamed("timestamp", "event_timestamp")


def stored(spark, sf_dir) -> DataFrame:
    o = observations(spark, sf_dir)
    return o.where(F.col("event_timestamp") < _ts(CUT)).select(*BATCH_COLS)


def batch_parts(spark, sf_dir) -> dict[str, DataFrame]:
    o = observations(spark, sf_dir).select(*BATCH_COLS)
    ts = F.col("event_timestamp")
    fresh = o.where(ts >= _ts(CUT))
    replay = o.where((ts >= _ts(REPLAY_FROM)) & (ts < _ts(CUT)))
    return {
        "fresh": fresh,
        "twins": fresh.where(F.col("pm2_5") > 200).withColumn("seq", F.col("seq") + 1_000_000_000),
        "replay": replay,
        "late": replay.withColumn("event_timestamp", ts - F.expr("INTERVAL 1 SECOND"))
                      .withColumn("seq", F.col("seq") + 2_000_000_000),
        "newcomers": fresh.where(F.col("pm2_5") < 10).withColumn("city", F.concat(F.lit("new-"), F.col("city")))
                          .withColumn("seq", F.col("seq") + 3_000_000_000),
        "broken": _broken(fresh),
    }


def _broken(fresh: DataFrame) -> DataFrame:
    kind = F.col("seq") % 7
    null = F.lit(None)
    return fresh.where(kind < 4).select(
        F.when(kind != 1, F.col("city")).alias("city"),
        F.when(kind == 0, null.cast("timestamp")).when(kind > 1, F.col("event_timestamp") + F.expr("INTERVAL 2 SECOND"))
        .otherwise(F.col("event_timestamp")).alias("event_timestamp"),
        (F.col("seq") + 4_000_000_000).alias("seq"), F.when(kind != 3, F.col("aqi")).alias("aqi"),
        *[F.when(kind == 2, F.lit(-5.0)).otherwise(F.col(c)).alias(c) if c == "pm10"
          else F.when(kind != 3, F.col(c)).alias(c) if c == "pm2_5" else F.col(c) for c in RAW_FEATURES])


def batch(spark, sf_dir) -> DataFrame:
    parts = list(batch_parts(spark, sf_dir).values())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL = f"""{obs_cte('user')},
o AS (SELECT city, timestamp AS event_timestamp, seq, aqi, {_P} FROM obs),
stored AS (SELECT * FROM o WHERE event_timestamp < TIMESTAMP '{CUT}'),
batch AS (
  SELECT city, event_timestamp, seq, aqi, {_P} FROM o WHERE event_timestamp >= TIMESTAMP '{CUT}'
  UNION ALL SELECT city, event_timestamp, seq + 1000000000, aqi, {_P} FROM o
            WHERE event_timestamp >= TIMESTAMP '{CUT}' AND pm2_5 > 200
  UNION ALL SELECT city, event_timestamp, seq, aqi, {_P} FROM o
            WHERE event_timestamp >= TIMESTAMP '{REPLAY_FROM}' AND event_timestamp < TIMESTAMP '{CUT}'
  UNION ALL SELECT city, event_timestamp - INTERVAL 1 SECOND, seq + 2000000000, aqi, {_P} FROM o
            WHERE event_timestamp >= TIMESTAMP '{REPLAY_FROM}' AND event_timestamp < TIMESTAMP '{CUT}'
  UNION ALL SELECT 'new-' || city, event_timestamp, seq + 3000000000, aqi, {_P} FROM o
            WHERE event_timestamp >= TIMESTAMP '{CUT}' AND pm2_5 < 10
  UNION ALL SELECT CASE WHEN seq % 7 <> 1 THEN city END,
                   CASE seq % 7 WHEN 0 THEN NULL WHEN 1 THEN event_timestamp ELSE event_timestamp + INTERVAL 2 SECOND END,
                   seq + 4000000000, CASE WHEN seq % 7 <> 3 THEN aqi END,
                   CASE WHEN seq % 7 = 2 THEN -5 ELSE pm10 END, CASE WHEN seq % 7 <> 3 THEN pm2_5 END,
                   {', '.join(RAW_FEATURES[2:])} FROM o
            WHERE event_timestamp >= TIMESTAMP '{CUT}' AND seq % 7 < 4)"""
#: Rows of ``batch`` that the contract refuses.
INVALID = "(city IS NULL OR event_timestamp IS NULL OR " + " OR ".join(
    f"{c} IS NULL OR {c} < 0" for c in ("aqi", *RAW_FEATURES)) + ")"
