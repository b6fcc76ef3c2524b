"""Queries: store appends, ingest, latest per key, lookups, as-of join."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, MIN_HISTORY_ROWS, RAW_FEATURES
from aerocast.operators import features as ft
from aerocast.operators import layout as lo
from aerocast.operators import partials as pt
from aerocast.operators import store as so
from aerocast.operators.joins import asof_join
from aerocast.operators.ordered import last_n_per_key
from aerocast.plans import scenario as sc
from aerocast.plans.registry import ORACLES, finish, query
from aerocast.plans.sqlparts import FEATURES, daily_cte, dense_daily_features_cte, hourly_cte, obs_cte
from aerocast.session import prepare, scratch_path
from aerocast.sources.observations import events_observations, table
from aerocast.streaming import ingest as ig

_P = ", ".join(RAW_FEATURES)


# --- K1, J3, R5: conflict-safe append (rows that would be inserted) ----------
@query("insert_ignore", f"""
WITH {sc.SQL},
b AS (SELECT *, event_timestamp + CASE WHEN seq >= 1000000000 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
                  AS created_timestamp FROM batch),
first AS (SELECT * FROM b WHERE city IS NOT NULL AND event_timestamp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city, event_timestamp ORDER BY created_timestamp) = 1)
SELECT city, event_timestamp, created_timestamp, seq, aqi FROM first f
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.city = f.city AND s.event_timestamp = f.event_timestamp)
""")
def q_insert_ignore(spark, sf_dir):
    prepare(spark)
    b = sc.batch(spark, sf_dir).withColumn(
        "created_timestamp",
        F.col("event_timestamp") + F.when(F.col("seq") >= 1_000_000_000, F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.expr("INTERVAL 0 HOUR")))
    rows = so.rows_to_insert(sc.stored(spark, sf_dir), b)
    return finish(rows.select("city", "event_timestamp", "created_timestamp", "seq", "aqi"))


# --- J4: already stored -------------------------------------------------------
@query("already_stored", f"""
WITH {sc.SQL}
SELECT city, event_timestamp, seq FROM batch b
WHERE EXISTS (SELECT 1 FROM stored s WHERE s.city = b.city AND s.event_timestamp = b.event_timestamp)
""")
def q_already_stored(spark, sf_dir):
    prepare(spark)
    return finish(so.already_stored(sc.batch(spark, sf_dir), sc.stored(spark, sf_dir))
                  .select("city", "event_timestamp", "seq"))


# --- J4, K1 over a stored table: day partitions, row groups by key ------------------
@query("probe_history", ORACLES["already_stored"])
def q_probe_history(spark, sf_dir):
    prepare(spark)
    path = scratch_path(spark, "history")
    lo.store_writer(sc.stored(spark, sf_dir).withColumn("event_date", F.to_date("event_timestamp"))).parquet(path)
    return finish(lo.held_rows(spark.read.parquet(path), sc.batch(spark, sf_dir)).select("city", "event_timestamp", "seq"))


# --- F6, R4: not newer than the stored history --------------------------------
@query("late_rows", f"""
WITH {sc.SQL},
last AS (SELECT city, max(event_timestamp) AS last_stored FROM stored GROUP BY city)
SELECT b.city, b.event_timestamp, b.seq, l.last_stored FROM batch b JOIN last l ON b.city = l.city
WHERE b.event_timestamp <= l.last_stored
""")
def q_late_rows(spark, sf_dir):
    prepare(spark)
    return finish(so.late_rows(sc.batch(spark, sf_dir), sc.stored(spark, sf_dir))
                  .select("city", "event_timestamp", "seq", "last_stored"))


_INGEST_SQL = f"""
WITH {sc.SQL},
st AS (SELECT city, count(*) AS n_stored, max(event_timestamp) AS last_ts FROM stored GROUP BY city),
b1 AS (SELECT b.*, st.n_stored, st.last_ts,
              EXISTS (SELECT 1 FROM stored s WHERE s.city = b.city AND s.event_timestamp = b.event_timestamp) AS in_store,
              row_number() OVER (PARTITION BY b.city, b.event_timestamp, {sc.INVALID.replace('city', 'b.city')} ORDER BY b.seq) AS twin
       FROM batch b LEFT JOIN st ON b.city = st.city),
b2 AS (SELECT *, CASE WHEN {sc.INVALID} THEN 'invalid' WHEN in_store THEN 'duplicate' WHEN coalesce(n_stored, 0) < 3 THEN 'no_history'
                      WHEN event_timestamp <= last_ts THEN 'late' WHEN twin > 1 THEN 'duplicate'
                      ELSE 'inserted' END AS status FROM b1),
hist AS (SELECT city, event_timestamp, aqi FROM stored
         QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_timestamp DESC) <= 3),
seqd AS (SELECT city, event_timestamp, aqi, false AS is_new FROM hist
         UNION ALL SELECT city, event_timestamp, aqi, true FROM b2 WHERE status = 'inserted'),
lg AS (SELECT city, event_timestamp, is_new, lag(aqi, 1) OVER w AS aqi_lag1, lag(aqi, 2) OVER w AS aqi_lag2,
              lag(aqi, 3) OVER w AS aqi_lag3,
              (lag(aqi, 3) OVER w + lag(aqi, 2) OVER w + lag(aqi, 1) OVER w) / 3 AS aqi_rolling_mean
       FROM seqd WINDOW w AS (PARTITION BY city ORDER BY event_timestamp))
SELECT b2.city, b2.event_timestamp, b2.seq, b2.aqi, {', '.join('b2.' + c for c in RAW_FEATURES)},
       CAST(hour(b2.event_timestamp) AS BIGINT) AS hour, CAST(month(b2.event_timestamp) AS BIGINT) AS month,
       CAST(day(b2.event_timestamp) AS BIGINT) AS day, CAST(isodow(b2.event_timestamp) - 1 AS BIGINT) AS day_of_week,
       lg.aqi_lag1, lg.aqi_lag2, lg.aqi_lag3, round(lg.aqi_rolling_mean, 6) AS aqi_rolling_mean, b2.status
FROM b2 LEFT JOIN lg ON lg.is_new AND b2.status = 'inserted' AND lg.city = b2.city
                    AND lg.event_timestamp = b2.event_timestamp
"""


# --- R1, R2, R4, R5 (set form): one batch against the stored history ----------
@query("ingest_batch", _INGEST_SQL)
def q_ingest_batch(spark, sf_dir):
    prepare(spark)
    stored = sc.stored(spark, sf_dir)
    out = ig.ingest_batch(sc.batch(spark, sf_dir), ig.history_summary(stored), stored)
    return finish(out, ["aqi_rolling_mean"])


# --- R1, R7 as Structured Streaming: two landed files, foreachBatch ----------
def _streamed(spark, sf_dir):
    """Two scheduled runs on one checkpoint, each picking up what landed since,
    and a third that meets all files again through a new checkpoint; the paths
    of status, store, served table and day partials."""
    root = scratch_path(spark, "stream-ingest")
    landing, store, status, served, partials, ckpt = (
        f"{root}/{p}" for p in ("landing", "store", "status", "served", "partials", "ckpt"))
    stored = sc.stored(spark, sf_dir)
    seed = ft.hourly_feature_rows(stored.withColumnRenamed("event_timestamp", "timestamp"),
                                  include_targets=False, complete_only=False)
    seed = seed.withColumnRenamed("timestamp", "event_timestamp").select(
        "city", "event_timestamp", F.col("event_timestamp").alias("created_timestamp"), "aqi", *FEATURE_COLUMNS)
    ig.seed_store(seed, store, served, partials)
    parts = sc.batch_parts(spark, sf_dir)
    first = parts["fresh"].unionByName(parts["newcomers"]).unionByName(parts["broken"])
    second = parts["twins"].unionByName(parts["replay"]).unionByName(parts["late"])
    for part, rows in (("1", first), ("2", second)):
        rows.write.parquet(f"{landing}/part={part}")
        ig.run_ingest_stream(spark, f"{landing}/part=*", store, status, ckpt, first.schema,
                             created_at="2024-02-01 00:00:00", served=served, run="hourly", partials=partials)
    ig.run_ingest_stream(spark, f"{landing}/part=*", store, status, f"{root}/ckpt2", first.schema,
                         created_at="2024-02-02 00:00:00", served=served, run="again", partials=partials)
    return status, store, served, partials


@query("stream_ingest", _INGEST_SQL)
def q_stream_ingest(spark, sf_dir):
    prepare(spark)
    status, *_ = _streamed(spark, sf_dir)
    out = spark.read.parquet(status).where("run = 'hourly'")
    out = out.select("city", "event_timestamp", "seq", "aqi", *RAW_FEATURES, "hour", "month", "day", "day_of_week",
                     "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_rolling_mean", "status")
    return finish(out, ["aqi_rolling_mean"])


# --- R5, R7, K1, K3: the stored and served tables after the stream, replay included ---
_STREAMED_SQL = _INGEST_SQL.replace("SELECT b2.city, b2.event_timestamp, b2.seq", ", done AS (SELECT b2.city, b2.event_timestamp, b2.seq").rstrip() + f"""),
held AS (SELECT city, event_timestamp, aqi FROM stored UNION ALL SELECT city, event_timestamp, aqi FROM done WHERE status = 'inserted')"""


@query("stream_store", f"""{_STREAMED_SQL}
SELECT city, count(*) AS n_rows, count(DISTINCT event_timestamp) AS n_keys, max(event_timestamp) AS last_ts FROM held GROUP BY city
""")
def q_stream_store(spark, sf_dir):
    prepare(spark)
    _, store, *_ = _streamed(spark, sf_dir)
    return finish(spark.read.parquet(store).groupBy("city").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_timestamp").alias("n_keys"), F.max("event_timestamp").alias("last_ts")))


@query("stream_served", f"""{_STREAMED_SQL}
SELECT city, event_timestamp, aqi FROM held
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_timestamp DESC) = 1
""")
def q_stream_served(spark, sf_dir):
    prepare(spark)
    _, _, served, _ = _streamed(spark, sf_dir)
    return finish(so.read_served(spark, served).select("city", "event_timestamp", "aqi"))


# --- A1, A2, A3 after a live run: from the day partials, which each batch advances ---
@query("status_from_partials", f"""{_STREAMED_SQL.replace('held AS (', 'hobs AS (SELECT city, event_timestamp AS timestamp, aqi, ' + _P + ' FROM stored UNION ALL SELECT city, event_timestamp, aqi, ' + _P + " FROM done WHERE status = 'inserted'), held AS (")},
{daily_cte('hobs')}, {dense_daily_features_cte()},
n AS (SELECT city, count(*) AS n_rows, max(timestamp) AS latest_timestamp FROM hobs GROUP BY city),
u AS (SELECT city, count(*) AS usable_daily_rows FROM dfeat GROUP BY city),
a AS (SELECT city, sum(aqi) AS aqi_of_days FROM daily GROUP BY city)
SELECT n.city, n.n_rows, true AS chronological, n.latest_timestamp, CAST(greatest(0, 30 - n.n_rows) AS BIGINT) AS missing_rows,
       coalesce(u.usable_daily_rows, 0) AS usable_daily_rows, n.n_rows >= 30 AND coalesce(u.usable_daily_rows, 0) >= 15 AS ready,
       round(a.aqi_of_days, 6) AS aqi_of_days
FROM n LEFT JOIN u ON n.city = u.city LEFT JOIN a ON n.city = a.city
""")
def q_status_from_partials(spark, sf_dir):
    prepare(spark)
    *_, path = _streamed(spark, sf_dir)
    partials = spark.read.parquet(path)
    days = pt.means(partials).groupBy("city").agg(F.sum("aqi").alias("aqi_of_days"))
    return finish(pt.status(partials).join(pt.training_status(partials).drop("n_rows"), "city").join(days, "city"), ["aqi_of_days"])


# --- W9: latest per key, equal event times resolved by created time ----------
_REISSUE_SQL = f"""{obs_cte('user')},
r AS (SELECT city, timestamp AS event_timestamp, timestamp AS created_timestamp, aqi FROM obs
      UNION ALL SELECT city, timestamp, timestamp + INTERVAL 1 HOUR, aqi + 1 FROM obs WHERE pm2_5 > 200)"""


def _reissued(spark, sf_dir):
    o = events_observations(spark, sf_dir, "user")
    base = o.select("city", F.col("timestamp").alias("event_timestamp"),
                    F.col("timestamp").alias("created_timestamp"), "aqi")
    again = o.where(F.col("pm2_5") > 200).select(
        "city", F.col("timestamp").alias("event_timestamp"),
        (F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("created_timestamp"), (F.col("aqi") + 1).alias("aqi"))
    return base.unionByName(again)


@query("latest_per_key", f"""
WITH {_REISSUE_SQL}
SELECT city, event_timestamp, created_timestamp, aqi FROM r
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_timestamp DESC, created_timestamp DESC) = 1
""")
def q_latest_per_key(spark, sf_dir):
    prepare(spark)
    return finish(so.latest_rows(_reissued(spark, sf_dir)))


# --- K3: incremental refresh of the served table -------------------------------
@query("materialize_latest", f"""
WITH {_REISSUE_SQL}
SELECT city, event_timestamp, created_timestamp, aqi FROM r
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_timestamp DESC, created_timestamp DESC) = 1
""")
def q_materialize_latest(spark, sf_dir):
    prepare(spark)
    r = _reissued(spark, sf_dir)
    cut = F.to_timestamp(F.lit(sc.CUT))
    root = scratch_path(spark, "served")
    so.refresh_served(spark, root, r.where(F.col("created_timestamp") < cut))
    so.refresh_served(spark, root, r.where(F.col("created_timestamp") >= cut))
    return finish(so.read_served(spark, root))


_SERVED_SQL = f"""{obs_cte('user')}, {hourly_cte('obs', name='bf', targets=False, complete=False)},
served AS (SELECT * FROM bf QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
ent AS (SELECT CAST(c_custkey AS VARCHAR) AS city FROM customer)"""


def _served(spark, sf_dir):
    # the newest vector reads the key's last four rows: its own and three before it
    tail = last_n_per_key(events_observations(spark, sf_dir, "user"), ["city"], "timestamp", 1 + MIN_HISTORY_ROWS)
    bf = ft.hourly_feature_rows(tail, include_targets=False, complete_only=False)
    rows = bf.withColumnRenamed("timestamp", "event_timestamp").withColumn(
        "created_timestamp", F.col("event_timestamp"))
    return so.latest_rows(rows)


def _entities(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("city"))


# --- J5: keyed lookup of the served vector --------------------------------------
@query("online_lookup", f"""
WITH {_SERVED_SQL}
SELECT e.city, s.timestamp AS event_timestamp, {', '.join('s.' + c for c in FEATURE_COLUMNS[:-1])},
       round(s.aqi_rolling_mean, 6) AS aqi_rolling_mean
FROM ent e LEFT JOIN served s ON e.city = s.city
""")
def q_online_lookup(spark, sf_dir):
    prepare(spark)
    out = so.online_lookup(_entities(spark, sf_dir), _served(spark, sf_dir),
                           columns=["event_timestamp", *FEATURE_COLUMNS])
    return finish(out.select("city", "event_timestamp", *FEATURE_COLUMNS), ["aqi_rolling_mean"])


# --- J5 on a bucketed, sorted table: the stored side is not shuffled -----------------
@query("bucketed_lookup", ORACLES["online_lookup"])
def q_bucketed_lookup(spark, sf_dir):
    prepare(spark)
    name = f"served_{uuid.uuid4().hex}"
    served = lo.write_bucketed(_served(spark, sf_dir), name, scratch_path(spark, name))
    out = so.online_lookup(_entities(spark, sf_dir), served, columns=["event_timestamp", *FEATURE_COLUMNS])
    return finish(out.select("city", "event_timestamp", *FEATURE_COLUMNS), ["aqi_rolling_mean"])


# --- F5: served vectors with a gap ----------------------------------------------
@query("online_vector_gaps", f"""
WITH {_SERVED_SQL}
SELECT e.city FROM ent e LEFT JOIN served s ON e.city = s.city
WHERE {' OR '.join('s.' + c.strip() + ' IS NULL' for c in FEATURES.split(','))}
""")
def q_online_vector_gaps(spark, sf_dir):
    from aerocast.operators.quality import missing_lags
    prepare(spark)
    out = so.online_lookup(_entities(spark, sf_dir), _served(spark, sf_dir))
    return missing_lags(out, FEATURE_COLUMNS).select("city")


# --- F2: supported-entity guard ---------------------------------------------------
@query("supported_entities", f"""
WITH {obs_cte('user')},
ok AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS city FROM customer WHERE c_mktsegment = 'BUILDING'),
t AS (SELECT o.city, CASE WHEN o.city IN (SELECT city FROM ok) THEN 'accepted' ELSE 'refused' END AS status FROM obs o)
SELECT status, count(*) AS n_rows, count(DISTINCT city) AS n_keys FROM t GROUP BY status
""")
def q_supported_entities(spark, sf_dir):
    prepare(spark)
    obs = events_observations(spark, sf_dir, "user")
    ok = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").cast("string").alias("city"))
    acc, ref = so.split_supported(obs, ok)
    t = acc.select("city", F.lit("accepted").alias("status")).unionByName(
        ref.select("city", F.lit("refused").alias("status")))
    return t.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("city").alias("n_keys"))


# --- J6: point-in-time join with TTL -------------------------------------------------
PIT_TTL_DAYS = 2


@query("pit_join", f"""
WITH f0 AS (SELECT CAST(user_id AS VARCHAR) AS city, ts AS event_timestamp, ts AS created_timestamp, value
            FROM events WHERE event_type = 'view'
            UNION ALL
            SELECT CAST(user_id AS VARCHAR), ts, ts + INTERVAL 1 HOUR, value + 1
            FROM events WHERE event_type = 'view' AND value > 100),
f AS (SELECT * FROM f0 QUALIFY row_number() OVER (PARTITION BY city, event_timestamp ORDER BY created_timestamp DESC) = 1),
e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS city, ts AS timestamp FROM events
      WHERE event_type = 'purchase' OR (event_type = 'view' AND value < 5))
SELECT e.event_id, e.city, e.timestamp,
       CASE WHEN e.timestamp - f.event_timestamp <= INTERVAL {PIT_TTL_DAYS} DAY THEN f.event_timestamp END AS event_timestamp,
       CASE WHEN e.timestamp - f.event_timestamp <= INTERVAL {PIT_TTL_DAYS} DAY THEN f.value END AS value
FROM e ASOF LEFT JOIN f ON e.city = f.city AND e.timestamp >= f.event_timestamp
""")
def q_pit_join(spark, sf_dir):
    prepare(spark)
    ev = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    ts = F.col("ts").cast("timestamp")
    views = ev.where(F.col("event_type") == "view")
    feats = views.select(user.alias("city"), ts.alias("event_timestamp"), ts.alias("created_timestamp"), "value") \
        .unionByName(views.where(F.col("value") > 100).select(
            user.alias("city"), ts.alias("event_timestamp"),
            (ts + F.expr("INTERVAL 1 HOUR")).alias("created_timestamp"), (F.col("value") + 1).alias("value")))
    ents = ev.where((F.col("event_type") == "purchase") | ((F.col("event_type") == "view") & (F.col("value") < 5))) \
        .select("event_id", user.alias("city"), ts.alias("timestamp"))
    out = asof_join(ents, feats, values=["value"], ttl_seconds=PIT_TTL_DAYS * 86400.0)
    return finish(out.select("event_id", "city", "timestamp", "event_timestamp", "value"))


# --- C2: collect landed payloads -> guard -> ingest statuses ----------------------
@query("collect_payloads", f"""
WITH {sc.SQL},
ok AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS city FROM customer WHERE c_mktsegment <> 'MACHINERY'),
acc AS (SELECT * FROM batch WHERE city IS NULL OR city IN (SELECT city FROM ok)),
st AS (SELECT city, count(*) AS n_stored, max(event_timestamp) AS last_ts FROM stored GROUP BY city),
b1 AS (SELECT b.*, st.n_stored, st.last_ts,
              EXISTS (SELECT 1 FROM stored s WHERE s.city = b.city AND s.event_timestamp = b.event_timestamp) AS in_store,
              row_number() OVER (PARTITION BY b.city, b.event_timestamp, {sc.INVALID.replace('city', 'b.city')}) AS twin
       FROM acc b LEFT JOIN st ON b.city = st.city),
b2 AS (SELECT *, CASE WHEN {sc.INVALID} THEN 'invalid' WHEN in_store THEN 'duplicate' WHEN coalesce(n_stored, 0) < 3 THEN 'no_history'
                      WHEN event_timestamp <= last_ts THEN 'late' WHEN twin > 1 THEN 'duplicate'
                      ELSE 'inserted' END AS status FROM b1),
hist AS (SELECT city, event_timestamp, aqi FROM stored
         QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_timestamp DESC) <= 3),
seqd AS (SELECT city, event_timestamp, aqi, false AS is_new FROM hist
         UNION ALL SELECT city, event_timestamp, aqi, true FROM b2 WHERE status = 'inserted'),
lg AS (SELECT city, event_timestamp, is_new, lag(aqi, 1) OVER w AS aqi_lag1, lag(aqi, 2) OVER w AS aqi_lag2,
              lag(aqi, 3) OVER w AS aqi_lag3,
              (lag(aqi, 3) OVER w + lag(aqi, 2) OVER w + lag(aqi, 1) OVER w) / 3 AS aqi_rolling_mean
       FROM seqd WINDOW w AS (PARTITION BY city ORDER BY event_timestamp))
SELECT b2.city, b2.event_timestamp, b2.aqi, lg.aqi_lag1, lg.aqi_lag2, lg.aqi_lag3,
       round(lg.aqi_rolling_mean, 6) AS aqi_rolling_mean, b2.status
FROM b2 LEFT JOIN lg ON lg.is_new AND b2.status = 'inserted' AND lg.city = b2.city
                    AND lg.event_timestamp = b2.event_timestamp
UNION ALL
SELECT city, event_timestamp, aqi, NULL, NULL, NULL, NULL, 'unsupported' FROM batch
WHERE city NOT IN (SELECT city FROM ok)
UNION ALL
SELECT city, event_timestamp, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN city IN (SELECT city FROM ok) THEN 'invalid' ELSE 'unsupported' END
FROM batch WHERE city IS NOT NULL AND seq % 11 = 0
""")
def q_collect_payloads(spark, sf_dir):
    from aerocast.plans.collect import collect
    prepare(spark)
    path = scratch_path(spark, "collect-payloads")
    _land(sc.batch(spark, sf_dir), path)
    status = collect(spark, path, sc.stored(spark, sf_dir), _supported(spark, sf_dir), multi_line=False)
    return finish(status.select(*_COLLECTED), ["aqi_rolling_mean"])


_COLLECTED = ["city", "event_timestamp", "aqi", "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_rolling_mean", "status"]


def _supported(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY").select(F.col("c_custkey").cast("string").alias("city"))


def _land(b, path, broken=None):
    """The rows of ``b`` as payloads, some once more without components; and lines that are cut short."""
    comp = F.struct(
        F.col("carbon_monoxide").alias("co"), F.col("nitrogen_dioxide").alias("no2"), F.col("ozone").alias("o3"),
        F.col("sulphur_dioxide").alias("so2"), F.col("pm2_5").alias("pm2_5"), F.col("pm10").alias("pm10"))
    when = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    b.select(when, "city", F.struct(F.array(F.struct(comp.alias("components"))).alias("list")).alias("air_pollution")).write.mode("append").json(path)
    b.where("city IS NOT NULL AND seq % 11 = 0").select(when, "city").write.mode("append").json(path)
    if broken is not None:
        broken.select(F.concat(F.lit('{"city": "'), F.col("city"), F.lit('", "air_poll')).alias("value")).write.mode("append").text(path)


# --- C2, S2 as an incremental job: two runs, each reading only what landed since -----------
@query("collect_incremental", ORACLES["collect_payloads"].rstrip() + """
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'malformed' FROM batch WHERE city IS NOT NULL AND seq % 13 = 0
""")
def q_collect_incremental(spark, sf_dir):
    from aerocast.plans.collect import collect_stream
    prepare(spark)
    root = scratch_path(spark, "collect-incremental")
    landing, store, status = f"{root}/landing", f"{root}/store", f"{root}/status"
    seed = ft.hourly_feature_rows(sc.stored(spark, sf_dir).withColumnRenamed("event_timestamp", "timestamp"),
                                  include_targets=False, complete_only=False).withColumnRenamed("timestamp", "event_timestamp")
    ig.seed_store(seed.select("city", "event_timestamp", F.col("event_timestamp").alias("created_timestamp"), "aqi", *FEATURE_COLUMNS), store)
    parts = sc.batch_parts(spark, sf_dir)
    for names in (("fresh", "newcomers", "broken"), ("twins", "replay", "late")):
        for name in names:
            _land(parts[name], landing, parts[name].where("city IS NOT NULL AND seq % 13 = 0"))
        collect_stream(spark, landing, store, status, f"{root}/ckpt", _supported(spark, sf_dir), "2024-02-01 00:00:00", multi_line=False)
    return finish(spark.read.parquet(status).select(*_COLLECTED), ["aqi_rolling_mean"])
