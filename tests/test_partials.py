"""Day partials, the incremental collect and corrected daily means."""

from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, RAW_FEATURES
from aerocast.operators import features as ft
from aerocast.operators import partials as pt
from aerocast.operators import status as stt
from aerocast.session import scratch_path
from aerocast.sources.observations import events_observations
from aerocast.streaming import ingest as ig
from aerocast.streaming.windows import run_daily_mean_table
from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def _store(spark, part=True):
    obs = events_observations(spark, SF_SMALL, "user").withColumnRenamed("timestamp", "event_timestamp")
    return obs.withColumn("event_date", F.to_date("event_timestamp"))


def test_partials_equal_the_history(spark):
    obs = _store(spark)
    hist = obs.withColumnRenamed("event_timestamp", "timestamp")
    days = pt.day_partials(obs)
    cols = ["city", "timestamp", "aqi", *RAW_FEATURES]
    assert _rows(pt.means(days).select(cols)) == _rows(ft.daily_mean(hist).select(cols))
    ready = ["city", "n_rows", "missing_rows", "usable_daily_rows", "ready"]
    assert _rows(pt.training_status(days).select(ready)) == _rows(stt.training_readiness(hist, ft.daily_features_from_obs(hist)).select(ready))
    status = ["city", "n_rows", "chronological", "latest_timestamp"]
    in_order = stt.history_status(hist.withColumn("seq", F.unix_micros("timestamp")))
    assert _rows(pt.status(days).select(status)) == _rows(in_order.select(status))
    # two parts of the same days add up
    odd, even = obs.where("seq % 2 = 1"), obs.where("seq % 2 = 0")
    both = pt.merged(pt.day_partials(odd).unionByName(pt.day_partials(even)))
    assert _rows(pt.means(both).select(cols)) == _rows(pt.means(days).select(cols))


def test_refresh_touches_only_its_days_and_repeats(spark):
    root, path = scratch_path(spark, "partials"), scratch_path(spark, "partials-store")
    obs = _store(spark)
    obs.write.partitionBy("event_date").parquet(path)
    held = spark.read.parquet(path)
    days = held.select("event_date").distinct()
    assert pt.refresh_days(spark, root, held, days) == days.count()
    want = _rows(pt.day_partials(obs).select("city", "event_date", "n_rows", "sum_aqi"))
    some = days.orderBy("event_date").limit(2)
    for _ in range(2):
        assert pt.refresh_days(spark, root, held, some) == 2
        assert _rows(spark.read.parquet(root).select("city", "event_date", "n_rows", "sum_aqi")) == want
    late = obs.where(F.col("event_date") == some.first()[0]).withColumn("aqi", F.col("aqi") + 1)
    late.write.mode("append").partitionBy("event_date").parquet(path)
    pt.refresh_days(spark, root, spark.read.parquet(path), late.select("event_date"))
    want = _rows(pt.day_partials(obs.unionByName(late)).select("city", "event_date", "n_rows", "sum_aqi"))
    assert _rows(spark.read.parquet(root).select("city", "event_date", "n_rows", "sum_aqi")) == want
    assert pt.refresh_days(spark, root, held, days.limit(0)) == 0


def test_collect_stream_reads_new_files_only(spark):
    import json

    from aerocast.plans.collect import collect_stream, history_after, readiness_after

    root = scratch_path(spark, "collect-stream")
    seed = spark.createDataFrame([("a", h) for h in (1, 2, 3)], "city string, h int").select(
        "city", F.timestamp_seconds(F.col("h") * 3600).alias("event_timestamp"), F.current_timestamp().alias("created_timestamp"),
        F.col("h").cast("double").alias("aqi"), *[F.lit(0.0).alias(c) for c in FEATURE_COLUMNS])
    ig.seed_store(seed, f"{root}/store", partials=f"{root}/partials")
    known = spark.createDataFrame([("a",), ("b",)], "city string")

    def land(name, city, hour, text=None):
        doc = {"timestamp": f"1970-01-01T{hour:02d}:00:00Z", "city": city,
               "air_pollution": {"list": [{"components": dict.fromkeys(("co", "no2", "o3", "so2", "pm2_5", "pm10"), 10.0)}]}}
        spark.createDataFrame([(text or json.dumps(doc),)], "value string").coalesce(1).write.text(f"{root}/landing/{name}")

    def run():
        collect_stream(spark, f"{root}/landing/*", f"{root}/store", f"{root}/status", f"{root}/ckpt", known, "2024-01-01 00:00:00",
                       served=f"{root}/served", partials=f"{root}/partials")
        return {(r.status, r.city): r.batch_id for r in spark.read.parquet(f"{root}/status").collect()}

    land("1", "a", 4)
    land("2", "mars", 4)
    assert run() == {("inserted", "a"): 0, ("unsupported", "mars"): 0}
    land("3", "b", 5)
    land("4", None, 0, text='{"city": "a", "air_poll')
    assert run() == {("inserted", "a"): 0, ("unsupported", "mars"): 0, ("no_history", "b"): 1, ("malformed", None): 1}
    st = spark.read.parquet(f"{root}/status")
    assert st.count() == 4 and st.where("status = 'malformed'").first().file is not None
    assert run() and spark.read.parquet(f"{root}/status").count() == 4  # nothing new: nothing read
    assert [(r.city, r.n_rows, r.chronological) for r in history_after(spark, f"{root}/partials").collect()] == [("a", 4, True)]
    assert readiness_after(spark, f"{root}/partials").first().missing_rows == 26


def test_daily_means_are_corrected_once_per_batch(spark):
    root = scratch_path(spark, "corrected")
    base = events_observations(spark, SF_SMALL, "user").select("city", "timestamp", "aqi", *RAW_FEATURES)
    parts = [base, base.where("aqi > 100").withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 3 DAY")),
             base.where("aqi < 20").withColumn("city", F.lit("new"))]
    seen = None
    for i, rows in enumerate(parts):
        rows.write.parquet(f"{root}/landing/part={i}")
        run_daily_mean_table(spark, f"{root}/landing/part=*", base.schema, f"{root}/out", f"{root}/ckpt")
        seen = rows if seen is None else seen.unionByName(rows)
        cols = ["city", "timestamp", "aqi", *RAW_FEATURES]
        assert _rows(spark.read.parquet(f"{root}/out").select(cols)) == _rows(ft.daily_mean(seen).select(cols))
