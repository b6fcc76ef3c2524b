"""Store, ingest and streaming properties on the driver tables."""

from pyspark.sql import functions as F

from aerocast.operators import store as so
from aerocast.plans import scenario as sc
from aerocast.plans.catalog import QUERIES
from aerocast.session import scratch_path
from aerocast.streaming import ingest as ig

from conftest import SF_SMALL


def test_append_once_is_idempotent(spark):
    path = scratch_path(spark, "store")
    rows = sc.stored(spark, SF_SMALL).withColumn("created_timestamp", F.col("event_timestamp"))
    n1 = so.append_once(spark, path, rows)
    n2 = so.append_once(spark, path, rows)
    assert n1 == rows.count() and n2 == 0
    assert so.key_violations(spark.read.parquet(path)).count() == 0
    assert so.append_once(spark, path, rows.limit(0)) == 0


def test_ingest_statuses_all_hit(spark):
    st = sc.stored(spark, SF_SMALL)
    out = ig.ingest_batch(sc.batch(spark, SF_SMALL), ig.history_summary(st), st)
    got = {r.status for r in out.select("status").distinct().collect()}
    assert got == {"inserted", "duplicate", "late", "no_history", "invalid"}
    assert out.count() == sc.batch(spark, SF_SMALL).count()
    ins = out.where("status = 'inserted'")
    assert ins.where("aqi_lag1 IS NULL OR aqi_rolling_mean IS NULL").count() == 0


def test_stream_equals_batch(spark):
    a = QUERIES["stream_ingest"](spark, SF_SMALL)
    b = QUERIES["ingest_batch"](spark, SF_SMALL)
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_asof_join_chunked_equals_unchunked(spark):
    from aerocast.operators.joins import asof_join
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    feats = ev.where("event_type = 'view'").select(
        F.col("event_type").alias("city"), F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("ts").cast("timestamp").alias("created_timestamp"), "value")
    ents = ev.where("event_type <> 'view'").select("event_id", F.lit("view").alias("city"),
                                                   F.col("ts").cast("timestamp").alias("timestamp"))
    a = asof_join(ents, feats, values=["value"], ttl_seconds=3600.0, chunk_rows=3)
    b = asof_join(ents, feats, values=["value"], ttl_seconds=3600.0)
    assert a.count() == b.count() == ents.count()
    assert a.exceptAll(b).count() == 0
    assert a.where("value IS NOT NULL").count() > 0


def test_stream_served_table_and_rerun(spark):
    """Served table after the stream = latest stored row per key; the store
    holds each key once; a second run over the same files adds nothing."""
    from aerocast.contract import FEATURE_COLUMNS
    from aerocast.operators import features as ft

    root = scratch_path(spark, "stream-test")
    landing, store, status, served, ckpt = (f"{root}/{p}" for p in ("landing", "store", "status", "served", "ckpt"))
    stored = sc.stored(spark, SF_SMALL)
    seed = ft.hourly_feature_rows(stored.withColumnRenamed("event_timestamp", "timestamp"),
                                  include_targets=False, complete_only=False)
    seed = seed.withColumnRenamed("timestamp", "event_timestamp").select(
        "city", "event_timestamp", F.col("event_timestamp").alias("created_timestamp"), "aqi", *FEATURE_COLUMNS)
    ig.seed_store(seed, store, served)
    b = sc.batch(spark, SF_SMALL)
    b.write.parquet(f"{landing}/part=1")
    ig.run_ingest_stream(spark, f"{landing}/part=*", store, status, ckpt, b.schema,
                         created_at="2024-02-01 00:00:00", served=served)
    st = spark.read.parquet(store)
    assert so.key_violations(st).count() == 0
    n_inserted = spark.read.parquet(status).where("status = 'inserted'").count()
    assert st.count() == seed.count() + n_inserted
    assert spark.read.parquet(status).select("batch_id").distinct().count() == 1  # one scheduled run: one micro-batch
    last = so.read_served(spark, served).select("city", "event_timestamp")
    expect = so.latest_rows(st.drop("run", "batch_id", "event_date")).select("city", "event_timestamp")
    assert last.exceptAll(expect).count() == 0 and expect.exceptAll(last).count() == 0
    assert spark.read.parquet(status).count() == b.count()  # a status for every row
    n_store = st.count()
    # batch 0 run again under its own name reports the same statuses
    ig.run_ingest_stream(spark, f"{landing}/part=*", store, f"{root}/status2", f"{root}/ckpt2", b.schema,
                         created_at="2024-02-01 00:00:00", run=spark.read.parquet(status).first().run)
    s1, s2 = spark.read.parquet(status), spark.read.parquet(f"{root}/status2")
    assert s1.exceptAll(s2).count() == 0 and s2.exceptAll(s1).count() == 0
    # the same files through a new checkpoint are duplicates of what is stored
    ig.run_ingest_stream(spark, f"{landing}/part=*", store, f"{root}/status3", f"{root}/ckpt3", b.schema,
                         created_at="2024-02-03 00:00:00", served=served)
    s3 = spark.read.parquet(f"{root}/status3")
    assert s3.count() == b.count() and s3.where("status = 'inserted'").count() == 0
    end = spark.read.parquet(store)
    assert end.count() == n_store and so.key_violations(end).count() == 0
    again = so.read_served(spark, served).select("city", "event_timestamp")
    assert again.exceptAll(expect).count() == 0 and expect.exceptAll(again).count() == 0


def test_store_probe_prunes_partitions(spark):
    root = scratch_path(spark, "dpp")
    stored = sc.stored(spark, SF_SMALL)
    stored.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(root)
    st = spark.read.parquet(root)
    out = ig.batch_status(sc.batch(spark, SF_SMALL), ig.history_summary(stored), st)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def _stream_parts(spark, root, parts, **kw):
    """The parts landed one after the other, a run after each; the statuses."""
    for i, rows in enumerate(parts):
        rows.write.parquet(f"{root}/landing/part={i}")
        ig.run_ingest_stream(spark, f"{root}/landing/part=*", f"{root}/store", f"{root}/status", f"{root}/ckpt", rows.schema,
                             created_at="2024-02-01 00:00:00", served=f"{root}/served", **kw)
    return spark.read.parquet(f"{root}/status")


def _tiny(spark, rows):
    from aerocast.contract import RAW_FEATURES
    df = spark.createDataFrame(rows, "city string, hour int, seq long, aqi double")
    return df.select("city", (F.timestamp_seconds(F.col("hour") * 3600)).alias("event_timestamp"), "seq", "aqi", *[F.lit(1.0).alias(c) for c in RAW_FEATURES])


def _tiny_store(spark, root, rows):
    from aerocast.contract import FEATURE_COLUMNS
    df = _tiny(spark, rows)
    ig.seed_store(df.select("city", "event_timestamp", F.col("event_timestamp").alias("created_timestamp"), "aqi",
                            *[F.lit(0.0).alias(c) for c in FEATURE_COLUMNS]), f"{root}/store", f"{root}/served")


def test_state_carries_lags_across_restarts(spark):
    """Each run restarts from the checkpoint: lags, last time and history come from the state store."""
    root = scratch_path(spark, "stream-state")
    _tiny_store(spark, root, [("a", h, h, float(h)) for h in (1, 2, 3, 4)] + [("b", 1, 1, 1.0)])
    st = _stream_parts(spark, root, [
        _tiny(spark, [("a", 6, 1, 6.0), ("a", 5, 2, 5.0), ("b", 2, 3, 2.0), ("c", 1, 4, 1.0)]),
        _tiny(spark, [("a", 8, 5, 8.0), ("a", 8, 6, 80.0), ("a", 6, 7, 6.0), ("a", 7, 8, 7.0)]),
        _tiny(spark, [("a", 9, 9, 9.0), ("b", 3, 10, 3.0)])])
    got = {r.seq: (r.status, r.aqi_lag1, r.aqi_lag2, r.aqi_lag3) for r in st.collect()}
    none = (None, None, None)
    assert got == {2: ("inserted", 4.0, 3.0, 2.0), 1: ("inserted", 5.0, 4.0, 3.0), 3: ("no_history", *none), 4: ("no_history", *none),
                   8: ("inserted", 6.0, 5.0, 4.0), 5: ("inserted", 7.0, 6.0, 5.0), 6: ("duplicate", *none), 7: ("duplicate", *none),
                   9: ("inserted", 8.0, 7.0, 6.0), 10: ("no_history", *none)}
    served = {r.city: r.aqi for r in so.read_served(spark, f"{root}/served").collect()}
    assert served == {"a": 9.0, "b": 1.0}


def test_failed_batch_is_run_again(spark, monkeypatch):
    """A batch that fails after its store append reports the same statuses when it is run again."""
    import pytest
    from pyspark.errors import StreamingQueryException

    root = scratch_path(spark, "stream-fail")
    _tiny_store(spark, root, [("a", h, h, float(h)) for h in (1, 2, 3)])
    real = so.refresh_served

    def broken(*args, **kw):
        raise RuntimeError("lost after the append")

    monkeypatch.setattr(so, "refresh_served", broken)
    rows = _tiny(spark, [("a", 5, 1, 5.0), ("a", 4, 2, 4.0), ("a", 3, 3, 3.0)])
    with pytest.raises(StreamingQueryException):
        _stream_parts(spark, root, [rows])
    assert spark.read.parquet(f"{root}/store").count() == 5
    monkeypatch.setattr(so, "refresh_served", real)
    ig.run_ingest_stream(spark, f"{root}/landing/part=*", f"{root}/store", f"{root}/status", f"{root}/ckpt", rows.schema,
                         created_at="2024-02-01 00:00:00", served=f"{root}/served")
    got = {r.seq: (r.status, r.aqi_lag1) for r in spark.read.parquet(f"{root}/status").collect()}
    assert got == {1: ("inserted", 4.0), 2: ("inserted", 3.0), 3: ("duplicate", None)}
    end = spark.read.parquet(f"{root}/store")
    assert end.count() == 5 and so.key_violations(end).count() == 0
    assert [r.aqi for r in so.read_served(spark, f"{root}/served").collect()] == [5.0]


def test_state_is_fed_few_rows_of_a_hot_key(spark):
    import pandas as pd
    rows = pd.DataFrame({"city": ["hot"] * 9000 + ["b"], "n": 0, "us": [*range(3000)] * 3 + [7], "seq": range(9001), "aqi": 1.0})
    out = pd.concat(ig.newest_rows(iter([rows])))
    assert sorted(map(tuple, out[["city", "us", "seq"]].values.tolist())) == [("b", 7, 9000), ("hot", 2997, 2997), ("hot", 2998, 2998), ("hot", 2999, 2999)]


def test_state_is_kept_by_bucket_of_keys(spark):
    """The stateful step is called per bucket of keys, not per key; every key keeps its own lags."""
    root = scratch_path(spark, "stream-buckets")
    keys = {f"k{i}": 10.0 * i for i in range(400)}
    _tiny_store(spark, root, [(k, h, h, v + h) for k, v in keys.items() for h in (1, 2, 3)])
    rows = _tiny(spark, [(k, 4, 1, v) for k, v in keys.items()] + [("new", 4, 1, 1.0)])
    rows.write.parquet(f"{root}/landing/part=0")
    q = ig.run_ingest_stream(spark, f"{root}/landing/part=*", f"{root}/store", f"{root}/status", f"{root}/ckpt", rows.schema,
                             created_at="2024-02-01 00:00:00")
    held = max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in q.recentProgress)
    assert 0 < held <= 64
    got = {r.city: (r.status, r.aqi_lag1, r.aqi_lag2, r.aqi_lag3) for r in spark.read.parquet(f"{root}/status").collect()}
    assert got == {k: ("inserted", v + 3, v + 2, v + 1) for k, v in keys.items()} | {"new": ("no_history", None, None, None)}


def test_a_bucket_without_new_rows_or_without_history():
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def step(state, *rows):
        out = pd.concat(ig.advance_bucket((0,), iter([pd.DataFrame(rows, columns=["city", "n", "us", "seq", "aqi"])]), state))
        return {r.city: (r.n, r.k, r.t3, r.v3) for r in out.itertuples()}

    state = State()
    assert step(state, ("new", 0, 5, 1, 1.0)) == {"new": (0, 0, 0, 0.0)}
    assert step(state, *[("a", 3, us, 0, float(us)) for us in (2, 1, 3)]) == {"a": (3, 3, 3, 3.0)}
    assert step(state, ("a", 0, 5, 2, 9.0), ("a", 0, 5, 1, 5.0), ("a", 0, 2, 3, 2.0), ("new", 0, 6, 1, 1.0)) == {"a": (3, 3, 3, 3.0), "new": (0, 0, 0, 0.0)}
    assert state.get == (["a"] * 3, [3] * 3, [2, 3, 5], [2.0, 3.0, 5.0])


def test_refresh_served_changes_only_its_buckets(spark):
    import glob
    root = scratch_path(spark, "served")
    rows = sc.stored(spark, SF_SMALL).withColumn("created_timestamp", F.col("event_timestamp"))
    early = rows.where(F.col("event_timestamp") < F.lit("2024-01-15").cast("timestamp"))
    late = rows.where(F.col("event_timestamp") >= F.lit("2024-01-15").cast("timestamp"))
    assert so.read_served(spark, root) is None
    so.refresh_served(spark, root, early)
    files = set(glob.glob(f"{root.removeprefix('file:')}/*/*.parquet"))
    one = late.where(F.col("city") == late.agg(F.min("city")).first()[0])
    assert so.refresh_served(spark, root, one) == 1
    assert len(files - set(glob.glob(f"{root.removeprefix('file:')}/*/*.parquet"))) <= 1  # one bucket's file was swapped
    so.refresh_served(spark, root, late)
    for _ in range(2):  # run again: the same rows
        got = so.read_served(spark, root).select("city", "event_timestamp")
        want = so.latest_rows(rows).select("city", "event_timestamp")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        so.refresh_served(spark, root, late)
    assert so.refresh_served(spark, root, rows.limit(0)) == 0


def test_null_keys_are_never_stored(spark):
    path = scratch_path(spark, "store-nulls")
    rows = sc.stored(spark, SF_SMALL).limit(20).withColumn("created_timestamp", F.col("event_timestamp"))
    bad = rows.limit(5).withColumn("city", F.lit(None).cast("string"))
    for _ in range(2):
        so.append_once(spark, path, rows.unionByName(bad))
    assert spark.read.parquet(path).count() == 20


def test_collect_stores_once(spark):
    """Payloads of every kind get a status; a second run stores nothing."""
    from aerocast.plans.collect import run_collect
    from aerocast.contract import FEATURE_COLUMNS, RAW_FEATURES
    from aerocast.operators import features as ft

    root = scratch_path(spark, "collect")
    seed = ft.hourly_feature_rows(sc.stored(spark, SF_SMALL).withColumnRenamed("event_timestamp", "timestamp"),
                                  include_targets=False, complete_only=False).withColumnRenamed("timestamp", "event_timestamp")
    seed = seed.select("city", "event_timestamp", F.col("event_timestamp").alias("created_timestamp"), "aqi", *FEATURE_COLUMNS)
    so.append_once(spark, f"{root}/store", seed)
    b = sc.batch(spark, SF_SMALL)
    names = dict(zip(("pm10", "pm2_5", "co", "no2", "so2", "o3"), RAW_FEATURES))
    comp = F.struct(*[F.col(c).alias(n) for n, c in names.items()])
    when = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    b.select(when, "city", F.struct(F.array(F.struct(comp.alias("components"))).alias("list")).alias("air_pollution")).write.json(f"{root}/in")
    b.limit(3).select(when, "city").write.mode("append").json(f"{root}/in")
    keys = seed.select("city").distinct()
    status, history, ready = run_collect(spark, f"{root}/in", f"{root}/store", f"{root}/served", keys, "2024-02-01 00:00:00", multi_line=False)
    counts = {r.status: r["count"] for r in status.groupBy("status").count().collect()}
    assert sum(counts.values()) == b.count() + 3 and counts["invalid"] >= 3 and counts["unsupported"] > 0 and counts["inserted"] > 0
    n = spark.read.parquet(f"{root}/store").count()
    assert n == seed.count() + counts["inserted"]
    assert history.agg(F.sum("n_rows")).first()[0] == n and ready.count() == keys.count()
    served = so.read_served(spark, f"{root}/served")
    assert served.count() == status.where("status = 'inserted'").select("city").distinct().count()
    run_collect(spark, f"{root}/in", f"{root}/store", f"{root}/served", keys, "2024-02-02 00:00:00", multi_line=False)
    end = spark.read.parquet(f"{root}/store")
    assert end.count() == n and so.key_violations(end).count() == 0
