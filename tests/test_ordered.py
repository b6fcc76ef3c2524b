"""The chunked positional windows equal the plain per-key window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerocast.operators.ordered import last_n_per_key, latest_per_key, shifted


def _frame(spark, n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in range(keys):
        t = 0
        for i in range(n if k else n // 20):
            # bursts and long pauses: many chunks are empty or hold 1-2 rows
            t += rnd.choice([1, 1, 2, 3, 50, 400])
            rows.append((f"k{k}", t, float(rnd.randint(0, 500)) / 10))
    return spark.createDataFrame(rows, "city string, t long, v double")


def test_shifted_equals_plain_window(spark):
    df = _frame(spark)
    w = Window.partitionBy("city").orderBy("t")
    plain = df.select(
        "city", "t", "v",
        *[F.lag("v", j).over(w).alias(f"v__lag{j}") for j in (1, 2, 3)],
        *[F.lead("v", j).over(w).alias(f"v__lead{j}") for j in (1, 2, 3)],
    )
    for chunk_rows in (1, 2, 5, 37, 10_000):
        got = shifted(df, ["city"], "t", ["v"], max_lag=3, max_lead=3, chunk_rows=chunk_rows)
        cols = plain.columns
        assert got.count() == plain.count()
        assert got.select(*cols).exceptAll(plain).count() == 0, chunk_rows
        assert plain.exceptAll(got.select(*cols)).count() == 0, chunk_rows


def test_last_n_and_latest(spark):
    df = _frame(spark)
    w = Window.partitionBy("city").orderBy(F.col("t").desc())
    plain = df.withColumn("_rank", F.row_number().over(w)).where("_rank <= 3")
    got = last_n_per_key(df, ["city"], "t", 3)
    assert got.select(plain.columns).exceptAll(plain).count() == 0
    assert got.count() == plain.count()
    top = latest_per_key(df, ["city"], ["t"])
    assert sorted(top.collect()) == sorted(plain.where("_rank = 1").drop("_rank").collect())


def test_burst_key_is_split(spark):
    """A key with one row a day for years and a burst of many rows within
    one minute: no chunk holds much more than the target."""
    from aerocast.operators.ordered import CHUNK, with_chunks
    day = 86_400_000_000
    sparse = [("hot", i * day) for i in range(3000)]
    burst = [("hot", 1500 * day + i * 60) for i in range(20_000)]
    df = spark.createDataFrame(sparse + burst, "city string, t long")
    sizes = [r["count"] for r in with_chunks(df, ["city"], "t", chunk_rows=500).groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 4 * 500, max(sizes)
    assert sum(sizes) == 23_000


def test_shifted_with_burst_equals_plain(spark):
    rows = [("k", i * 1000) for i in range(200)] + [("k", 100_000 + i) for i in range(300)] + \
           [("j", i) for i in range(7)]
    df = spark.createDataFrame([(k, t, float(t % 97)) for k, t in rows], "city string, t long, v double")
    w = Window.partitionBy("city").orderBy("t")
    plain = df.select("city", "t", "v", *[F.lag("v", j).over(w).alias(f"v__lag{j}") for j in (1, 2, 3)],
                      *[F.lead("v", j).over(w).alias(f"v__lead{j}") for j in (1, 2, 3)])
    got = shifted(df, ["city"], "t", ["v"], max_lag=3, max_lead=3, chunk_rows=3).select(*plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_shifted_property(spark):
    """Random keys, gaps and chunk sizes: equal to the plain window."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rows_strategy = st.lists(
        st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10_000), st.integers(0, 500)),
        min_size=1, max_size=120, unique_by=lambda r: (r[0], r[1]))

    @settings(max_examples=6, deadline=None)
    @given(rows_strategy, st.integers(1, 9), st.integers(0, 3), st.integers(0, 3))
    def check(rows, chunk_rows, lags, leads):
        df = spark.createDataFrame([(k, t, float(v)) for k, t, v in rows], "city string, t long, v double")
        w = Window.partitionBy("city").orderBy("t")
        plain = df.select("city", "t", "v",
                          *[F.lag("v", j).over(w).alias(f"v__lag{j}") for j in range(1, lags + 1)],
                          *[F.lead("v", j).over(w).alias(f"v__lead{j}") for j in range(1, leads + 1)])
        got = shifted(df, ["city"], "t", ["v"], max_lag=lags, max_lead=leads, chunk_rows=chunk_rows)
        got = got.select(*plain.columns)
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0

    check()


def test_asof_join_matches_pandas_merge_asof(spark):
    """Random entity and feature rows, tiny chunks: equal to pandas
    merge_asof (backward, per key) after keeping the latest created row per
    (key, event time), with the TTL applied."""
    import pandas as pd
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from aerocast.operators.joins import asof_join

    feats_s = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 300), st.integers(0, 2),
                                 st.integers(0, 99)), min_size=0, max_size=60,
                        unique_by=lambda r: (r[0], r[1], r[2]))
    ents_s = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 320)), min_size=1, max_size=40)

    @settings(max_examples=5, deadline=None)
    @given(feats_s, ents_s, st.integers(1, 7), st.integers(5, 200))
    def check(feats, ents, chunk_rows, ttl):
        base = pd.Timestamp("2026-01-01", tz="UTC")
        fp = pd.DataFrame(feats, columns=["city", "t", "c", "value"])
        fp["event_timestamp"] = base + pd.to_timedelta(fp["t"], unit="s")
        fp["created_timestamp"] = base + pd.to_timedelta(fp["t"] + fp["c"], unit="s")
        fp["value"] = fp["value"].astype(float)
        ep = pd.DataFrame([(i, k, t) for i, (k, t) in enumerate(ents)], columns=["eid", "city", "t"])
        ep["timestamp"] = base + pd.to_timedelta(ep["t"], unit="s")
        fschema = "city string, event_timestamp timestamp, created_timestamp timestamp, value double"
        fdf = spark.createDataFrame(fp[["city", "event_timestamp", "created_timestamp", "value"]], fschema) \
            if len(fp) else spark.createDataFrame([], fschema)
        edf = spark.createDataFrame(ep[["eid", "city", "timestamp"]], "eid long, city string, timestamp timestamp")
        got = asof_join(edf, fdf, values=["value"], ttl_seconds=float(ttl), chunk_rows=chunk_rows) \
            .select("eid", "value").toPandas().set_index("eid")["value"].sort_index()
        # brute force
        want = {}
        for _, e in ep.iterrows():
            cand = fp[(fp.city == e.city) & (fp.event_timestamp <= e.timestamp)]
            v = None
            if len(cand):
                last_t = cand.event_timestamp.max()
                top = cand[cand.event_timestamp == last_t].sort_values("created_timestamp").iloc[-1]
                if (e.timestamp - last_t).total_seconds() <= ttl:
                    v = top.value
            want[e.eid] = v
        for eid, v in want.items():
            g = got.loc[eid]
            assert (v is None and pd.isna(g)) or g == v, (eid, g, v)

    check()


def test_bursts_inside_segments_and_null_keys_are_cut(spark):
    """One NULL key, 40,000 rows in bursts of very different density."""
    from aerocast.operators.ordered import CHUNK, with_chunks

    df = spark.range(40_000).select(
        F.lit(None).cast("string").alias("city"),
        (F.floor(F.col("id") / 500) * 10_000_000 + F.col("id") % 500).cast("long").alias("t"))
    sizes = [r["count"] for r in with_chunks(df, ["city"], "t", chunk_rows=100).groupBy(CHUNK).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 400


def _chunk_sizes(spark, df, chunk_rows):
    from aerocast.operators.ordered import CHUNK, with_chunks
    return [r["count"] for r in with_chunks(df, ["city"], "t", chunk_rows=chunk_rows).groupBy("city", CHUNK).count().collect()]


def test_one_key_in_bursts_is_balanced(spark):
    """320,000 rows of one key: 64 bursts whose rows stand ever closer."""
    df = spark.range(320_000).select(
        F.lit("hot").alias("city"),
        (F.floor(F.col("id") / 5000) * 1_000_000_000_000 + (F.col("id") % 5000) * (F.floor(F.col("id") / 5000) + 1)).cast("long").alias("t"))
    sizes = _chunk_sizes(spark, df, 5000)
    assert sum(sizes) == 320_000 and len(sizes) > 40 and max(sizes) <= 2 * 5000


def test_a_million_small_keys_stay_whole(spark):
    """10^6 keys of two rows: only the keys at the parts' ends can be cut, and no part is deep."""
    df = spark.range(2_000_000).select((F.col("id") % 1_000_000).cast("string").alias("city"), F.col("id").alias("t"))
    from aerocast.operators.ordered import CHUNK, range_cuts, with_chunks
    cut = range_cuts(df, ["city"], "t", 20)
    assert cut.count() <= 19
    per = with_chunks(df, ["city"], "t", chunk_rows=100_000).groupBy("city").agg(F.countDistinct(CHUNK).alias("n"), F.count("*").alias("rows"))
    worst = per.agg(F.max("rows"), F.count(F.when(F.col("n") > 1, 1)), F.count("*")).first()
    assert worst[0] == 2 and worst[1] <= 19 and worst[2] == 1_000_000


def test_hot_key_and_small_keys_together(spark):
    """A third of the rows on one key: equal to the plain window, no chunk above twice the target."""
    hot = spark.range(20_000).select(F.lit("hot").alias("city"), (F.col("id") * F.col("id")).alias("t"), F.col("id").cast("double").alias("v"))
    rest = spark.range(40_000).select((F.col("id") % 7000).cast("string").alias("city"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    nulls = spark.range(900).select(F.lit(None).cast("string").alias("city"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    df = hot.unionByName(rest).unionByName(nulls)
    sizes = _chunk_sizes(spark, df, 1000)
    assert sum(sizes) == 60_900 and max(sizes) <= 2000
    w = Window.partitionBy("city").orderBy("t")
    plain = df.select("*", F.lag("v", 1).over(w).alias("v__lag1"), F.lag("v", 2).over(w).alias("v__lag2"), F.lead("v", 1).over(w).alias("v__lead1"))
    got = shifted(df, ["city"], "t", ["v"], max_lag=2, max_lead=1, chunk_rows=1000).select(*plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_binary_search_over_cuts(spark):
    from aerocast.operators.ordered import cuts_before
    cuts = [3, 7, 7_000, 7_001, 90_000]
    for most in (5, 8, 300):
        df = spark.createDataFrame([(x,) for x in (-1, 3, 4, 7, 8, 7001, 7002, 90_000, 90_001)], "x bigint").withColumn("c", F.array(*map(F.lit, cuts)).cast("array<bigint>"))
        got = {r.x: r.n for r in df.withColumn("n", cuts_before(F.col("c"), F.col("x"), most)).collect()}
        assert got == {x: sum(c < x for c in cuts) for x in got}
