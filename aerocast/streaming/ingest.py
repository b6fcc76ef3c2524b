"""Live ingest as a set operation per micro-batch.

Status of each arriving row, tested in this order; every row gets one:

1. ``invalid``    - no key, no time, or an index or pollutant that is absent,
   not finite or negative; such a row is never stored and hides no other;
2. ``duplicate``  - its ``(key, ts)`` is already stored;
3. ``no_history`` - the key has fewer than 3 stored rows (fail closed);
4. ``late``       - not newer than the key's last stored time;
5. ``duplicate``  - an in-batch twin of an earlier-arriving row (by ``seq``;
   exact copies with equal ``seq`` keep one winner);
6. ``inserted``   - otherwise; its lags come from the key's last 3 stored rows
   followed by the batch's inserted rows in event-time order (each new row is
   history for the next).

Per key the rules need a small summary (stored rows, last time, last 3 rows)
instead of the history; only rows that could be stored (``ts <= last time``) are
checked against the store, over the batch's days. The streaming job keeps those
summaries in Spark's state store, one value per hash bucket of keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from aerocast.contract import FEATURE_COLUMNS, MIN_HISTORY_ROWS, RAW_FEATURES
from aerocast.functions import calendar_columns
from aerocast.operators.features import rolling_prev3
from aerocast.operators.layout import only_keys_of, store_writer
from aerocast.operators.ordered import last_n_per_key, shifted
from aerocast.session import path_exists, shared_root

KEY, TS, SEQ, DATE = "city", "event_timestamp", "seq", "event_date"
STATUS_COLUMNS = ["city", "event_timestamp", "seq", "aqi", *FEATURE_COLUMNS, "status"]


def is_invalid() -> Column:
    """Rows that the contract refuses whatever is stored."""
    bad = F.col(KEY).isNull() | F.col(TS).isNull()
    for c in ("aqi", *RAW_FEATURES):
        v = F.col(c).cast("double")
        bad = bad | v.isNull() | F.isnan(v) | (v < 0) | (v == float("inf"))
    return bad


def history_summary(stored: DataFrame, *, n_last: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Per key: stored row count, last event time, last ``n_last`` (ts, aqi)."""
    counts = stored.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_stored"), F.max(TS).alias("last_ts"))
    last = last_n_per_key(stored.select(KEY, TS, "aqi"), [KEY], TS, n_last)
    arr = last.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct(TS, "aqi"))).alias("last_rows"))
    return counts.join(arr, KEY, "left")


def batch_status(batch: DataFrame, summary: DataFrame, stored: DataFrame) -> DataFrame:
    """Batch rows with their key's summary and ``status`` (rules 1-6).

    Only rows not newer than their key's last time probe ``stored``; when
    the store has ``event_date``, the date joins too, so dynamic partition
    pruning reads only the candidates' days.
    """
    s = summary.select(KEY, "n_stored", "last_ts", "last_rows")
    # ties between copies with equal seq: the least index, then a row id taken at the scan
    b = batch.select(KEY, TS, SEQ, "aqi", *RAW_FEATURES).withColumn("_rid", F.monotonically_increasing_id()) \
        .withColumn("_bad", is_invalid()).join(s, KEY, "left")
    cand = b.where(~F.col("_bad") & (F.col(TS) <= F.col("last_ts"))).select(KEY, TS).distinct()
    if DATE in stored.columns:
        # the date in the join key lets dynamic partition pruning read only
        # the store partitions of the candidates' days
        cand = cand.withColumn(DATE, F.to_date(TS))
        probe = [KEY, TS, DATE]
    else:
        probe = [KEY, TS]
    hit = cand.join(stored.select(*probe), probe, "left_semi").select(KEY, TS).withColumn("_stored", F.lit(True))
    firsts = b.where(~F.col("_bad")).groupBy(KEY, TS).agg(F.min(F.struct(SEQ, "aqi", "_rid")).alias("_first"))
    b = b.join(hit, [KEY, TS], "left").join(firsts, [KEY, TS], "left")
    status = (
        F.when(F.col("_bad"), "invalid")
        .when(F.col("_stored"), "duplicate")
        .when(F.coalesce(F.col("n_stored"), F.lit(0)) < MIN_HISTORY_ROWS, "no_history")
        .when(F.col(TS) <= F.col("last_ts"), "late")
        .when(F.struct(SEQ, "aqi", "_rid") != F.col("_first"), "duplicate")
        .otherwise("inserted")
    )
    return b.withColumn("status", status)


def ingest_batch(batch: DataFrame, summary: DataFrame, stored: DataFrame,
                 chunk_rows: int | None = None, summary_is_table: bool = False) -> DataFrame:
    """Status rows for ``batch`` (key, event_timestamp, seq, aqi, pollutants).

    Output: ``STATUS_COLUMNS``; features are NULL unless inserted.

    The summary (one row per key) and the status-annotated batch are each
    used by several branches of the plan; both are checkpointed to the
    shared checkpoint folder (two small eager jobs), so the sources are read
    once and the arrival tie-break ids are fixed once.
    """
    shared_root(batch.sparkSession)
    s = summary.select(KEY, "n_stored", "last_ts", "last_rows")
    if not summary_is_table:          # a written table needs no second copy
        s = s.checkpoint()
    b = batch_status(batch, s, stored).checkpoint()
    ins = b.where(F.col("status") == "inserted")

    prior = s.select(KEY, F.explode("last_rows").alias("_r")).select(
        KEY, F.col(f"_r.{TS}").alias(TS), F.col("_r.aqi").alias("aqi"), F.lit(False).alias("_new"))
    seqd = prior.unionByName(ins.select(KEY, TS, "aqi", F.lit(True).alias("_new")))
    lagged = shifted(seqd, [KEY], TS, ["aqi"], max_lag=3, chunk_rows=chunk_rows).where("_new").select(
        KEY, TS,
        F.col("aqi__lag1").alias("aqi_lag1"), F.col("aqi__lag2").alias("aqi_lag2"),
        F.col("aqi__lag3").alias("aqi_lag3"),
        rolling_prev3("aqi__lag1", "aqi__lag2", "aqi__lag3").alias("aqi_rolling_mean"))
    done = ins.join(lagged, [KEY, TS], "left")
    rest = b.where(F.col("status") != "inserted")
    out = done.unionByName(rest, allowMissingColumns=True)
    return out.select(KEY, TS, SEQ, "aqi", *RAW_FEATURES, *calendar_columns(TS),
                      "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_rolling_mean", "status")


def store_rows(status_rows: DataFrame, created_at) -> DataFrame:
    """The 18-column store rows of the inserted part."""
    return status_rows.where(F.col("status") == "inserted").select(
        KEY, TS, F.lit(created_at).cast("timestamp").alias("created_timestamp"), "aqi", *FEATURE_COLUMNS)


_TIMES, _VALUES = ("t1", "t2", "t3"), ("v1", "v2", "v3")  # oldest to newest, the last ``k`` of them count
SUMMARY = "n long, k int, " + ", ".join([*(f"{t} long" for t in _TIMES), *(f"{v} double" for v in _VALUES)])
HELD = [KEY, "n", "us", "aqi"]
STATE = f"{KEY} array<string>, n array<long>, us array<long>, aqi array<double>"
FED = f"{KEY} string, n long, us long, seq long, aqi double"
BUCKET = "bucket"
BUCKET_KEYS, LEAST_BUCKETS = 128, 64  # keys of a state bucket, on average; buckets of a run


def newest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The newest rows of each key in an Arrow batch, one per time (least seq,
    then least index): all that a key's state can need of it."""
    for rows in batches:
        best = rows.sort_values([KEY, "us", "seq", "aqi"]).drop_duplicates([KEY, "us"])
        yield best.groupby(KEY, sort=False).tail(MIN_HISTORY_ROWS)


def advance_bucket(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The summaries before the batch of a bucket's keys in it; the state moves
    on past the rows that the rules insert. Rows with ``n`` seed a key that has
    no state yet. The state holds up to three rows of each key with history,
    oldest first; a key without history inserts nothing and needs none."""
    rows = pd.concat(list(batches))
    held = pd.DataFrame(dict(zip(HELD, state.get)), columns=HELD) if state.exists else rows.iloc[:0][HELD]
    held = held.astype({"n": "int64", "us": "int64", "aqi": "float64"})
    seed = rows[(rows["n"] > 0) & ~rows[KEY].isin(held[KEY])].sort_values([KEY, "us"])
    if len(seed):
        seed = seed[HELD].assign(n=seed.groupby(KEY)["n"].transform("max"))
        held = pd.concat([held, seed]) if len(held) else seed
    yield _summaries(pd.Index(rows[KEY].unique()), held)
    ready = held[held["n"] >= MIN_HISTORY_ROWS].groupby(KEY).agg(n=("n", "max"), last=("us", "last")).reset_index()  # fail closed
    new = rows[rows["n"] == 0].drop(columns="n").merge(ready, on=KEY)
    new = new[new["us"] > new["last"]].sort_values([KEY, "us", "seq", "aqi"]).drop_duplicates([KEY, "us"])
    if len(new):
        held = pd.concat([held, new[HELD]]).groupby(KEY, sort=False).tail(MIN_HISTORY_ROWS)
    if len(seed) or len(new):
        state.update(tuple(held[c].tolist() for c in HELD))


def _summaries(keys: pd.Index, held: pd.DataFrame) -> pd.DataFrame:
    """One row of SUMMARY for each of ``keys``; ``held`` has a key's rows oldest first."""
    mine = held[held[KEY].isin(keys)]
    at, place = keys.get_indexer(mine[KEY]), 2 - mine.groupby(KEY).cumcount(ascending=False).to_numpy()
    n, times, values = np.zeros(len(keys), "int64"), np.zeros((len(keys), 3), "int64"), np.zeros((len(keys), 3))
    n[at], times[at, place], values[at, place] = mine["n"], mine["us"], mine["aqi"]
    return pd.DataFrame({KEY: keys, "n": n, "k": np.bincount(at, minlength=len(keys)).astype("int32"),
                         **{c: times[:, i] for i, c in enumerate(_TIMES)}, **{c: values[:, i] for i, c in enumerate(_VALUES)}})


def keyed_summaries(rows: DataFrame, seeds: DataFrame, buckets: int) -> DataFrame:
    """Per key of the micro-batch, its summary before it, from the state store.

    ``rows`` and ``seeds`` are streams. A key's rows are cut to three per Arrow
    batch before they are shuffled, so a hot key stays small. The state store
    holds ``buckets`` values, each for the keys of a hash bucket: a call of the
    stateful function costs the same few milliseconds for one key as for a
    hundred. A checkpoint keeps one number of buckets."""
    fed = (rows.where(~is_invalid())
           .select(KEY, F.lit(0).cast("long").alias("n"), F.unix_micros(TS).alias("us"), F.col(SEQ).cast("long").alias("seq"),
                   F.col("aqi").cast("double").alias("aqi")).mapInPandas(newest_rows, FED))
    return (fed.unionByName(seeds).withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(buckets))).groupBy(BUCKET)
            .applyInPandasWithState(advance_bucket, f"{KEY} string, {SUMMARY}", STATE, "append", "NoTimeout")
            .select(KEY, F.col("n").alias("n_stored"), F.when(F.col("k") > 0, F.timestamp_micros("t3")).alias("last_ts"),
                    F.slice(F.array(*[F.struct(F.timestamp_micros(t).alias(TS), F.col(v).alias("aqi")) for t, v in zip(_TIMES, _VALUES)]),
                            4 - F.col("k"), F.col("k")).alias("last_rows")))


def seed_rows(stored: DataFrame) -> DataFrame:
    """What the state of a new run starts from: up to three rows per key, with its row count."""
    s = history_summary(stored)
    return s.select(KEY, F.col("n_stored").alias("n"), F.explode("last_rows").alias("r")).select(
        KEY, "n", F.unix_micros(f"r.{TS}").alias("us"), F.lit(0).cast("long").alias("seq"), F.col("r.aqi").cast("double").alias("aqi"))


def append_new(spark: SparkSession, store: str, rows: DataFrame) -> None:
    """Append the rows whose (key, ts) the store doesn't hold; the probe reads
    only the days of ``rows`` and, of those, the row groups of their keys."""
    probe = [KEY, TS, DATE]
    rows = rows.withColumn(DATE, F.to_date(TS))
    held = rows.select(*probe).join(only_keys_of(spark.read.parquet(store), rows, KEY).select(*probe), probe, "left_semi")
    store_writer(rows.join(held, probe, "left_anti"), key=KEY, ts=TS, day=DATE).mode("append").parquet(store)


def run_ingest_stream(spark: SparkSession, landing: str, store: str, status_out: str, checkpoint: str,
                      schema: T.StructType, created_at, max_files_per_trigger: int | None = None,
                      served: str | None = None, run: str | None = None, partials: str | None = None):
    """Structured Streaming job over landed observation files; see ``ingest_rows``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return ingest_rows(reader.parquet(landing), store, status_out, checkpoint, created_at, served=served, run=run, partials=partials)


def ingest_rows(rows: DataFrame, store: str, status_out: str, checkpoint: str, created_at, *,
                served: str | None = None, run: str | None = None, partials: str | None = None):
    """Structured Streaming job: a stream of observations -> statuses, store,
    served table, day partials.

    Rows whose ``refused`` (where there is such a column) is not null get it
    as their status and touch nothing else.

    A run is named by its checkpoint (or ``run``). Each key's summary lives in
    the state store under the checkpoint; a new checkpoint is seeded once from
    the rows that other runs stored, and their number fixes its state buckets. A batch that is run again after a failure
    starts from the state before it and from all rows that other batches and
    runs stored, so it gives the same statuses; files that reach the job again
    through a new checkpoint are ``duplicate``. Store appends skip every (key,
    ts) the store holds, whoever wrote it. The store is partitioned by event
    day; status by run and batch; the served table by key bucket. One run
    writes a store at a time: a run that another one followed has stale state.

    Runs as ``availableNow``: everything landed since the last run is one
    micro-batch by default (a scheduled run, as the hourly collector), or
    ``maxFilesPerTrigger`` files of the source per batch. Files carry no time
    order, so a row that reaches a key after a newer row of it was stored is
    ``late``.
    """
    from aerocast.operators.partials import refresh_days
    from aerocast.operators.store import refresh_served

    spark = rows.sparkSession
    if "refused" not in rows.columns:
        rows = rows.withColumn("refused", F.lit(None).cast("string"))
    run = run or hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    seeds, layout = f"{checkpoint.rstrip('/')}-seed", f"{checkpoint.rstrip('/')}-buckets"
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        others = spark.read.parquet(store).where(F.col("run") != run)
        seed_rows(others).write.mode("overwrite").parquet(seeds)
        many = spark.read.parquet(seeds).count() // (BUCKET_KEYS * MIN_HISTORY_ROWS)
        spark.range(1).select(F.lit(max(LEAST_BUCKETS, many)).alias("buckets")).write.mode("overwrite").parquet(layout)
    buckets = spark.read.parquet(layout).first()["buckets"]
    shared_root(spark)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        own = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        both = df.checkpoint()  # the stateful plan runs once per batch
        landed = both.where("row is not null").select("row.*")
        refused = landed.where("refused is not null").withColumnRenamed("refused", "status")
        summary = both.where("state is not null").select("state.*")
        st = ingest_batch(landed.where("refused is null"), summary, spark.read.parquet(store).where(~own), summary_is_table=True)
        st = st.unionByName(refused, allowMissingColumns=True).withColumns(
            {"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")}).persist()
        new = store_rows(st, created_at)
        append_new(spark, store, new.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")}))
        (st.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", "batch_id").parquet(status_out))
        if served is not None:
            refresh_served(spark, served, new)
        if partials is not None:
            refresh_days(spark, partials, spark.read.parquet(store), new.select(F.to_date(TS).alias(DATE)))
        st.unpersist()

    states = keyed_summaries(rows.where("refused is null"), spark.readStream.schema(FED).parquet(seeds), buckets)
    as_row, as_state = F.struct(*rows.columns).alias("row"), F.struct(*states.columns).alias("state")
    both = rows.select(as_row).unionByName(states.select(as_state), allowMissingColumns=True)
    q = (both.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def seed_store(stored: DataFrame, store: str, served: str | None = None, partials: str | None = None) -> None:
    """Write the initial store, its served table and its day partials."""
    from aerocast.operators.partials import day_partials
    from aerocast.operators.store import refresh_served

    spark = stored.sparkSession
    store_writer(stored.withColumns({"run": F.lit("seed"), "batch_id": F.lit(-1).cast("long"), DATE: F.to_date(TS)}),
                 key=KEY, ts=TS, day=DATE).mode("overwrite").parquet(store)
    if served is not None:
        refresh_served(spark, served, spark.read.parquet(store).drop("run", "batch_id", DATE))
    if partials is not None:
        day_partials(spark.read.parquet(store)).write.mode("overwrite").partitionBy(DATE).parquet(partials)
