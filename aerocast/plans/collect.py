"""Hourly collect entry point over landed payload files (set form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import RAW_FEATURES
from aerocast.operators import features as ft
from aerocast.operators import partials as pt
from aerocast.operators import status as stt
from aerocast.operators.store import append_once, refresh_served
from aerocast.sources.files import CORRUPT, flatten_payloads, read_payloads, stream_payloads
from aerocast.streaming import ingest as ig


def collect(spark: SparkSession, landing: str, stored: DataFrame, supported: DataFrame,
            multi_line: bool = True) -> DataFrame:
    """One status row per payload landed in ``landing``; none vanishes.

    Flatten -> supported-key guard (``unsupported``) -> ingest statuses against
    ``stored`` (city, event_timestamp, aqi, ...); payloads without a key, time
    or component are ``invalid``. Arrival order is the file's event time.
    """
    obs = (flatten_payloads(read_payloads(spark, landing, multi_line)).withColumnRenamed("timestamp", ig.TS)
           .withColumn(ig.SEQ, F.unix_micros(ig.TS)))
    known = supported.select(ig.KEY).distinct().withColumn("_known", F.lit(True))
    marked = obs.join(known, ig.KEY, "left")
    foreign = F.col(ig.KEY).isNotNull() & F.col("_known").isNull()
    status = ig.ingest_batch(marked.where(~foreign).drop("_known"), ig.history_summary(stored), stored)
    refused = marked.where(foreign).select(ig.KEY, ig.TS, ig.SEQ, "aqi", *RAW_FEATURES, F.lit("unsupported").alias("status"))
    return status.unionByName(refused, allowMissingColumns=True)


def run_collect(spark: SparkSession, landing: str, store: str, served: str, supported: DataFrame, created_at,
                multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Collect into the store and refresh the served table.

    Returns (status rows, history status per key, training readiness per key),
    the latter two over the store after the run. A run over the same files
    again stores nothing.
    """
    status = collect(spark, landing, spark.read.parquet(store), supported, multi_line).checkpoint()
    new = ig.store_rows(status, created_at)
    append_once(spark, store, new)
    refresh_served(spark, served, new)
    held = spark.read.parquet(store).withColumnRenamed(ig.TS, "timestamp")
    ready = stt.training_readiness(held, ft.daily_features_from_obs(held))
    return status, status_after(spark.read.parquet(store)), ready


def collect_stream(spark: SparkSession, landing: str, store: str, status_out: str, checkpoint: str, supported: DataFrame,
                   created_at, *, served: str | None = None, partials: str | None = None, archive: str | None = None,
                   multi_line: bool = True, run: str | None = None, max_files_per_trigger: int | None = None):
    """The hourly collect as an incremental job: each run reads only the
    payload files that landed since the last one.

    One status row per payload: text that cannot be read as a payload is
    ``malformed``, a key outside ``supported`` ``unsupported``, the others get
    the ingest statuses; each row names its file. Keyed state, store, served
    table and day partials are advanced per micro-batch, so neither the
    landing folder nor the store is read again. ``history_after`` and
    ``readiness_after`` report from the partials.
    """
    obs = (flatten_payloads(stream_payloads(spark, landing, multi_line, archive, max_files_per_trigger))
           .withColumnRenamed("timestamp", ig.TS).withColumn(ig.SEQ, F.unix_micros(ig.TS)))
    known = supported.select(ig.KEY).where(F.col(ig.KEY).isNotNull()).distinct().withColumn("_known", F.lit(True))
    refused = (F.when(F.col(CORRUPT).isNotNull(), "malformed")
               .when(F.col(ig.KEY).isNotNull() & F.col("_known").isNull(), "unsupported"))
    marked = obs.join(known, ig.KEY, "left").withColumn("refused", refused)
    rows = marked.select("file", ig.KEY, ig.TS, ig.SEQ, "aqi", *RAW_FEATURES, "refused")
    return ig.ingest_rows(rows, store, status_out, checkpoint, created_at, served=served, run=run, partials=partials)


def history_after(spark: SparkSession, partials: str) -> DataFrame:
    """History status per key after a run, from the day partials."""
    return pt.status(spark.read.parquet(partials))


def readiness_after(spark: SparkSession, partials: str) -> DataFrame:
    """Training readiness per key after a run, from the day partials."""
    return pt.training_status(spark.read.parquet(partials))


def status_after(stored: DataFrame) -> DataFrame:
    """History status per key (count, chronological, latest)."""
    return stt.history_status(stored.withColumnRenamed(ig.TS, "timestamp")
                              .withColumn("seq", F.unix_micros("timestamp")))
