"""Event-time daily means on a stream: watermark + tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocast.contract import RAW_FEATURES
from aerocast.session import path_exists, shared_root

DAY = "event_date"


def daily_mean_stream(stream: DataFrame, *, key: str = "city", ts: str = "timestamp",
                      lateness: str = "1 hour") -> DataFrame:
    """Closed UTC days per key; a day is emitted once the watermark passes it.

    The watermark needs ``TimestampType`` (``timestamp_ntz`` is refused), so
    event times are cast first. ``n_rows`` is the number of rows a day was
    closed with; rows that come later are listed by ``late_after_close``.
    """
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return s.groupBy(F.col(key), F.window(ts, "1 day").alias("_w")).agg(
        *[F.avg(c).alias(c) for c in ["aqi", *RAW_FEATURES]], F.count(F.lit(1)).alias("n_rows")
    ).select(key, F.col("_w.start").alias(ts), "aqi", *RAW_FEATURES, "n_rows")


def run_daily_mean_stream(spark: SparkSession, landing: str, schema: T.StructType, out: str,
                          checkpoint: str, lateness: str = "1 hour") -> None:
    src = spark.readStream.schema(schema).parquet(landing)
    q = (daily_mean_stream(src, lateness=lateness).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_daily_mean_table(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str,
                         lateness: str = "40 days", key: str = "city", ts: str = "timestamp") -> None:
    """Stored daily means that late rows correct.

    Update mode: each micro-batch gives the days that it changed, with all
    their rows so far, and those replace the stored ones of the same key and
    day. Days stay open for ``lateness`` (the state holds that many days per
    key); what comes later still is listed by ``late_after_close``. The table
    is partitioned by day and only changed days are rewritten; a batch that is
    run again writes the same rows.
    """
    means = daily_mean_stream(spark.readStream.schema(schema).parquet(landing), key=key, ts=ts, lateness=lateness)
    shared_root(spark)

    def upsert(changed: DataFrame, batch_id: int) -> None:
        changed = changed.withColumn(DAY, F.to_date(ts)).checkpoint()  # the stateful plan runs once per batch
        days = sorted(r[0] for r in changed.select(DAY).distinct().collect())
        if not days:
            return
        there = path_exists(spark, f"{out.rstrip('/')}/_SUCCESS")
        if there:
            held = spark.read.parquet(out).where(F.col(DAY).isin(days)).select(*changed.columns)
            same = held[key].eqNullSafe(changed[key]) & (held[DAY] == changed[DAY])
            changed = held.join(changed, same, "left_anti").unionByName(changed)
        (changed.repartition(DAY).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic" if there else "static").partitionBy(DAY).parquet(out))

    q = (means.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def late_after_close(landed: DataFrame, closed: DataFrame, *, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """Per key and closed day with rows that came past the watermark: rows
    landed, rows in the emitted mean, and their difference. The stream drops
    such rows unseen; this lists them from the landed files, so a day can be
    computed anew."""
    day = F.date_trunc("day", F.col(ts).cast("timestamp"))
    seen = landed.groupBy(F.col(key), day.alias(ts)).agg(F.count(F.lit(1)).alias("n_landed"))
    return (seen.join(closed.select(key, F.col(ts).cast("timestamp").alias(ts), "n_rows"), [key, ts])
            .withColumn("n_late", F.col("n_landed") - F.col("n_rows")).where("n_late > 0"))
