"""Day partials: one row per key and UTC day with counts, sums and time bounds.

Daily means, history status and training readiness need no more than these, so
they are kept beside the observation store and read instead of it. The table is
partitioned by day. When rows are stored, the days they fall on are computed
anew from the store's partitions of those days and swapped in, so a refresh
that is run again gives the same rows and late rows correct their day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerocast.contract import RAW_FEATURES
from aerocast.operators import features as ft
from aerocast.operators.status import readiness
from aerocast.session import path_exists

KEY, DATE = "city", "event_date"
VALUES = ["aqi", *RAW_FEATURES]


def day_partials(obs: DataFrame, *, key: str = KEY, ts: str = "event_timestamp") -> DataFrame:
    """(key, event_date, n_rows, first_ts, last_ts, sum and count of each value)."""
    return obs.groupBy(F.col(key), F.to_date(ts).alias(DATE)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        *[F.sum(c).alias(f"sum_{c}") for c in VALUES], *[F.count(c).alias(f"n_{c}") for c in VALUES])


def merged(partials: DataFrame, *, key: str = KEY) -> DataFrame:
    """Partials of several sources (or of several parts of a day) added up."""
    return partials.groupBy(key, DATE).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        *[F.sum(f"{kind}_{c}").alias(f"{kind}_{c}") for kind in ("sum", "n") for c in VALUES])


def refresh_days(spark: SparkSession, root: str, store: DataFrame, days: DataFrame) -> int:
    """Compute the partials of ``days`` anew from ``store`` (partitioned by
    ``event_date``); returns the number of days. Other days are not read."""
    wanted = sorted(r[0] for r in days.where(F.col(DATE).isNotNull()).select(DATE).distinct().collect())
    if not wanted:
        return 0
    there = path_exists(spark, f"{root.rstrip('/')}/_SUCCESS")
    (day_partials(store.where(F.col(DATE).isin(wanted))).repartition(DATE).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if there else "static").partitionBy(DATE).parquet(root))
    return len(wanted)


def means(partials: DataFrame, *, key: str = KEY, ts: str = "timestamp") -> DataFrame:
    """The daily means (A1)."""
    return partials.select(key, F.col(DATE).cast("timestamp").alias(ts),
                           *[(F.col(f"sum_{c}") / F.col(f"n_{c}")).alias(c) for c in VALUES])


def status(partials: DataFrame, *, key: str = KEY) -> DataFrame:
    """Per key: stored rows, whether the days follow one another in time, latest time (A2)."""
    days = Window.partitionBy(key).orderBy(DATE)
    return (partials.withColumn("_after", F.col("first_ts") >= F.lag("last_ts").over(days)).groupBy(key)
            .agg(F.sum("n_rows").alias("n_rows"), F.coalesce(F.bool_and("_after"), F.lit(True)).alias("chronological"),
                 F.max("last_ts").alias("latest_timestamp")))


def training_status(partials: DataFrame, *, key: str = KEY) -> DataFrame:
    """Readiness of each key for training (A3)."""
    usable = ft.daily_feature_rows(means(partials, key=key), key=key)
    return readiness(partials.groupBy(key).agg(F.sum("n_rows").alias("n_rows")),
                     usable.groupBy(key).agg(F.count(F.lit(1)).alias("usable_daily_rows")), key=key)
