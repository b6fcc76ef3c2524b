"""The observation store: append once per key, latest row per key, lookups.

Plain Parquet has no unique index and no MERGE, so the same guarantees come
from set operations: an anti join for idempotent appends, an aggregate for
the uniqueness check and a ranked window for the newest row per key. Rows with
a NULL in their key have no identity and are never stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, STORE_KEY
from aerocast.operators.layout import only_keys_of, store_writer
from aerocast.operators.ordered import latest_per_key, one_per_key
from aerocast.session import path_exists

SERVED_BUCKETS = 16  # of the served table; more where a bucket of keys outgrows a task
BUCKET = "bucket"


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the smallest ``order_cols``; NULL keys are left out."""
    return one_per_key(df.dropna(subset=list(keys)), keys, [F.col(c).asc() for c in order_cols])


def rows_to_insert(existing: DataFrame, batch: DataFrame, keys: Sequence[str] = STORE_KEY,
                   order_cols: Sequence[str] = ("created_timestamp",)) -> DataFrame:
    """Batch rows whose key is new: in-batch twins reduced to the first by
    ``order_cols``, then an anti join on the stored keys (only the key
    columns of the store are read)."""
    dedup = first_per_key(batch, keys, order_cols)
    return dedup.join(existing.select(*keys), list(keys), "left_anti")


def append_once(spark: SparkSession, store_path: str, batch: DataFrame,
                keys: Sequence[str] = STORE_KEY, ts: str = "event_timestamp",
                order_cols: Sequence[str] = ("created_timestamp",), partition_by: str = "event_date",
                within: tuple | None = None) -> int:
    """Conflict-safe append; returns rows inserted (0 for an empty batch).

    The store is read only over the batch's time range (partition and
    row-group pruning), so the anti join does not scan the whole history.
    ``within`` gives that range where it is known, so ``batch`` runs once.
    """
    lo, hi = within or batch.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        return 0
    if path_exists(spark, store_path):
        existing = spark.read.parquet(store_path).where(
            (F.col(partition_by) >= F.to_date(F.lit(lo))) & (F.col(partition_by) <= F.to_date(F.lit(hi)))
        ).where(F.col(ts).between(lo, hi))
        if within is None:  # the batch may be run for its keys
            existing = only_keys_of(existing, batch, keys[0])
        new = rows_to_insert(existing, batch, keys, order_cols)
    else:
        new = first_per_key(batch, keys, order_cols)
    new = new.withColumn(partition_by, F.to_date(ts)).cache()
    n = new.count()
    if n:
        store_writer(new, key=keys[0], ts=ts, day=partition_by).mode("append").parquet(store_path)
    new.unpersist()
    return n


def key_violations(df: DataFrame, keys: Sequence[str] = STORE_KEY) -> DataFrame:
    """Keys held by more than one row (the unique index as a check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def latest_rows(df: DataFrame, key: str = "city", ts: str = "event_timestamp",
                created: str = "created_timestamp") -> DataFrame:
    """Newest row per key; equal event times resolved by the created time."""
    return latest_per_key(df, [key], [ts, created])


def materialize(snapshot: DataFrame | None, new_rows: DataFrame, key: str = "city",
                ts: str = "event_timestamp", created: str = "created_timestamp") -> DataFrame:
    """Served table after an incremental refresh: latest of (snapshot ∪ new)."""
    fresh = latest_rows(new_rows, key, ts, created)
    if snapshot is None:
        return fresh
    return latest_rows(snapshot.unionByName(fresh), key, ts, created)


def online_lookup(entities: DataFrame, served: DataFrame, key: str = "city",
                  columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Served vector per entity row; unknown keys get NULLs. The served
    table holds one row per key: adaptive execution broadcasts it when its
    measured size is below the threshold, else a shuffle join is kept."""
    side = served.select(key, *columns)
    return entities.join(side, key, "left")


def split_supported(df: DataFrame, supported: DataFrame, key: str = "city") -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) rows by membership in the supported-key table."""
    keys = supported.select(key).distinct()
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def already_stored(batch: DataFrame, stored: DataFrame, keys: Sequence[str] = STORE_KEY) -> DataFrame:
    return batch.join(stored.select(*keys), list(keys), "left_semi")


def late_rows(batch: DataFrame, stored: DataFrame, key: str = "city", ts: str = "event_timestamp") -> DataFrame:
    """Rows not newer than their key's last stored time (with that time)."""
    last = stored.groupBy(key).agg(F.max(ts).alias("last_stored"))
    return batch.join(last, key).where(F.col(ts) <= F.col("last_stored"))


def served_bucket(key: str, buckets: int = SERVED_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_served(spark: SparkSession, root: str) -> DataFrame | None:
    """The served table (latest row per key); None if there is none yet."""
    return spark.read.parquet(root).drop(BUCKET) if path_exists(spark, f"{root.rstrip('/')}/_SUCCESS") else None


def refresh_served(spark: SparkSession, root: str, new_rows: DataFrame, key: str = "city",
                   ts: str = "event_timestamp", created: str = "created_timestamp", buckets: int = SERVED_BUCKETS) -> int:
    """Incremental refresh of the served table; returns the buckets rewritten.

    The table is partitioned by a hash bucket of the key. Only the buckets that
    hold a key of ``new_rows`` are read, merged (latest of the bucket and the
    new rows) and swapped by a dynamic partition overwrite; the others are not
    touched. A refresh that is run again gives the same rows. One table keeps
    one number of ``buckets``.
    """
    fresh = latest_rows(new_rows, key, ts, created).withColumn(BUCKET, served_bucket(key, buckets)).persist()  # read twice
    changed = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # ``buckets`` numbers at most
    if changed:
        out, there = fresh, read_served(spark, root) is not None
        if there:
            held = spark.read.parquet(root).where(F.col(BUCKET).isin(changed))
            out = materialize(held.select(*fresh.columns), fresh, key, ts, created)
        # a dynamic overwrite swaps the buckets when all of them are written, so they can be read meanwhile
        (out.repartition(BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic" if there else "static").partitionBy(BUCKET).parquet(root))
    fresh.unpersist()
    return len(changed)
