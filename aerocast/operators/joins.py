"""Point-in-time (as-of) join with a TTL, without a per-key task.

For each entity row ``(key, t)`` take the newest feature row with
``event_ts <= t`` (equal event times: the latest created time wins), and only
when ``t - event_ts <= ttl``. Built as a union of both sides ordered by time,
carried forward with ``last(..., ignorenulls)`` inside ``(key, chunk)``
windows; each chunk's carry-in comes from a one-row-per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerocast.contract import FEATURE_TTL_DAYS
from aerocast.operators.ordered import CHUNK, latest_per_key, resolve_chunk_rows, with_chunks


def asof_join(entities: DataFrame, features: DataFrame, *, key: str = "city",
              entity_ts: str = "timestamp", feature_ts: str = "event_timestamp",
              created: str | None = "created_timestamp", values: Sequence[str] = (),
              ttl_seconds: float | None = FEATURE_TTL_DAYS * 86400.0,
              chunk_rows: int | None = None) -> DataFrame:
    """Entity rows plus ``feature_ts`` and ``values`` of the matched row.

    Unmatched rows (no earlier feature row, or older than the TTL) keep NULLs.
    """
    values = list(values)
    # bounds the union without running the ranked window below
    rows = entities.select(key).count() + features.select(key).count()
    feats = features.select(key, feature_ts, *([created] if created else []), *values)
    if created:
        feats = latest_per_key(feats, [key, feature_ts], [created])
    payload = F.struct(F.col(feature_ts).alias("_fts"), *[F.col(v) for v in values])
    ent_cols = entities.columns
    left = entities.select(
        F.col(key).alias("_k"), F.col(entity_ts).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*ent_cols).alias("_ent"), F.lit(None).alias("_feat"))
    right = feats.select(
        F.col(key).alias("_k"), F.col(feature_ts).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).alias("_ent"), payload.alias("_feat"))
    left = left.withColumn("_feat", F.lit(None).cast(right.schema["_feat"].dataType))
    right = right.withColumn("_ent", F.lit(None).cast(left.schema["_ent"].dataType))
    both = with_chunks(left.unionByName(right), ["_k"], "_t", chunk_rows, rows)
    if rows <= resolve_chunk_rows(entities, chunk_rows):
        return _matched(both, ent_cols, feature_ts, values, ttl_seconds)

    # carry-in: the newest feature row of all earlier chunks of the key
    per_chunk = both.groupBy("_k", CHUNK).agg(
        F.max_by(F.when(F.col("_side") == 0, F.col("_feat")), F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
    carry = per_chunk.select(
        "_k", CHUNK,
        F.last("_last", ignorenulls=True).over(
            Window.partitionBy("_k").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)).alias("_feat"),
    ).where(F.col("_feat").isNotNull())
    carry_rows = carry.select(
        "_k", F.col("_feat._fts").alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.schema["_ent"].dataType).alias("_ent"), "_feat", CHUNK)

    return _matched(both.unionByName(carry_rows), ent_cols, feature_ts, values, ttl_seconds)


def _matched(both: DataFrame, ent_cols: Sequence[str], feature_ts: str, values: Sequence[str],
             ttl_seconds: float | None) -> DataFrame:
    """Entity rows with the newest feature row before them in their chunk, if it is young enough."""
    w = (Window.partitionBy("_k", CHUNK).orderBy("_t", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = both.select(
        "_side", "_t", "_ent", F.last("_feat", ignorenulls=True).over(w).alias("_m"))
    out = filled.where(F.col("_side") == 1)
    ok = F.col("_m").isNotNull()
    if ttl_seconds is not None:
        age = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col("_m._fts").cast("timestamp"))
        ok = ok & (age <= F.lit(int(ttl_seconds * 1_000_000)))
    return out.select(
        *[F.col(f"_ent.{c}").alias(c) for c in ent_cols],
        F.when(ok, F.col("_m._fts")).alias(feature_ts),
        *[F.when(ok, F.col(f"_m.{v}")).alias(v) for v in values],
    )
