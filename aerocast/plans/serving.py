"""Serving rows: the live feature row of each key from its stored history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.contract import FEATURE_COLUMNS, MIN_HISTORY_ROWS, RAW_FEATURES
from aerocast.operators import features as ft
from aerocast.operators import quality as qc
from aerocast.operators.ordered import last_n_per_key


def serving_rows(history: DataFrame, live: DataFrame, *, key: str = "city", ts: str = "timestamp",
                 chunk_rows: int | None = None, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, refused) for live observations (one or more per key).

    Only the last 3 history rows of each key are read back (two-level top-n),
    unioned with the live rows, and lagged positionally. Refused: keys with
    fewer than 3 history rows (``insufficient_history``) or live rows not
    newer than the key's last history time (``not_newer``). History and live
    rows must pass the contract gate (one job each).
    """
    if validate:
        history = qc.require_valid(history, key=key, ts=ts)
        live = qc.require_valid(live, key=key, ts=ts)
    cols = [key, ts, "aqi", *RAW_FEATURES]
    stats = history.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_last"))
    lv = live.select(*cols).join(stats, key, "left")
    reason = (F.when(F.coalesce(F.col("_n"), F.lit(0)) < MIN_HISTORY_ROWS, "insufficient_history")
              .when(F.col(ts) <= F.col("_last"), "not_newer"))
    lv = lv.withColumn("_reason", reason)
    ok = lv.where(F.col("_reason").isNull()).select(*cols)
    refused = lv.where(F.col("_reason").isNotNull()).select(*cols, F.col("_reason").alias("reason"))
    tail = last_n_per_key(history.select(*cols), [key], ts, MIN_HISTORY_ROWS).drop("_rank")
    u = tail.withColumn("_live", F.lit(False)).unionByName(ok.withColumn("_live", F.lit(True)))
    feats = ft.hourly_feature_rows(u.withColumnRenamed("_live", "_lv"), key=key, ts=ts,
                                   include_targets=False, complete_only=False, chunk_rows=chunk_rows)
    live_keys = ok.select(key, ts)
    rows = feats.join(live_keys, [key, ts], "left_semi").select(key, ts, "aqi", *FEATURE_COLUMNS)
    return rows, refused
