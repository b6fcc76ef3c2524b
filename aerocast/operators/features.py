"""Feature rows: calendar fields, lags, rolling mean, lead targets.

Two contracts, kept apart on purpose:

* hourly (positional): lags and leads count rows, gaps are not seen;
* daily (calendar): one row per UTC day, and a lag, rolling mean or target
  that would touch a missing day makes the row incomplete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocast.contract import (
    FEATURE_COLUMNS,
    RAW_FEATURES,
    TARGET_COLUMNS,
    TRAIN_FRACTION_DEN,
    TRAIN_FRACTION_NUM,
)
from aerocast.functions import calendar_columns, floor_day
from aerocast.operators.ordered import latest_per_key, shifted
from aerocast.operators.quality import REASONS, stop_at


def rolling_prev3(l1, l2, l3):
    """Mean of the three previous values, NULL unless all three are present."""
    return (F.col(l3) + F.col(l2) + F.col(l1)) / 3


def hourly_feature_rows(obs: DataFrame, *, key: str = "city", ts: str = "timestamp",
                        include_targets: bool = True, complete_only: bool = True,
                        chunk_rows: int | None = None, guard: str | None = None, rows: int | None = None) -> DataFrame:
    """Positional features per key, ordered by ``ts`` (unique per key).

    Output: key, ts, aqi, the 14 features (contract order) and, if asked, the
    3 lead targets. ``complete_only`` drops rows with any missing value.
    ``guard`` names the arrival order: the job then stops at two rows of one
    key and time, or at a row that arrived before an older one. Both stand
    side by side in the window that makes the lags, so nothing more is read.
    """
    leads = len(TARGET_COLUMNS) if include_targets else 0
    base = obs.select(key, ts, "aqi", *RAW_FEATURES)
    carried = ["aqi"]
    if guard:
        base = obs.select(key, ts, "aqi", *RAW_FEATURES, F.col(ts).alias("__at"), F.col(guard).alias("__seq"))
        carried += ["__at", "__seq"]
    sh = shifted(base, [key], ts, carried, max_lag=3, max_lead=leads, chunk_rows=chunk_rows, rows=rows)
    if guard:
        sh = sh.where(stop_at(F.when(F.col("__at__lag1") == F.col("__at"), F.lit(REASONS["duplicate_timestamp"].format(n="some")))
                              .when(F.col("__seq__lag1") > F.col("__seq"), F.lit(REASONS["out_of_order"].format(n="some")))))
    cols = [
        F.col(key), F.col(ts), F.col("aqi"), *[F.col(c) for c in RAW_FEATURES],
        *calendar_columns(ts),
        F.col("aqi__lag1").alias("aqi_lag1"),
        F.col("aqi__lag2").alias("aqi_lag2"),
        F.col("aqi__lag3").alias("aqi_lag3"),
        rolling_prev3("aqi__lag1", "aqi__lag2", "aqi__lag3").alias("aqi_rolling_mean"),
    ]
    if include_targets:
        cols += [F.col(f"aqi__lead{h}").alias(t) for h, t in enumerate(TARGET_COLUMNS, 1)]
    out = sh.select(*cols)
    if complete_only:
        out = complete_rows(out, include_targets=include_targets)
    return out


def is_complete(*, include_targets: bool = True, extra: Sequence[str] = ("aqi",)) -> Column:
    """No feature (and target) is missing: neither NULL nor NaN."""
    ok = F.lit(True)
    for c in [*extra, *FEATURE_COLUMNS, *(TARGET_COLUMNS if include_targets else [])]:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def complete_rows(df: DataFrame, *, include_targets: bool = True, extra: Sequence[str] = ("aqi",)) -> DataFrame:
    """Drop rows with any missing feature (and target): NULL or NaN."""
    subset = [*extra, *FEATURE_COLUMNS] + (list(TARGET_COLUMNS) if include_targets else [])
    return df.na.drop(subset=subset)


def daily_mean(obs: DataFrame, *, key: str = "city", ts: str = "timestamp",
               include_open_day: bool = True, as_of=None) -> DataFrame:
    """One row per key and UTC day: mean of aqi and the six pollutants.

    A hash aggregate with map-side partial sums, so hot keys are reduced
    before the shuffle. By default the day still open counts as a full day
    (as the contract does); with ``include_open_day=False`` the days not yet
    closed at ``as_of`` (an instant; default: now) are left out.
    """
    if not include_open_day:
        cut = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        obs = obs.where(F.col(ts) < F.date_trunc("day", cut))
    return (
        obs.groupBy(F.col(key), floor_day(ts).alias(ts))
        .agg(*[F.avg(c).alias(c) for c in ["aqi", *RAW_FEATURES]])
    )


def gap_fill(daily: DataFrame, *, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """Every day between a key's first and last day; missing days are NULL.

    The calendar is generated per key from its (min, max) days, so its size
    is the key's span in days, not its row count.
    """
    span = daily.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    cal = span.select(
        key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(ts)
    )
    # a null key is a key like any other
    right = daily.withColumnsRenamed({key: "__key", ts: "__day"})
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(ts) == F.col("__day"))
    return cal.join(right, same, "left").select(*daily.columns)


def daily_feature_rows(daily: DataFrame, *, key: str = "city", ts: str = "timestamp",
                       include_targets: bool = True, complete_only: bool = True) -> DataFrame:
    """Calendar-aware features over the daily means (gaps need no fill).

    Lag k is the value on day d-k, lead k on day d+k, via range frames over
    the day number; a missing day gives NULL, so the row is dropped by the
    complete-case filter exactly as on a gap-filled calendar. The daily frame
    holds one row per key and day, so a per-key window is bounded by the
    number of days, not by the raw row count.
    """
    dn = "_day_no"
    d = daily.withColumn(dn, F.unix_date(F.to_date(ts)))
    w = Window.partitionBy(key).orderBy(dn)

    def at(offset: int):
        return F.max("aqi").over(w.rangeBetween(offset, offset))

    cols = [
        F.col(key), F.col(ts), F.col("aqi"), *[F.col(c) for c in RAW_FEATURES],
        *calendar_columns(ts, daily=True),
        at(-1).alias("aqi_lag1"), at(-2).alias("aqi_lag2"), at(-3).alias("aqi_lag3"),
    ]
    if include_targets:
        cols += [at(h).alias(t) for h, t in enumerate(TARGET_COLUMNS, 1)]
    out = d.select(*cols)
    out = out.select(
        *[c for c in out.columns if c not in ("aqi_lag1", "aqi_lag2", "aqi_lag3") and c not in TARGET_COLUMNS],
        "aqi_lag1", "aqi_lag2", "aqi_lag3",
        rolling_prev3("aqi_lag1", "aqi_lag2", "aqi_lag3").alias("aqi_rolling_mean"),
        *([c for c in TARGET_COLUMNS] if include_targets else []),
    )
    if complete_only:
        out = complete_rows(out, include_targets=include_targets)
    return out


def daily_features_from_obs(obs: DataFrame, *, key: str = "city", ts: str = "timestamp",
                            include_targets: bool = True) -> DataFrame:
    return daily_feature_rows(daily_mean(obs, key=key, ts=ts), key=key, ts=ts, include_targets=include_targets)


def latest_vector(features: DataFrame, *, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """The newest complete feature row of every key (a ranked window cut before the shuffle)."""
    return latest_per_key(features, [key], [ts])


def chrono_split(rows: DataFrame, *, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """Add ``is_train``: the first ``n*4 div 5`` rows of each key by time.

    Meant for the daily rows (bounded by days per key).
    """
    w = Window.partitionBy(key).orderBy(ts)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return rows.withColumn(
        "is_train", F.row_number().over(w) <= F.floor(n * TRAIN_FRACTION_NUM / TRAIN_FRACTION_DEN)
    )
