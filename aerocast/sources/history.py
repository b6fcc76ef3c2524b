"""Reads of the stored history: one key, and ordered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.contract import HISTORY_PAGE_SIZE, RAW_FEATURES


def city_history(store: DataFrame, city: str, ts: str = "event_timestamp") -> DataFrame:
    """``timestamp, aqi, <6 pollutants>`` of one key (filter and columns reach
    the scan; the order is applied by the consumer's window, not here)."""
    return store.where(F.col("city") == city).select(F.col(ts).alias("timestamp"), "aqi", *RAW_FEATURES)


def history_page(store: DataFrame, offset: int, size: int = HISTORY_PAGE_SIZE,
                 order=("city", "timestamp")) -> DataFrame:
    """One ordered page (a top-(offset+size) plan, not a full sort). The plan
    holds offset + size rows; ``page_after`` holds ``size`` however far it is."""
    if size < 1:
        raise ValueError("page size must be a positive integer")
    return store.orderBy(*order).offset(offset).limit(size)


def page_after(store: DataFrame, after: tuple | None, size: int = HISTORY_PAGE_SIZE,
               order=("city", "timestamp")) -> DataFrame:
    """The next ``size`` rows beyond the key ``after`` (None: the first page).
    The condition reaches the scan, so pages already read are skipped there."""
    if size < 1:
        raise ValueError("page size must be a positive integer")
    rows = store
    if after is not None:
        lead, last = order
        first, then = (F.lit(v) for v in after)
        rows = store.where((F.col(lead) >= first) & ((F.col(lead) > first) | (F.col(last) > then)))
    return rows.orderBy(*order).limit(size)
