"""PM2.5 -> US AQI, AQI band and hazard flag as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocast.contract import (
    AQI_CATEGORIES,
    AQI_CEILING,
    AQI_TOP_CATEGORY,
    HAZARD_THRESHOLD,
    PM25_AQI_BREAKPOINTS,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round1(x) -> Column:
    """Half-even rounding to one place."""
    return F.bround(_c(x), 1)


def pm25_to_aqi(pm25, strict: bool = False) -> Column:
    """Piecewise-linear AQI of a PM2.5 concentration, rounded half-even.

    The first segment whose upper end is >= the value is used (so values
    between two segments extrapolate the upper one); above the table the
    index is capped. Negative, NaN, infinite or NULL input gives NULL, or an
    error when ``strict``.
    """
    c = _c(pm25).cast("double")
    bad = c.isNull() | F.isnan(c) | (c < 0) | (c == F.lit(float("inf")))
    expr = None
    for low, high, a_low, a_high in PM25_AQI_BREAKPOINTS:
        value = round1(
            F.lit(float(a_high - a_low)) * (c - F.lit(float(low))) / F.lit(float(high - low))
            + F.lit(float(a_low))
        )
        expr = F.when(c <= F.lit(float(high)), value) if expr is None else expr.when(c <= F.lit(float(high)), value)
    expr = expr.otherwise(F.lit(AQI_CEILING))
    if strict:
        return F.when(bad, F.raise_error(F.lit("a PM2.5 concentration is absent, negative or not finite"))).otherwise(expr)
    return F.when(~bad, expr)


def aqi_category(aqi) -> Column:
    """Band label: each bound is inclusive; above the last one, the top band."""
    a = _c(aqi)
    expr = None
    for limit, label in AQI_CATEGORIES:
        expr = F.when(a <= limit, label) if expr is None else expr.when(a <= limit, label)
    return F.when(a.isNotNull(), expr.otherwise(F.lit(AQI_TOP_CATEGORY)))


def is_hazardous(aqi) -> Column:
    return _c(aqi) > F.lit(HAZARD_THRESHOLD)
