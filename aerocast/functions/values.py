"""Coercion to missing, NaN handling and JSON field access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """NaN -> NULL (Spark keeps NaN apart from NULL; the contract does not)."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def try_number(x) -> Column:
    """Text or number -> double; unparseable, NULL or NaN -> NULL."""
    return nan_to_null(_c(x).try_cast("double"))


def try_timestamp(x) -> Column:
    return F.try_to_timestamp(_c(x).cast("string"))


def json_field(x, path: str) -> Column:
    """One field of a JSON text column as text (NULL when absent)."""
    return F.get_json_object(_c(x), path)
