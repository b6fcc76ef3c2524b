"""aerocast: a Spark-native engine for sensor time series, with air quality as
its main case.

Everything is expressed as DataFrame / SQL / ML / Structured Streaming work:
observations are validated, turned into the US AQI, appended once per
``(key, timestamp)``, shaped into hourly and gap-aware daily feature rows,
served by key and by point in time, and fed to one random forest per horizon.
"""

from aerocast.contract import (  # noqa: F401
    FEATURE_COLUMNS,
    RAW_FEATURES,
    SCHEMA_VERSION,
    TARGET_COLUMNS,
    DataQualityError,
)

__all__ = [
    "FEATURE_COLUMNS",
    "RAW_FEATURES",
    "SCHEMA_VERSION",
    "TARGET_COLUMNS",
    "DataQualityError",
]
