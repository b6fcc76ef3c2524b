"""Column expressions (JVM-side, code-generated): no Python UDFs."""

from aerocast.functions.aqi import aqi_category, is_hazardous, pm25_to_aqi, round1  # noqa: F401
from aerocast.functions.timefn import (  # noqa: F401
    calendar_columns,
    floor_day,
    iso_date,
    to_utc_instant,
    to_utc_naive,
    version_stamp,
    weekday_monday0,
)
from aerocast.functions.values import json_field, nan_to_null, try_number, try_timestamp  # noqa: F401
