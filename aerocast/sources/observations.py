"""Observation adapters over the driver tables.

``events`` is the observation stream: ``event_type`` (5 dense keys) or
``user_id`` (many keys with gap days) plays the city, ``event_id`` the arrival
order, ``value`` the PM2.5 reading and ``props.k`` the PM10 reading. The other
pollutants are fixed, exact functions of the two (multiples by powers of two
and sums), so every engine gets the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.functions import pm25_to_aqi

OBSERVATION_COLUMNS = ["city", "timestamp", "seq", "pm10", "pm2_5", "carbon_monoxide",
                       "nitrogen_dioxide", "sulphur_dioxide", "ozone", "aqi"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_observations(spark: SparkSession, sf_dir: str, by: str = "type") -> DataFrame:
    """Observation rows from ``events``; ``by`` = ``type`` or ``user``."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    value = F.col("value")
    city = F.col("event_type") if by == "type" else F.col("user_id").cast("string")
    return ev.select(
        city.alias("city"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("seq"),
        k.alias("pm10"),
        value.alias("pm2_5"),
        (value * 4 + k).alias("carbon_monoxide"),
        (value / 2).alias("nitrogen_dioxide"),
        (k / 4).alias("sulphur_dioxide"),
        (value + k).alias("ozone"),
        pm25_to_aqi(value).alias("aqi"),
    )


# Fixed value: scale of the orders reading. Not a decimal fraction, so daily
# means of prices never sit exactly on a rounding tie.
ORDERS_SCALE = 0.0001414213562373095


def orders_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second daily series: ``o_orderpriority`` as key, price as reading."""
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice") * F.lit(ORDERS_SCALE)
    return o.select(
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_orderkey").alias("seq"),
        p.alias("pm10"), p.alias("pm2_5"), p.alias("carbon_monoxide"),
        p.alias("nitrogen_dioxide"), p.alias("sulphur_dioxide"), p.alias("ozone"),
        pm25_to_aqi(p).alias("aqi"),
    )
