"""File sources: CSV history and landed nested JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocast.contract import RAW_FEATURES, DataQualityError
from aerocast.functions import pm25_to_aqi, to_utc_instant, try_number

D = T.DoubleType()

COMPONENTS = T.StructType([T.StructField(n, D) for n in ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")])
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("air_pollution", T.StructType([
        T.StructField("coord", T.StructType([T.StructField("lon", D), T.StructField("lat", D)])),
        T.StructField("list", T.ArrayType(T.StructType([
            T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType())])),
            T.StructField("components", COMPONENTS),
            T.StructField("dt", T.LongType()),
        ]))),
    ])),
    T.StructField("weather", T.StructType([
        T.StructField("main", T.StructType([T.StructField("temp", D), T.StructField("humidity", D),
                                            T.StructField("pressure", D)])),
        T.StructField("wind", T.StructType([T.StructField("speed", D), T.StructField("deg", D),
                                            T.StructField("gust", D)])),
        T.StructField("dt", T.LongType()),
        T.StructField("name", T.StringType()),
    ])),
])

# Fixed mapping of payload component names to contract columns.
COMPONENT_MAP = {
    "pm10": "pm10",
    "pm2_5": "pm2_5",
    "carbon_monoxide": "co",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
}


def read_csv_history(spark: SparkSession, path: str, city: str | None = None,
                     columns=("city", "timestamp", *RAW_FEATURES)) -> DataFrame:
    """CSV history: header row, every field read as text (no inference pass),
    required columns picked by name, numbers coerced (bad -> NULL)."""
    raw = spark.read.option("header", True).csv(path)
    missing = sorted(set(columns) - set(raw.columns))
    if missing:
        raise DataQualityError(f"the file lacks {', '.join(missing)}")
    df = raw.select(
        F.col("city"), to_utc_instant("timestamp").alias("timestamp"),
        *[try_number(c).alias(c) for c in RAW_FEATURES])
    return df.where(F.col("city") == city) if city is not None else df


def read_payloads(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed payload files (one JSON document per file when ``multi_line``)."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line).json(path)


CORRUPT = "_corrupt_record"


def stream_payloads(spark: SparkSession, landing: str, multi_line: bool = True, archive: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """New payload files as a stream, each read once by a checkpointed job.

    Text that is no payload document comes as a row whose ``_corrupt_record``
    is not null; ``file`` names the source of each row. With ``archive``,
    files are moved there once their batch is done, so listing stays short.
    """
    reader = (spark.readStream.schema(T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing).withColumn("file", F.col("_metadata.file_name"))


def flatten_payloads(payloads: DataFrame, source: str = "payload") -> DataFrame:
    """One observation row per payload: first reading of the pollution list,
    renamed components, PM2.5-derived AQI, weather fields (absent -> NULL).

    A payload without components gives a row without pollutants, which every
    gate refuses by name; none vanishes. ``payload_rejects`` lists the payloads
    that lack some component.
    """
    comp = F.get(F.col("air_pollution.list"), 0).getField("components")
    return payloads.select(
        *[c for c in ("file", CORRUPT) if c in payloads.columns],
        F.col("city"),
        to_utc_instant("timestamp").alias("timestamp"),
        *[comp.getField(src).alias(dst) for dst, src in COMPONENT_MAP.items()],
        pm25_to_aqi(comp.getField("pm2_5")).alias("aqi"),
        F.col("weather.main.temp").alias("temperature"),
        F.col("weather.main.humidity").alias("humidity"),
        F.col("weather.wind.speed").alias("wind_speed"),
        F.lit(source).alias("source"),
    )


def payload_rejects(payloads: DataFrame) -> DataFrame:
    comp = F.get(F.col("air_pollution.list"), 0).getField("components")
    lacking = comp.isNull()
    for name in COMPONENT_MAP.values():
        lacking = lacking | comp.getField(name).isNull()
    return payloads.where(lacking)
