"""JSON and CSV: export records, typed reads with defaults, archive payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.sources.tables import floats_without_nan

# Column types of the asset dimension file.
ASSET_SEED = T.StructType(
    [
        T.StructField("asset_id", T.StringType()),
        T.StructField("asset_name", T.StringType()),
        T.StructField("asset_type", T.StringType()),
        T.StructField("capacity_mw", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("region", T.StringType()),
    ]
)

# Archive variable → (column, default for a missing hour).
ARCHIVE_VARIABLES = {
    "wind_speed_100m": ("wind_speed_mps", 0.0),
    "wind_direction_100m": ("wind_direction_deg", 0.0),
    "shortwave_radiation": ("ghi", 0.0),
    "temperature_2m": ("temperature_c", 15.0),
    "surface_pressure": ("pressure_hpa", 1013.0),
    "relative_humidity_2m": ("relative_humidity", 60.0),
    "cloud_cover": ("cloud_cover_pct", 0.0),
}

ARCHIVE_PAYLOAD = T.StructType(
    [
        T.StructField("asset_id", T.StringType()),
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in ARCHIVE_VARIABLES]
            ),
        ),
    ]
)


def read_asset_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ASSET_SEED).csv(path, header=True)


def write_asset_seed(assets: DataFrame, path: str) -> None:
    """The asset dimension as CSV with a header."""
    assets.select(*ASSET_SEED.fieldNames()).write.mode("overwrite").csv(path, header=True)


def json_ready(df: DataFrame) -> DataFrame:
    """Days and times as ISO text, NaN as NULL."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return floats_without_nan(df).select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, temporal)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields stay in the object."""
    json_ready(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def number_or(c: Column, default: float | None = 0.0) -> Column:
    """A JSON scalar as a number; missing or unreadable values become the default."""
    value = c.try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def text_or(c: Column, default: Column | str = "") -> Column:
    return F.coalesce(c, default if isinstance(default, Column) else F.lit(default))


def read_json_text(spark: SparkSession, path: str, fields: list[str], whole_file: bool = False):
    """The named fields as text, whatever scalar the file holds.

    ``whole_file`` reads one JSON array per file instead of one object per line.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def read_assets_json(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    fields = ["asset_id", "capacity_mw", "size_category", "asset_type", "display_name", "region"]
    raw = read_json_text(spark, path, fields, whole_file)
    return raw.select(
        "asset_id",
        number_or(F.col("capacity_mw")).alias("capacity_mw"),
        text_or(F.col("size_category")).alias("size_category"),
        text_or(F.col("asset_type")).alias("asset_type"),
        text_or(F.col("display_name"), F.col("asset_id")).alias("display_name"),
        text_or(F.col("region")).alias("region"),
    )


def read_daily_json(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    numbers = [
        "total_net_generation_mwh", "daily_capacity_factor", "avg_availability_pct",
        "total_curtailment_mwh", "total_discharge_mwh", "total_co2_tonnes", "total_fuel_mmbtu",
    ]
    texts = ["daily_performance_rating", "asset_type"]
    raw = read_json_text(
        spark, path, ["asset_id", "date", *numbers, *texts, "avg_soc_pct"], whole_file
    )
    soc = F.col("avg_soc_pct")
    return raw.select(
        "asset_id",
        "date",
        *[number_or(F.col(n)).alias(n) for n in numbers],
        *[text_or(F.col(n)).alias(n) for n in texts],
        F.when(soc.isNotNull(), number_or(soc)).alias("avg_soc_pct"),
    )


def read_weather_json(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    texts = ["performance_category", "inferred_asset_type"]
    raw = read_json_text(
        spark, path, ["asset_id", "date", "performance_score", *texts], whole_file
    )
    return raw.select(
        "asset_id",
        "date",
        number_or(F.col("performance_score")).alias("performance_score"),
        *[text_or(F.col(n)).alias(n) for n in texts],
    )


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Manifest fields with empty-text and zero defaults."""
    schema = (
        "generated_at string, date_range struct<start:string,`end`:string>, asset_count string, "
        "schema_version string, weather_source string"
    )
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(
        text_or(F.col("generated_at")).alias("generated_at"),
        text_or(F.col("date_range.start")).alias("date_range_start"),
        text_or(F.col("date_range.end")).alias("date_range_end"),
        F.coalesce(F.col("asset_count").try_cast("bigint"), F.lit(0)).alias("asset_count"),
        text_or(F.col("schema_version")).alias("schema_version"),
        text_or(F.col("weather_source")).alias("weather_source"),
    )


def read_archive_payload(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return spark.read.schema(ARCHIVE_PAYLOAD).option("multiLine", whole_file).json(path)


def flatten_hourly(payload: DataFrame) -> DataFrame:
    """Parallel hourly arrays to one row per hour, renamed, missing hours defaulted."""
    hours = payload.select(
        "asset_id",
        F.inline(
            F.arrays_zip(
                F.col("hourly.time").alias("time"),
                *[F.col(f"hourly.{v}").alias(v) for v in ARCHIVE_VARIABLES],
            )
        ),
    )
    return hours.select(
        F.col("time").cast("timestamp_ntz").alias("timestamp"),
        "asset_id",
        *[
            F.coalesce(F.col(v), F.lit(default)).alias(name)
            for v, (name, default) in ARCHIVE_VARIABLES.items()
        ],
    )


def hourly_payload(weather: DataFrame) -> DataFrame:
    """The reverse of ``flatten_hourly``: one object of arrays per asset and day.

    Grouping by day keeps each array at the hours of a day.
    """
    inverse = {name: v for v, (name, _) in ARCHIVE_VARIABLES.items()}
    hour = F.struct(
        F.col("timestamp").cast("string").alias("time"),
        *[F.col(name).alias(v) for name, v in inverse.items()],
    )
    days = (
        weather.withColumn("_day", F.col("timestamp").cast("date"))
        .groupBy("asset_id", "_day")
        .agg(F.array_sort(F.collect_list(hour)).alias("h"))
    )
    return days.select(
        "asset_id",
        F.struct(
            F.col("h.time").alias("time"), *[F.col(f"h.{v}").alias(v) for v in ARCHIVE_VARIABLES]
        ).alias("hourly"),
    )
