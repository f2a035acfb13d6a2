"""Parquet tables: landing files, guards, overwrite, keyed upsert, daily partitions."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.functions.calendar import day_of
from voltseries.functions.numeric import nan_to_null
from voltseries.operators.dedup import LOAD_ID, keep_latest
from voltseries.session import scratch_path

WARMUP_DAYS = 7
FILE_ORDER = ("date", "asset_id", "timestamp")
SCHEMA_FOLDER = "_schema"
POINTERS = "_versions"


def _text_rows(spark: SparkSession, path: str) -> list[str]:
    try:
        return [r["value"] for r in spark.read.text(path).collect()]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept with an upserted table; None for other folders."""
    # Every change appends a line; the longest schema is the newest, as columns only join.
    lines = _text_rows(spark, f"{path.rstrip('/')}/{SCHEMA_FOLDER}")
    schemas = [T.StructType.fromJson(json.loads(line)) for line in lines]
    return max(schemas, key=len) if schemas else None


def read_landing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landing files or an upserted table; with a schema nothing is inferred from the data."""
    schema = schema if schema is not None else stored_schema(spark, path)
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def save_landing(df: DataFrame, path: str, partition_by_date: bool = True) -> None:
    """Snappy Parquet, one folder per date of ``timestamp`` or a plain table.

    Rows are spread by ranges of (date, asset, hour): a large day is written by many
    tasks, and a task writes few days, so the file count stays near the task count.
    """
    if partition_by_date:
        dated = df.withColumn("date", day_of("timestamp"))
        writer = dated.repartitionByRange(*FILE_ORDER).write.partitionBy("date")
    else:
        writer = df.write
    writer.mode("overwrite").option("compression", "snappy").parquet(path)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def require_mart(
    df: DataFrame, columns: Sequence[str], min_rows: int | None = None
) -> DataFrame:
    """The frame itself, or an error if columns or rows are missing.

    The row check reads at most ``min_rows`` rows.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if min_rows is not None:
        found = df.limit(min_rows).count()
        if found < min_rows:
            raise ValueError(f"{found} rows, need at least {min_rows}")
    return df


def floats_without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every float column."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def replace_table(
    df: DataFrame, path: str, check: Callable[[DataFrame], object] | None = None
) -> None:
    """Write ``df`` as the next version of a table, and only then make it current.

    A version is a folder of its own; the switch is the commit of one appended line, so
    an interrupted or refused write leaves the current version as it was.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    number = 1 + max((n for n, _ in _versions(spark, path)), default=0)
    name = f"version-{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{name}")
    if check is not None:
        check(spark.read.schema(df.schema).parquet(f"{path}/{name}"))
    line = spark.createDataFrame([(f"{number} {name}",)], "value string")
    line.coalesce(1).write.mode("append").text(f"{path}/{POINTERS}")


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    lines = [line.split(" ", 1) for line in _text_rows(spark, f"{path}/{POINTERS}")]
    return sorted((int(number), name) for number, name in lines)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by ``replace_table``."""
    path = path.rstrip("/")
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no table at {path}")
    return spark.read.parquet(f"{path}/{versions[-1][1]}")


def overwrite_table(df: DataFrame, path: str) -> bool:
    """Replace a result table; NaN becomes NULL. Empty input leaves it as it is."""
    if df.isEmpty():
        return False
    replace_table(floats_without_nan(df), path)
    return True


def _days_of(
    spark: SparkSession, path: str, schema: T.StructType, days: Sequence[dt.date | None]
) -> DataFrame:
    """The partitions of some days, the one of rows without a date among them if asked."""
    table = spark.read.schema(schema).parquet(path)
    chosen = F.col("date").isin([d for d in days if d is not None])
    return table.filter(chosen | F.col("date").isNull() if None in days else chosen)


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str] = ("asset_id", "timestamp"),
    version: str = LOAD_ID,
) -> list[str]:
    """Merge a batch into a date-partitioned table; returns the added columns.

    Only the days the batch touches are read and rewritten; rows without a timestamp
    are a day of their own. The batch is planned once and staged, and so are the merged
    days, because a plan cannot overwrite files it reads. The table changes in the last
    write only: an interrupted run leaves it as it was, and a repeated run gives the
    same table. The schema is kept beside the data; read with ``read_landing``.
    """
    incoming = scratch_path(spark, "batch")
    batch = batch.withColumn("date", day_of("timestamp"))
    batch.write.parquet(incoming)
    batch = spark.read.schema(batch.schema).parquet(incoming)
    # One value per calendar day: bounded by the calendar, not by the rows.
    days = [r["date"] for r in batch.select("date").distinct().collect()]
    if not days:
        return []
    known = stored_schema(spark, path)
    keys = ["date", *[k for k in keys if k != "date"]]
    schema, merged = batch.schema, batch
    if known is not None:
        added = [f for f in batch.schema if f.name not in known.names]
        schema = T.StructType([*known.fields, *added])
        merged = _days_of(spark, path, schema, days).unionByName(batch, allowMissingColumns=True)
    staged = scratch_path(spark, "upsert")
    keep_latest(merged, keys, version).select(*schema.names).write.parquet(staged)
    (
        spark.read.schema(schema).parquet(staged)
        .repartitionByRange(*FILE_ORDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("date")
        .parquet(path)
    )
    if known is None or len(schema) > len(known):
        line = spark.createDataFrame([(schema.json(),)], "value string")
        line.coalesce(1).write.mode("append").text(f"{path.rstrip('/')}/{SCHEMA_FOLDER}")
    return [] if known is None else [n for n in schema.names if n not in known.names]


def day_partition(df: DataFrame, day: str | dt.date, partition_col: str | None = None) -> DataFrame:
    """The hours 00 to 23 of one day; an empty day is an error."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    kind = "timestamp_ntz"
    low = F.lit(f"{day}T00:00:00").cast(kind)
    high = F.lit(f"{day}T23:00:00").cast(kind)
    rows = df.filter(F.col("timestamp").between(low, high))
    if partition_col:
        rows = rows.filter(F.col(partition_col) == F.lit(day))
    if rows.isEmpty():
        raise ValueError(f"no rows for {day}")
    return rows


def load_day(
    spark: SparkSession, landing: DataFrame, path: str, day: str | dt.date
) -> list[str]:
    """Merge one day of the landing frame into the raw table at ``path``."""
    return upsert(spark, path, day_partition(landing, day))


def with_lookback(
    df: DataFrame,
    day: str | dt.date,
    transform: Callable[[DataFrame], DataFrame],
    days: int = WARMUP_DAYS,
    date_col: str = "date",
) -> DataFrame:
    """Apply ``transform`` to [day − days, day] and keep the rows of ``day``."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    first = day - dt.timedelta(days=days)
    wide = df.filter(F.col(date_col).between(F.lit(first), F.lit(day)))
    return transform(wide).filter(F.col(date_col) == F.lit(day))


def preferred_source(
    primary: DataFrame | None, fallback: DataFrame, primary_label: str, fallback_label: str
) -> tuple[DataFrame, str]:
    """The primary frame if it has rows, else the fallback, and the label of the choice."""
    if primary is not None and not primary.isEmpty():
        return primary, primary_label
    return fallback, fallback_label


def combine_assets(
    frames: Sequence[DataFrame], columns: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Union of per-asset frames, projected, and sorted only if asked."""
    out = frames[0].select(*columns)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*columns))
    return out.orderBy(*order_by) if order_by else out


def day_spine(start: str | dt.date, end: str | dt.date, spark: SparkSession) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return spark.range(1).select(
        F.explode(F.sequence(first, F.date_sub(last, 1))).alias("date_day")
    )


def day_spine_of(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row per day between the first and the last day of a frame."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a view: nothing is stored, the plan gets a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, path: str) -> DataFrame:
    """Materialise as a stored table and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
