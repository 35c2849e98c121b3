"""Readers of daily, biometric, wearable, session, payload and food tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daypanel.core import (
    DAY, ENTITY, SAMPLE_TYPES, SESSION_TYPES, WEARABLE_PREFIX, WEARABLE_TYPES, empty, ensure_columns,
)

# Headers of the daily intake export and their columns here.
INTAKE_HEADERS = {
    "Date": DAY, "Energy (kcal)": "energy", "Protein (g)": "protein", "Carbs (g)": "carbs", "Fat (g)": "fat",
    "Fiber (g)": "fiber", "Sodium (mg)": "sodium", "Water (g)": "water",
}
BIOMETRIC_HEADERS = {"Day": DAY, "Time": "reading_ts", "Metric": "metric", "Unit": "unit", "Amount": "amount"}
FOOD_HEADERS = {"Food Name": "food_name", "Category": "category", "Label": "label"}
DROPPED_INTAKE = ["Completed"]
# Column that holds a record whose number of fields differs from the header's.
BAD_LINE = "bad_line"


class MissingTable(FileNotFoundError):
    """A table named explicitly does not exist."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on its Hadoop file system?  Globs count as existing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    statuses = fs.globStatus(hadoop)
    return statuses is not None and len(statuses) > 0


def read_any(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Columns as text for CSV (cast explicitly afterwards), typed for the other formats."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    return reader.load(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header as text columns, and in ``bad_line`` the whole line of a record with more or fewer fields than the header."""
    names = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, BAD_LINE]])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    # All columns are parsed, so that the number of fields is known whichever columns are selected.
    return reader.option("columnPruning", False).csv(path)


def read_good(spark: SparkSession, path: str, fmt: str, bad_records: str | None) -> DataFrame:
    """The table, or of a CSV its whole records, with the others written to ``bad_records`` as (file, first cell, line)."""
    if bad_records is None or fmt != "csv":
        return read_any(spark, path, fmt)
    rows = read_csv(spark, path)
    # The reader parses no line for the line alone, so the first cell goes along.
    bad = rows.filter(F.col(BAD_LINE).isNotNull()).select(F.col("_metadata.file_name").alias("file"), F.col(f"`{rows.columns[0]}`").alias("first"), F.col(BAD_LINE).alias("line"))
    bad.write.mode("overwrite").parquet(bad_records)
    return rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def with_entity(df: DataFrame, entity: str | None) -> DataFrame:
    """Add a constant entity to a single person's file; a file with the column keeps its own."""
    if ENTITY in df.columns:
        return df
    if entity is None:
        raise ValueError("table has no entity column; pass entity=")
    return df.withColumn(ENTITY, F.lit(entity))


def rename(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in headers.items() if k in df.columns})


def to_day(df: DataFrame) -> DataFrame:
    """``day`` as date; text may carry a time part."""
    if DAY not in df.columns:
        raise ValueError("table has no day column")
    return df.withColumn(DAY, F.to_date(F.try_to_timestamp(F.col(DAY).cast("string"))))


def doubles(df: DataFrame, keep: list[str]) -> DataFrame:
    """Every column not in ``keep`` as double, invalid text as null."""
    return df.select(
        *keep, *(F.col(f"`{c}`").cast("string").try_cast("double").alias(c) for c in df.columns if c not in keep)
    )


def read_intake(
    spark: SparkSession, path: str, fmt: str = "csv", entity: str | None = None, bad_records: str | None = None
) -> DataFrame:
    """Daily intake; unknown nutrient columns are kept as doubles, the completion flag is dropped."""
    df = rename(read_good(spark, path, fmt, bad_records).drop(*DROPPED_INTAKE), INTAKE_HEADERS)
    return doubles(to_day(with_entity(df, entity)), [ENTITY, DAY])


def read_biometrics(
    spark: SparkSession, path: str, fmt: str = "csv", entity: str | None = None, bad_records: str | None = None
) -> DataFrame:
    """Long biometrics (entity, day, metric, unit, amount), with the time and the number of a reading where the table has them."""
    df = to_day(with_entity(rename(read_good(spark, path, fmt, bad_records), BIOMETRIC_HEADERS), entity))
    df = ensure_columns(df, {"metric": "string", "unit": "string", "amount": "string"})
    order = {"reading_ts": "string", "reading_no": "bigint"}
    extra = [F.col(c).cast("string").try_cast(t).alias(c) for c, t in order.items() if c in df.columns]
    return df.select(ENTITY, DAY, "metric", "unit", F.col("amount").cast("string").try_cast("double").alias("amount"), *extra)


def read_wearable(
    spark: SparkSession, path: str | None, fmt: str = "csv", entity: str | None = None,
    prefix: str = WEARABLE_PREFIX, date_column: str = "Date",
) -> DataFrame | None:
    """Optional wearable days: no path gives none, a missing table or day column is an error.

    Columns starting with ``prefix`` are kept (and renamed to this library's prefix).
    """
    if not path:
        return None
    if not path_exists(spark, path):
        raise MissingTable(path)
    df = rename(read_any(spark, path, fmt), {date_column: DAY})
    if DAY not in df.columns:
        raise ValueError(f"wearable table must include a {date_column} column")
    df = to_day(with_entity(df, entity))
    columns = [c for c in df.columns if c.startswith(prefix)]
    typed = []
    for c in columns:
        name = WEARABLE_PREFIX + c[len(prefix):]
        typed.append(F.col(f"`{c}`").cast("string").try_cast(WEARABLE_TYPES.get(name, "double")).alias(name))
    return df.select(ENTITY, DAY, *typed)


def read_sessions(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """Session table; a missing one is an empty one."""
    if not path or not path_exists(spark, path):
        return empty(spark, SESSION_TYPES)
    return read_any(spark, path, fmt)


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Stored table: none if absent, else with every day valid (one aggregate checks that)."""
    if not path_exists(spark, path):
        return None
    raw = read_any(spark, path, fmt)
    if not raw.columns:
        return empty(spark, {})
    if DAY not in raw.columns:
        raise ValueError(f"{path} has no day column")
    if dict(raw.dtypes)[DAY] == "date":
        bad = F.col(DAY).isNull()
        checked = raw
    else:
        parsed = F.to_date(F.try_to_timestamp(F.col(DAY).cast("string")))
        bad = parsed.isNull()
        checked = raw.withColumn(DAY, parsed)
    if raw.agg(F.count_if(bad)).first()[0]:
        raise ValueError(f"{path} holds invalid days")
    return checked


def read_payloads(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed endpoint payloads (entity, day, endpoint, payload), with their landing time where the table has it."""
    rows = ensure_columns(to_day(read_any(spark, path, fmt)), {"landed_at": "timestamp"})
    return rows.select(ENTITY, DAY, "endpoint", "payload", F.col("landed_at").cast("timestamp").alias("landed_at"))


def read_foods(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Labelled, unlabelled or servings food table."""
    df = rename(read_any(spark, path, fmt), FOOD_HEADERS)
    return ensure_columns(df, {"food_name": "string", "category": "string", "label": "string"})


def no_samples(spark: SparkSession) -> DataFrame:
    """Sample table of a source that has none, with the fixed schema."""
    return empty(spark, SAMPLE_TYPES)
