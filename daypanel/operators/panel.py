"""Daily panel: join intake, biometrics and wearable by day, fill, roll, next-day change.

Readings of a day have a total order (see :func:`reading_order`), and every window here follows it, so the order of rows
in the files never matters.  By default one reading a day enters the panel, which bounds all windows by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, WEARABLE_PREFIX, wearable_columns, whole
from daypanel.functions.stats import rolling_mean

# Optional columns of biometrics that order the readings of a day, and the position they get here.
READING_COLUMNS = ("reading_ts", "reading_no")
READING = "reading"
PER_DAY = ("last", "largest", "all")


def reading_order(biometrics: DataFrame) -> Column:
    """When a reading was taken, then its number in its file, then its amount: what is absent or null comes first.

    Readings that agree in all of these are equal, so their order cannot matter.
    """
    return F.struct(*(F.col(c) for c in READING_COLUMNS if c in biometrics.columns), F.col("amount"))


def weight_readings(biometrics: DataFrame, unit: str = "kg", metric: str | None = None, per_day: str = "last") -> DataFrame:
    """Readings with the given unit as (entity, day, weight).

    ``per_day`` keeps the last reading of a day in :func:`reading_order`, the largest, or all of them, numbered in the column
    ``reading``; every reading then makes a row of its own, as in the daily process this reproduces.  Last and
    largest are aggregates combined before the exchange.  ``metric`` narrows to one metric.
    """
    if per_day not in PER_DAY:
        raise ValueError(f"per_day must be one of {', '.join(PER_DAY)}")
    kept = biometrics.filter(F.col("unit") == unit)
    if metric is not None:
        kept = kept.filter(F.col("metric") == metric)
    if per_day == "all":
        spec = Window.partitionBy(*KEYS).orderBy(reading_order(biometrics))
        return kept.select(*KEYS, F.col("amount").alias("weight"), F.row_number().over(spec).alias(READING))
    kept = kept.filter(F.col("amount").isNotNull())
    chosen = F.max("amount") if per_day == "largest" else F.max_by("amount", reading_order(biometrics))
    return kept.groupBy(*KEYS).agg(chosen.alias("weight"))


def join_daily(
    intake: DataFrame, biometrics: DataFrame, wearable: DataFrame | None = None, prefix: str = WEARABLE_PREFIX,
    **readings,
) -> DataFrame:
    """Intake left-joined with weight readings and wearable days on (entity, day)."""
    daily = intake.join(weight_readings(biometrics, **readings), KEYS, "left")
    if wearable is not None:
        daily = daily.join(wearable.select(*KEYS, *wearable_columns(wearable, prefix)), KEYS, "left")
    return daily


def finish_daily(daily: DataFrame, trailing_weight: str = "zero", prefix: str = WEARABLE_PREFIX) -> DataFrame:
    """Back-fill weight, fill non-wearable nulls with 0, add rolling intake and next-day change.

    Days after the last reading have no later value to take: they become 0, or stay null with
    ``trailing_weight="null"``.  All windows share one partitioning and one sort, by day and, where a day has several, by reading.
    """
    if trailing_weight not in ("zero", "null"):
        raise ValueError("trailing_weight must be 'zero' or 'null'")
    series = Window.partitionBy(ENTITY).orderBy(DAY, *([READING] if READING in daily.columns else []))
    onwards = series.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    daily = daily.withColumn("weight", F.first("weight", ignorenulls=True).over(onwards))
    types = dict(daily.dtypes)
    fill = [
        c
        for c in daily.columns
        if c not in (*KEYS, READING)
        and not c.startswith(prefix)
        and types[c] in ("double", "float", "int", "bigint")
        and not (c == "weight" and trailing_weight == "null")
    ]
    daily = daily.fillna(0, subset=fill)
    return daily.withColumns(
        {
            "energy_avg_7": rolling_mean(F.col("energy"), 7, order=series),
            "energy_avg_30": rolling_mean(F.col("energy"), 30, order=series),
            "weight_change": F.lead("weight").over(series) - F.col("weight"),
        }
    )


def process_daily(
    intake: DataFrame, biometrics: DataFrame, wearable: DataFrame | None = None, trailing_weight: str = "zero",
    prefix: str = WEARABLE_PREFIX, **readings,
) -> DataFrame:
    """The processed daily table."""
    return finish_daily(join_daily(intake, biometrics, wearable, prefix, **readings), trailing_weight, prefix)


def last_of_day(daily: DataFrame) -> DataFrame:
    """Of a table with all readings the row of each day's last one, for operators that take one row a day."""
    if READING not in daily.columns:
        return daily
    rest = [c for c in daily.columns if c not in KEYS]
    # The reading number decides; a day without a reading has one row.
    last = F.max_by(F.struct(*rest), F.coalesce(READING, F.lit(0)))
    return daily.groupBy(*KEYS).agg(last.alias("_last")).select(*KEYS, *(F.col(f"_last.`{c}`").alias(c) for c in rest if c != READING))


def has_wearable_data(daily: DataFrame, columns: list[str]) -> DataFrame:
    """Per entity: does any of the columns hold a value?"""
    any_value = F.lit(False)
    for c in columns:
        if c in daily.columns:
            any_value = any_value | F.col(c).isNotNull()
    return daily.groupBy("entity").agg(F.bool_or(any_value).alias("has_data"))


def last_months(daily: DataFrame, months: int) -> DataFrame:
    """Rows from ``months`` calendar months before the entity's newest day on."""
    newest = F.max("day").over(whole())
    return daily.withColumn("_from", F.add_months(newest, -months)).filter("day >= _from").drop("_from")


def last_days(daily: DataFrame, days: int) -> DataFrame:
    newest = F.max("day").over(whole())
    return daily.withColumn("_from", F.date_sub(newest, days)).filter("day >= _from").drop("_from")
