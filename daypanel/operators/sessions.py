"""Activity sessions and intraday samples: daily summaries, groups, pivots, newest sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import (
    DAY, ENTITY, KEYS, SESSION_TYPES, by_day, ensure_columns, latest_groups, numeric, week_start,
)
from daypanel.functions.scalars import SESSION_GROUPS, session_group
from daypanel.functions.stats import rolling_mean

SESSION_DAILY = ["w_session_min", "w_session_kcal", "w_session_avg_hr", "w_session_max_hr"]


def with_group(sessions: DataFrame, include_cardio: bool = False) -> DataFrame:
    """Keep a given group column; otherwise derive it from the session type."""
    if "session_group" in sessions.columns:
        return sessions
    return sessions.withColumn("session_group", session_group(F.col("session_type"), include_cardio))


def zero_sum(c: str | Column) -> Column:
    """Grouped sum in which a group without values counts as 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def session_daily(sessions: DataFrame) -> DataFrame:
    """Per day: total minutes and energy, mean of average and largest of maximum heart rate."""
    return sessions.groupBy(*KEYS).agg(
        zero_sum("duration_min").alias("w_session_min"),
        zero_sum("kcal").alias("w_session_kcal"),
        F.avg("avg_hr").alias("w_session_avg_hr"),
        F.max("max_hr").alias("w_session_max_hr"),
    )


def session_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(*KEYS).agg(F.count(F.lit(1)).cast("int").alias("w_session_count"))


def sample_daily(samples: DataFrame) -> DataFrame:
    """Per day: smallest, largest and mean heart rate of the intraday samples."""
    return samples.groupBy(*KEYS).agg(
        F.min("bpm").alias("w_hr_min"), F.max("bpm").alias("w_hr_max"), F.avg("bpm").alias("w_hr_avg")
    )


def add_session_fallback(daily: DataFrame, sessions: DataFrame) -> DataFrame:
    """Daily session columns keep their value; where null, the aggregate over sessions steps in."""
    summed = session_daily(sessions)
    renamed = summed.select(*KEYS, *(F.col(c).alias(f"_{c}") for c in SESSION_DAILY))
    daily = numeric(daily, [c for c in SESSION_DAILY if c in daily.columns])
    joined = ensure_columns(daily, {c: "double" for c in SESSION_DAILY}).join(renamed, KEYS, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in SESSION_DAILY}
    return joined.withColumns(filled).drop(*(f"_{c}" for c in SESSION_DAILY))


def activity_proxy() -> Column:
    """Active energy if the entity has any; otherwise a blend of steps, minutes and duration."""
    whole = Window.partitionBy(ENTITY)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    # Energy per step, per intensity minute and per session minute.
    blend = zero("w_steps") * 0.04 + zero("w_total_intensity_min") * 5.0 + zero("w_session_min") * 3.0
    return F.when(F.count("w_active_kcal").over(whole) > 0, F.col("w_active_kcal")).otherwise(blend)


REPORT_INPUT_COLUMNS = {
    "w_sleep_seconds": "double", "w_moderate_min": "double", "w_vigorous_min": "double",
    "w_active_kcal": "double", "w_steps": "double", "w_session_min": "double",
}


def report_inputs(daily: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Daily rows enriched for the wearable reports.

    ``daily`` must hold ``weight_smoothed``.  Without sessions the session columns stay as they are.
    """
    daily = numeric(ensure_columns(daily, REPORT_INPUT_COLUMNS), REPORT_INPUT_COLUMNS)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    daily = daily.withColumns(
        {
            "w_sleep_hours": F.col("w_sleep_seconds") / 3600.0,
            "w_total_intensity_min": zero("w_moderate_min") + zero("w_vigorous_min"),
        }
    )
    if sessions is not None:
        daily = add_session_fallback(daily, sessions)
    daily = daily.withColumn("activity_proxy", activity_proxy())
    return daily.withColumns(
        {
            "activity_proxy_7d": rolling_mean(F.col("activity_proxy"), 7, 1),
            "trend_change_7d": F.lead("weight_smoothed", 7).over(by_day()) - F.col("weight_smoothed"),
            "week": week_start(F.col(DAY)),
        }
    )


def group_contribution(sessions: DataFrame, daily: DataFrame) -> DataFrame:
    """Per session group: counts, totals, mean heart rate, mean next-day weight change.

    Sessions are summed per (entity, day, group) before they meet the daily rows, so the join
    moves one row per day and group however many sessions there are.
    """
    per_day = with_group(sessions).groupBy(*KEYS, "session_group").agg(
        F.count("session_id").alias("_ids"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("duration_min").alias("_minutes"),
        F.sum("kcal").alias("_kcal"),
        F.sum("avg_hr").alias("_hr"),
        F.count("avg_hr").alias("_hr_n"),
    )
    change = F.col("weight_change")
    joined = per_day.join(daily.select(*KEYS, "weight_change"), KEYS, "left")
    known = F.when(change.isNotNull(), F.col("_rows"))
    return joined.groupBy(ENTITY, "session_group").agg(
        F.sum("_ids").alias("sessions"),
        zero_sum("_minutes").alias("total_duration"),
        zero_sum("_kcal").alias("total_kcal"),
        F.try_divide(F.sum("_hr"), F.nullif(F.sum("_hr_n"), F.lit(0))).alias("average_hr"),
        F.try_divide(F.sum(change * F.col("_rows")), F.sum(known)).alias("next_day_change"),
    )


def group_week_pivot(sessions: DataFrame, weeks: int = 8) -> DataFrame:
    """Weekly energy by session group as columns, 0 where none; the newest weeks."""
    cells = with_group(sessions).withColumn("week", week_start(F.col(DAY)))
    column = lambda g: g.split("/")[0]
    wide = cells.groupBy(ENTITY, "week").agg(
        *(zero_sum(F.when(F.col("session_group") == g, F.col("kcal"))).alias(f"kcal_{column(g)}") for g in SESSION_GROUPS)
    )
    return latest_groups(wide, "week", weeks)


def newest_sessions(sessions: DataFrame, daily: DataFrame, limit: int = 12) -> DataFrame:
    """The newest sessions of every entity with same-day intake and next-day change.

    Ranked first (with the limit applied before the shuffle), joined afterwards.
    """
    sessions = with_group(ensure_columns(sessions, {c: t for c, t in SESSION_TYPES.items() if c != "session_group"}))
    spec = Window.partitionBy(ENTITY).orderBy(
        F.col(DAY).desc(), F.col("session_id").desc_nulls_last(), F.col("start_time").desc_nulls_last(),
        F.col("session_name").desc_nulls_last(), F.col("session_type").desc_nulls_last(),
        F.col("duration_min").desc_nulls_last(), F.col("kcal").desc_nulls_last(),
    )
    top = sessions.withColumn("position", F.row_number().over(spec)).filter(F.col("position") <= limit)
    joined = top.join(daily.select(*KEYS, "energy", "weight_change"), KEYS, "left")
    return joined.select(
        ENTITY, DAY, "position", "session_group", "duration_min", "kcal", "avg_hr", "max_hr",
        "training_effect", "training_load", F.col("energy").alias("same_day_intake"),
        F.col("weight_change").alias("next_day_change"),
    )
