"""Incremental history: sync bounds, keyed merges where the newest source wins, gap repair."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, SESSION_TYPES, by_day, ensure_columns, keep_last, numeric
from daypanel.functions.stats import rolling_mean, rolling_sum

# Defaults of look-back, overlap, gap scan, gap limit, and metrics missing together.
LOOKBACK_DAYS, OVERLAP_DAYS = 30, 2
GAP_SCAN_DAYS, GAP_MAX_DATES, GAP_MIN_MISSING = 180, 30, 2

# Metrics watched for gaps; floors alone does not justify a repair.
GAP_MONITORED = [
    "w_steps", "w_distance_m", "w_active_kcal", "w_resting_hr", "w_floors", "w_sleep_seconds", "w_sleep_score",
    "w_avg_stress", "w_body_battery_max", "w_body_battery_min", "w_moderate_min", "w_vigorous_min",
    "w_session_count", "w_hr_min", "w_hr_max", "w_hr_avg", "w_hrv", "w_respiration", "w_spo2", "w_readiness",
    "w_training_status",
]
GAP_PRIORITY = [c for c in GAP_MONITORED if c != "w_floors"]


@dataclass(frozen=True)
class SyncConfig:
    """Bounds of one sync run, checked when built.  ``end`` defaults to yesterday."""

    end: dt.date = field(default_factory=lambda: dt.date.today() - dt.timedelta(days=1))
    start: dt.date | None = None
    lookback_days: int = LOOKBACK_DAYS
    overlap_days: int = OVERLAP_DAYS
    force_full: bool = False
    gap_scan_days: int = GAP_SCAN_DAYS
    gap_max_dates: int = GAP_MAX_DATES
    gap_min_missing: int = GAP_MIN_MISSING

    def __post_init__(self) -> None:
        for name in ("lookback_days", "overlap_days", "gap_scan_days", "gap_max_dates", "gap_min_missing"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.start is not None and self.start > self.end:
            raise ValueError("start must not be later than end")

    @property
    def history_start(self) -> dt.date:
        return self.start or self.end - dt.timedelta(days=self.lookback_days - 1)


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from start to end."""
    if start > end:
        raise ValueError("start must not be later than end")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(DAY))


def lookback_range(spark: SparkSession, days: int, end: dt.date) -> DataFrame:
    if days <= 0:
        raise ValueError("days must be positive")
    return date_range(spark, end - dt.timedelta(days=days - 1), end)


def sync_bounds(entities: DataFrame, history: DataFrame | None, config: SyncConfig) -> DataFrame:
    """Per entity the first and last day to request.

    An entity without history, or a forced run, starts at the history start.
    """
    start = F.lit(config.history_start)
    entities = entities.select(ENTITY).distinct()
    if history is None or config.force_full:
        out = entities.withColumn("sync_start", start)
    else:
        newest = history.groupBy(ENTITY).agg(F.max(DAY).alias("_newest"))
        resumed = F.greatest(start, F.date_sub("_newest", config.overlap_days))
        out = entities.join(newest, ENTITY, "left").withColumn("sync_start", F.coalesce(resumed, start)).drop("_newest")
    return out.withColumn("sync_end", F.lit(config.end))


def stack(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """Union of both with a ``_source`` rank; columns missing on one side become null."""
    parts = [d.withColumn("_source", F.lit(i)) for i, d in enumerate((old, new)) if d is not None]
    if not parts:
        raise ValueError("nothing to merge")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def weekly_rollups(daily: DataFrame) -> DataFrame:
    """Seven-row totals of steps and intensity and mean stress, over the full history."""
    base = ["w_steps", "w_avg_stress", "w_moderate_min", "w_vigorous_min"]
    daily = numeric(ensure_columns(daily, {c: "double" for c in base}), base)
    minutes = F.coalesce("w_moderate_min", F.lit(0.0)) + F.coalesce("w_vigorous_min", F.lit(0.0))
    return daily.withColumn("_minutes", minutes).withColumns(
        {
            "w_weekly_steps": rolling_sum(F.col("w_steps"), 7),
            "w_weekly_avg_stress": rolling_mean(F.col("w_avg_stress"), 7, 1),
            "w_weekly_intensity_min": rolling_sum(F.col("_minutes"), 7),
        }
    ).drop("_minutes")


def require(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")


def newest_first(tie_break: Sequence[str], df: DataFrame) -> list[Column]:
    return [F.col("_source"), *(F.col(c) for c in tie_break if c in df.columns)]


def merge_daily(old: DataFrame | None, new: DataFrame | None, version: str | None = None) -> DataFrame:
    """Upsert of daily rows by (entity, day), newest source wins, rollups recomputed.

    ``version`` names a column that orders rows of one source (a load time or file position).
    """
    both = stack(old, new)
    require(both, KEYS, "daily history")
    rest = [c for c in both.columns if c not in (*KEYS, "_source", version)]
    order = newest_first([version] if version else [], both) + [F.col(c) for c in rest]
    return weekly_rollups(keep_last(both, KEYS, order).drop("_source"))


def session_key() -> Column:
    """Durable id where there is one; otherwise day, start, name, type and duration."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    composite = F.concat_ws("::", *(text(c) for c in (DAY, "start_time", "session_name", "session_type", "duration_min")))
    return F.coalesce(F.concat(F.lit("id::"), F.col("session_id").cast("string")), composite)


def durable_key() -> Column:
    """The key of sessions that may move to another day; null where the key includes the day."""
    return F.when(F.col("session_id").isNotNull(), session_key())


def merge_sessions(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """Upsert of sessions by their key; of several copies the newest source, then latest start."""
    both = stack(old, new)
    require(both, KEYS, "session history")
    both = ensure_columns(both, SESSION_TYPES).withColumn("_key", session_key())
    order = newest_first(list(dict.fromkeys([DAY, "start_time", "session_id", "kcal", "duration_min", *SESSION_TYPES])), both)
    return keep_last(both, [ENTITY, "_key"], order).drop("_source", "_key")


def merge_samples(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """Upsert of samples by (entity, day, timestamp)."""
    both = stack(old, new)
    require(both, [*KEYS, "sample_ts"], "sample history")
    return keep_last(both, [*KEYS, "sample_ts"], newest_first(["bpm"], both)).drop("_source")


def blanks_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    text = [c for c in columns if types.get(c) == "string"]
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in text}) if text else df


def gap_days(
    history: DataFrame, config: SyncConfig, bounds: DataFrame | None = None,
    monitored: Sequence[str] | None = None, priority: Sequence[str] | None = None,
) -> DataFrame:
    """Days worth requesting again, per entity, newest first up to the limit.

    A day qualifies with an interior gap in a priority metric, or gaps in several monitored
    ones.  Gaps are found on the full history; only then the scan range applies.  Days from
    ``bounds.sync_start`` on are left out, as the regular overlap requests them anyway.
    """
    require(history, KEYS, "daily history")
    watched = [c for c in (monitored or GAP_MONITORED) if c in history.columns]
    first_class = [c for c in (priority or GAP_PRIORITY) if c in watched]
    rows = blanks_to_null(history.select(*KEYS, *watched), watched)
    if not watched:
        return rows.filter(F.lit(False))
    # First and last known day per metric give the same flag as two running counts per metric.
    spec = Window.partitionBy(ENTITY)
    known = {c: F.when(F.col(c).isNotNull(), F.col(DAY)) for c in watched}
    rows = rows.withColumns(
        {f"_f_{c}": F.min(k).over(spec) for c, k in known.items()} | {f"_l_{c}": F.max(k).over(spec) for c, k in known.items()}
    )
    gap = {
        c: F.coalesce(
            F.col(c).isNull() & (F.col(DAY) > F.col(f"_f_{c}")) & (F.col(DAY) < F.col(f"_l_{c}")), F.lit(False)
        )
        for c in watched
    }
    count = sum((g.cast("int") for g in gap.values()), F.lit(0))
    wanted = count >= config.gap_min_missing
    for c in first_class:
        wanted = wanted | gap[c]
    scan_start = max(config.history_start, config.end - dt.timedelta(days=config.gap_scan_days - 1))
    rows = rows.filter(wanted & F.col(DAY).between(F.lit(scan_start), F.lit(config.end)))
    rows = rows.select(*KEYS).distinct()
    if bounds is not None:
        rows = rows.join(bounds.select(ENTITY, "sync_start"), ENTITY, "left")
        rows = rows.filter(F.coalesce(F.col(DAY) < F.col("sync_start"), F.lit(True))).drop("sync_start")
    newest = Window.partitionBy(ENTITY).orderBy(F.col(DAY).desc())
    return rows.withColumn("_k", F.row_number().over(newest)).filter(F.col("_k") <= config.gap_max_dates).drop("_k")


def requested_days(bounds: DataFrame, gaps: DataFrame | None = None) -> DataFrame:
    """Distinct (entity, day) of the overlap range and the gaps."""
    span = F.when(F.col("sync_start") <= F.col("sync_end"), F.sequence("sync_start", "sync_end"))
    days = bounds.select(ENTITY, F.explode(span).alias(DAY))
    return days if gaps is None else days.unionByName(gaps.select(*KEYS)).distinct()


def landed_for(payloads: DataFrame, days: DataFrame) -> DataFrame:
    """Landed payload rows of the requested days."""
    return payloads.join(days.select(*KEYS), KEYS, "left_semi")
