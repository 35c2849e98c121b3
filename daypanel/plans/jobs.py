"""Whole jobs: process the daily tables, sync landed payloads, seed from exports, report."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, shared_dir
from daypanel.operators import sync
from daypanel.operators.payload import normalise
from daypanel.sources import exports, sinks
from daypanel.sources.tables import MissingTable, no_samples, path_exists


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: several outputs then share one computation.

    Unlike a cached frame it survives lost executors, and readers prune its columns.
    """
    path = f"{shared_dir(df.sparkSession)}/daypanel/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def months_of(df: DataFrame) -> list[str]:
    """Calendar months present, a list as short as the calendar."""
    months = [r[0] for r in df.select(F.date_format(DAY, "yyyy-MM").alias("m")).distinct().collect()]
    if None in months:
        raise ValueError("rows without a day")
    return months


def upsert_table(
    new: DataFrame, table: str, merge, key=None, version: str | None = None, mark: dict[str, str] | None = None, attempts: int = 3
) -> None:
    """Merge new rows into a stored table, rewriting only the months they touch.

    Rows are matched by keys that include the day; where a key does not (a session id), ``key`` gives it as a column, null for rows
    whose key includes the day.  The store keeps such keys by month beside its rows: they are probed, and a month that holds an old row with a
    key of the new rows is rewritten too.  The stored rows of other months are never read.  The new rows are computed once.  Where another
    writer publishes meanwhile, the merge starts again from what that one published.
    """
    spark = new.sparkSession
    new = materialise(new, "new")
    touched = set(months_of(new))
    if not touched:
        return
    for attempt in range(attempts):
        base, months = sinks.pointer(spark, table), set(touched)
        known = sinks.read_keys(spark, table, base)
        if key is not None and known is not None:
            ids = new.select(ENTITY, key.alias("key")).where(F.col("key").isNotNull()).distinct()
            months |= {r[0] for r in known.join(ids, [ENTITY, "key"], "left_semi").select("month").distinct().collect()}
        merged = merge(sinks.read_parts(spark, table, base, sorted(months)), new)
        try:
            # Each attempt writes a version of its own: the directory of a lost race may be listed by nobody.
            sinks.replace_months(merged, table, sorted(months), version and version + f"-{attempt}" * (attempt > 0), mark, base, key)
            return
        except sinks.PointerMoved:
            if attempt == attempts - 1:
                raise


def merge_daily_rows(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Stored daily rows carry no rollups: those reach across months and are made when reading."""
    rolled = sync.merge_daily(old, new)
    return rolled.drop("w_weekly_steps", "w_weekly_avg_stress", "w_weekly_intensity_min")


def read_daily_history(spark: SparkSession, root: str) -> DataFrame | None:
    """Stored daily rows with their seven-row rollups over the full history."""
    daily = sinks.read_version(spark, sinks.store_paths(root)["daily"])
    return None if daily is None else sync.weekly_rollups(daily)


def upsert_store(
    root: str, daily: DataFrame, sessions: DataFrame, samples: DataFrame, version: str | None = None
) -> None:
    paths = sinks.store_paths(root)
    upsert_table(daily, paths["daily"], merge_daily_rows, version=version)
    upsert_table(sessions, paths["sessions"], sync.merge_sessions, sync.durable_key(), version)
    upsert_table(samples, paths["samples"], sync.merge_samples, version=version)


def plan_sync(payloads: DataFrame, history: DataFrame | None, config: sync.SyncConfig) -> DataFrame:
    """(entity, day) pairs this run works on: overlap range and repairable gaps."""
    bounds = sync.sync_bounds(payloads, history, config)
    gaps = None
    if history is not None and not config.force_full:
        gaps = sync.gap_days(history, config, bounds)
    return sync.requested_days(bounds, gaps)


def sync_store(
    payloads: DataFrame, root: str, config: sync.SyncConfig | None = None, details: DataFrame | None = None
) -> DataFrame:
    """Normalise the landed payloads of the requested days and merge them into the store."""
    spark = payloads.sparkSession
    config = config or sync.SyncConfig()
    paths = sinks.store_paths(root)
    history = None if config.force_full else sinks.read_version(spark, paths["daily"])
    landed = materialise(sync.landed_for(payloads, plan_sync(payloads, history, config)), "landed")
    daily, sessions, samples = normalise(landed, details)
    if config.force_full:
        replace_store(root, sync.merge_daily(None, daily), sync.merge_sessions(None, sessions), sync.merge_samples(None, samples))
    else:
        upsert_store(root, daily, sessions, samples)
    return read_daily_history(spark, root)


def replace_store(root: str, daily: DataFrame, sessions: DataFrame, samples: DataFrame) -> None:
    paths = sinks.store_paths(root)
    rollups = ["w_weekly_steps", "w_weekly_avg_stress", "w_weekly_intensity_min"]
    sinks.replace_table(daily.drop(*rollups), paths["daily"])
    sinks.replace_table(sessions, paths["sessions"], key=sync.durable_key())
    sinks.replace_table(samples, paths["samples"])


def seed_store(spark: SparkSession, export_root: str, root: str, merge_existing: bool = True) -> DataFrame:
    """Build or extend the store from historical export files."""
    if not path_exists(spark, export_root):
        raise MissingTable(export_root)
    sessions = materialise(exports.export_sessions(spark, export_root), "sessions")
    daily = materialise(exports.export_daily(spark, export_root, sessions), "daily")
    samples = no_samples(spark)
    if merge_existing:
        upsert_store(root, daily, sessions, samples)
    else:
        replace_store(root, sync.merge_daily(None, daily), sync.merge_sessions(None, sessions), samples)
    return read_daily_history(spark, root)
