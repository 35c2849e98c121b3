"""Shared building blocks: session, schema helpers, window specifications.

Every table carries ``entity`` (whose series it is) and, for daily tables, ``day``.  Daily tables
hold at most one row per ``(entity, day)``, so an ordered window over one entity is bounded by
the number of calendar days in the history, however many raw rows that entity produced.  Raw
rows (sessions, samples, payloads, events) are always reduced with a partial aggregate or a
limited rank before they reach a window.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = "entity"
DAY = "day"
KEYS = [ENTITY, DAY]

# Daily nutrient columns, in report order.
NUTRIENTS = ["energy", "protein", "carbs", "fat", "fiber", "sodium", "water"]

# Prefix of wearable columns, whose nulls are meaningful and never filled.
WEARABLE_PREFIX = "w_"

# The 25 wearable metrics of one day, in stored order.
WEARABLE_DOUBLES = [
    "w_steps", "w_distance_m", "w_active_kcal", "w_floors", "w_resting_hr",
    "w_sleep_seconds", "w_sleep_score", "w_avg_stress",
    "w_body_battery_max", "w_body_battery_min",
    "w_moderate_min", "w_vigorous_min",
    "w_session_min", "w_session_kcal", "w_session_avg_hr", "w_session_max_hr",
    "w_hr_min", "w_hr_max", "w_hr_avg",
    "w_hrv", "w_respiration", "w_spo2", "w_readiness",
]
WEARABLE_TYPES: dict[str, str] = {
    **{c: "double" for c in WEARABLE_DOUBLES[:12]},
    "w_session_count": "int",
    **{c: "double" for c in WEARABLE_DOUBLES[12:]},
    "w_training_status": "string",
}

SESSION_TYPES: dict[str, str] = {
    "session_id": "bigint",
    "session_name": "string",
    "session_type": "string",
    "session_group": "string",
    "start_time": "string",
    "duration_min": "double",
    "kcal": "double",
    "distance_m": "double",
    "avg_hr": "double",
    "max_hr": "double",
    "training_effect": "double",
    "training_load": "double",
}

SAMPLE_TYPES: dict[str, str] = {"sample_ts": "string", "bpm": "double"}


def get_session(app_name: str = "daypanel", master: str | None = None) -> SparkSession:
    """Session with UTC time and adaptive execution; cluster settings are left to the cluster.

    Panel rows are few bytes but take many window and payload expressions each, so the adaptive
    join of small shuffle partitions may go on below its default of 1 MB while cores are idle.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables that cut lineage and for stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a local folder is taken only if the master is
    local (tests); on a cluster a folder of the driver's machine would be lost to the executors, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="daypanel-")
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def by_day(*keys: str) -> WindowSpec:
    """Ordered window of one series; all daily windows use this one spec so they share a sort."""
    return Window.partitionBy(*(keys or (ENTITY,))).orderBy(DAY)


def whole(*keys: str) -> WindowSpec:
    """Unordered window over a whole series."""
    return Window.partitionBy(*(keys or (ENTITY,)))


def from_end(*keys: str) -> WindowSpec:
    return Window.partitionBy(*(keys or (ENTITY,))).orderBy(F.col(DAY).desc())


def rank_from_end(*keys: str) -> Column:
    """1 for the newest row; from the ascending rank, so that no second sort is needed."""
    return F.count(F.lit(1)).over(whole(*keys)) - F.row_number().over(by_day(*keys)) + 1


def frame(size: int, *keys: str) -> WindowSpec:
    """The current row and the ``size - 1`` rows before it (rows, never calendar days)."""
    return by_day(*keys).rowsBetween(1 - size, Window.currentRow)


def up_to_here(*keys: str) -> WindowSpec:
    return by_day(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def from_here(*keys: str) -> WindowSpec:
    return by_day(*keys).rowsBetween(Window.currentRow, Window.unboundedFollowing)


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add each absent column as a typed null column."""
    have = set(df.columns)
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in have}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, types: Mapping[str, str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Exactly ``keys`` and the given columns, in that order, absent ones as null."""
    return ensure_columns(df, types).select(*keys, *(F.col(c).cast(t).alias(c) for c, t in types.items()))


def empty(spark: SparkSession, types: Mapping[str, str], keys: Mapping[str, str] | None = None) -> DataFrame:
    keys = keys if keys is not None else {ENTITY: "string", DAY: "date"}
    schema = ", ".join(f"{c} {t}" for c, t in {**keys, **types}.items())
    return spark.createDataFrame([], schema)


def numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast to double; text that is no number becomes null, and NaN becomes null too."""
    types = dict(df.dtypes)
    changed: dict[str, Column] = {}
    for c in columns:
        if types.get(c) in ("double", "float"):
            changed[c] = F.nullif(F.col(c).cast("double"), F.lit(float("nan")))
        elif types.get(c) is not None:
            as_double = F.col(c).try_cast("double")
            changed[c] = F.nullif(as_double, F.lit(float("nan")))
    return df.withColumns(changed) if changed else df


def wearable_columns(df: DataFrame, prefix: str = WEARABLE_PREFIX) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def tail_rows(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of every entity; the rank limit is applied before the shuffle."""
    return df.withColumn("_back", F.row_number().over(from_end())).filter(F.col("_back") <= n).drop("_back")


def latest_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of the ``n`` newest values of ``group`` (a week, a month) of every entity."""
    order = Window.partitionBy(ENTITY).orderBy(F.col(group).desc())
    return df.withColumn("_g", F.dense_rank().over(order)).filter(F.col("_g") <= n).drop("_g")


def keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last in ``order``.

    ``row_number() = 1`` is planned with a partial group limit, so each task sends at most one
    row per key into the shuffle and a key with very many copies does not land in one task.
    """
    spec = Window.partitionBy(*keys).orderBy(*(o.desc_nulls_last() for o in order))
    return df.withColumn("_keep", F.row_number().over(spec)).filter("_keep = 1").drop("_keep")


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast(T.DateType())


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def rows_of(*structs: Column) -> Column:
    """``explode`` of a short literal list of structs: several output rows from one input row."""
    return F.explode(F.array(*structs))
