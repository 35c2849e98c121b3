"""Outlier attribution, recovery and activity regimes, box groups, runs of equal state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, by_day, ensure_columns, numeric, tail_rows, whole
from daypanel.functions.stats import pair_count, rank_quartile, rolling_mean, safe_corr, zscore
from daypanel.operators.rollup import box_stats, unpack_box

# Columns whose series-wide z-score explains outlier days.
OUTLIER_METRICS = {
    "carbs": "carbs", "sodium": "sodium", "water": "water", "sleep_score": "w_sleep_score", "stress": "w_avg_stress",
    "steps": "w_steps", "active_kcal": "w_active_kcal",
}
TAGS = ("glycogen / sodium / hydration", "recovery / sleep / stress", "activity load")

# Recovery metrics of the scatter report.
RECOVERY_METRICS = {
    "sleep duration": "w_sleep_hours", "sleep score": "w_sleep_score", "stress": "w_avg_stress", "HRV": "w_hrv",
    "resting HR": "w_resting_hr", "body battery min": "w_body_battery_min",
}


def outlier_days(daily: DataFrame, threshold_kg: float = 0.6) -> DataFrame:
    """Days of large weight change with z-scores, day-to-day deltas and an explanation tag.

    Z-scores and deltas are taken over the whole series; the filter comes after the windows.
    """
    extra = {"w_resting_hr": "double", "w_hrv": "double", "w_body_battery_min": "double", "w_active_kcal": "double"}
    types = {**{c: "double" for c in OUTLIER_METRICS.values()}, **extra}
    daily = numeric(ensure_columns(daily, types), [*types, "weight_change"])
    z = {f"{name}_z": zscore(F.col(c), whole()) for name, c in OUTLIER_METRICS.items()}
    deltas = {
        "resting_hr_delta": F.col("w_resting_hr") - F.lag("w_resting_hr").over(by_day()),
        "hrv_delta": F.col("w_hrv") - F.lag("w_hrv").over(by_day()),
    }
    rows = daily.select(ENTITY, DAY, "weight_change", *types).withColumns({**z, **deltas})
    rows = rows.filter(F.abs("weight_change") >= threshold_kg)
    # greatest() skips nulls; a comparison with an all-null signal counts as false.
    recovery = F.greatest(*(F.abs(c) for c in ("sleep_score_z", "stress_z", "hrv_delta", "resting_hr_delta")))
    activity = F.greatest(F.abs("steps_z"), F.abs("active_kcal_z"))
    hydration = F.greatest(F.abs("sodium_z"), F.abs("carbs_z"), F.abs("water_z"))
    tag = (
        F.when(F.coalesce((hydration >= recovery) & (hydration >= activity), F.lit(False)), TAGS[0])
        .when(F.coalesce(recovery >= activity, F.lit(False)), TAGS[1])
        .otherwise(TAGS[2])
    )
    return rows.select(
        ENTITY, DAY, F.col("weight_change").alias("weight_delta"), *z, *deltas,
        F.col("w_body_battery_min").alias("body_battery_min"), F.col("w_active_kcal").alias("active_kcal"),
        tag.alias("tag"),
    )


def largest_outliers(outliers: DataFrame, limit: int = 10) -> DataFrame:
    spec = Window.partitionBy(ENTITY).orderBy(F.abs("weight_delta").desc(), DAY)
    return outliers.withColumn("position", F.row_number().over(spec)).filter(F.col("position") <= limit)


REGIME_COLUMNS = {"w_sleep_hours": "double", "w_avg_stress": "double", "w_steps": "double", "w_hrv": "double"}


def regime_masks() -> dict[str, Column]:
    """The nine overlapping regimes; the medians are columns ``_med_*``."""
    sleep = F.col("w_sleep_hours")
    masks = {
        "sleep <6h": sleep < 6,
        "sleep 6 to 8h": (sleep >= 6) & (sleep < 8),
        "sleep >8h": sleep >= 8,
    }
    for label, c in (("stress", "w_avg_stress"), ("step", "w_steps"), ("HRV", "w_hrv")):
        masks[f"high {label} days"] = F.col(c) >= F.col(f"_med_{c}")
        masks[f"low {label} days"] = F.col(c) < F.col(f"_med_{c}")
    return {label: F.coalesce(m, F.lit(False)) for label, m in masks.items()}


def regime_table(daily: DataFrame) -> DataFrame:
    """Means and day count in each of nine regimes; nine rows per entity, also when empty."""
    values = {
        "mean_intake": "energy", "mean_weight_change": "weight_change", "mean_active_kcal": "w_active_kcal",
        "mean_resting_hr": "w_resting_hr", "mean_hrv": "w_hrv",
    }
    daily = ensure_columns(daily, {**REGIME_COLUMNS, **{c: "double" for c in values.values()}})
    rows = daily.select(ENTITY, *{*REGIME_COLUMNS, *values.values()}).withColumns(
        {f"_med_{c}": F.percentile(c, 0.5).over(whole()) for c in ("w_avg_stress", "w_steps", "w_hrv")}
    )
    aggs, cells = [], []
    for i, (label, mask) in enumerate(regime_masks().items()):
        aggs += [F.avg(F.when(mask, F.col(c))).alias(f"{name}__{i}") for name, c in values.items()]
        aggs.append(F.count(F.when(mask, F.lit(1))).alias(f"days__{i}"))
        cells.append(
            F.struct(
                F.lit(label).alias("regime"), *(F.col(f"{n}__{i}").alias(n) for n in values),
                F.col(f"days__{i}").alias("days"),
            )
        )
    return rows.groupBy(ENTITY).agg(*aggs).select(ENTITY, F.inline(F.array(*cells)))


BOX_SPECS = {
    "sleep score quartiles": "w_sleep_score", "stress high vs low": "w_avg_stress",
    "steps high vs low": "w_steps", "HRV high vs low": "w_hrv",
}


def recovery_boxes(daily: DataFrame, target: str = "weight_change", min_values: int = 8) -> DataFrame:
    """Quartiles of next-day change by sleep-score quartile and by median halves.

    In the halves a missing value falls into ``Low``; in the quartiles it stays out.
    """
    daily = ensure_columns(daily, {c: "double" for c in BOX_SPECS.values()})
    ranks = Window.partitionBy(ENTITY).orderBy(F.col("w_sleep_score").asc_nulls_last(), DAY)
    count = {c: F.count(c).over(whole()) for c in BOX_SPECS.values()}
    rows = daily.select(ENTITY, DAY, target, *BOX_SPECS.values())
    rows = rows.withColumns(
        {
            **{f"_n_{c}": e for c, e in count.items()},
            **{f"_med_{c}": F.percentile(c, 0.5).over(whole()) for c in BOX_SPECS.values() if c != "w_sleep_score"},
            "_rank": F.row_number().over(ranks),
        }
    )
    cells = []
    for title, c in BOX_SPECS.items():
        if c == "w_sleep_score":
            quartile = F.concat(F.lit("Q"), rank_quartile(F.col("_rank"), F.col(f"_n_{c}")))
            label = F.when(F.col(c).isNotNull(), quartile)
        else:
            label = F.when(F.col(c) >= F.col(f"_med_{c}"), "High").otherwise("Low")
        label = F.when(F.col(f"_n_{c}") >= min_values, label)
        cells.append(F.struct(F.lit(title).alias("panel"), label.alias("bin")))
    long = rows.select(ENTITY, F.col(target).alias("value"), F.inline(F.array(*cells)))
    parts = box_stats(F.col("value"))
    boxes = long.filter("bin is not null and value is not null").groupBy(ENTITY, "panel", "bin").agg(
        *(e.alias(a) for a, e in parts.items())
    )
    return unpack_box(boxes)


def activity_regimes(daily: DataFrame, window: int = 14, min_count: int = 5) -> DataFrame:
    """Daily regime (high, low, normal) of the smoothed activity proxy against its 33/67 % cuts."""
    rows = daily.withColumn("activity_regime", rolling_mean(F.col("activity_proxy_7d"), window, min_count))
    level = F.col("activity_regime")
    rows = rows.withColumns(
        {
            "_high": F.percentile("activity_regime", 0.67).over(whole()),
            "_low": F.percentile("activity_regime", 0.33).over(whole()),
        }
    )
    state = (
        F.when(F.coalesce(level <= F.col("_low"), F.lit(False)), "low")
        .when(F.coalesce(level >= F.col("_high"), F.lit(False)), "high")
        .otherwise("normal")
    )
    return rows.withColumn("regime", state).drop("_high", "_low")


def state_runs(rows: DataFrame, state: str, min_length: int = 4) -> DataFrame:
    """Runs of consecutive rows in one state, at least ``min_length`` long."""
    inner = Window.partitionBy(ENTITY, state).orderBy(DAY)
    island = F.row_number().over(by_day()) - F.row_number().over(inner)
    runs = (
        rows.withColumn("_island", island)
        .groupBy(ENTITY, state, "_island")
        .agg(F.min(DAY).alias("start_day"), F.max(DAY).alias("end_day"), F.count(F.lit(1)).alias("days"))
    )
    return runs.filter(F.col("days") >= min_length).drop("_island")


def activity_regime_runs(daily: DataFrame, min_length: int = 4) -> DataFrame:
    rows = activity_regimes(daily).select(ENTITY, DAY, "regime")
    return state_runs(rows, "regime", min_length).filter("regime in ('high', 'low')")


def bias_signal(daily: DataFrame, rows: int = 30, min_pairs: int = 11) -> DataFrame:
    """r of activity proxy and intake minus adaptive expenditure in the last rows."""
    recent = tail_rows(daily.select(ENTITY, DAY, "activity_proxy", "energy", "tdee_adaptive"), rows)
    x, y = F.col("activity_proxy"), F.col("energy") - F.col("tdee_adaptive")
    out = recent.groupBy(ENTITY).agg(pair_count(x, y).alias("n"), safe_corr(x, y).alias("_r"))
    return out.select(ENTITY, "n", F.when(F.col("n") >= min_pairs, F.col("_r")).alias("r"))


def recovery_scatter(daily: DataFrame, min_points: int = 5) -> DataFrame:
    """Points (recovery metric, next-day change, colour metric) where all three are known."""
    color = "carbs" if "carbs" in daily.columns else "sodium"
    daily = ensure_columns(daily, {**{c: "double" for c in RECOVERY_METRICS.values()}, color: "double"})
    daily = numeric(daily, [*RECOVERY_METRICS.values(), "weight_change"])
    wide = daily.select(
        ENTITY, DAY, F.col("weight_change"), F.col(color).alias("color"),
        *(F.col(c).alias(label) for label, c in RECOVERY_METRICS.items()),
    )
    long = wide.unpivot([ENTITY, DAY, "weight_change", "color"], list(RECOVERY_METRICS), "metric", "x")
    points = long.filter("x is not null and weight_change is not null and color is not null")
    n = F.count(F.lit(1)).over(Window.partitionBy(ENTITY, "metric"))
    return points.withColumn("_n", n).filter(F.col("_n") >= min_points).drop("_n")
