"""Weekly, monthly, weekday and recent-window rollups of the daily panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import (
    DAY, ENTITY, NUTRIENTS, ensure_columns, latest_groups, month_start, rank_from_end, tail_rows, week_start, whole,
)
from daypanel.functions import scalars as sc
from daypanel.functions.stats import variation_pct
from daypanel.operators.panel import last_days


def first_value(c: str) -> Column:
    """Earliest non-null value of the group."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(DAY)))


def last_value(c: str) -> Column:
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(DAY)))


def first_row(c: str) -> Column:
    """Value on the earliest day of the group, null or not."""
    return F.min_by(c, DAY)


def last_row(c: str) -> Column:
    return F.max_by(c, DAY)


def share(flag: str) -> Column:
    return F.avg(F.col(flag).cast("double"))


def with_week(daily: DataFrame) -> DataFrame:
    return daily.withColumn("week", week_start(F.col(DAY)))


WEEKLY_DECISION_COLUMNS = {
    "weight": "double", "weight_smoothed": "double", **{n: "double" for n in NUTRIENTS},
    "w_steps": "double", "w_active_kcal": "double", "w_sleep_hours": "double", "w_sleep_score": "double",
    "w_avg_stress": "double", "w_resting_hr": "double", "w_body_battery_min": "double", "w_hrv": "double",
    "on_track": "boolean",
}


def weekly_decision(daily: DataFrame, weeks: int = 8) -> DataFrame:
    """Weekly means, first/last known weight, trend, adherence flag; the newest weeks."""
    daily = with_week(ensure_columns(daily, WEEKLY_DECISION_COLUMNS))
    weekly = daily.groupBy(ENTITY, "week").agg(
        F.avg("weight").alias("avg_weight"),
        first_value("weight").alias("week_start_weight"),
        last_value("weight").alias("week_end_weight"),
        F.avg("energy").alias("avg_intake"),
        F.avg("protein").alias("avg_protein"),
        F.avg("carbs").alias("avg_carbs"),
        F.avg("sodium").alias("avg_sodium"),
        F.avg("w_steps").alias("avg_steps"),
        F.coalesce(F.sum("w_active_kcal"), F.lit(0.0)).alias("total_active_kcal"),
        F.avg("w_sleep_hours").alias("avg_sleep_hours"),
        F.avg("w_sleep_score").alias("avg_sleep_score"),
        F.avg("w_avg_stress").alias("avg_stress"),
        F.avg("w_resting_hr").alias("avg_resting_hr"),
        F.avg("w_body_battery_min").alias("avg_body_battery_min"),
        F.avg("w_hrv").alias("avg_hrv"),
        share("on_track").alias("avg_adherence"),
        first_value("weight_smoothed").alias("_first_smoothed"),
        last_value("weight_smoothed").alias("_last_smoothed"),
    )
    weekly = weekly.withColumns(
        {
            "weight_delta": F.col("week_end_weight") - F.col("week_start_weight"),
            "trend_slope": F.col("_last_smoothed") - F.col("_first_smoothed"),
            "adherence_flag": F.when(F.col("avg_adherence") >= 0.8, "on track").otherwise("watch"),
        }
    ).drop("_first_smoothed", "_last_smoothed")
    return latest_groups(weekly, "week", weeks)


def weekly_table(daily: DataFrame, weeks: int = 8) -> DataFrame:
    """Weekly intake, expenditure, deficit, first/last row weight, adherence, wearable totals."""
    have = set(daily.columns)
    daily = with_week(ensure_columns(daily, {"tdee_adaptive": "double"}))
    aggs = [
        F.avg("energy").alias("avg_intake"),
        F.avg("tdee_adaptive").alias("avg_tdee"),
        first_row("weight").alias("weight_start"),
        last_row("weight").alias("weight_end"),
        (share("on_track") * 100).alias("adherence_pct"),
    ]
    if "w_steps" in have:
        aggs.append(F.avg("w_steps").alias("steps"))
    if "w_sleep_seconds" in have:
        aggs.append((F.avg("w_sleep_seconds") / 3600.0).alias("sleep_hours"))
    if "w_avg_stress" in have:
        aggs.append(F.avg("w_avg_stress").alias("stress"))
    minutes = [c for c in ("w_moderate_min", "w_vigorous_min") if c in have]
    if minutes:
        total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in minutes), F.lit(0.0))
        aggs.append(F.sum(total).alias("intensity_min"))
    if "w_session_count" in have:
        aggs.append(F.coalesce(F.sum("w_session_count"), F.lit(0)).cast("double").alias("sessions"))
    weekly = daily.groupBy(ENTITY, "week").agg(*aggs)
    weekly = weekly.withColumns(
        {
            "deficit": F.col("avg_intake") - F.col("avg_tdee"),
            "weight_delta": F.col("weight_end") - F.col("weight_start"),
        }
    )
    return latest_groups(weekly, "week", weeks)


def waterfall(daily: DataFrame, weeks: int = 16) -> DataFrame:
    """Weekly weight change and running total over all weeks; the newest weeks are kept."""
    weekly = (
        with_week(daily)
        .filter("weight is not null")
        .groupBy(ENTITY, "week")
        .agg(first_row("weight").alias("first_weight"), last_row("weight").alias("last_weight"))
        .withColumn("change", F.col("last_weight") - F.col("first_weight"))
    )
    running = Window.partitionBy(ENTITY).orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    weekly = weekly.withColumn("cumulative", F.sum("change").over(running))
    return latest_groups(weekly, "week", weeks)


def weekly_activity(daily: DataFrame, rows: int = 56, weeks: int = 8) -> DataFrame:
    """Weekly sums of steps, intensity minutes and session counts over the last rows."""
    types = {"w_steps": "double", "w_moderate_min": "double", "w_vigorous_min": "double", "w_session_count": "double"}
    recent = with_week(tail_rows(ensure_columns(daily, types).select(ENTITY, DAY, *types), rows))

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0))

    weekly = recent.groupBy(ENTITY, "week").agg(
        total("w_steps").alias("steps"),
        (total("w_moderate_min") + total("w_vigorous_min")).alias("intensity_min"),
        total("w_session_count").alias("sessions"),
    )
    return latest_groups(weekly, "week", weeks)


def weekday_stats(daily: DataFrame, value: str = "energy") -> DataFrame:
    """Mean, median, deviation and row count by weekday; seven rows per entity, always."""
    stats = (
        daily.groupBy(ENTITY, F.weekday(DAY).alias("day_num"))
        .agg(
            F.avg(value).alias("mean"),
            F.percentile(value, 0.5).alias("median"),
            F.stddev_samp(value).alias("std"),
            F.count(F.lit(1)).alias("days"),
        )
    )
    return seven_days(stats, ["mean", "median", "std"], "days")


def seven_days(stats: DataFrame, doubles: list[str], count: str) -> DataFrame:
    """Complete (entity, day_num) to Monday..Sunday from the at most seven groups it has."""
    by_num = F.map_from_entries(F.collect_list(F.struct("day_num", F.struct(*doubles, count))))
    full = stats.groupBy(ENTITY).agg(by_num.alias("m")).select(
        ENTITY, "m", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_num")
    )
    cell = F.try_element_at("m", F.col("day_num"))
    return full.select(
        ENTITY, "day_num", sc.weekday_name(F.col("day_num")).alias("day_name"),
        *(cell[c].alias(c) for c in doubles), F.coalesce(cell[count], F.lit(0)).alias(count),
    )


def intake_variation(daily: DataFrame, value: str = "energy") -> DataFrame:
    return daily.groupBy(ENTITY).agg(variation_pct(F.col(value)).alias("cv_pct"))


def weekend_difference(daily: DataFrame, value: str = "energy") -> DataFrame:
    """Mean on weekends, on weekdays, and their difference."""
    out = daily.groupBy(ENTITY).agg(
        F.avg(F.when(sc.is_weekend(F.col(DAY)), F.col(value))).alias("weekend_mean"),
        F.avg(F.when(~sc.is_weekend(F.col(DAY)), F.col(value))).alias("weekday_mean"),
    )
    return out.withColumn("difference", F.col("weekend_mean") - F.col("weekday_mean"))


def coverage_by_month(daily: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Monthly share of days, in percent, that hold each kind of data."""
    types = {"w_sleep_seconds": "double", "w_hrv": "double", "w_body_battery_min": "double"}
    daily = ensure_columns(daily, types).select(ENTITY, DAY, "weight", *types)
    if sessions is None:
        daily = daily.withColumn("_has_session", F.lit(False))
    else:
        days = sessions.select(ENTITY, DAY).distinct().withColumn("_has_session", F.lit(True))
        daily = daily.join(days, [ENTITY, DAY], "left")

    def pct(flag: Column) -> Column:
        return F.avg(flag.cast("double")) * 100

    return daily.groupBy(ENTITY, month_start(F.col(DAY)).alias("month")).agg(
        pct(F.col("weight").isNotNull()).alias("weight_pct"),
        pct(F.col("w_sleep_seconds").isNotNull()).alias("sleep_pct"),
        pct(F.col("w_hrv").isNotNull()).alias("hrv_pct"),
        pct(F.col("w_body_battery_min").isNotNull()).alias("body_battery_pct"),
        pct(F.coalesce(F.col("_has_session"), F.lit(False))).alias("session_pct"),
        pct(F.col("weight").isNotNull()).alias("body_composition_pct"),
    )


def box_stats(value: Column) -> dict[str, Column]:
    q = F.percentile(value, F.array(*(F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0))))
    return {"_q": q, "n": F.count(value)}


def unpack_box(df: DataFrame) -> DataFrame:
    names = ["low", "q1", "median", "q3", "high"]
    return df.withColumns({n: F.col("_q")[i] for i, n in enumerate(names)}).drop("_q")


def weekday_boxes(daily: DataFrame, value: str = "energy") -> DataFrame:
    """Quartiles of a metric by weekday."""
    parts = box_stats(F.col(value))
    boxes = daily.groupBy(ENTITY, F.weekday(DAY).alias("day_num")).agg(*(e.alias(a) for a, e in parts.items()))
    return unpack_box(boxes.filter("n > 0"))


def weekend_histogram(daily: DataFrame, value: str = "weight_change", bins: int = 29) -> DataFrame:
    """Counts in equal-width bins over the entity's range, split weekday/weekend."""
    x = F.col(value)
    rows = daily.filter(x.isNotNull()).select(
        ENTITY, x.alias("x"), sc.is_weekend(F.col(DAY)).alias("is_weekend"),
        F.min(x).over(whole()).alias("lo"), F.max(x).over(whole()).alias("hi"),
    )
    bin_no = F.least(F.width_bucket("x", "lo", "hi", F.lit(bins)), F.lit(bins)).cast("int")
    rows = rows.withColumn("bin", bin_no)
    return rows.groupBy(ENTITY, "bin").agg(
        F.count(F.when(~F.col("is_weekend"), 1)).alias("weekday_days"),
        F.count(F.when(F.col("is_weekend"), 1)).alias("weekend_days"),
        F.min("lo").alias("range_low"),
        F.max("hi").alias("range_high"),
    )


def adherence_days(daily: DataFrame, days: int = 180) -> DataFrame:
    """Calendar cells of the last days: status by (week label, weekday)."""
    cells = last_days(daily.select(ENTITY, DAY, "on_track", "deficit"), days)
    return cells.select(
        ENTITY, DAY, sc.iso_week_label(F.col(DAY)).alias("year_week"), F.weekday(DAY).alias("weekday"),
        sc.adherence_status(F.col("on_track"), F.col("deficit")).alias("status"),
    )


def adherence_counts(daily: DataFrame, days: int = 180) -> DataFrame:
    """Days on track, under and over target in the last days, with shares in percent."""
    cells = adherence_days(daily, days)
    out = cells.groupBy(ENTITY).agg(
        F.count(F.lit(1)).alias("days"),
        *(
            F.count(F.when(F.col("status") == v, 1)).alias(n)
            for n, v in (("on_track_days", 1.0), ("under_days", 0.5), ("over_days", 0.0))
        ),
    )
    return out.withColumns(
        {c.replace("_days", "_pct"): F.col(c) * 100.0 / F.col("days") for c in ("on_track_days", "under_days", "over_days")}
    )


INSIGHT_COLUMNS = {
    "w_sleep_seconds": "double", "w_avg_stress": "double", "w_steps": "double", "w_body_battery_max": "double",
}


def adherence_insights(daily: DataFrame, target_energy: float, rows: int = 60, min_values: int = 6) -> DataFrame:
    """How sleep, stress, steps and recovery go with keeping to the target, last rows."""
    have_flag = "on_track" in daily.columns
    daily = ensure_columns(daily, INSIGHT_COLUMNS)
    if not have_flag:
        daily = daily.withColumn("on_track", F.coalesce(F.col("energy") <= target_energy, F.lit(False)))
    recent = tail_rows(daily.select(ENTITY, DAY, "energy", "on_track", *INSIGHT_COLUMNS), rows)
    sleep, stress = F.col("w_sleep_seconds") / 3600.0, F.col("w_avg_stress")
    recent = recent.withColumns(
        {"_sleep_cut": F.percentile(sleep, 0.5).over(whole()), "_stress_cut": F.percentile(stress, 0.5).over(whole())}
    )
    on = F.col("on_track").cast("double")
    over = F.coalesce(F.col("energy") > target_energy, F.lit(False)).cast("double")
    out = recent.groupBy(ENTITY).agg(
        F.count("w_sleep_seconds").alias("_n_sleep"),
        F.count("w_avg_stress").alias("_n_stress"),
        F.count("w_steps").alias("_n_steps"),
        F.count("w_body_battery_max").alias("_n_battery"),
        F.max("_sleep_cut").alias("sleep_cut"),
        F.max("_stress_cut").alias("stress_cut"),
        (F.avg(F.when(sleep >= F.col("_sleep_cut"), on)) * 100).alias("long_sleep_hit_pct"),
        (F.avg(F.when(sleep < F.col("_sleep_cut"), on)) * 100).alias("short_sleep_hit_pct"),
        (F.avg(F.when(stress >= F.col("_stress_cut"), over)) * 100).alias("high_stress_over_pct"),
        (F.avg(F.when(stress < F.col("_stress_cut"), over)) * 100).alias("low_stress_over_pct"),
        F.avg(F.when(F.col("on_track"), F.col("w_steps"))).alias("on_track_steps"),
        F.avg(F.when(~F.col("on_track"), F.col("w_steps"))).alias("off_track_steps"),
        F.avg("w_body_battery_max").alias("peak_battery"),
    )
    sleep_ok = (
        (F.col("_n_sleep") >= min_values)
        & F.col("long_sleep_hit_pct").isNotNull() & F.col("short_sleep_hit_pct").isNotNull()
    )
    stress_ok = (
        (F.col("_n_stress") >= min_values)
        & F.col("high_stress_over_pct").isNotNull() & F.col("low_stress_over_pct").isNotNull()
    )
    steps_ok = (
        (F.col("_n_steps") >= min_values) & F.col("on_track_steps").isNotNull() & F.col("off_track_steps").isNotNull()
    )
    battery_ok = F.col("_n_battery") >= min_values
    keep = {
        "sleep_cut": sleep_ok, "long_sleep_hit_pct": sleep_ok, "short_sleep_hit_pct": sleep_ok,
        "stress_cut": stress_ok, "high_stress_over_pct": stress_ok, "low_stress_over_pct": stress_ok,
        "on_track_steps": steps_ok, "off_track_steps": steps_ok, "peak_battery": battery_ok,
    }
    return out.select(ENTITY, *(F.when(ok, F.col(c)).alias(c) for c, ok in keep.items()))


def insight_texts(insights: DataFrame) -> DataFrame:
    """Sentences per entity; presentation, last step."""
    lines = F.array(
        F.when(
            F.col("sleep_cut").isNotNull(),
            F.format_string(
                "Sleep: days of %.1f h or more met the target %.0f%% of the time, shorter ones %.0f%%",
                "sleep_cut", "long_sleep_hit_pct", "short_sleep_hit_pct",
            ),
        ),
        F.when(
            F.col("stress_cut").isNotNull(),
            F.format_string(
                "Stress: %.0f%% of higher-stress days went over target, %.0f%% of calmer days",
                "high_stress_over_pct", "low_stress_over_pct",
            ),
        ),
        F.when(
            F.col("on_track_steps").isNotNull(),
            F.format_string("Steps: %.0f on on-target days, %.0f otherwise", "on_track_steps", "off_track_steps"),
        ),
        F.when(F.col("peak_battery").isNotNull(), F.format_string("Recovery: mean daily peak battery %.0f", "peak_battery")),
    )
    kept = F.filter(lines, lambda t: t.isNotNull())
    fallback = F.array(F.lit("Too little wearable coverage for adherence insights"))
    return insights.select(ENTITY, F.posexplode(F.when(F.size(kept) > 0, kept).otherwise(fallback)).alias("pos", "text"))


def recent_macros(daily: DataFrame, rows: int = 30) -> DataFrame:
    """Mean grams and energy shares of the last rows."""
    cols = ["protein", "carbs", "fat", "protein_pct", "carbs_pct", "fat_pct"]
    return tail_rows(daily.select(ENTITY, DAY, *cols), rows).groupBy(ENTITY).agg(
        *(F.avg(c).alias(f"avg_{c}") for c in cols)
    )


# Windows of the key-figure table; the all-time column shows no expenditure.
KEY_WINDOWS = {"last_7": 7, "last_30": 30, "all_time": None}
KEY_FIGURES = [
    "avg_weight", "avg_intake", "tdee", "surplus", "trend_kg_week", "expected_kg_week", "discrepancy_kg_week",
    "protein_g", "fiber_g", "weekend_diff", "intake_cv_pct", "adherence_pct",
]


def key_figures(daily: DataFrame) -> DataFrame:
    """(entity, time window) rows with the twelve key figures.

    One pass: each window is a set of conditional aggregates over the rank from the end.
    """
    types = {"tdee_adaptive": "double", "weight_smoothed": "double", "on_track": "boolean"}
    rows = ensure_columns(daily, types).withColumn("_back", rank_from_end())
    aggs = []
    for label, size in KEY_WINDOWS.items():
        inside = F.lit(True) if size is None else F.col("_back") <= size

        def pick(c: Column | str) -> Column:
            return F.when(inside, F.col(c) if isinstance(c, str) else c)

        smooth_day = F.when(inside & F.col("weight_smoothed").isNotNull(), F.col(DAY))
        tdee_day = F.when(inside & F.col("tdee_adaptive").isNotNull(), F.col(DAY))
        weekend = sc.is_weekend(F.col(DAY))
        aggs += [
            F.avg(pick("weight")).alias(f"avg_weight__{label}"),
            F.avg(pick("energy")).alias(f"avg_intake__{label}"),
            F.max_by("tdee_adaptive", tdee_day).alias(f"tdee__{label}"),
            F.min_by("weight_smoothed", smooth_day).alias(f"s0__{label}"),
            F.max_by("weight_smoothed", smooth_day).alias(f"s1__{label}"),
            F.count(smooth_day).alias(f"sn__{label}"),
            F.min(pick(DAY)).alias(f"d0__{label}"),
            F.max(pick(DAY)).alias(f"d1__{label}"),
            F.avg(F.when(F.col("energy").isNotNull(), pick("protein"))).alias(f"protein_g__{label}"),
            F.avg(F.when(F.col("energy").isNotNull(), pick("fiber"))).alias(f"fiber_g__{label}"),
            F.avg(F.when(weekend, pick("energy"))).alias(f"we__{label}"),
            F.avg(F.when(~weekend, pick("energy"))).alias(f"wd__{label}"),
            variation_pct(pick("energy")).alias(f"intake_cv_pct__{label}"),
            (F.avg(pick(F.col("on_track").cast("double"))) * 100).alias(f"adherence_pct__{label}"),
        ]
    wide = rows.groupBy(ENTITY).agg(*aggs)
    cells = []
    for label, size in KEY_WINDOWS.items():
        c = lambda name: F.col(f"{name}__{label}")
        tdee = c("tdee") if size is not None else F.lit(None).cast("double")
        surplus = c("avg_intake") - tdee
        span = F.greatest(F.datediff(c("d1"), c("d0")), F.lit(1))
        trend = F.when(c("sn") >= 2, (c("s1") - c("s0")) / span * 7)
        expected = surplus / sc.KCAL_PER_KG * 7
        values = {
            "avg_weight": c("avg_weight"), "avg_intake": c("avg_intake"), "tdee": tdee, "surplus": surplus,
            "trend_kg_week": trend, "expected_kg_week": expected, "discrepancy_kg_week": trend - expected,
            "protein_g": c("protein_g"), "fiber_g": c("fiber_g"), "weekend_diff": c("we") - c("wd"),
            "intake_cv_pct": c("intake_cv_pct"), "adherence_pct": c("adherence_pct"),
        }
        cells.append(F.struct(F.lit(label).alias("time_window"), *(v.alias(k) for k, v in values.items())))
    return wide.select(ENTITY, F.inline(F.array(*cells)))


def key_figures_by_metric(figures: DataFrame) -> DataFrame:
    """Transposed: one row per metric, one column per window."""
    long = figures.unpivot([ENTITY, "time_window"], KEY_FIGURES, "figure", "value")
    cells = [F.max(F.when(F.col("time_window") == w, F.col("value"))).alias(w) for w in KEY_WINDOWS]
    return long.groupBy(ENTITY, "figure").agg(*cells)


def month_calendar(daily: DataFrame, columns: list[str]) -> DataFrame:
    """Cells of the entity's latest month: weekday row, week-of-month column, metric values."""
    daily = ensure_columns(daily, {c: "double" for c in columns})
    latest = F.max(month_start(F.col(DAY))).over(whole())
    cells = daily.withColumn("_latest", latest).filter(month_start(F.col(DAY)) == F.col("_latest"))
    return cells.select(
        ENTITY, DAY, F.dayofmonth(DAY).alias("day_of_month"), F.weekday(DAY).alias("weekday"),
        sc.week_of_month(F.col(DAY)).alias("week"), *columns,
    )
