"""Report datasets: each former page as tables a dashboard can read; nothing is drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, NUTRIENTS, tail_rows
from daypanel.functions import scalars as sc
from daypanel.functions.stats import rolling_mean
from daypanel.operators import correlate, energy, metrics, panel, regimes, rollup, sessions as ses, trend
from daypanel.operators.metrics import Goals

# Wearable columns of which any makes the wearable pages worthwhile.
WEARABLE_REPORT_COLUMNS = [
    "w_steps", "w_sleep_seconds", "w_avg_stress", "w_body_battery_max", "w_body_battery_min", "w_resting_hr",
    "w_moderate_min", "w_vigorous_min", "w_session_count",
]
CALENDAR_COLUMNS = ["weight_change", "w_sleep_score", "w_avg_stress", "w_steps"]


def enriched_daily(processed: DataFrame, goals: Goals = Goals()) -> DataFrame:
    """Processed table with prepared metrics, expenditure columns and per-entity estimates."""
    return energy.with_estimates(energy.energy_columns(metrics.prepare_metrics(processed, goals)))


def estimates_of(enriched: DataFrame) -> DataFrame:
    """The per-entity estimates back out of the enriched rows, without computing them again."""
    cols = [c for c in enriched.columns if c.startswith("est_")]
    return enriched.groupBy(ENTITY).agg(*(F.first(c, ignorenulls=True).alias(c[4:]) for c in cols))


def weight_report(enriched: DataFrame, goals: Goals) -> dict[str, DataFrame]:
    est = estimates_of(enriched)
    scenarios = trend.scenarios(enriched, goals.target_weight)
    low, high = sc.healthy_weight_range(goals.height_cm)
    trends = trend.weight_trends(enriched).join(trend.axis_limits(enriched, goals.target_weight), ENTITY)
    return {
        "weight_daily": enriched.select(ENTITY, DAY, "weight", "weight_smoothed", "bmi", sc.bmi_band(F.col("bmi")).alias("bmi_band")),
        "weight_trends": trends.withColumns({"healthy_low": F.lit(low), "healthy_high": F.lit(high)}),
        "weight_projection": trend.projection(enriched),
        "weight_scenarios": scenarios,
        "weight_scenario_paths": trend.scenario_paths(scenarios),
    }


def expenditure_report(enriched: DataFrame) -> dict[str, DataFrame]:
    """Rolling intake is taken over all rows, the trim to six months comes afterwards."""
    est = estimates_of(enriched)
    recent = tail_rows(enriched.select(ENTITY, DAY, "energy"), 30).groupBy(ENTITY).agg(F.avg("energy").alias("recent_intake"))
    rows = enriched.select(
        ENTITY, DAY, rolling_mean(F.col("energy"), 7, 1).alias("intake_7d"), "tdee_adaptive",
        F.col("est_weighted_average").alias("_best"),
    )
    line = panel.last_months(rows, 6).filter(F.col("_best").isNotNull()).drop("_best")
    line = line.withColumn("in_deficit", F.col("intake_7d") <= F.col("tdee_adaptive"))
    return {
        "expenditure_methods": energy.method_bars(est),
        "expenditure_advice": energy.recommendation_text(energy.recommendation(est.join(recent, ENTITY))),
        "expenditure_line": line,
    }


def macros_report(enriched: DataFrame) -> dict[str, DataFrame]:
    return {
        "macros_daily": enriched.select(
            ENTITY, DAY, "energy_avg_7", "energy_avg_30", "weight",
            rolling_mean(F.col("deficit"), 7, 1).alias("deficit_7d"),
            (rolling_mean(F.col("on_track").cast("double"), 7) * 100).alias("adherence_7d_pct"),
        ),
        "macros_recent": rollup.recent_macros(enriched),
    }


def correlation_report(enriched: DataFrame) -> dict[str, DataFrame]:
    bars = correlate.best_lag_bars(enriched, NUTRIENTS)
    return {
        "nutrient_lags": correlate.lagged_correlations(enriched, NUTRIENTS),
        "nutrient_best_lags": bars,
        "strongest_driver": correlate.strongest_driver_text(correlate.strongest_driver(bars)),
    }


def behaviour_report(enriched: DataFrame) -> dict[str, DataFrame]:
    return {
        "weekly_waterfall": rollup.waterfall(enriched),
        "change_histogram": rollup.weekend_histogram(enriched),
        "weekday_boxes": rollup.weekday_boxes(enriched),
        "weekday_stats": rollup.weekday_stats(enriched),
        "adherence_calendar": rollup.adherence_days(enriched),
        "adherence_counts": rollup.adherence_counts(enriched),
    }


def summary_report(enriched: DataFrame, goals: Goals) -> dict[str, DataFrame]:
    est = estimates_of(enriched).select(ENTITY, "weighted_average")
    status = trend.status_summary(enriched, goals).join(est, ENTITY, "left")
    status = status.join(rollup.weekend_difference(enriched).select(ENTITY, F.col("difference").alias("weekend_diff")), ENTITY)
    status = energy.recommendation(status).withColumn(
        "weekend_advice", F.when(F.abs("weekend_diff") > 300, "improve weekend consistency").otherwise("consistent")
    )
    top = correlate.nutrient_correlations(enriched, NUTRIENTS).filter("r is not null")
    strongest = top.groupBy(ENTITY).agg(
        F.max_by(F.struct("metric", "r"), F.struct(correlate.size(F.col("r")).alias("a"), F.col("metric"))).alias("t")
    ).select(ENTITY, F.col("t.metric").alias("strongest_nutrient"), F.col("t.r").alias("strongest_r"))
    figures = rollup.key_figures(enriched)
    return {
        "summary": status.join(strongest, ENTITY, "left"),
        "key_figures": rollup.key_figures_by_metric(figures),
    }


def weekly_report(enriched: DataFrame) -> dict[str, DataFrame]:
    weekly = rollup.weekly_table(enriched)
    return {
        "weekly_table": weekly.withColumn("week_label", sc.week_label(F.col("week"))),
        "velocity": enriched.select(ENTITY, DAY, "weight_velocity_7d", (F.col("weight_velocity_7d") <= 0).alias("losing")),
    }


def context_report(enriched: DataFrame, goals: Goals) -> dict[str, DataFrame]:
    recent = tail_rows(enriched, 42)
    mean = lambda c: rolling_mean(c, 7, 1)
    insights = rollup.adherence_insights(enriched, goals.target_energy)
    return {
        "wearable_available": panel.has_wearable_data(enriched, WEARABLE_REPORT_COLUMNS),
        "wearable_weekly_activity": rollup.weekly_activity(enriched),
        "wearable_recovery": recent.select(
            ENTITY, DAY, mean(F.col("w_sleep_seconds") / 3600.0).alias("sleep_hours_7d"),
            mean(F.col("w_avg_stress")).alias("stress_7d"), "w_body_battery_min", "w_body_battery_max",
            mean(F.col("w_body_battery_max")).alias("peak_battery_7d"),
            mean(F.col("w_resting_hr")).alias("resting_hr_7d"),
        ),
        "wearable_insights": rollup.insight_texts(insights),
    }


def adjusted_report(report: DataFrame) -> dict[str, DataFrame]:
    rows = report.select(
        ENTITY, DAY, rolling_mean(F.col("energy"), 7, 1).alias("intake_7d"), "tdee_adaptive", "activity_proxy",
        "activity_proxy_7d", "weight_smoothed",
    )
    return {
        "adjusted_daily": rows,
        "adjusted_regimes": regimes.activity_regime_runs(report),
        "adjusted_bias": regimes.bias_signal(report),
    }


def lag_report(report: DataFrame) -> dict[str, DataFrame]:
    """Recent matrices see the last 30 rows only, all-time ones every row; both come from one pass."""
    targets = {"change": "weight_change", "trend": "trend_change_7d"}
    both = correlate.lag_correlations_of(report, correlate.LAG_METRICS, targets, LAG_PARTS, 7)
    tables = {
        f"lag_{name}_{target}": correlate.lag_matrix(both.filter((F.col("part") == part) & (F.col("target") == target)))
        for name, part in (("all", "all_time"), ("recent", "recent")) for target in targets
    }
    return tables | {"lag_summary": lag_summary(report)}


# Spans of the lag report: how many of the last rows, and how many pairs a value needs.
LAG_PARTS = {"all_time": (None, 11), "recent": (30, 5)}


def lag_summary(report: DataFrame, target: str = "weight_change", parts: dict | None = None) -> DataFrame:
    """The best lag of every metric over all rows and over the recent ones, side by side, in one pass."""
    parts = parts or LAG_PARTS
    corr = correlate.lag_correlations_of(report, correlate.LAG_METRICS, {target: target}, parts, 7)
    return correlate.best_lags_of(corr, list(parts))


def wearable_pages(report: DataFrame, sessions: DataFrame) -> dict[str, DataFrame]:
    outliers = regimes.outlier_days(report)
    return {
        "spikes": regimes.largest_outliers(outliers, 10),
        "recovery_scatter": regimes.recovery_scatter(report),
        "weekly_decision": rollup.weekly_decision(report),
        "session_groups": ses.group_contribution(sessions, report),
        "session_week_pivot": ses.group_week_pivot(sessions),
        "session_table": ses.newest_sessions(sessions, report, 8),
        "regimes": regimes.regime_table(report),
        "recovery_boxes": regimes.recovery_boxes(report),
        "month_calendar": rollup.month_calendar(report, CALENDAR_COLUMNS),
        "coverage": rollup.coverage_by_month(report, sessions),
    }


def goal_report(enriched: DataFrame, goals: Goals) -> dict[str, DataFrame]:
    progress = trend.goal_progress(enriched, goals.target_weight)
    burn = trend.burndown(enriched)
    return {
        "goal_progress": progress,
        "goal_change": trend.cumulative_change(enriched),
        "goal_burndown": burn,
        "goal_targets": trend.burndown_state(enriched, goals.target_weight),
    }


def report_tables(enriched: DataFrame, report: DataFrame, sessions: DataFrame, goals: Goals = Goals()) -> dict[str, DataFrame]:
    """All datasets of the report from the enriched panel and its wearable extension.

    Both inputs feed many outputs: pass them materialised (``plans.jobs.materialise``).
    """
    return {
        **weight_report(enriched, goals),
        **expenditure_report(enriched),
        **macros_report(enriched),
        **correlation_report(enriched),
        **behaviour_report(enriched),
        **summary_report(enriched, goals),
        **weekly_report(enriched),
        **context_report(report, goals),
        **adjusted_report(report),
        **lag_report(report),
        **wearable_pages(report, sessions),
        **goal_report(enriched, goals),
    }


def build_report(processed: DataFrame, sessions: DataFrame, root: str, goals: Goals = Goals()) -> dict[str, str]:
    """The whole report job: enrich once, write every dataset."""
    from daypanel.plans.jobs import materialise
    from daypanel.sources.sinks import write_report

    enriched = materialise(enriched_daily(processed, goals), "enriched")
    report = materialise(ses.report_inputs(enriched, sessions), "report")
    return write_report(report_tables(enriched, report, sessions, goals), root)
