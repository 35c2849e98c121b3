"""The rules with their default windows and counts over years of days with gaps."""

from __future__ import annotations

from checks.queries import GOALS, query
from daypanel.operators import correlate, energy, metrics, panel, regimes, rollup, sessions as ses
from daypanel.plans import panels, report


def prepared(spark, sf_dir):
    return metrics.prepare_metrics(panel.finish_daily(panels.long_days(spark, sf_dir)), GOALS)


def with_energy(spark, sf_dir):
    return energy.energy_columns(prepared(spark, sf_dir))


def wearable_report(spark, sf_dir):
    return ses.report_inputs(with_energy(spark, sf_dir), panels.long_sessions(spark, sf_dir))


@query("weekly_table_long", 5)
def weekly_table_long(spark, sf_dir):
    return rollup.weekly_table(with_energy(spark, sf_dir))


@query("weekly_decision_long", 5)
def weekly_decision_long(spark, sf_dir):
    return rollup.weekly_decision(wearable_report(spark, sf_dir))


@query("weekly_activity_long")
def weekly_activity_long(spark, sf_dir):
    return rollup.weekly_activity(panels.long_days(spark, sf_dir))


@query("session_week_pivot_long")
def session_week_pivot_long(spark, sf_dir):
    return ses.group_week_pivot(panels.long_sessions(spark, sf_dir))


@query("coverage_month_long")
def coverage_month_long(spark, sf_dir):
    return rollup.coverage_by_month(panels.long_days(spark, sf_dir), panels.long_sessions(spark, sf_dir))


@query("adherence_insights_long")
def adherence_insights_long(spark, sf_dir):
    return rollup.adherence_insights(prepared(spark, sf_dir), GOALS.target_energy)


@query("bias_signal_long")
def bias_signal_long(spark, sf_dir):
    return regimes.bias_signal(wearable_report(spark, sf_dir))


@query("lag_matrix_long", 5)
def lag_matrix_long(spark, sf_dir):
    return correlate.lag_matrix(correlate.lag_correlations(wearable_report(spark, sf_dir), correlate.LAG_METRICS, "trend_change_7d", 7, 11))


@query("lag_summary_long")
def lag_summary_long(spark, sf_dir):
    return report.lag_summary(wearable_report(spark, sf_dir))
