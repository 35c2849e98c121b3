import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypanel.operators import metrics, regimes, rollup, sessions as ses, trend
from tests.conftest import ordered, series


def test_first_value_skips_nulls_first_row_does_not(spark):
    df = series(spark, {"weight": [None, 80.0, 81.0, None], "energy": [1.0] * 4, "on_track": [True] * 4})
    row = rollup.weekly_table(df).first()
    assert (row["weight_start"], row["weight_end"]) == (None, None)
    row = rollup.weekly_decision(df).first()
    assert (row["week_start_weight"], row["week_end_weight"], row["adherence_flag"]) == (80.0, 81.0, "on track")
    assert row["total_active_kcal"] == 0.0


def test_newest_weeks_only(spark):
    df = series(spark, {"weight": [80.0 + i for i in range(140)], "energy": [1.0] * 140, "on_track": [True] * 140})
    assert rollup.weekly_table(df, 8).count() == 8
    falls = rollup.waterfall(df).orderBy("week").collect()
    assert len(falls) == 16 and falls[-1]["cumulative"] == 6.0 * 20


def test_weekday_stats_always_seven_rows(spark):
    got = rollup.weekday_stats(series(spark, {"energy": [100.0, None]})).orderBy("day_num").collect()
    assert [r["day_name"] for r in got] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert [r["days"] for r in got] == [1, 1, 0, 0, 0, 0, 0]
    assert got[0]["mean"] == 100.0 and got[1]["mean"] is None


def test_variation_needs_two_values(spark):
    assert rollup.intake_variation(series(spark, {"energy": [5.0]})).first()["cv_pct"] is None
    assert rollup.intake_variation(series(spark, {"energy": [2000.0] * 5})).first()["cv_pct"] == 0.0


def test_histogram_holds_every_row(spark):
    df = series(spark, {"weight_change": [float(i) for i in range(30)]})
    got = rollup.weekend_histogram(df).agg(F.sum(F.col("weekday_days") + F.col("weekend_days")), F.max("bin")).first()
    assert tuple(got) == (30, 29)
    same = rollup.weekend_histogram(series(spark, {"weight_change": [1.0, 1.0]})).collect()
    assert len(same) == 1 and same[0]["weekday_days"] == 2


def test_key_figures_windows(spark):
    n = 40
    df = series(spark, {
        "energy": [2000.0] * n, "weight": [80.0] * n, "protein": [100.0] * n, "fiber": [25.0] * n, "on_track": [True] * n,
        "weight_smoothed": [80 - 0.1 * i for i in range(n)], "tdee_adaptive": [2300.0] * n,
    })
    got = {r["time_window"]: r for r in rollup.key_figures(df).collect()}
    assert got["all_time"]["tdee"] is None and got["last_7"]["tdee"] == 2300.0
    assert got["last_30"]["trend_kg_week"] == pytest.approx(-0.7)
    assert got["last_7"]["surplus"] == -300 and got["last_7"]["expected_kg_week"] == pytest.approx(-0.3)
    assert got["last_30"]["adherence_pct"] == 100.0
    assert rollup.key_figures_by_metric(rollup.key_figures(df)).count() == 12


def test_coverage(spark):
    df = series(spark, {"weight": [80.0, None], "w_hrv": [50.0, 51.0]})
    sessions = spark.createDataFrame([("a", dt.date(2024, 1, 1))] * 3, "entity string, day date")
    row = rollup.coverage_by_month(df, sessions).first()
    assert (row["weight_pct"], row["hrv_pct"], row["sleep_pct"], row["session_pct"]) == (50.0, 100.0, 0.0, 50.0)


def test_insights_need_six_values(spark):
    few = series(spark, {"energy": [1900.0] * 5, "w_steps": [1.0] * 5})
    rows = rollup.insight_texts(rollup.adherence_insights(few, 2000.0)).collect()
    assert len(rows) == 1 and rows[0]["text"].startswith("Too little")
    many = series(spark, {"energy": [1900.0, 2100.0] * 5, "w_steps": [10.0, 20.0] * 5})
    row = rollup.adherence_insights(many, 2000.0).first()
    assert (row["on_track_steps"], row["off_track_steps"]) == (10.0, 20.0)


def test_regimes_always_nine_rows(spark):
    df = series(spark, {"energy": [1.0, 2.0, 3.0], "weight_change": [0.1, 0.2, None], "w_steps": [1.0, 2.0, None]})
    got = {r["regime"]: r for r in regimes.regime_table(df).collect()}
    assert len(got) == 9 and got["high step days"]["days"] == 1 and got["low step days"]["days"] == 1
    assert got["sleep <6h"]["days"] == 0 and got["sleep <6h"]["mean_intake"] is None


def test_outlier_tag_and_threshold(spark):
    n = 20
    df = series(spark, {
        "weight_change": [0.1] * 10 + [0.9] + [0.1] * 9, "carbs": [100.0] * 10 + [400.0] + [100.0] * 9, "sodium": [1.0] * n,
    })
    row = regimes.outlier_days(df).collect()
    assert len(row) == 1 and row[0]["tag"] == "activity load" and row[0]["sodium_z"] is None
    with_steps = df.withColumn("w_steps", F.lit(5.0)).withColumn("w_avg_stress", F.dayofmonth("day").cast("double"))
    with_steps = with_steps.withColumn("w_active_kcal", F.dayofmonth("day") * 1.0)
    assert regimes.outlier_days(with_steps).first()["tag"] == "glycogen / sodium / hydration"
    assert regimes.outlier_days(df, 2.0).count() == 0


def test_runs_of_at_least_four(spark):
    df = series(spark, {"s": ["h"] * 4 + ["l"] * 3 + ["h"] * 5})
    got = regimes.state_runs(df, "s").orderBy("start_day").collect()
    assert [(r["s"], r["days"]) for r in got] == [("h", 4), ("h", 5)]


def test_median_halves_put_missing_into_low(spark):
    df = series(spark, {"w_avg_stress": [1.0] * 4 + [9.0] * 4 + [None] * 2, "weight_change": [0.1 * i for i in range(10)]})
    got = {r["bin"]: r["n"] for r in regimes.recovery_boxes(df).collect()}
    assert got == {"High": 4, "Low": 6}


def test_session_summaries(spark):
    rows = [
        ("a", dt.date(2024, 1, 1), 1, "running", 30.0, 300.0, 140.0, 170.0), ("a", dt.date(2024, 1, 1), None, "walking", None, None, None, 150.0),
        ("a", dt.date(2024, 1, 2), 2, "walking", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "entity string, day date, session_id long, session_type string, duration_min double, kcal double, avg_hr double, max_hr double")
    assert ordered(ses.session_daily(df), "w_session_min", "w_session_avg_hr", "w_session_max_hr") == [(30.0, 140.0, 170.0), (0.0, None, None)]
    daily = series(spark, {"weight_change": [0.5, None], "energy": [2000.0, 2100.0]})
    groups = {r["session_group"]: r for r in ses.group_contribution(df, daily).collect()}
    assert groups["walks"]["sessions"] == 1 and groups["walks"]["next_day_change"] == 0.5 and groups["runs"]["average_hr"] == 140.0
    table = ses.newest_sessions(df, daily, 2).orderBy("position").collect()
    assert [r["day"].day for r in table] == [2, 1] and table[1]["same_day_intake"] == 2000.0
    pivot = ses.group_week_pivot(df).first()
    assert pivot["kcal_runs"] == 300.0 and pivot["kcal_cycling"] == 0.0


def test_activity_proxy_switches_for_the_whole_series(spark):
    base = {"weight_smoothed": [80.0] * 2, "w_steps": [1000.0, None], "w_moderate_min": [10.0, None]}
    df = series(spark, {**base, "w_active_kcal": [None, 5.0]}, "a").unionByName(
        series(spark, {**base, "w_active_kcal": [None, None]}, "b").withColumn("w_active_kcal", F.col("w_active_kcal").cast("double"))
    )
    assert ordered(ses.report_inputs(df), "activity_proxy") == [None, 5.0, 90.0, 0.0]


def test_goal_progress(spark):
    df = series(spark, {"weight": [80 - 0.1 * i for i in range(31)], "weight_smoothed": [80 - 0.1 * i for i in range(31)]})
    row = trend.goal_progress(df, 75.0).first()
    assert row["status"] == "On Track" and row["complete"] == pytest.approx(0.6) and row["days_to_goal"] == pytest.approx(20)
    assert row["goal_day"] in (dt.date(2024, 2, 19), dt.date(2024, 2, 18))
    assert trend.goal_progress(df, 85.0).first()["status"] == "Off Track"
    flat = series(spark, {"weight": [80.0] * 5, "weight_smoothed": [80.0] * 5})
    assert trend.goal_progress(flat, 75.0).first()["status"] == "Stalled"


def test_projection_and_scenarios(spark):
    df = series(spark, {"weight": [80.0] * 40, "weight_smoothed": [80 - 0.1 * i for i in range(40)], "energy": [2000.0] * 40})
    rows = trend.projection(df).orderBy("day").collect()
    assert len(rows) == 90 and rows[0]["projected"] == pytest.approx(76.0) and rows[0]["lower"] == pytest.approx(76.0)
    est = spark.createDataFrame([("a", 2500.0)], "entity string, weighted_average double")
    got = {r["scenario"]: r for r in trend.scenario_summary(df, est, 75.0).collect()}
    assert len(got) == 4 and got["standard"]["days_to_target"] == pytest.approx(1.1 / (500 / 7000))
    assert got["current average"]["kcal"] == 2000.0
    assert trend.scenario_paths(trend.scenario_summary(df, est, 75.0)).count() == 360


def test_axis_limits_without_weights(spark):
    df = series(spark, {"weight": [None]}).withColumn("weight", F.col("weight").cast("double"))
    assert tuple(trend.axis_limits(df, 70.0).first())[1:] == (60.0, 80.0)


def test_prepared_metrics_zero_guards(spark):
    df = series(spark, {"energy": [0.0, 2000.0], "weight": [0.0, 80.0], "protein": [10.0, 100.0], "carbs": [1.0, 1.0], "fat": [1.0, 1.0]})
    rows = metrics.prepare_metrics(df).orderBy("day").collect()
    assert rows[0]["protein_pct"] is None and rows[0]["protein_per_kg"] is None
    assert rows[1]["protein_pct"] == 20.0 and rows[1]["on_track"] is True and rows[0]["weekday"] == 0
