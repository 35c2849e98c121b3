import datetime as dt
import math

from pyspark.sql import functions as F

from daypanel.operators import energy, metrics, panel
from daypanel.operators.metrics import Goals
from daypanel.plans import report
from tests.conftest import series


def processed(spark, n=60, entity="a"):
    wave = lambda a, b, k: [a + b * math.sin(i / k) for i in range(n)]
    return panel.finish_daily(series(spark, {
        "energy": wave(2100, 200, 3), "protein": wave(110, 20, 4), "carbs": wave(220, 60, 2), "fat": wave(70, 10, 5), "fiber": wave(25, 5, 3),
        "sodium": wave(2300, 500, 6), "water": wave(2000, 300, 7), "weight": [82 - 0.02 * i + 0.4 * math.sin(i / 2) for i in range(n)],
        "w_steps": wave(8000, 3000, 3), "w_active_kcal": wave(400, 150, 4), "w_sleep_seconds": wave(26000, 4000, 5), "w_sleep_score": wave(78, 8, 3),
        "w_avg_stress": wave(30, 8, 2), "w_resting_hr": wave(54, 3, 6), "w_hrv": wave(55, 9, 4), "w_body_battery_max": wave(85, 8, 3),
        "w_body_battery_min": wave(20, 5, 5), "w_moderate_min": wave(20, 10, 3), "w_vigorous_min": wave(10, 5, 4),
    }, entity))


def sessions(spark):
    kinds = ["running", "walking", "strength_training", "cycling"]
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=2 * i), 100 + i, kinds[i % 4], 30.0 + i, 250.0 + i, 130.0, 165.0) for i in range(18)]
    return spark.createDataFrame(rows, "entity string, day date, session_id long, session_type string, duration_min double, kcal double, avg_hr double, max_hr double")


def test_build_report_writes_every_dataset(spark, tmp_path):
    paths = report.build_report(processed(spark), sessions(spark), str(tmp_path))
    assert len(paths) >= 45
    counts = {name: spark.read.parquet(p).count() for name, p in paths.items()}
    assert all(n > 0 for name, n in counts.items() if name not in ("adjusted_regimes", "spikes", "weight_scenario_paths")), counts
    assert counts["regimes"] == 9 and counts["key_figures"] == 12 and counts["weekly_decision"] == 8 and counts["session_table"] == 8
    assert counts["lag_all_change"] == 12 and counts["lag_summary"] == 12


def test_six_months_are_cut_after_rolling(spark):
    days = processed(spark, 365).withColumn("energy", F.col("energy") + 1)
    rows = energy.with_estimates(energy.energy_columns(metrics.prepare_metrics(days, Goals())))
    line = report.expenditure_report(rows)["expenditure_line"]
    first = line.agg(F.min("day")).first()[0]
    assert first == dt.date(2024, 6, 30)
    assert line.filter(F.col("day") == F.lit(first)).first()["intake_7d"] is not None
