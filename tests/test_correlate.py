import numpy as np
import pytest

from daypanel.operators import correlate
from tests.conftest import series


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=30), rng.normal(size=30)
    change = np.roll(x, 2) * 0.8 + rng.normal(size=30) * 0.2
    return {"energy": x.tolist(), "carbs": y.tolist(), "fat": [5.0] * 30, "weight_change": [*change.tolist()[:-1], None]}


def by_metric(df):
    return {r["metric"]: r for r in df.collect()}


def test_constant_metric_has_no_correlation(spark, frame):
    got = by_metric(correlate.nutrient_correlations(series(spark, frame), ["energy", "carbs", "fat"]))
    assert got["fat"]["r"] is None and got["fat"]["significant"] is False
    x, y = np.array(frame["energy"][:-1]), np.array(frame["weight_change"][:-1])
    assert got["energy"]["r"] == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_lag_finds_the_delay(spark, frame):
    corr = correlate.lag_correlations(series(spark, frame), ["energy", "carbs"], max_lag=3, min_pairs=11)
    best = by_metric(correlate.best_lags(corr))
    assert best["energy"]["best_lag"] == 2 and best["energy"]["sign"] == "positive"
    assert best["energy"]["sample_size"] == 27


def test_too_few_pairs(spark):
    df = series(spark, {"energy": [1.0, 2.0, 4.0], "weight_change": [1.0, 2.0, 1.0]})
    assert correlate.correlation_intervals(df, ["energy"]).count() == 0
    assert correlate.nutrient_correlations(df, ["energy"]).count() == 1
    assert correlate.lagged_correlations(df, ["energy"]).filter("r is not null").count() == 0


def test_interval_contains_r_and_widens(spark, frame):
    df = series(spark, frame)
    narrow = by_metric(correlate.correlation_intervals(df, ["energy", "carbs"], 0.90))
    wide = by_metric(correlate.correlation_intervals(df, ["energy", "carbs"], 0.99))
    for m in narrow:
        assert wide[m]["ci_low"] < narrow[m]["ci_low"] < narrow[m]["r"] < narrow[m]["ci_high"] < wide[m]["ci_high"]


def test_absent_metric_gives_an_empty_row(spark, frame):
    corr = correlate.lag_correlations(series(spark, frame), {"HRV": "w_hrv"}, max_lag=7, min_pairs=11)
    row = correlate.best_lags(corr).first()
    assert (row["best_lag"], row["sign"], row["sample_size"]) == (None, "na", 0)
    assert correlate.lag_matrix(corr).columns[2:] == [f"lag_{k}" for k in range(8)]


def test_best_lag_keeps_same_day_interval(spark, frame):
    bars = by_metric(correlate.best_lag_bars(series(spark, frame), ["energy", "carbs", "fat"]))
    row = bars["energy"]
    assert row["best_lag"] == 2 and row["ci_low"] < row["best_r"] < row["ci_high"]
    assert row["ci_low_lag0"] < row["r_lag0"] < row["ci_high_lag0"]
    assert bars["fat"]["best_lag"] is None
    top = correlate.strongest_driver_text(correlate.strongest_driver(correlate.best_lag_bars(series(spark, frame), ["energy", "carbs"]))).first()
    assert top["nutrient"] in ("energy", "carbs") and top["nutrient"] in top["sentence"]
