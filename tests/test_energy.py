import numpy as np
import pandas as pd
import pytest

from daypanel.operators import energy
from tests.conftest import ordered, series


def estimates(spark, kcal, kg):
    return energy.estimates(energy.energy_columns(series(spark, {"energy": kcal, "weight": kg}))).first()


def test_constant_weight_stays_constant(spark):
    days = energy.smooth_weight(series(spark, {"weight": [80.0] * 20, "energy": [1.0] * 20}))
    got = ordered(days, "weight_smoothed")
    assert got[:2] == [None, None] and all(abs(v - 80) < 1e-9 for v in got[2:])


def test_stable_weight_gives_intake(spark):
    est = estimates(spark, [2500.0] * 60, [80.0] * 60)
    for method in ("adaptive", "rolling_30d", "stable_periods", "recent_30d", "weighted_average"):
        assert est[method] == pytest.approx(2500, abs=1e-6)
    assert est["stable_periods_count"] == 60 - 14 + 1
    assert est["regression"] is None


def test_losing_weight_raises_the_estimate(spark):
    est = estimates(spark, [2000.0] * 60, [80 - 0.5 * i / 7 for i in range(60)])
    assert 2100 < est["weighted_average"] < 2600


def test_implausible_estimates_are_left_out(spark):
    est = estimates(spark, [9000.0] * 60, [80.0] * 60)
    assert est["adaptive"] is None and est["weighted_average"] is None


def test_methods_equal_a_row_by_row_computation(spark):
    rng = np.random.default_rng(3)
    kcal = rng.normal(2200, 250, 75).round(1)
    kg = (82 + rng.normal(0, 0.4, 75) - np.arange(75) * 0.02).round(2)
    rows = energy.energy_columns(series(spark, {"energy": kcal.tolist(), "weight": kg.tolist()}))
    sm = pd.Series(kg).ewm(span=10, min_periods=3).mean()
    delta = sm.diff()
    adaptive = (pd.Series(kcal) - delta * 7000).ewm(span=14, min_periods=7).mean()
    got = pd.Series(ordered(rows, "tdee_adaptive"), dtype=float)
    assert np.allclose(got, adaptive, equal_nan=True, atol=1e-6)
    for window, least, column in ((14, 7, "tdee_14d"), (30, 14, "tdee_30d")):
        want = []
        for i in range(75):
            lo = max(0, i - window + 1)
            short = i - lo + 1 < least
            want.append(np.nan if short else kcal[lo : i + 1].mean() - delta[lo : i + 1].mean() * 7000)
        assert np.allclose(pd.Series(ordered(rows, column), dtype=float), want, equal_nan=True, atol=1e-6)
    stable = []
    for i in range(75 - 13):
        w = sm[i : i + 14]
        if w.max() - w.min() <= 0.5:
            stable.append(kcal[i : i + 14].mean())
    got = energy.stable_estimate(rows).first()
    assert got["stable_periods_count"] == len(stable) and got["stable_periods"] == pytest.approx(np.mean(stable))
    ok = ~delta.isna()
    slope, icept = np.polyfit(kcal[ok], delta[ok], 1)
    reg = energy.regression_estimate(rows).first()
    want = -icept / slope
    assert (reg["regression"] is None and not 1000 < want < 5000) or reg["regression"] == pytest.approx(want)


def test_one_entity_alone_equals_its_slice(spark):
    a = series(spark, {"energy": [2000.0 + i for i in range(40)], "weight": [80 + (i % 5) * 0.1 for i in range(40)]}, "a")
    b = series(spark, {"energy": [2500.0 - i for i in range(50)], "weight": [70 + (i % 3) * 0.2 for i in range(50)]}, "b")
    both = energy.estimates(energy.energy_columns(a.unionByName(b))).filter("entity = 'a'").first()
    assert both == energy.estimates(energy.energy_columns(a)).first()


def test_recommendation_limits(spark):
    rows = spark.createDataFrame([("a", 2500.0, 2701.0), ("b", 2500.0, 2299.0), ("c", 2500.0, 2600.0), ("d", None, 2000.0)],
                                 "entity string, weighted_average double, recent_intake double")
    got = {r["entity"]: r["advice"] for r in energy.recommendation(rows).collect()}
    assert got == {"a": "reduce", "b": "in deficit", "c": "maintenance", "d": None}
    assert energy.recommendation_text(energy.recommendation(rows)).count() == 4
