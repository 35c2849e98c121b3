from decimal import Decimal, localcontext

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from daypanel.functions import scalars as sc
from daypanel.functions.stats import corr_p_value, drop_blocks, ewm, rank_quartile, rolling_mean, with_blocks
from tests.conftest import ordered, series


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_bmi_band_limits(spark):
    got = one(spark, **{f"b{i}": sc.bmi_band(F.lit(v)) for i, v in enumerate((18.4, 18.5, 25.0, 30.0))})
    assert list(got) == ["Underweight", "Normal", "Overweight", "Obese"]


@pytest.mark.parametrize(
    "kind, cardio, group",
    [
        ("Trail_Running", False, "runs"), ("dog walk", False, "walks"), ("hiking", False, "walks"), ("indoor_cycling", False, "cycling"),
        ("road_biking", False, "cycling"), ("weight lifting", False, "gym/resistance training"), ("cardio", False, "other"),
        ("cardio", True, "gym/resistance training"), (None, True, "other"), ("  ", False, "other"),
    ],
)
def test_session_group(spark, kind, cardio, group):
    assert one(spark, g=sc.session_group(F.lit(kind).cast("string"), cardio))["g"] == group


def test_week_label_is_the_sunday(spark):
    assert one(spark, w=sc.week_label(F.lit("2024-01-29").cast("date")))["w"] == "02-04"


def test_fixed_and_cell_text(spark):
    got = one(
        spark, a=sc.fixed_text(F.lit(2.345), 2, True), b=sc.fixed_text(F.lit(None).cast("double")),
        c=sc.cell_text(F.lit(12345.6), "number"), d=sc.cell_text(F.lit(12.6), "number"), e=sc.cell_text(F.lit(1.234), "number"),
        f=sc.cell_text(F.lit("abcdefgh"), "text", 5), g=sc.cell_text(F.lit(None).cast("string"), "text"), h=sc.cell_text(F.lit(True), "bool"),
    )
    assert list(got) == ["+2.35", "--", "12,346", "13", "1.23", "abcd…", "--", "Yes"]


def test_timestamps(spark):
    got = one(
        spark,
        a=sc.any_timestamp(F.lit(1704067200000.0), F.lit(None).cast("string")).cast("string"),
        b=sc.any_timestamp(F.lit(1704067200.0), F.lit(None).cast("string")).cast("string"),
        c=sc.any_timestamp(F.lit(None).cast("double"), F.lit("2024-01-01T02:00:00+02:00")).cast("string"),
        d=sc.any_timestamp(F.lit(None).cast("double"), F.lit("junk")).cast("string"),
        e=sc.any_timestamp(F.lit(None).cast("double"), F.lit("2024-01-01T00:00:00.0")).cast("string"),
    )
    assert list(got) == ["2024-01-01 00:00:00"] * 3 + [None, "2024-01-01 00:00:00"]


def test_first_truthy_skips_zero_but_keeps_a_last_zero(spark):
    zero, none, five = F.lit(0.0), F.lit(None).cast("double"), F.lit(5.0)
    got = one(spark, a=sc.first_truthy(zero, none, five), b=sc.first_truthy(none, zero), c=sc.first_truthy(zero, none))
    assert list(got) == [5.0, 0.0, None]


def test_week_of_month(spark):
    days = ["2024-01-01", "2024-01-07", "2024-01-08", "2024-09-01", "2024-09-02"]
    got = one(spark, **{f"d{i}": sc.week_of_month(F.lit(d).cast("date")) for i, d in enumerate(days)})
    assert list(got) == [0, 0, 1, 0, 1]


def weights(n, holes, seed=1):
    rng = np.random.default_rng(seed)
    x = 80 + rng.normal(0, 1, n).cumsum() * 0.1
    return [None if i in holes else float(v) for i, v in enumerate(x)]


@pytest.mark.parametrize("span, least, block", [(10, 3, 1000), (10, 3, 220), (14, 7, 300)])
def test_ewm_equals_pandas(spark, span, least, block):
    holes = {0, 1, 7, 8, 9, *range(250, 290), *range(430, 890), 1199}
    x = weights(1200, holes)
    df = drop_blocks(ewm(with_blocks(series(spark, {"x": x}), block), "x", "e", span, least, block))
    got = ordered(df, "e")
    want = pd.Series(x, dtype=float).ewm(span=span, min_periods=least).mean()
    assert [v is None for v in got] == want.isna().tolist()
    assert np.allclose([v for v in got if v is not None], want.dropna(), rtol=0, atol=1e-10)


def test_ewm_rejects_blocks_out_of_range(spark):
    with pytest.raises(ValueError):
        ewm(with_blocks(series(spark, {"x": [1.0]})), "x", "e", 10, 3, 100)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(x=st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=1, max_size=25), size=st.integers(1, 9))
def test_rolling_mean_equals_pandas(spark, x, size):
    df = series(spark, {"x": x}).withColumn("x", F.col("x").cast("double"))
    got = ordered(df.select("entity", "day", rolling_mean(F.col("x"), size, 1).alias("m")), "m")
    want = pd.Series(x, dtype=float).rolling(size, min_periods=1).mean()
    for g, w in zip(got, want):
        assert (g is None) == bool(np.isnan(w)) and (g is None or math.isclose(g, w, abs_tol=1e-9))


def p_by_integration(r, n):
    """Two-sided p-value by integrating the density of r, proportional to (1 - r^2)^((n - 4) / 2)."""
    area = lambda top: np.trapezoid(np.cos(t := np.linspace(0, top, 200_001)) ** (n - 3), t)
    return 1 - area(np.arcsin(abs(r))) / area(np.pi / 2)


@pytest.mark.parametrize("r, n", [(0.5, 10), (-0.3, 11), (0.9, 4), (0.2, 3), (0.05, 500), (-0.12, 777)])
def test_p_value(spark, r, n):
    got = one(spark, p=corr_p_value(F.lit(r), F.lit(n)))["p"]
    assert got == pytest.approx(p_by_integration(r, n), abs=1e-8)


def test_p_value_edges(spark):
    got = one(
        spark, a=corr_p_value(F.lit(1.0), F.lit(5)), b=corr_p_value(F.lit(0.4), F.lit(2)), c=corr_p_value(F.lit(None).cast("double"), F.lit(9)),
        e=corr_p_value(F.lit(0.01), F.lit(200_000)),
    )
    assert got["a"] == 0.0 and got["b"] is None and got["c"] is None
    assert 0 < got["e"] < 1e-4


def exact_p(r: str, n: int) -> Decimal:
    """The finite series for an even number of degrees of freedom, with 260 digits."""
    with localcontext() as ctx:
        ctx.prec = 260
        sin = Decimal(r)
        cos2, term, total = 1 - sin * sin, Decimal(1), Decimal(1)
        for k in range(1, (n - 2) // 2):
            term *= Decimal(2 * k - 1) / Decimal(2 * k) * cos2
            total += term
        return 1 - sin * total


def arctan(x: Decimal) -> Decimal:
    """Halving the angle eight times, then its power series."""
    for _ in range(8):
        x = x / (1 + (1 + x * x).sqrt())
    term, total, k = x, x, 1
    while abs(term) > Decimal(10) ** -200:
        term *= -x * x
        k += 2
        total += term / k
    return total * 256


def exact_p_odd(r: str, n: int) -> Decimal:
    """The finite series for an odd number of degrees of freedom, with 190 digits."""
    with localcontext() as ctx:
        ctx.prec = 200
        sin = Decimal(r)
        cos = (1 - sin * sin).sqrt()
        term, total = cos, cos if n > 3 else Decimal(0)
        for k in range(1, (n - 3) // 2):
            term *= Decimal(2 * k) / Decimal(2 * k + 1) * cos * cos
            total += term
        return 1 - (arctan(sin / cos) + sin * total) / (2 * arctan(Decimal(1)))


@pytest.mark.parametrize("r", ["0.0003", "0.02", "0.2", "0.5", "0.7", "0.71", "0.9", "0.95", "0.9486", "0.9999"])
@pytest.mark.parametrize("n", [3, 5, 7, 11, 25, 99, 1001, 20_001])
def test_p_value_odd_degrees(spark, r, n):
    want = float(exact_p_odd(r, n))
    if 0.0 < want and (want > 1e-180 or n < 1000):
        assert one(spark, p=corr_p_value(F.lit(float(r)), F.lit(n)))["p"] == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("r", ["0.0001", "0.00123", "0.0025", "0.01"])
def test_p_value_of_a_million_pairs(spark, r):
    got = one(spark, p=corr_p_value(F.lit(float(r)), F.lit(1_000_000)))["p"]
    assert got == pytest.approx(float(exact_p(r, 1_000_000)), rel=1e-9)


@pytest.mark.parametrize("r, n", [
    ("0.9", 200), ("0.4", 1000), ("0.03", 100_000), ("0.03", 100_002), ("0.001", 100_000), ("0.5", 6), ("0.95", 10), ("0.99", 102), ("0.1", 40_000),
    ("0.6", 12), ("0.02", 22_500), ("0.021", 22_500), ("0.3", 102), ("0.0001", 50),
])
def test_p_value_relative(spark, r, n):
    got = one(spark, p=corr_p_value(F.lit(float(r)), F.lit(n)))["p"]
    assert got == pytest.approx(float(exact_p(r, n)), rel=1e-9)


@pytest.mark.parametrize("n", [8, 9, 10, 13, 50, 101])
def test_rank_quartile_equals_qcut(spark, n):
    df = spark.range(1, n + 1).select(F.col("id"), rank_quartile(F.col("id"), F.lit(n)).alias("q")).orderBy("id")
    want = pd.qcut(pd.Series(range(1, n + 1)), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
    assert [r["q"] for r in df.collect()] == want
