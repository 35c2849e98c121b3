import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daypanel.core import ensure_columns, numeric
from daypanel.operators import panel
from daypanel.plans.report import WEARABLE_REPORT_COLUMNS
from daypanel.sources import tables
from tests.conftest import ordered, series

INTAKE = "Date,Energy (kcal),Protein (g),Zinc (mg),Completed\n2024-01-01,2000,100,7,true\n2024-01-02,2100,x,8,true\n2024-01-03,1900,90,,true\n"
BIO = "Day,Metric,Unit,Amount\n2024-01-02,Weight,kg,80\n2024-01-02,Body Fat,%,20\n2024-01-03,Heart Rate,bpm,60\n"
WEARABLE = "Date,watch_steps,watch_hrv,other\n2024-01-01,5000,,9\n2024-01-02,,55,9\n"


@pytest.fixture
def files(tmp_path):
    for name, text in (("intake", INTAKE), ("bio", BIO), ("wearable", WEARABLE), ("nodate", "x,watch_steps\n1,2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    return lambda name: str(tmp_path / f"{name}.csv")


def test_read_intake(spark, files):
    df = tables.read_intake(spark, files("intake"), entity="a")
    assert df.columns == ["entity", "day", "energy", "protein", "Zinc (mg)"]
    assert dict(df.dtypes)["day"] == "date"
    assert ordered(df, "protein") == [100.0, None, 90.0]


def test_process_daily_fill_policy(spark, files):
    intake = tables.read_intake(spark, files("intake"), entity="a")
    bio = tables.read_biometrics(spark, files("bio"), entity="a")
    wearable = tables.read_wearable(spark, files("wearable"), entity="a", prefix="watch_")
    assert wearable.columns == ["entity", "day", "w_steps", "w_hrv"]
    out = panel.process_daily(intake, bio, wearable)
    # The first day is back-filled, the day after the last reading becomes 0, wearable nulls stay.
    assert ordered(out, "weight", "weight_change") == [(80.0, 0.0), (80.0, -80.0), (0.0, None)]
    assert ordered(out, "w_steps", "w_hrv") == [(5000.0, None), (None, 55.0), (None, None)]
    assert ordered(out, "Zinc (mg)") == [7.0, 8.0, 0.0]
    kept = panel.process_daily(intake, bio, None, trailing_weight="null")
    assert ordered(kept, "weight") == [80.0, 80.0, None]


def test_optional_wearable_source(spark, files):
    assert tables.read_wearable(spark, None) is None
    with pytest.raises(FileNotFoundError):
        tables.read_wearable(spark, files("missing"), entity="a")
    with pytest.raises(ValueError):
        tables.read_wearable(spark, files("nodate"), entity="a")


def test_readings_of_a_day(spark):
    intake = series(spark, {"energy": [2000, 2100]})
    bio = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), "Weight", "kg", 80.0), ("a", dt.date(2024, 1, 1), "Lean Mass", "kg", 60.0)],
        "entity string, day date, metric string, unit string, amount double",
    )
    assert ordered(panel.join_daily(intake, bio), "weight") == [80.0, None]
    assert panel.join_daily(intake, bio, per_day="all").count() == 3
    assert panel.join_daily(intake, bio, metric="Weight", per_day="all").count() == 2
    assert ordered(panel.join_daily(intake, bio, metric="Lean Mass"), "weight") == [60.0, None]
    with pytest.raises(ValueError):
        panel.join_daily(intake, bio, per_day="first")


READINGS = [("07:10", 80.0), ("21:30", 81.5), (None, 79.0), ("21:30", 81.0)]


@pytest.mark.parametrize("seed", range(4))
def test_order_of_rows_does_not_matter(spark, seed):
    """The same readings in any order of rows give the same panel; the last one of the day counts, or all in their order."""
    rows = [("a", dt.date(2024, 1, d), "Weight", "kg", kg + d, at) for d in (1, 2) for at, kg in READINGS]
    random.Random(seed).shuffle(rows)
    bio = spark.createDataFrame(rows, "entity string, day date, metric string, unit string, amount double, reading_ts string").repartition(3)
    intake = series(spark, {"energy": [2000, 2100, 1900]})
    assert ordered(panel.process_daily(intake, bio), "weight", "weight_change") == [(82.5, 1.0), (83.5, -83.5), (0.0, None)]
    assert ordered(panel.process_daily(intake, bio, per_day="largest"), "weight") == [82.5, 83.5, 0.0]
    every = panel.process_daily(intake, bio, per_day="all")
    got = [(r.reading, r.weight, r.weight_change, r.energy_avg_7) for r in every.orderBy("day", "reading").collect()]
    assert [g[:3] for g in got] == [
        (1, 80.0, 1.0), (2, 81.0, 1.0), (3, 82.0, 0.5), (4, 82.5, -1.5), (1, 81.0, 1.0), (2, 82.0, 1.0), (3, 83.0, 0.5), (4, 83.5, -83.5), (None, 0.0, None),
    ]
    assert [g[3] for g in got][:6] == [None] * 6 and got[6][3] == pytest.approx((4 * 2000 + 3 * 2100) / 7)
    assert ordered(panel.last_of_day(every), "weight", "weight_change") == [(82.5, -1.5), (83.5, -83.5), (0.0, None)]


def test_read_biometrics_keeps_the_time(spark, tmp_path):
    (tmp_path / "bio.csv").write_text("Day,Time,Metric,Unit,Amount\n2024-01-01,21:30,Weight,kg,81\n2024-01-01,07:10,Weight,kg,80\n")
    bio = tables.read_biometrics(spark, str(tmp_path / "bio.csv"), entity="a")
    assert bio.columns == ["entity", "day", "metric", "unit", "amount", "reading_ts"]
    assert ordered(panel.join_daily(series(spark, {"energy": [2000]}), bio), "weight") == [81.0]


def test_rolling_means_need_full_windows(spark):
    daily = series(spark, {"energy": list(range(1, 32)), "weight": [80.0] * 31})
    out = panel.finish_daily(daily)
    assert ordered(out, "energy_avg_7")[:7] == [None] * 6 + [4.0]
    assert ordered(out, "energy_avg_30")[28:] == [None, 15.5, 16.5]


def test_entities_do_not_touch_each_other(spark):
    a = series(spark, {"energy": [1, 2, 3], "weight": [None, 80.0, None]}, "a")
    b = series(spark, {"energy": [4, 5, 6], "weight": [90.0, None, 91.0]}, "b")
    both = panel.finish_daily(a.unionByName(b))
    alone = panel.finish_daily(a)
    assert both.filter("entity = 'a'").orderBy("day").collect() == alone.orderBy("day").collect()


def test_has_wearable_data(spark):
    df = series(spark, {"w_steps": [None, None]}, "a").withColumn("w_steps", F.col("w_steps").cast("double"))
    df = df.unionByName(series(spark, {"w_steps": [None, 3]}, "b"))
    got = {r["entity"]: r["has_data"] for r in panel.has_wearable_data(df, WEARABLE_REPORT_COLUMNS).collect()}
    assert got == {"a": False, "b": True}


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("",), (None,), ("nan",)], "v string")
    assert [r[0] for r in numeric(df, ["v"]).collect()] == [1.5, None, None, None, None]
    assert ensure_columns(df, {"w": "double", "v": "string"}).columns == ["v", "w"]


def test_last_months(spark):
    daily = series(spark, {"energy": list(range(365))})
    first = panel.last_months(daily, 6).agg(F.min("day")).first()[0]
    assert first == dt.date(2024, 6, 30)
