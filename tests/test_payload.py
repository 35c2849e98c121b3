import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from daypanel.core import WEARABLE_TYPES
from daypanel.operators import payload
from daypanel.operators.sync import SyncConfig
from daypanel.plans import jobs
from daypanel.sources import exports, sinks
from tests.conftest import ordered

DAY = dt.date(2024, 1, 2)


def landed(spark, day=DAY, entity="a", **payloads):
    rows = [(entity, day, e, p if isinstance(p, str) else json.dumps(p)) for e, p in payloads.items()]
    return spark.createDataFrame(rows, "entity string, day date, endpoint string, payload string")


def daily(spark, **payloads):
    return payload.normalise(landed(spark, **payloads))[0].first().asDict()


def test_newest_landing_wins(spark):
    """A day's payload fetched again replaces the earlier one, in any order of the rows; an empty one does not."""
    at = lambda h: dt.datetime(2024, 1, 3, h)
    beat = lambda x: json.dumps({"restingHeartRate": x, "heartRateValues": [{"time": "t", "bpm": x}]})
    ride = lambda *ids: json.dumps({"activities": [{"activityId": i, "duration": 5} for i in ids]})
    rows = [
        ("a", DAY, "heart_rate", beat(50), at(1)), ("a", DAY, "heart_rate", beat(60), at(2)), ("a", DAY, "heart_rate", "{}", at(3)),
        ("a", DAY, "activity", ride(1, 2), at(1)), ("a", DAY, "activity", ride(3), at(2)), ("b", DAY, "activity", ride(1), at(1)), ("b", DAY, "activity", '{"activities":[]}', at(2)),
    ]
    for order in (rows, rows[::-1]):
        landed_rows = spark.createDataFrame(order, "entity string, day date, endpoint string, payload string, landed_at timestamp").coalesce(1)
        days, sessions, samples = payload.normalise(landed_rows)
        assert {r["entity"]: (r["w_resting_hr"], r["w_session_min"]) for r in days.collect()} == {"a": (60.0, 5.0), "b": (None, None)}
        assert [(r["entity"], r["session_id"]) for r in sessions.collect()] == [("a", 3)]
        assert [r["bpm"] for r in samples.collect()] == [60.0]
        assert payload.payloads_by_endpoint(landed_rows).where("entity = 'a'").first()["heart_rate"] == beat(60)


def test_flat_day(spark):
    row = daily(
        spark, summary={"totalSteps": 9000, "totalDistanceMeters": 6500.5, "activeKilocalories": 450},
        sleep={"dailySleepDTO": {"sleepTimeSeconds": 27000}, "sleepScores": {"overall": {"value": 81}}},
        stress={"averageStressLevel": 28}, heart_rate={"restingHeartRate": 52},
        intensity={"moderateIntensityMinutes": 20, "vigorousIntensityDurationInSeconds": 600},
        body_battery={"bodyBatteryValuesArray": [{"bodyBatteryLevel": 15}, {"bodyBatteryLevel": 92}, {"bodyBatteryLevel": 140}]},
        activity=[{"activityId": 1}, {"activityId": 2}, 5], spo2={}, training_status={"trainingStatusType": "  "},
    )
    want = {
        "w_steps": 9000.0, "w_distance_m": 6500.5, "w_active_kcal": 450.0, "w_sleep_seconds": 27000.0, "w_sleep_score": 81.0, "w_avg_stress": 28.0,
        "w_resting_hr": 52.0, "w_moderate_min": 20.0, "w_vigorous_min": 10.0, "w_body_battery_max": 92.0, "w_body_battery_min": 15.0,
        "w_session_count": 3, "w_session_min": 0.0, "w_session_kcal": 0.0,
    }
    assert {k: v for k, v in row.items() if v is not None and k not in ("entity", "day")} == want
    assert list(row)[2:] == list(WEARABLE_TYPES)


@pytest.mark.parametrize(
    "value, want",
    [
        ({"hrvSummaries": [{"calendarDate": "2024-01-01", "lastNightAvg": 40}, {"calendarDate": "2024-01-02", "summary": {"avgOvernightHrv": 63}}]}, 63.0),
        ({"lastNightAvg": 44.5}, 44.5),
        ([{"date": "2024-01-02T00:00:00", "value": 51}], 51.0),
        ({"x": [{"y": {"rmssd": 37}}, {"weeklyAvg": 99}]}, 37.0),
        ({"lastNightAvg": "n/a", "items": [{"hrvValue": 48}]}, 48.0),
        ({"x": 1}, None),
    ],
)
def test_hrv_shapes(spark, value, want):
    assert daily(spark, hrv=value)["w_hrv"] == want


@pytest.mark.parametrize(
    "summary, activity, want",
    [
        ({"activityCount": 4}, [], 4), ({"summary": {"activityCount": "2"}}, {"items": []}, 2), ({}, {"activityList": [1, 2, 3]}, 3),
        ({}, {"page": {"totalElements": 6}}, 6), ({}, {"x": 1}, None),
    ],
)
def test_activity_count(spark, summary, activity, want):
    assert daily(spark, summary=summary, activity=activity, stress={"avgStressLevel": 1})["w_session_count"] == want


def test_first_path_is_chosen_before_blank_becomes_null(spark):
    row = daily(spark, training_status={"trainingStatusType": " ", "status": "PEAKING"}, training_readiness={"score": None, "value": 70})
    assert row["w_training_status"] is None and row["w_readiness"] == 70.0


def test_samples_from_list_and_from_digit_keys(spark):
    a = landed(spark, heart_rate={"heartRateValues": [{"timestampGMT": "t1", "value": 60}, {"time": " t2 ", "bpm": "75"}, 3, {"time": "", "value": 1}]})
    b = landed(spark, entity="b", heart_rate={"1700": 55, "1800": 65.5, "x1": 3, "1900": "70"})
    days, _, samples = payload.normalise(a.unionByName(b))
    assert sorted(tuple(r)[2:] for r in samples.collect()) == [("1700", 55.0), ("1800", 65.5), ("t1", 60.0), ("t2", 75.0)]
    assert ordered(days, "w_hr_min", "w_hr_max", "w_hr_avg") == [(60, 75, 67.5), (55, 65.5, 60.25)]


def test_detail_overrides_by_key_even_with_null(spark):
    summary = {
        "activityId": 9, "activityName": " Run ", "activityType": {"typeKey": "cardio_training"}, "calories": 100, "averageHR": 120,
        "durationInSeconds": 1800, "summaryDTO": {"averageHR": 111},
    }
    details = spark.createDataFrame([("a", 9, json.dumps({"calories": 130, "averageHR": None, "trainingLoad": 8}))], "entity string, session_id long, payload string")
    by = payload.payloads_by_endpoint(landed(spark, activity={"activities": [summary]}))
    row = payload.session_rows(by, details).first()
    assert (row["session_name"], row["session_group"], row["kcal"], row["avg_hr"], row["duration_min"], row["training_load"]) == (
        "Run", "gym/resistance training", 130.0, 111.0, 30.0, 8.0,
    )
    alone = payload.session_rows(by).first()
    assert (alone["kcal"], alone["avg_hr"]) == (100.0, 120.0)
    days = payload.normalise(landed(spark, activity={"activities": [summary]}), details)[0].first()
    assert (days["w_session_kcal"], days["w_session_min"], days["w_session_count"]) == (130.0, 30.0, 1)


def test_pages_of_a_day_are_merged(spark):
    """Newest landing of each page; a session on two pages counts once, as the newest page gives it."""
    one = lambda i, kcal: {"activityId": i, "activityName": f"Run {i}", "calories": kcal, "durationInMinutes": 10}
    at = lambda h: dt.datetime(2024, 1, 2, h)
    pages = [(0, at(1), [one(1, 5), one(2, 6)]), (0, at(3), [one(1, 50), one(2, 60)]), (1, at(2), [one(2, 61), one(3, 70), {"activityName": "no id"}, {"activityName": "no id"}])]
    rows = [("a", dt.date(2024, 1, 1), "activity", p, t, json.dumps(items)) for p, t, items in pages]
    paged = spark.createDataFrame(rows, "entity string, day date, endpoint string, page int, landed_at timestamp, payload string")
    got = sorted((r.session_id or 0, r.kcal or 0) for r in payload.session_rows(paged).collect())
    assert got == [(0, 0), (0, 0), (1, 50.0), (2, 60.0), (3, 70.0)]
    day = payload.normalise(paged)[0].first()
    assert (day.w_session_count, day.w_session_kcal, day.w_session_min) == (5, 180.0, 30.0)
    assert (payload.daily_rows(paged).first().w_session_kcal) == 180.0


def test_no_text_is_exchanged_for_sessions(spark):
    rows = [("a", dt.date(2024, 1, 1), "activity", 0, "[]")]
    paged = spark.createDataFrame(rows, "entity string, day date, endpoint string, page int, payload string")
    for df in (payload.session_rows(paged), payload.daily_rows(paged), payload.session_rows(paged.drop("page"))):
        plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        exchanged = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert exchanged and not any(re.match(r"payload#", c.strip()) for columns in exchanged for c in columns.split(","))


def write(root, name, value):
    path = root / "ann" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value))


@pytest.fixture
def export(tmp_path):
    root = tmp_path / "export"
    write(root, "DI-Connect-Aggregator/UDSFile_1.json", [
        {"calendarDate": "2024-01-01", "totalSteps": 1},
        {"calendarDate": "2024-01-01", "totalSteps": 8000, "totalDistanceMeters": 6000, "activeKilocalories": 400, "moderateIntensityMinutes": 10,
         "vigorousIntensityMinutes": 5, "restingHeartRate": 0, "currentDayRestingHeartRate": None, "minHeartRate": 45, "maxHeartRate": 150,
         "averageSpo2Value": 95, "respiration": {"avgRespiration": 13},
         "allDayStress": {"aggregatorList": [{"type": "AWAKE", "averageStressLevel": 40}, {"type": "TOTAL", "averageStressLevel": 30}]},
         "bodyBattery": {"bodyBatteryStatList": [{"bodyBatteryStatType": "H", "statsValue": 88}, {"bodyBatteryStatType": "L", "statsValue": 20}]}},
    ])
    write(root, "DI-Connect-Aggregator/UDSFile_2.json", [{"calendarDate": "2024-01-03", "totalSteps": 5, "respiration": 14,
          "allDayStress": {"aggregatorList": [{"type": "AWAKE", "averageStressLevel": 0}]}}, {"noDate": 1}, 7])
    write(root, "DI-Connect-Wellness/2024_sleepData.json", [{"calendarDate": "2024-01-01", "deepSleepSeconds": 3600, "lightSleepSeconds": 18000,
          "averageRespiration": 0, "sleepScores": {"overallScore": 77}, "spo2SleepSummary": {"averageSPO2": 96}}])
    write(root, "DI-Connect-Wellness/x_fitnessAgeData.json", [{"asOfDateGmt": "2024-01-01T00:00:00.0", "rhr": 51}, {"asOfDateGmt": "", "rhrLastEntryDate": 1704153600000, "rhr": 53},
          {"asOfDateGmt": "junk", "rhrLastEntryDate": "2024-01-09", "rhr": 60}])
    write(root, "DI-Connect-Wellness/x_healthStatusData.json", [{"calendarDate": "2024-01-01", "metrics": [{"type": "HRV", "value": 0}, {"type": "HR", "value": 58}]}])
    write(root, "DI-Connect-Wellness/x_wellnessActivities.json", [
        {"calendarDate": "2024-01-01", "summaryTypeDataList": [{"summaryType": "RMSSD_HRV", "avgValue": 42}, {"summaryType": "RESPIRATION", "avgValue": 12.5}]},
        {"calendarDate": "2024-01-01", "summaryTypeDataList": [{"summaryType": "RMSSD_HRV", "avgValue": 1}]},
        {"calendarDate": "2024-01-03", "summaryTypeDataList": [{"summaryType": "STRESS", "avgValue": 22}, {"summaryType": "HEART_RATE", "minValue": 44, "maxValue": 99, "avgValue": 60}]},
    ])
    write(root, "DI-Connect-Fitness/x_summarizedActivities.json", [{"summarizedActivitiesExport": [
        {"activityId": 5, "name": "Morning", "activityType": "running", "startTimeLocal": 1704096000000, "startTimeGmt": 1704092400000, "duration": 1800000.0,
         "distance": 5000, "avgHr": 140, "maxHr": 165, "calories": 300},
        {"activityId": 6, "name": "undated", "duration": 60000},
    ]}])
    return root


def test_export_daily(spark, export):
    rows = {r["day"].day: r.asDict() for r in exports.export_daily(spark, str(export)).collect()}
    assert sorted(rows) == [1, 2, 3]
    known = lambda d: {k: v for k, v in rows[d].items() if v is not None and k not in ("entity", "day")}
    assert known(1) == {
        "w_steps": 8000.0, "w_distance_m": 6000.0, "w_active_kcal": 400.0, "w_resting_hr": 51.0, "w_sleep_seconds": 21600.0, "w_sleep_score": 77.0,
        "w_avg_stress": 30.0, "w_body_battery_max": 88.0, "w_body_battery_min": 20.0, "w_moderate_min": 10.0, "w_vigorous_min": 5.0,
        "w_session_count": 1, "w_session_min": 30.0, "w_session_kcal": 300.0, "w_session_avg_hr": 140.0, "w_session_max_hr": 165.0,
        "w_hr_min": 45.0, "w_hr_max": 150.0, "w_hr_avg": 58.0, "w_hrv": 42.0, "w_respiration": 12.5, "w_spo2": 96.0,
    }
    assert known(2) == {"w_resting_hr": 53.0}
    assert known(3) == {"w_steps": 5.0, "w_avg_stress": 22.0, "w_hr_min": 44.0, "w_hr_max": 99.0, "w_hr_avg": 60.0, "w_respiration": 14.0}
    assert rows[1]["entity"] == "ann"


def test_export_sessions(spark, export):
    row = exports.export_sessions(spark, str(export)).collect()
    assert len(row) == 1
    assert (row[0]["session_id"], row[0]["session_name"], row[0]["session_group"], row[0]["duration_min"], row[0]["distance_m"]) == (5, "Morning", "runs", 30.0, 5000.0)
    assert row[0]["start_time"] == "2024-01-01T08:00:00Z"


def test_seed_and_sync_jobs(spark, export, tmp_path):
    root = str(tmp_path / "store")
    assert jobs.seed_store(spark, str(export), root).count() == 3
    assert jobs.seed_store(spark, str(export), root).count() == 3
    with pytest.raises(FileNotFoundError):
        jobs.seed_store(spark, str(tmp_path / "missing"), root)
    config = SyncConfig(end=dt.date(2024, 1, 5), start=dt.date(2024, 1, 1))
    landing = landed(spark, dt.date(2024, 1, 4), "ann", summary={"totalSteps": 4000}).unionByName(landed(spark, dt.date(2024, 1, 2), "ann", summary={"totalSteps": 77}))
    landing = landing.unionByName(landed(spark, dt.date(2024, 1, 9), "ann", summary={"totalSteps": 1}))
    out = jobs.sync_store(landing, root, config)
    # Day 2 is an interior gap and inside the overlap; day 9 was not requested.
    assert ordered(out, "w_steps") == [8000.0, 77.0, 5.0, 4000.0]
    assert ordered(out, "w_weekly_steps") == [8000.0, 8077.0, 8082.0, 12082.0]
    assert sinks.read_version(spark, sinks.store_paths(root)["sessions"]).count() == 1
    full = jobs.sync_store(landing, root, SyncConfig(end=dt.date(2024, 1, 9), start=dt.date(2024, 1, 1), force_full=True))
    assert ordered(full, "w_steps") == [77.0, 4000.0, 1.0]
    assert full.select(F.count("w_weekly_steps")).first()[0] == 3
