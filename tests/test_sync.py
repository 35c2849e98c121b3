import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypanel.core import WEARABLE_TYPES, conform
from daypanel.operators import sync
from daypanel.operators.sync import SyncConfig
from daypanel.plans import jobs
from daypanel.sources import sinks, tables
from daypanel.streaming import live
from tests.conftest import ordered, series


def old_and_new(spark):
    old = series(spark, {"w_steps": [1000, 1500], "w_avg_stress": [20, 30], "w_moderate_min": [10, 0], "w_vigorous_min": [5, 0]})
    new = series(spark, {"w_steps": [2000, 3000], "w_avg_stress": [25, 35], "w_moderate_min": [20, 30], "w_vigorous_min": [10, 10]}, start="2024-01-02")
    return old, new


def test_merge_daily_newest_wins_and_rolls(spark):
    out = sync.merge_daily(*old_and_new(spark))
    assert ordered(out, "w_steps") == [1000, 2000, 3000]
    assert ordered(out, "w_weekly_steps") == [1000, 3000, 6000]
    assert ordered(out, "w_weekly_intensity_min") == [15, 45, 85]
    assert ordered(out, "w_weekly_avg_stress") == [20, 22.5, pytest.approx(80 / 3)]


def test_merge_daily_with_one_side_and_other_columns(spark):
    old, _ = old_and_new(spark)
    assert sync.merge_daily(old, None).count() == 2
    extra = series(spark, {"w_hrv": [55.0]}, start="2024-01-05")
    out = sync.merge_daily(old, extra)
    assert ordered(out, "w_hrv") == [None, None, 55.0] and ordered(out, "w_weekly_steps")[-1] == 2500
    with pytest.raises(ValueError):
        sync.merge_daily(None, None)
    with pytest.raises(ValueError):
        sync.merge_daily(old.drop("day"), None)


SESSION = "entity string, day date, session_id long, session_name string, session_type string, start_time string, duration_min double, kcal double"
D = dt.date(2024, 1, 1)


def test_merge_sessions_by_id_or_composite_key(spark):
    old = spark.createDataFrame([("a", D, None, "Walk", "walking", "08:00", 30.0, 1.0), ("a", D, 7, "Run", "running", "09:00", 20.0, 1.0)], SESSION)
    new = spark.createDataFrame([
        ("a", D, None, "Walk", "walking", "08:00", 30.0, 2.0), ("a", D, None, "Walk", "walking", "18:00", 30.0, 3.0),
        ("a", D + dt.timedelta(1), 7, "Run", "running", "09:05", 21.0, 4.0), ("b", D, 7, "Run", "running", "09:05", 21.0, 5.0),
    ], SESSION)
    got = sorted((r["entity"], r["kcal"]) for r in sync.merge_sessions(old, new).collect())
    assert got == [("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 5.0)]


def test_merge_samples(spark):
    schema = "entity string, day date, sample_ts string, bpm double"
    old = spark.createDataFrame([("a", D, "t1", 60.0), ("a", D, "t2", 61.0)], schema)
    new = spark.createDataFrame([("a", D, "t2", 70.0), ("a", D, "t3", 71.0)], schema)
    assert sorted(r["bpm"] for r in sync.merge_samples(old, new).collect()) == [60.0, 70.0, 71.0]
    with pytest.raises(ValueError):
        sync.merge_samples(old.drop("sample_ts"), None)


def config(**kw):
    return SyncConfig(end=dt.date(2024, 1, 10), start=dt.date(2024, 1, 1), **kw)


@pytest.mark.parametrize(
    "columns, found",
    [
        ({"w_steps": [1, 2, 3, 4], "w_hrv": [50.0, None, 52.0, 53.0]}, [2]),
        ({"w_steps": [1, 2, 3, 4], "w_sleep_score": [80.0, 81.0, None, 83.0]}, [3]),
        ({"w_steps": [1, 2, 3, 4], "w_hrv": [50.0, 51.0, 52.0, None]}, []),
        ({"w_steps": [1, 2, 3, 4], "w_session_min": [30.0, None, 40.0, 20.0]}, []),
        ({"w_steps": [1, 2, 3, 4], "w_floors": [3.0, None, 4.0, 2.0]}, []),
        ({"w_steps": [1, 2, 3, 4], "w_training_status": ["ok", "  ", "ok", "ok"]}, [2]),
    ],
)
def test_gap_days(spark, columns, found):
    got = sync.gap_days(series(spark, columns), config())
    assert sorted(r["day"].day for r in got.collect()) == found


def test_gap_days_leave_out_overlap_and_keep_the_newest(spark):
    history = series(spark, {"w_steps": list(range(10)), "w_hrv": [1.0, None, None, None, None, None, 7.0, None, 9.0, 10.0]})
    bounds = sync.sync_bounds(history, history, config(overlap_days=3))
    assert bounds.first()["sync_start"] == dt.date(2024, 1, 7)
    days = lambda c, b=None: sorted(r["day"].day for r in sync.gap_days(history, c, b).collect())
    assert days(config()) == [2, 3, 4, 5, 6, 8]
    assert days(config(), bounds) == [2, 3, 4, 5, 6]
    assert days(config(gap_max_dates=2), bounds) == [5, 6]
    assert days(config(gap_scan_days=5)) == [6, 8]


def test_sync_bounds_and_requested_days(spark):
    everyone = spark.createDataFrame([("a",), ("b",)], "entity string")
    history = series(spark, {"w_steps": [1] * 8})
    got = {r["entity"]: r["sync_start"].day for r in sync.sync_bounds(everyone, history, config()).collect()}
    assert got == {"a": 6, "b": 1}
    forced = sync.sync_bounds(everyone, history, config(force_full=True))
    assert {r["sync_start"].day for r in forced.collect()} == {1}
    gaps = spark.createDataFrame([("a", dt.date(2024, 1, 3)), ("a", dt.date(2024, 1, 7))], "entity string, day date")
    days = sync.requested_days(sync.sync_bounds(everyone, history, config()), gaps)
    assert sorted(r["day"].day for r in days.filter("entity = 'a'").collect()) == [3, 6, 7, 8, 9, 10]


def test_config_is_checked(spark):
    for bad in ({"lookback_days": 0}, {"overlap_days": -1}, {"gap_scan_days": 0}, {"start": dt.date(2030, 1, 1)}):
        with pytest.raises(ValueError):
            SyncConfig(**{"end": dt.date(2024, 1, 10), **bad})
    assert SyncConfig(end=dt.date(2024, 1, 30)).history_start == dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        sync.date_range(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    assert sync.lookback_range(spark, 3, dt.date(2024, 3, 1)).count() == 3


def test_store_replaces_only_touched_months(spark, tmp_path):
    table = str(tmp_path / "daily")
    assert sinks.read_version(spark, table) is None
    sinks.replace_table(series(spark, {"w_steps": list(range(60))}), table)
    before = sinks.published(spark, table)
    assert sorted(before) == ["2024-01", "2024-02"]
    new = series(spark, {"w_steps": [999.0, 998.0]}, start="2024-02-29")
    jobs.upsert_table(new, table, jobs.merge_daily_rows)
    after = sinks.published(spark, table)
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"] and "2024-03" in after
    assert ordered(sinks.read_version(spark, table), "w_steps")[-3:] == [58.0, 999.0, 998.0]
    assert sinks.read_version(spark, table, ["2024-03"]).count() == 1


def test_a_session_that_moves_to_another_month_is_not_doubled(spark, tmp_path):
    table = str(tmp_path / "sessions")
    make = lambda day, kcal: spark.createDataFrame([("a", day, 7, "Run", "running", "09:00", 20.0, kcal)], SESSION)
    for day, kcal in ((dt.date(2024, 1, 31), 1.0), (dt.date(2024, 2, 1), 2.0)):
        jobs.upsert_table(make(day, kcal), table, sync.merge_sessions, sync.durable_key())
    got = sinks.read_version(spark, table).collect()
    assert [(r["day"].month, r["kcal"]) for r in got] == [(2, 2.0)]


def test_a_second_writer_is_refused(spark, tmp_path):
    """Both merge from the same pointer: the first publishes, the second is refused and loses nothing by merging again."""
    table = str(tmp_path / "daily")
    sinks.replace_table(series(spark, {"w_steps": [1.0, 2.0]}), table)
    base = sinks.pointer(spark, table)
    first, second = series(spark, {"w_steps": [10.0]}), series(spark, {"w_steps": [20.0]}, start="2024-01-02")
    write = lambda new: sinks.replace_months(jobs.merge_daily_rows(sinks.read_parts(spark, table, base), new), table, ["2024-01"], base=base)
    write(first)
    with pytest.raises(sinks.PointerMoved):
        write(second)
    assert ordered(sinks.read_version(spark, table), "w_steps") == [10.0, 2.0]
    jobs.upsert_table(second, table, jobs.merge_daily_rows)
    assert ordered(sinks.read_version(spark, table), "w_steps") == [10.0, 20.0]


def test_a_merge_overtaken_starts_again(spark, tmp_path):
    table = str(tmp_path / "daily")
    sinks.replace_table(series(spark, {"w_steps": [1.0, 2.0]}), table)
    overtaken = []

    def merge(old, new):
        if not overtaken:
            overtaken.append(True)
            jobs.upsert_table(series(spark, {"w_steps": [20.0]}, start="2024-01-02"), table, jobs.merge_daily_rows)
        return jobs.merge_daily_rows(old, new)

    jobs.upsert_table(series(spark, {"w_steps": [10.0]}), table, merge)
    assert ordered(sinks.read_version(spark, table), "w_steps") == [10.0, 20.0]


def test_columns_and_types_over_versions(spark, tmp_path):
    table = str(tmp_path / "daily")
    sinks.replace_table(series(spark, {"w_steps": [1.0]}), table)
    later = series(spark, {"w_hrv": [50.0]}, start="2024-02-01").withColumn("w_steps", F.lit(7))
    jobs.upsert_table(later, table, jobs.merge_daily_rows)
    got = sinks.read_version(spark, table)
    assert dict(got.dtypes)["w_steps"] == "double" and ordered(got, "w_steps", "w_hrv") == [(1.0, None), (7.0, 50.0)]


def test_expiry_keeps_what_pointers_name(spark, tmp_path):
    table = str(tmp_path / "daily")
    for month, steps in (("2024-01-01", 1.0), ("2024-02-01", 2.0), ("2024-02-01", 3.0), ("2024-02-01", 4.0)):
        jobs.upsert_table(series(spark, {"w_steps": [steps]}, start=month), table, jobs.merge_daily_rows)
    series(spark, {"w_steps": [9.0]}).write.parquet(f"{table}/v=20000101T000000-unpublished")
    assert sinks.expire(spark, table) == []  # all of it is younger than a day
    gone = sinks.expire(spark, table, keep=1, older_than=dt.timedelta(0))
    assert len([g for g in gone if g.startswith("v=")]) == 3 and "v=20000101T000000-unpublished" in gone
    assert ordered(sinks.read_version(spark, table), "w_steps") == [1.0, 4.0]
    jobs.upsert_table(series(spark, {"w_steps": [5.0]}, start="2024-02-02"), table, jobs.merge_daily_rows)
    assert ordered(sinks.read_version(spark, table), "w_steps") == [1.0, 4.0, 5.0]


def test_a_sync_reads_only_touched_months(spark, tmp_path):
    """Two days of sessions merged into a year: keys are probed, rows of other months never read."""
    table = str(tmp_path / "sessions")
    make = lambda rows: spark.createDataFrame(rows, SESSION)
    year = [("a", dt.date(2023, m, d), 100 * m + d if d % 2 else None, "Run", "running", "09:00", 20.0, 1.0) for m in range(1, 13) for d in (1, 2, 3)]
    jobs.upsert_table(make(year), table, sync.merge_sessions, sync.durable_key())
    assert sinks.read_keys(spark, table, sinks.pointer(spark, table)).count() == 24
    read = []

    def merge(old, new):
        read.extend(sorted({p.split("month=")[1][:7] for p in old.inputFiles()}))
        return sync.merge_sessions(old, new)

    # One new session, one corrected in place, one that moved from March to December.
    jobs.upsert_table(make([("a", dt.date(2023, 12, 30), 9, "Run", "running", "09:00", 20.0, 5.0), ("a", dt.date(2023, 12, 1), 1201, "Run", "running", "09:00", 20.0, 6.0), ("a", dt.date(2023, 12, 31), 303, "Run", "running", "09:00", 20.0, 7.0)]), table, merge, sync.durable_key())
    assert read == ["2023-03", "2023-12"]
    got = sinks.read_version(spark, table)
    assert got.count() == 37 and [r.day for r in got.where("session_id = 303").collect()] == [dt.date(2023, 12, 31)]
    before = sinks.pointer(spark, table)
    assert set(before.parts) == {f"2023-{m:02d}" for m in range(1, 13)} and before.generation == 2


def test_unfinished_write_leaves_the_old_version(spark, tmp_path):
    table = str(tmp_path / "daily")
    sinks.replace_table(series(spark, {"w_steps": [1.0]}), table)
    broken = series(spark, {"w_steps": [2.0]}).withColumn("w_steps", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception):
        sinks.replace_table(broken, table)
    assert ordered(sinks.read_version(spark, table), "w_steps") == [1.0]


def test_an_empty_table_and_rows_without_a_day(spark, tmp_path):
    table = str(tmp_path / "samples")
    sinks.replace_table(tables.no_samples(spark), table)
    assert sinks.read_version(spark, table) is None and sinks.published(spark, table) == {}
    undated = series(spark, {"w_steps": [1.0]}).withColumn("day", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        jobs.upsert_table(undated, table, jobs.merge_daily_rows)


def test_stream_merge_applies_each_batch_once(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "store", "checkpoint"))
    old, new = old_and_new(spark)
    old.coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = spark.readStream.schema(old.schema).parquet(landing)
        live.upsert_stream(stream, table, jobs.merge_daily_rows, checkpoint).awaitTermination()
        return ordered(sync.weekly_rollups(sinks.read_version(spark, table)), "w_weekly_steps")

    assert run() == [1000, 2500]
    new.coalesce(1).write.mode("append").parquet(landing)
    assert run() == [1000, 3000, 6000]
    state = sinks.published(spark, table)
    assert run() == [1000, 3000, 6000] and sinks.published(spark, table) == state


def test_stream_of_samples_drops_repeats(spark, tmp_path):
    landing = str(tmp_path / "landing")
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("a", at(1), 60.0), ("a", at(2), 80.0), ("a", at(2), 80.0), ("b", at(3), 50.0)]
    spark.createDataFrame(rows, "entity string, ts timestamp, bpm double").coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema("entity string, ts timestamp, bpm double").parquet(landing)
    live.write_daily_samples(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert ordered(live.read_daily_samples(spark, str(tmp_path / "t")), "w_hr_min", "w_hr_max", "w_hr_avg") == [(60, 80, 70), (50, 50, 50)]


def test_stream_of_samples_takes_them_late(spark, tmp_path):
    """Samples ten days late, and a correction of an old one, reach their day as in the batch merge."""
    landing = str(tmp_path / "landing")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    files = [[("a", at(10, 1), 70.0)], [("a", at(21, 1), 90.0)], [("a", at(10, 2), 40.0), ("a", at(10, 3), 100.0)], [("a", at(10, 1), 60.0)]]
    for rows in files:
        spark.createDataFrame(rows, "entity string, ts timestamp, bpm double").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("entity string, ts timestamp, bpm double").parquet(landing)
        live.write_daily_samples(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    got = ordered(live.read_daily_samples(spark, str(tmp_path / "t")), "w_hr_min", "w_hr_max", "w_hr_avg")
    assert got == [(40, 100, 200 / 3), (90, 90, 90)]


def test_read_history(spark, tmp_path):
    path = str(tmp_path / "h.csv")
    assert tables.read_history(spark, path, "csv") is None
    (tmp_path / "h.csv").write_text("entity,day,w_steps\na,2024-01-01,5\na,bad,6\n")
    with pytest.raises(ValueError):
        tables.read_history(spark, path, "csv")
    (tmp_path / "h.csv").write_text("entity,day,w_steps\na,2024-01-01,5\n")
    assert tables.read_history(spark, path, "csv").first()["day"] == dt.date(2024, 1, 1)
    assert tables.read_sessions(spark, str(tmp_path / "none")).count() == 0


def test_publish_run(spark, tmp_path):
    path = sinks.publish_run(series(spark, {"w": [1.0]}), str(tmp_path), "daily", dt.date(2024, 5, 6), "csv")
    assert path.endswith("run_date=2024-05-06/daily")
    assert spark.read.option("header", True).csv(path).count() == 1
    assert conform(series(spark, {"w_steps": [1.0]}), WEARABLE_TYPES).columns[2:] == list(WEARABLE_TYPES)
