"""Exports: their files are bounded whatever the number of users and events, and a field of a record is read once."""

import datetime as dt
import re

from daypanel.functions import payloads as pl
from daypanel.plans import landing
from daypanel.sources import exports
from pyspark.sql import functions as F


def events(spark, path, shifts):
    start = dt.datetime(2024, 1, 30, 8)
    kinds = ["view", "click", "purchase", "signup", "error"]
    rows = [
        (shift * 300_000 + i, start + dt.timedelta(hours=i), shift * 24_000 + 12 * (i % 7) + 24 * shift, kinds[i % 5], 10.0 + i + shift)
        for shift in shifts for i in range(70)
    ] + [(None, start, None, "view", 1.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_files_follow_users_events_and_months(spark, tmp_path):
    one = landing.write_export(spark, events(spark, tmp_path / "one", [0]))
    three = landing.write_export(spark, events(spark, tmp_path / "three", [0, 1, 2]))
    for kind in exports.PATTERNS:
        count = lambda root: exports.export_files(spark, root, kind).where("entity = '0'").count()
        assert count(three) == 3 * count(one) and count(one) == 4  # two series, two months


def test_highest_user_of_the_second_series_wins_across_files(spark, tmp_path):
    sf = events(spark, tmp_path, [0, 1, 2])
    days = landing.days_of_users(spark, sf).where("household = 0")
    got = exports.health_days(spark, landing.write_export(spark, sf)).where("entity = '0'")
    want = days.groupBy("day").agg(F.max_by("w_resting_hr", F.struct(F.col("user") % 5 >= 3, "user")).alias("want"))
    best = {r.day: r.want for r in want.collect()}
    assert best and {r.day: r.hr_health for r in got.collect()} == best


def test_time_fields_are_read_once(spark, tmp_path):
    root = landing.write_export(spark, events(spark, tmp_path, [0]))
    for rows, fields in ((exports.export_sessions(spark, root), 3), (exports.fitness_days(spark, root), 2)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("schemaOfVariant", plan)) == fields


def test_objects_are_told_from_other_values(spark):
    texts = ["{}", '{"a":1}', '{"a":{"b":[1]},"":2}', "[]", '[{"a":1}]', "1", '"x"', "null", "true", "{bad", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", pl.is_object(pl.parsed(F.col("t"))).alias("o"))
    assert [r.o for r in rows.orderBy("i").collect()] == [True] * 3 + [False] * 8
