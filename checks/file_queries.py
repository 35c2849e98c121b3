"""Queries over files: they write the driver tables in the shapes of the inputs and read them back by the library's readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.queries import GOALS, query
from daypanel.core import DAY, ENTITY, KEYS
from daypanel.functions import scalars as sc
from daypanel.operators import panel, sync, text
from daypanel.plans import jobs, landing, panels
from daypanel.sources import exports, sinks, tables

RUN_DATE = dt.date(2024, 5, 6)
FIRST_RUN, SECOND_RUN = dt.date(2024, 1, 20), dt.date(2024, 1, 30)


@query("csv_daily")
def csv_daily(spark, sf_dir):
    """The daily process from three CSV folders; records with too many fields are kept apart."""
    paths = landing.write_csvs(spark, sf_dir)
    intake = tables.read_intake(spark, paths["intake"], bad_records=paths["intake"] + "-bad")
    biometrics = tables.read_biometrics(spark, paths["biometrics"], bad_records=paths["biometrics"] + "-bad")
    wearable = tables.read_wearable(spark, paths["wearable"], prefix="watch_")
    return panel.process_daily(intake, biometrics, wearable)


@query("csv_bad_records")
def csv_bad_records(spark, sf_dir):
    path = landing.write_csvs(spark, sf_dir)["intake"]
    tables.read_intake(spark, path, bad_records=path + "-bad")
    fields = F.split("line", ",", -1)
    return spark.read.parquet(path + "-bad").select(fields[0].alias(ENTITY), fields[1].alias(DAY), F.size(fields).alias("fields"))


@query("published_run")
def published_run(spark, sf_dir):
    """The processed table published as CSV under a run date, and read back as history."""
    root = landing.new_folder(spark, "publish")
    path = sinks.publish_run(panel.process_daily(*panels.three_inputs(spark, sf_dir)), root, "daily", RUN_DATE, "csv")
    back = tables.read_history(spark, f"{root}/run_date={RUN_DATE:%Y-%m-%d}/daily", "csv")
    values = [F.col(c).cast("double").alias(c) for c in ("energy", "sodium", "weight", "w_steps", "energy_avg_7", "weight_change")]
    return back.select(F.col(ENTITY).cast("bigint").alias(ENTITY), DAY, F.lit(path.removeprefix(root)).alias("folder"), *values)


@query("daily_file")
def daily_file(spark, sf_dir):
    path = landing.new_folder(spark, "daily")
    sinks.write_daily(panel.process_daily(*panels.three_inputs(spark, sf_dir)), path)
    return tables.read_history(spark, path)


@query("report_files")
def report_files(spark, sf_dir):
    """Two report datasets written and read back."""
    daily = panels.event_days(spark, sf_dir)
    per_day = daily.groupBy(DAY).agg(F.count(F.lit(1)).alias("users"), F.sum("energy").alias("energy"))
    per_user = daily.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("days"))
    paths = sinks.write_report({"by_day": per_day, "by_user": per_user}, landing.new_folder(spark, "report"))
    days = spark.read.parquet(paths["by_day"]).select(F.lit("by_day").alias("dataset"), F.col(DAY).cast("string").alias("name"), F.col("users").alias("n"), "energy")
    users = spark.read.parquet(paths["by_user"]).select(F.lit("by_user").alias("dataset"), F.col(ENTITY).cast("string").alias("name"), F.col("days").alias("n"), F.lit(None).cast("double").alias("energy"))
    return days.unionByName(users)


@query("session_file")
def session_file(spark, sf_dir):
    """A stored session table read back, and an absent one, which counts as empty."""
    path = landing.new_folder(spark, "sessions")
    panels.sessions(spark, sf_dir).write.parquet(path)
    both = tables.read_sessions(spark, path).unionByName(tables.read_sessions(spark, path + "-none"), allowMissingColumns=True)
    return both.groupBy("session_type").agg(F.count(F.lit(1)).alias("sessions"), F.sum("kcal").alias("kcal"), F.count("session_id").alias("with_id"))


@query("food_file")
def food_file(spark, sf_dir):
    """A food table under its original headers; a missing category gets the default."""
    path = landing.new_folder(spark, "foods")
    foods = panels.foods(spark, sf_dir).withColumn("category", F.when(F.col("doc_id") % 10 != 0, F.col("category")))
    foods.withColumnsRenamed({"food_name": "Food Name", "category": "Category", "label": "Label"}).write.parquet(path)
    ready = text.prepare_text(text.fill_category(tables.read_foods(spark, path, "parquet")))
    return ready.select("doc_id", "category", "label", F.md5("combined").alias("combined_md5"))


@query("payload_file")
def payload_file(spark, sf_dir):
    path = landing.new_folder(spark, "payloads")
    landing.summary_payloads(spark, sf_dir, str(SECOND_RUN), 0.0).drop("landed_at").write.parquet(path)
    return tables.read_payloads(spark, path).select(*KEYS, "endpoint", F.get_json_object("payload", "$.totalSteps").cast("double").alias("w_steps"), F.col("landed_at").isNull().alias("undated"))


# --- exports -----------------------------------------------------------------------------------


@query("export_daily")
def export_daily(spark, sf_dir):
    return exports.export_daily(spark, landing.write_export(spark, sf_dir))


@query("export_sessions")
def export_sessions(spark, sf_dir):
    return exports.export_sessions(spark, landing.write_export(spark, sf_dir)).drop("start_time")


@query("export_timestamps")
def export_timestamps(spark, sf_dir):
    """Starts given as epoch milliseconds, epoch seconds or text become one form; fitness days are keyed by either of two dates."""
    root = landing.write_export(spark, sf_dir)
    starts = exports.export_sessions(spark, root).groupBy(ENTITY, F.col("start_time").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    fitness = exports.fitness_days(spark, root).select(ENTITY, F.col(DAY).cast("string").alias("at"), F.lit(1).cast("bigint").alias("n"))
    return starts.unionByName(fitness)


@query("export_typed_entries")
def export_typed_entries(spark, sf_dir):
    """Values of typed lists: the first entry of a type in health records, and of the longest list in wellness snapshots."""
    root = landing.write_export(spark, sf_dir)
    return exports.health_days(spark, root).join(exports.wellness_days(spark, root), KEYS, "full")


@query("export_sleep")
def export_sleep(spark, sf_dir):
    return exports.sleep_days(spark, landing.write_export(spark, sf_dir))


# --- whole jobs --------------------------------------------------------------------------------


@query("sync_job")
def sync_job(spark, sf_dir):
    """Two runs against one store: days fetched again, days that came late, gaps repaired, days never requested."""
    root = landing.new_folder(spark, "store")
    run = lambda last, more: jobs.sync_store(
        landing.summary_payloads(spark, sf_dir, str(last), more), root, sync.SyncConfig(end=last, start=dt.date(2024, 1, 1))
    )
    run(FIRST_RUN, 1.0)
    return run(SECOND_RUN, 0.0).select(*KEYS, "w_steps", "w_distance_m", "w_active_kcal", "w_weekly_steps", "w_weekly_intensity_min")


@query("seed_job")
def seed_job(spark, sf_dir):
    """A store seeded from an export, twice: the second run changes nothing."""
    export, root = landing.write_export(spark, sf_dir), landing.new_folder(spark, "store")
    jobs.seed_store(spark, export, root)
    days = jobs.seed_store(spark, export, root)
    stored = sinks.read_version(spark, sinks.store_paths(root)["sessions"]).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("stored_sessions"))
    picked = days.select(*KEYS, "w_steps", "w_resting_hr", "w_session_count", "w_weekly_steps", "w_weekly_avg_stress", "w_weekly_intensity_min")
    return picked.join(stored, KEYS, "left")


# --- what no other query uses ------------------------------------------------------------------


@query("calendar_days")
def calendar_days(spark, sf_dir):
    """Every day from the first to the last of the events, with their number and the week's label; the last 7 days marked."""
    events = panels.event_days(spark, sf_dir, "energy").groupBy(DAY).agg(F.count(F.lit(1)).alias("users"))
    first, last = events.agg(F.min(DAY), F.max(DAY)).first()
    recent = sync.lookback_range(spark, 7, last).withColumn("recent", F.lit(True))
    days = sync.date_range(spark, first, last).join(events, DAY, "left").join(recent, DAY, "left")
    return days.select(DAY, F.coalesce("users", F.lit(0)).alias("users"), F.coalesce("recent", F.lit(False)).alias("recent"), sc.week_label(F.trunc(DAY, "week")).alias("week"))


@query("healthy_weights")
def healthy_weights(spark, sf_dir):
    """Days within the healthy range of weight for the height."""
    low, high = sc.healthy_weight_range(GOALS.height_cm)
    days = panels.event_days(spark, sf_dir, "weight")
    return days.groupBy(ENTITY).agg(F.count_if(F.col("weight").between(low, high)).alias("healthy"), F.count("weight").alias("weighed"), F.lit(low).alias("low"), F.lit(high).alias("high"))


@query("gap_dates_text")
def gap_dates_text(spark, sf_dir):
    """A text column with blanks counts as missing there; every day of the data, all defaults."""
    status = F.when(F.col("w_avg_stress").isNull(), "  ").otherwise("productive")
    days = panels.event_days(spark, sf_dir, "w_avg_stress").select(*KEYS, status.alias("w_training_status"))
    return sync.gap_days(days, sync.SyncConfig(end=SECOND_RUN, start=dt.date(2024, 1, 1)))
