"""One DataFrame query per operator or dataset, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, NUTRIENTS, shared_dir, tail_rows
from daypanel.functions import scalars as sc
from daypanel.functions.stats import drop_blocks, ewm, with_blocks
from daypanel.operators import (
    correlate, energy, metrics, panel, payload, regimes, rollup, sessions as ses, sync, text, trend,
)
from daypanel.operators.metrics import Goals
from daypanel.plans import jobs, panels, report
from daypanel.sources import sinks
from daypanel.streaming import live

GOALS = Goals()
# Goals of the order panel, whose weights and intakes lie elsewhere.
ORDER_GOALS = Goals(height_cm=170.0, target_weight=65.0, target_energy=4000.0)
CONFIG = sync.SyncConfig(end=dt.date(2024, 1, 30), start=dt.date(2024, 1, 1))
SAMPLE_SIZE = 200
LEAST_ACCURACY = 0.7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, small integers widened, so that engines can be compared by value."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("double", "float"):
            # Adding zero turns a negative zero into a plain one.
            c = F.round(c, digits) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, digits: int = 6) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir), digits)
        return fn

    return register


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prepare_metrics(panels.processed_events(spark, sf_dir), GOALS)


def with_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return energy.energy_columns(prepared(spark, sf_dir))


def prepared_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prepare_metrics(panels.processed_orders(spark, sf_dir), ORDER_GOALS)


def energy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return energy.energy_columns(prepared_orders(spark, sf_dir))


def wearable_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ses.report_inputs(with_energy(spark, sf_dir), panels.sessions(spark, sf_dir))


# --- daily table and metrics -------------------------------------------------------------------


@query("processed_daily")
def processed_daily(spark, sf_dir):
    return panel.process_daily(*panels.three_inputs(spark, sf_dir))


@query("processed_daily_readings")
def processed_daily_readings(spark, sf_dir):
    """Several readings a day, the last one taken."""
    return panel.process_daily(*panels.readings_inputs(spark, sf_dir))


@query("processed_daily_all_readings")
def processed_daily_all_readings(spark, sf_dir):
    """Several readings a day, a row for each, in the order in which they were taken."""
    return panel.process_daily(*panels.readings_inputs(spark, sf_dir), per_day="all")


METRIC_COLUMNS = [
    *KEYS, "bmi", "weight_velocity_7d", "protein_pct", "carbs_pct", "fat_pct", "deficit", "on_track",
    "protein_per_kg", "month", "weekday", "is_weekend",
]


@query("prepared_metrics")
def prepared_metrics(spark, sf_dir):
    return prepared(spark, sf_dir).select(*METRIC_COLUMNS, sc.bmi_band(F.col("bmi")).alias("bmi_band"))


@query("prepared_metrics_orders")
def prepared_metrics_orders(spark, sf_dir):
    return prepared_orders(spark, sf_dir).select(*METRIC_COLUMNS, sc.bmi_band(F.col("bmi")).alias("bmi_band"))


@query("ewm_weight")
def ewm_weight(spark, sf_dir):
    """Smoothed weight before any filling, so that nulls decay and carry."""
    days = panels.event_days(spark, sf_dir, "weight")
    return drop_blocks(ewm(with_blocks(days), "weight", "weight_smoothed", 10, 3))


@query("ewm_weight_orders")
def ewm_weight_orders(spark, sf_dir):
    """Long series cut into several blocks of rows."""
    days = panels.order_days(spark, sf_dir).select(*KEYS, "weight")
    return drop_blocks(ewm(with_blocks(days, 220), "weight", "weight_smoothed", 10, 3, 220))


@query("has_wearable_data")
def has_wearable_data(spark, sf_dir):
    return panel.has_wearable_data(panels.event_days(spark, sf_dir), report.WEARABLE_REPORT_COLUMNS)


# --- expenditure -------------------------------------------------------------------------------


@query("adaptive_tdee", 5)
def adaptive_tdee(spark, sf_dir):
    return with_energy(spark, sf_dir).select(*KEYS, "weight_smoothed", "tdee_adaptive")


@query("adaptive_tdee_orders", 5)
def adaptive_tdee_orders(spark, sf_dir):
    return energy_orders(spark, sf_dir).select(*KEYS, "weight_smoothed", "tdee_adaptive")


@query("rolling_tdee", 5)
def rolling_tdee(spark, sf_dir):
    return with_energy(spark, sf_dir).select(*KEYS, "tdee_14d", "tdee_30d")


@query("stable_tdee", 5)
def stable_tdee(spark, sf_dir):
    return energy.stable_estimate(energy_orders(spark, sf_dir))


@query("regression_tdee", 4)
def regression_tdee(spark, sf_dir):
    return energy.regression_estimate(with_energy(spark, sf_dir))


@query("tdee_estimates", 4)
def tdee_estimates(spark, sf_dir):
    return energy.estimates(with_energy(spark, sf_dir))


@query("tdee_estimates_orders", 4)
def tdee_estimates_orders(spark, sf_dir):
    return energy.estimates(energy_orders(spark, sf_dir))


@query("expenditure_methods", 4)
def expenditure_methods(spark, sf_dir):
    return energy.method_bars(energy.estimates(with_energy(spark, sf_dir)))


@query("expenditure_advice", 4)
def expenditure_advice(spark, sf_dir):
    days = with_energy(spark, sf_dir)
    recent = tail_rows(days.select(*KEYS, "energy"), 30).groupBy(ENTITY).agg(F.avg("energy").alias("recent_intake"))
    est = energy.estimates(days).select(ENTITY, "weighted_average")
    return energy.recommendation(est.join(recent, ENTITY))


@query("expenditure_line", 5)
def expenditure_line(spark, sf_dir):
    return report.expenditure_report(energy.with_estimates(energy_orders(spark, sf_dir)))["expenditure_line"]


# --- correlations ------------------------------------------------------------------------------


@query("nutrient_corr")
def nutrient_corr(spark, sf_dir):
    return correlate.nutrient_correlations(panels.processed_events(spark, sf_dir), NUTRIENTS)


@query("nutrient_corr_orders")
def nutrient_corr_orders(spark, sf_dir):
    return correlate.nutrient_correlations(panels.processed_orders(spark, sf_dir), NUTRIENTS)


@query("lagged_corr")
def lagged_corr(spark, sf_dir):
    return correlate.lagged_correlations(panels.processed_events(spark, sf_dir), NUTRIENTS)


@query("corr_ci")
def corr_ci(spark, sf_dir):
    return correlate.correlation_intervals(panels.processed_events(spark, sf_dir), NUTRIENTS)


@query("best_lag_bars")
def best_lag_bars(spark, sf_dir):
    return correlate.best_lag_bars(panels.processed_events(spark, sf_dir), NUTRIENTS)


@query("strongest_driver")
def strongest_driver(spark, sf_dir):
    return correlate.strongest_driver(correlate.best_lag_bars(panels.processed_events(spark, sf_dir), NUTRIENTS))


def lag_corr(spark, sf_dir, target="weight_change", recent=False, need=11):
    rows = wearable_report(spark, sf_dir)
    rows = tail_rows(rows, 30) if recent else rows
    return correlate.lag_correlations(rows, correlate.LAG_METRICS, target, 7, need)


@query("lag_matrix", 5)
def lag_matrix(spark, sf_dir):
    return correlate.lag_matrix(lag_corr(spark, sf_dir, "trend_change_7d", need=5))


@query("lag_best")
def lag_best(spark, sf_dir):
    return correlate.best_lags(lag_corr(spark, sf_dir))


@query("lag_two_targets")
def lag_two_targets(spark, sf_dir):
    targets = {"change": "weight_change", "trend": "trend_change_7d"}
    return correlate.lag_correlations_with(wearable_report(spark, sf_dir), correlate.LAG_METRICS, targets, 7, 8)


@query("lag_summary")
def lag_summary(spark, sf_dir):
    return report.lag_summary(wearable_report(spark, sf_dir), parts={"all_time": (None, 11), "recent": (30, 5)})


# --- attribution and regimes -------------------------------------------------------------------


@query("zscore_outliers")
def zscore_outliers(spark, sf_dir):
    return regimes.outlier_days(panels.processed_events(spark, sf_dir))


@query("largest_spikes")
def largest_spikes(spark, sf_dir):
    days = panels.processed_orders(spark, sf_dir)
    top = regimes.largest_outliers(regimes.outlier_days(days), 10)
    return top.select(*KEYS, "position", "weight_delta", "carbs_z", "sodium_z", "water_z", "tag")


@query("regimes")
def regime_rows(spark, sf_dir):
    return regimes.regime_table(wearable_report(spark, sf_dir))


@query("recovery_boxes")
def recovery_boxes(spark, sf_dir):
    return regimes.recovery_boxes(panels.processed_events(spark, sf_dir))


@query("activity_regime_runs")
def activity_regime_runs(spark, sf_dir):
    return regimes.activity_regime_runs(wearable_report(spark, sf_dir))


@query("bias_signal")
def bias_signal(spark, sf_dir):
    return regimes.bias_signal(wearable_report(spark, sf_dir), min_pairs=5)


@query("recovery_scatter")
def recovery_scatter(spark, sf_dir):
    return regimes.recovery_scatter(wearable_report(spark, sf_dir))


@query("report_inputs", 5)
def report_inputs(spark, sf_dir):
    cols = [
        *KEYS, "w_sleep_hours", "w_total_intensity_min", "w_session_min", "w_session_kcal", "w_session_avg_hr",
        "w_session_max_hr", "activity_proxy", "activity_proxy_7d", "trend_change_7d", "week",
    ]
    return wearable_report(spark, sf_dir).select(*cols)


# --- rollups -----------------------------------------------------------------------------------


@query("weekly_table", 5)
def weekly_table(spark, sf_dir):
    return rollup.weekly_table(with_energy(spark, sf_dir))


@query("weekly_table_orders", 5)
def weekly_table_orders(spark, sf_dir):
    return rollup.weekly_table(energy_orders(spark, sf_dir))


@query("weekly_decision", 5)
def weekly_decision(spark, sf_dir):
    return rollup.weekly_decision(wearable_report(spark, sf_dir))


@query("waterfall")
def waterfall(spark, sf_dir):
    return rollup.waterfall(panels.processed_events(spark, sf_dir))


@query("waterfall_orders")
def waterfall_orders(spark, sf_dir):
    return rollup.waterfall(panels.processed_orders(spark, sf_dir))


@query("weekly_activity")
def weekly_activity(spark, sf_dir):
    return rollup.weekly_activity(panels.event_days(spark, sf_dir))


@query("dow_stats")
def dow_stats(spark, sf_dir):
    return rollup.weekday_stats(panels.event_days(spark, sf_dir, "energy"))


@query("intake_variation")
def intake_variation(spark, sf_dir):
    return rollup.intake_variation(panels.order_days(spark, sf_dir))


@query("weekend_difference")
def weekend_difference(spark, sf_dir):
    return rollup.weekend_difference(panels.order_days(spark, sf_dir))


@query("coverage_month")
def coverage_month(spark, sf_dir):
    return rollup.coverage_by_month(panels.event_days(spark, sf_dir), panels.sessions(spark, sf_dir))


@query("coverage_month_orders")
def coverage_month_orders(spark, sf_dir):
    return rollup.coverage_by_month(panels.order_days(spark, sf_dir))


@query("weekday_boxes")
def weekday_boxes(spark, sf_dir):
    return rollup.weekday_boxes(panels.order_days(spark, sf_dir))


@query("hist_weekend")
def hist_weekend(spark, sf_dir):
    return rollup.weekend_histogram(panels.processed_orders(spark, sf_dir))


@query("adherence_days")
def adherence_days(spark, sf_dir):
    return rollup.adherence_days(prepared_orders(spark, sf_dir))


@query("adherence_counts")
def adherence_counts(spark, sf_dir):
    return rollup.adherence_counts(prepared_orders(spark, sf_dir))


@query("adherence_insights")
def adherence_insights(spark, sf_dir):
    return rollup.adherence_insights(prepared(spark, sf_dir), GOALS.target_energy)


@query("recent_macros")
def recent_macros(spark, sf_dir):
    return rollup.recent_macros(prepared(spark, sf_dir))


@query("key_figures", 5)
def key_figures(spark, sf_dir):
    return rollup.key_figures(with_energy(spark, sf_dir))


@query("month_calendar")
def month_calendar(spark, sf_dir):
    return rollup.month_calendar(panels.processed_events(spark, sf_dir), report.CALENDAR_COLUMNS)


@query("macros_daily")
def macros_daily(spark, sf_dir):
    return report.macros_report(prepared_orders(spark, sf_dir))["macros_daily"]


@query("wearable_recovery")
def wearable_recovery(spark, sf_dir):
    return report.context_report(tail_rows(prepared(spark, sf_dir), 42), GOALS)["wearable_recovery"]


# --- sessions and samples ----------------------------------------------------------------------


@query("session_daily")
def session_daily(spark, sf_dir):
    return ses.session_daily(panels.sessions(spark, sf_dir))


@query("session_groups")
def session_groups(spark, sf_dir):
    return ses.group_contribution(panels.sessions(spark, sf_dir), panels.processed_events(spark, sf_dir))


@query("session_week_pivot")
def session_week_pivot(spark, sf_dir):
    return ses.group_week_pivot(panels.sessions(spark, sf_dir))


@query("session_table")
def session_table(spark, sf_dir):
    return ses.newest_sessions(panels.sessions(spark, sf_dir), panels.processed_events(spark, sf_dir))


@query("hr_daily")
def hr_daily(spark, sf_dir):
    return ses.sample_daily(panels.samples(spark, sf_dir))


@query("hr_daily_stream")
def hr_daily_stream(spark, sf_dir):
    """The same from a stream of the event file."""
    root = f"{shared_dir(spark)}/daypanel-stream/{_fresh()}"
    schema = panels.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = events.select(
        F.col("user_id").alias(ENTITY), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("bpm")
    )
    live.write_daily_samples(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return live.read_daily_samples(spark, f"{root}/table")


# --- incremental history -----------------------------------------------------------------------


def _fresh() -> str:
    import uuid

    return uuid.uuid4().hex


@query("merge_daily")
def merge_daily(spark, sf_dir):
    return sync.merge_daily(*panels.two_batches(spark, sf_dir))


@query("merge_stream")
def merge_stream(spark, sf_dir):
    """The same merge from files that arrive one after the other."""
    root = f"{shared_dir(spark)}/daypanel-stream/{_fresh()}"
    old, new = panels.two_batches(spark, sf_dir)
    old = old.withColumn("w_readiness", F.lit(None).cast("double"))
    for part in (old, new.select(*old.columns)):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(old.schema).parquet(f"{root}/landing")
        live.upsert_stream(stream, f"{root}/store/daily", jobs.merge_daily_rows, f"{root}/checkpoint").awaitTermination()
    return jobs.read_daily_history(spark, f"{root}/store")


def session_batches(spark, sf_dir):
    """Sessions as stored, and a later batch that repeats the last days with corrected energy."""
    sessions = ses.with_group(panels.sessions(spark, sf_dir))
    late = sessions.filter(F.col(DAY) >= F.lit(panels.SPLIT_DAY).cast("date"))
    old = sessions.filter(F.col(DAY) <= F.date_add(F.lit(panels.SPLIT_DAY).cast("date"), 3))
    return old, late.withColumn("kcal", F.col("kcal") + 1)


@query("merge_sessions")
def merge_sessions(spark, sf_dir):
    return sync.merge_sessions(*session_batches(spark, sf_dir))


@query("merge_samples")
def merge_samples(spark, sf_dir):
    samples = panels.samples(spark, sf_dir)
    late = samples.filter(F.col(DAY) >= F.lit(panels.SPLIT_DAY).cast("date")).withColumn("bpm", F.col("bpm") + 0.5)
    return sync.merge_samples(samples, late)


@query("store_roundtrip")
def store_roundtrip(spark, sf_dir):
    """Two sync runs into a versioned store; the second rewrites only the months it touches."""
    root = f"{shared_dir(spark)}/daypanel-store/{_fresh()}"
    table = f"{root}/sessions"
    for batch in session_batches(spark, sf_dir):
        jobs.upsert_table(batch, table, sync.merge_sessions, sync.durable_key())
    return sinks.read_version(spark, table).groupBy(*KEYS, "session_group").agg(
        F.count(F.lit(1)).alias("sessions"), F.round(F.sum("kcal"), 3).alias("kcal")
    )


def history(spark, sf_dir):
    return sync.merge_daily(*panels.two_batches(spark, sf_dir))


@query("sync_bounds")
def sync_bounds(spark, sf_dir):
    """Every entity's history ends some landed days before its last one; entities with few days have none yet."""
    return sync.sync_bounds(panels.event_days(spark, sf_dir, "energy"), panels.stored_days(spark, sf_dir), CONFIG)


@query("gap_dates")
def gap_dates(spark, sf_dir):
    old = panels.stored_days(spark, sf_dir)
    return sync.gap_days(old, CONFIG, sync.sync_bounds(old, old, CONFIG))


@query("gap_dates_several")
def gap_dates_several(spark, sf_dir):
    """No priority metric: only days missing several monitored ones at once."""
    return sync.gap_days(panels.event_days(spark, sf_dir), CONFIG, priority=["w_session_count"])


@query("sync_dates")
def sync_dates(spark, sf_dir):
    return jobs.plan_sync(panels.event_days(spark, sf_dir, "energy"), panels.stored_days(spark, sf_dir), CONFIG)


# --- payloads ----------------------------------------------------------------------------------


@query("payload_daily")
def payload_daily(spark, sf_dir):
    return payload.normalise(panels.landed_payloads(spark, sf_dir))[0]


@query("payload_samples")
def payload_samples(spark, sf_dir):
    return payload.normalise(panels.landed_payloads(spark, sf_dir))[2]


@query("payload_session_days")
def payload_session_days(spark, sf_dir):
    """Daily session totals from the session lists of the day, without details."""
    landed, _ = landed_session_payloads(spark, sf_dir)
    return payload.daily_rows(landed).select(*KEYS, *ses.SESSION_DAILY)


def landed_session_payloads(spark, sf_dir):
    """Pages of session lists per day in three wrappers, as JSON text, and detail payloads for some."""
    rows = panels.sessions(spark, sf_dir).withColumn("variant", F.col(ENTITY) % 3)
    c = F.col
    nest = lambda **f: F.struct(*(v.alias(k) for k, v in f.items()))
    one = F.when(
        c("variant") == 0,
        F.to_json(nest(
            activityId=c("session_id"), activityName=c("session_name"), activityType=nest(typeKey=c("session_type")),
            startTimeLocal=c("start_time"), durationInSeconds=c("duration_min") * 60, calories=c("kcal"), averageHR=c("avg_hr"),
        )),
    ).when(
        c("variant") == 1,
        F.to_json(nest(
            summaryId=c("session_id").cast("string"), activityTypeDTO=nest(typeKey=c("session_type")),
            summaryDTO=nest(
                activityName=c("session_name"), startTimeGMT=c("start_time"), duration=c("duration_min"),
                calories=c("kcal"), averageHeartRate=c("avg_hr"),
            ),
        )),
    ).otherwise(
        F.to_json(nest(
            id=c("session_id"), activityName=F.concat(F.lit("  "), c("session_name"), F.lit(" ")), activityType=c("session_type"),
            startTimeGMT=c("start_time"), durationInMinutes=c("duration_min"), activityCalories=c("kcal"),
            averageHeartRate=c("avg_hr"), trainingLoad=c("training_load"),
        ))
    )
    # Three pages a day; every fifth session with an id stands on two of them, as lists shift while they are read.
    page = F.pmod(F.xxhash64("start_time", "session_type", "duration_min"), F.lit(3)).cast("int")
    pages = F.when(c("session_id") % 5 == 0, F.array(page, page + 1)).otherwise(F.array(page))
    rows = rows.withColumn("page", F.explode(pages))
    listed = rows.groupBy(*KEYS, "variant", "page").agg(F.concat(F.lit("["), F.array_join(F.collect_list(one), ","), F.lit(",9]")).alias("l"))
    wrapped = F.when(c("variant") == 0, c("l")).otherwise(
        F.concat(F.lit('{"'), F.when(c("variant") == 1, "activities").otherwise("data"), F.lit('":'), c("l"), F.lit("}"))
    )
    landed = listed.select(*KEYS, "page", F.lit("activity").alias("endpoint"), wrapped.alias("payload"))
    detail = rows.drop("page").distinct().filter("session_id is not null and session_id % 2 = 0").select(
        ENTITY, "session_id",
        F.concat(F.lit('{"calories":'), (c("session_id") % 100).cast("string"), F.lit(',"averageHR":null,"maxHR":150}')).alias("payload"),
    )
    return landed, detail


@query("payload_sessions")
def payload_sessions(spark, sf_dir):
    landed, detail = landed_session_payloads(spark, sf_dir)
    return payload.session_rows(landed, detail)


# --- trends and goals --------------------------------------------------------------------------


@query("weight_trends")
def weight_trends(spark, sf_dir):
    return trend.weight_trends(panels.processed_orders(spark, sf_dir))


@query("axis_limits")
def axis_limits(spark, sf_dir):
    return trend.axis_limits(panels.event_days(spark, sf_dir, "weight"), 79.0)


@query("weight_projection", 5)
def weight_projection(spark, sf_dir):
    return trend.projection(energy.smooth_weight(panels.processed_orders(spark, sf_dir)))


@query("weight_scenarios", 4)
def weight_scenarios(spark, sf_dir):
    return trend.scenarios(energy_orders(spark, sf_dir), ORDER_GOALS.target_weight)


@query("scenario_paths", 4)
def scenario_paths(spark, sf_dir):
    return trend.scenario_paths(trend.scenarios(with_energy(spark, sf_dir), GOALS.target_weight))


@query("goal_progress", 5)
def goal_progress(spark, sf_dir):
    return trend.goal_progress(energy.smooth_weight(panels.processed_orders(spark, sf_dir)), ORDER_GOALS.target_weight)


@query("goal_change")
def goal_change(spark, sf_dir):
    return trend.cumulative_change(panels.event_days(spark, sf_dir, "weight"))


@query("burndown", 3)
def burndown(spark, sf_dir):
    return trend.burndown(energy.with_estimates(with_energy(spark, sf_dir)))


@query("burndown_targets", 3)
def burndown_targets(spark, sf_dir):
    return trend.burndown_state(with_energy(spark, sf_dir), GOALS.target_weight)


@query("status_summary", 5)
def status_summary(spark, sf_dir):
    return trend.status_summary(energy_orders(spark, sf_dir), ORDER_GOALS)


@query("report_summary", 4)
def report_summary(spark, sf_dir):
    """The joined summary page: state, estimate, advice, weekends and the strongest nutrient."""
    return report.summary_report(report.enriched_daily(panels.processed_orders(spark, sf_dir), ORDER_GOALS), ORDER_GOALS)["summary"]


# --- text labelling ----------------------------------------------------------------------------


@query("stratified_sample")
def stratified_sample(spark, sf_dir):
    docs = panels.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    return text.stratified_sample(docs, "source", "doc_id", SAMPLE_SIZE)


@query("stratum_quotas")
def stratum_quotas(spark, sf_dir):
    docs = panels.table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return text.stratum_quotas(docs, "source", SAMPLE_SIZE).withColumnRenamed("_quota", "quota")


@query("text_preview")
def text_preview(spark, sf_dir):
    return text.preview(panels.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id", 10)


@query("text_prepare")
def text_prepare(spark, sf_dir):
    ready = text.prepare_text(text.fill_category(panels.foods(spark, sf_dir)))
    return ready.select("doc_id", "category", "label", F.md5("combined").alias("combined_md5"))


@query("text_classify")
def text_classify(spark, sf_dir):
    """Every document is scored once by a model of the rows not held out.

    What SQL can state of it: scores lie between 0 and 1, the label follows the score, and on held-out rows the labels are right more often
    than the stated rate and junk scores higher on average.
    """
    rows = text.prepare_text(text.fill_category(panels.foods(spark, sf_dir)))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = text.train_classifier(rows.where(~held_out))
    scored = jobs.materialise(text.label_table(model, rows.select("doc_id", "label", "combined")).withColumn("held_out", held_out), "scored")
    right = F.col("generated_label") == text.label_text(F.col("label"))
    of = lambda k: F.avg(F.when(F.col("label") == k, F.col("score")))
    accuracy, junk, other = scored.where("held_out AND label IS NOT NULL").agg(F.avg(right.cast("int")), of(1), of(0)).first()
    return scored.select(
        "doc_id", F.col("score").between(0, 1).alias("in_range"),
        (F.col("generated_label") == F.when(F.col("score") > 0.5, "Junk").otherwise("Not Junk")).alias("label_follows"),
        F.lit(accuracy >= LEAST_ACCURACY).alias("accurate"), F.lit(junk > other).alias("separates"),
    )


# Queries over files and over the long panel register themselves.
from checks import file_queries, long_queries  # noqa: E402,F401
