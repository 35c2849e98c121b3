"""Files in the shapes of the inputs, written from the driver tables: CSVs, exports and landed payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, shared_dir
from daypanel.plans import panels
from daypanel.sources.tables import INTAKE_HEADERS

HOUSEHOLDS = 12  # an export belongs to a household of several users, whose records of a day compete
# Ids whose records one file of a household may hold: a month of 2,000 users, or 25,000 sessions, is some ten megabytes, however many there are.
USERS_A_FILE, EVENTS_A_FILE = 24_000, 300_000


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/daypanel/{uuid.uuid4().hex}/{name}"


def write_csvs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The three daily inputs as CSV folders with their original headers.

    Some sodium cells are no numbers, and on two days every user has one more record with too many fields.
    """
    intake, biometrics, wearable = panels.three_inputs(spark, sf_dir)
    root = new_folder(spark, "csv")
    paths = {name: f"{root}/{name}" for name in ("intake", "biometrics", "wearable")}
    heads = {c: h for h, c in INTAKE_HEADERS.items()}
    day_number = F.dayofmonth(DAY)
    cells = intake.withColumn("sodium", F.when(F.col(ENTITY) % 4 == 1, "n/a").otherwise(F.col("sodium").cast("string")))
    more = F.when(day_number.isin(5, 17), F.array(F.lit("true"), F.lit("true,one,more"))).otherwise(F.array(F.lit("true")))
    cells = cells.withColumn("Completed", F.explode(more)).withColumnsRenamed(heads)
    # Without quotes the extra fields are fields of their own.
    cells.write.option("header", True).option("quote", "\u0000").csv(paths["intake"])
    biometrics.withColumnsRenamed({DAY: "Day", "metric": "Metric", "unit": "Unit", "amount": "Amount"}).write.option("header", True).csv(paths["biometrics"])
    named = {c: "watch_" + c.removeprefix("w_") for c in wearable.columns if c.startswith("w_")}
    wearable.withColumnsRenamed({DAY: "Date", **named}).withColumn("other", F.lit(9)).write.option("header", True).csv(paths["wearable"])
    return paths


def nested(**fields: Column) -> Column:
    return F.struct(*(v.alias(k) for k, v in fields.items()))


def days_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.event_days(spark, sf_dir).withColumnRenamed(ENTITY, "user").withColumn("household", F.col("user") % HOUSEHOLDS)


def write_export(spark: SparkSession, sf_dir: str) -> str:
    """An export of every household: files of JSON arrays of a bounded size, with records in the order of day and user.

    Files of a kind come in two series, of which the second wins; the files of a series follow each other by user, then by month, so records of
    a day compete as if each series were one file.
    """
    root = new_folder(spark, "export")
    d, c = days_of_users(spark, sf_dir), F.col
    odd = c("user") % 2 == 1
    third = c("user") % 3 == 0
    day, none = c(DAY).cast("string"), F.lit(None).cast("double")
    entry = lambda kind, value: nested(type=F.lit(kind), value=value)
    level = lambda kind, value: nested(type=F.lit(kind), averageStressLevel=value)
    seen = lambda kind, avg, low=none, high=none: nested(summaryType=F.lit(kind), minValue=low, maxValue=high, avgValue=avg)
    records = {
        "DI-Connect-Aggregator/UDSFile_{}.json": (d, nested(
            calendarDate=day, totalSteps=c("w_steps"), totalDistanceMeters=c("w_distance_m"), activeKilocalories=c("w_active_kcal"),
            moderateIntensityMinutes=c("w_moderate_min"), vigorousIntensityMinutes=c("w_vigorous_min"),
            restingHeartRate=F.when(odd, c("w_resting_hr")).otherwise(0.0), currentDayRestingHeartRate=F.when(third, c("w_hrv")),
            minHeartRate=c("w_respiration") + 30, maxHeartRate=c("w_sleep_score") + 60, averageSpo2Value=F.when(odd, 95.0),
            allDayStress=nested(aggregatorList=F.when(third, F.array(level("AWAKE", F.lit(1.0)), level("TOTAL", c("w_avg_stress")))).otherwise(F.array(level("AWAKE", c("w_avg_stress"))))),
            bodyBattery=nested(bodyBatteryStatList=F.array(nested(statsValue=c("w_body_battery_max")), nested(statsValue=c("w_body_battery_min")))),
            respiration=nested(avgRespiration=c("w_respiration")),
        )),
        "DI-Connect-Wellness/{}_sleepData.json": (d.where(c("user") % 5 != 0), nested(
            calendarDate=day, sleepTimeSeconds=F.when(odd, c("w_sleep_seconds")), deepSleepSeconds=c("w_avg_stress") * 60, lightSleepSeconds=none,
            remSleepSeconds=c("w_moderate_min") * 60, sleepScores=nested(overallScore=c("w_sleep_score")),
            averageRespiration=F.when(third, 0.0).otherwise(c("w_respiration")), averageSPO2=F.when(third, 93.0),
        )),
        "DI-Connect-Wellness/{}_fitnessAgeData.json": (d.where(c("user") % 7 != 0), nested(
            asOfDateGmt=F.when(odd, F.concat(day, F.lit("T00:00:00.0"))).otherwise(""), rhrLastEntryDate=F.unix_millis(c(DAY).cast("timestamp")), rhr=c("w_resting_hr"),
        )),
        "DI-Connect-Wellness/{}_healthStatusData.json": (d, nested(
            calendarDate=day, metrics=F.array(entry("HRV", F.when(third, 0.0).otherwise(c("w_hrv"))), entry("HR", c("w_resting_hr")), entry("HR", F.lit(1.0)), entry("SPO2", none)),
        )),
        "DI-Connect-Wellness/{}_wellnessActivities.json": (d, nested(
            calendarDate=day, summaryTypeDataList=F.when(odd, F.array(seen("STRESS", c("w_avg_stress")))).otherwise(F.array(
                seen("HEART_RATE", c("w_resting_hr"), c("w_respiration"), c("w_sleep_score")), seen("RMSSD_HRV", c("w_hrv")), seen("RESPIRATION", c("w_respiration")), seen("STRESS", F.lit(7.0)),
            )),
        )),
    }
    texts = [
        rows.groupBy("household", file_number(F.col("user"), USERS_A_FILE).alias("n")).agg(json_array(F.sort_array(F.collect_list(F.struct(DAY, "user", record.alias("record"))))).alias("value"))
        .select("household", F.lit(name).alias("name"), "n", "value")
        for name, (rows, record) in records.items()
    ]
    texts.append(session_files(spark, sf_dir))
    files = texts[0]
    for t in texts[1:]:
        files = files.unionByName(t)
    full = F.replace("name", F.lit("{}"), c("n"))
    files = files.select(
        c("household").cast("string").alias("entity"), F.substring_index(full, "/", 1).alias("folder"), F.substring_index(full, "/", -1).alias("file"), "value",
    )
    files.write.partitionBy("entity", "folder", "file").text(root)
    return root


def file_number(number: Column, ids: int) -> Column:
    """Which of a household's files holds a record: the series, the block of ids in their order, the month."""
    series = F.when(F.col("user") % 5 < 3, "1").otherwise("2")
    block = F.coalesce(F.floor(number / ids), F.lit(0)) + F.lit(10**15)  # as many digits for every id, negative ones too
    return F.concat_ws("-", series, block.cast("string"), F.coalesce(F.date_format(DAY, "yyyy-MM"), F.lit("undated")))


def json_array(sorted_records: Column) -> Column:
    return F.to_json(F.transform(sorted_records, lambda x: x["record"]))


def session_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as exported sessions: times as epoch milliseconds, epoch seconds or text, some without any."""
    c = F.col
    events = panels.table(spark, sf_dir, "events").withColumns({"user": c("user_id"), "household": c("user_id") % HOUSEHOLDS, DAY: c("ts").cast("date")})
    kind = F.lit(None).cast("string")
    for event, name in panels.SESSION_OF_EVENT.items():
        kind = F.when(c("event_type") == event, name).otherwise(kind)
    whole = F.date_trunc("second", "ts")
    variant = c("event_id") % 4
    # One field holds numbers or text, so the record is put together as text.
    stamp = F.when(variant == 0, F.unix_millis(whole).cast("string")).when(variant == 1, F.unix_seconds(whole).cast("string")).when(variant == 2, F.concat(F.lit('"'), F.date_format(whole, "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"')))
    fields = F.to_json(nested(
        activityId=F.when(c("event_id") % 7 != 0, c("event_id")), name=F.concat(F.lit(" "), c("event_type"), F.lit(" ")), activityType=kind,
        startTimeGmt=F.when((variant == 3) & (c("event_id") % 3 != 0), F.unix_millis(whole)), duration=c("value") * 60000, distance=c("value") * 100,
        avgHr=F.when(c("event_type") != "error", c("value") * 0.064 + 90), maxHr=F.when(c("event_type") != "error", c("value") * 0.128 + 110), calories=c("value") * 5,
    ))
    record = F.when(stamp.isNull(), fields).otherwise(F.concat(F.lit('{"startTimeLocal":'), stamp, F.lit(","), F.substring(fields, F.lit(2), F.length(fields))))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", record.alias("record")))), lambda x: x["record"])
    value = F.concat(F.lit('[{"summarizedActivitiesExport":['), F.array_join(listed, ","), F.lit("]}]"))
    return events.groupBy("household", file_number(c("event_id"), EVENTS_A_FILE).alias("n")).agg(value.alias("value")).select(
        "household", F.lit("DI-Connect-Fitness/{}_summarizedActivities.json").alias("name"), "n", "value"
    )


def summary_payloads(spark: SparkSession, sf_dir: str, last_day: str, more: float) -> DataFrame:
    """Landed daily summaries up to a day; in the early landing the tenth is missing for some users, and ``more`` is added to the steps."""
    days = panels.event_days(spark, sf_dir).where(F.col(DAY) <= F.lit(last_day).cast("date"))
    if more:
        days = days.where((F.col(ENTITY) % 5 != 0) | (F.dayofmonth(DAY) != 10))
    body = F.to_json(nested(totalSteps=F.col("w_steps") + more, totalDistanceMeters=F.col("w_distance_m"), activeKilocalories=F.col("w_active_kcal")))
    return days.select(*KEYS, F.lit("summary").alias("endpoint"), body.alias("payload"), F.col(DAY).cast("timestamp").alias("landed_at"))
