"""Historical export files: arrays of JSON records under ``root/<entity>/<folder>/<file>``.

Files are read whole so that the order of records inside a file can decide ties: of several
records for one day the one in the later file, then the later position, wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, WEARABLE_TYPES, conform, empty, keep_last
from daypanel.functions import payloads as pl
from daypanel.functions.scalars import any_timestamp, first_truthy
from daypanel.operators.payload import battery_bounds, session_columns
from daypanel.operators.sessions import session_counts, session_daily
from daypanel.sources.tables import path_exists

# File patterns and record fields of the export.
PATTERNS = {
    "summary": "DI-Connect-Aggregator/UDSFile_*.json",
    "sleep": "DI-Connect-Wellness/*_sleepData.json",
    "fitness": "DI-Connect-Wellness/*_fitnessAgeData.json",
    "health": "DI-Connect-Wellness/*_healthStatusData.json",
    "wellness": "DI-Connect-Wellness/*_wellnessActivities.json",
    "sessions": "DI-Connect-Fitness/*_summarizedActivities.json",
}
METRICS_TYPE = "array<struct<type:string,value:string>>"
WELLNESS_TYPE = "array<struct<summaryType:string,minValue:string,maxValue:string,avgValue:string>>"
STRESS_TYPE = "array<struct<type:string,averageStressLevel:string>>"
BATTERY_TYPE = "array<struct<statsValue:string>>"


def export_files(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """(entity, file, value): whole files of one kind, in ``root/<entity>/<folder>/<file>``; none if there is none.

    An export landed by a Spark job has folders ``entity=…/folder=…/file=…`` instead, with one part file in each.
    """
    folder, name = PATTERNS[kind].split("/")
    plain, landed = f"{root.rstrip('/')}/*/{folder}/{name}", f"{root.rstrip('/')}/entity=*/folder={folder}/file={name}/part-*"
    step = lambda i: F.element_at(F.split(F.col("_metadata.file_path"), "/"), i)
    places = [(plain, step(-3), F.col("_metadata.file_path")), (landed, F.substring_index(step(-4), "=", -1), step(-2))]
    found = None
    for pattern, entity, file in places:
        if path_exists(spark, pattern):
            # The landed folders' names would become columns; the path says the same.
            files = spark.read.schema("value string").option("wholetext", True).format("text").load(pattern)
            files = files.select(entity.alias(ENTITY), file.alias("file"), "value")
            found = files if found is None else found.unionByName(files)
    return found


def export_records(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """(entity, file, pos, rec): every object of the record arrays of one kind."""
    files = export_files(spark, root, kind)
    if files is None:
        return empty(spark, {"file": "string", "pos": "int", "rec": "variant"}, {ENTITY: "string"})
    files = files.select(ENTITY, "file", pl.parsed(F.col("value")).alias("v"))
    as_list = F.try_variant_get("v", "$", "array<variant>")
    items = F.coalesce(as_list, F.array("v"))
    return files.select(ENTITY, "file", F.posexplode(items).alias("pos", "rec")).filter(
        pl.is_object(F.col("rec"))
    )


def text_at(*path: str) -> Column:
    return F.try_variant_get("rec", pl.path_text(path), "string")


def number_at(*path: str) -> Column:
    return pl.number(text_at(*path))


def typed_at(path: tuple[str, ...], ddl: str) -> Column:
    return F.from_json(text_at(*path), ddl)


def calendar_day() -> Column:
    return F.to_date(F.try_to_timestamp(F.nullif(text_at("calendarDate"), F.lit(""))))


def with_timestamps(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Columns of UTC timestamps from fields of a record: a JSON number is an epoch, JSON text is ISO text.

    Text and kind of a field become columns first: an expression that names them many times would read the record as often.
    """
    kind = lambda f: F.schema_of_variant(F.try_variant_get("rec", pl.path_text((f,)), "variant"))
    rows = rows.withColumns({f"_text_{c}": text_at(f) for c, f in fields.items()} | {f"_is_text_{c}": kind(f) == "STRING" for c, f in fields.items()})
    moment = lambda text, is_text: any_timestamp(F.when(~is_text, pl.number(text)), F.when(is_text, text))
    rows = rows.withColumns({c: moment(F.col(f"_text_{c}"), F.col(f"_is_text_{c}")) for c in fields})
    return rows.drop(*(f"_text_{c}" for c in fields), *(f"_is_text_{c}" for c in fields))


def with_day(rows: DataFrame, day: Column) -> DataFrame:
    """The dated rows and their day, which is computed once: as a generated column its filter does not compute it again."""
    return rows.select("*", F.explode_outer(F.array(day)).alias(DAY)).filter(F.col(DAY).isNotNull())


def by_calendar_day(spark: SparkSession, root: str, kind: str) -> DataFrame:
    rows = with_day(export_records(spark, root, kind), calendar_day())
    return keep_last(rows, KEYS, [F.col("file"), F.col("pos")])


def summary_days(spark: SparkSession, root: str) -> DataFrame:
    stress = typed_at(("allDayStress", "aggregatorList"), STRESS_TYPE)
    battery = F.try_variant_get("rec", "$['bodyBattery']", "variant")
    battery_text = text_at("bodyBattery")
    high, low = battery_bounds(battery_text, battery)
    listed = F.transform(
        typed_at(("bodyBattery", "bodyBatteryStatList"), BATTERY_TYPE), lambda s: s["statsValue"].try_cast("double")
    )
    neither = high.isNull() & low.isNull()
    respiration = F.coalesce(
        pl.number(F.when(F.try_variant_get("rec", "$['respiration']", "map<string,variant>").isNull(), text_at("respiration"))),
        pl.number(
            F.coalesce(
                text_at("respiration", "averageRespiration"), text_at("respiration", "avgRespiration"),
                text_at("respiration", "value"),
            )
        ),
    )
    return by_calendar_day(spark, root, "summary").select(
        *KEYS,
        number_at("totalSteps").alias("w_steps"),
        number_at("totalDistanceMeters").alias("w_distance_m"),
        number_at("activeKilocalories").alias("w_active_kcal"),
        number_at("moderateIntensityMinutes").alias("w_moderate_min"),
        number_at("vigorousIntensityMinutes").alias("w_vigorous_min"),
        number_at("restingHeartRate").alias("rest_now"),
        number_at("currentDayRestingHeartRate").alias("rest_day"),
        number_at("minHeartRate").alias("hr_min"),
        number_at("maxHeartRate").alias("hr_max"),
        number_at("averageSpo2Value").alias("spo2_day"),
        pl.number(pl.total_or_first(stress, "type", "averageStressLevel")).alias("stress_day"),
        F.when(neither, F.array_max(listed)).otherwise(high).alias("w_body_battery_max"),
        F.when(neither, F.array_min(listed)).otherwise(low).alias("w_body_battery_min"),
        respiration.alias("resp_day"),
    )


def sleep_days(spark: SparkSession, root: str) -> DataFrame:
    return by_calendar_day(spark, root, "sleep").select(
        *KEYS,
        pl.stage_total(
            number_at("sleepTimeSeconds"), number_at("deepSleepSeconds"), number_at("lightSleepSeconds"),
            number_at("remSleepSeconds"),
        ).alias("w_sleep_seconds"),
        pl.number(F.coalesce(text_at("sleepScores", "overallScore"), text_at("overallSleepScore"))).alias("w_sleep_score"),
        number_at("averageRespiration").alias("resp_sleep"),
        pl.number(F.coalesce(text_at("spo2SleepSummary", "averageSPO2"), text_at("averageSPO2"))).alias("spo2_sleep"),
    )


def fitness_days(spark: SparkSession, root: str) -> DataFrame:
    """Keyed by the first of two dates that is given; one that does not parse drops the record."""
    first = F.nullif(text_at("asOfDateGmt"), F.lit(""))
    rows = with_timestamps(export_records(spark, root, "fitness"), {"_as_of": "asOfDateGmt", "_last_entry": "rhrLastEntryDate"})
    rows = with_day(rows, F.to_date(F.when(first.isNotNull(), F.col("_as_of")).otherwise(F.col("_last_entry")))).drop("_as_of", "_last_entry")
    rows = keep_last(rows, KEYS, [F.col("file"), F.col("pos")])
    return rows.select(*KEYS, number_at("rhr").alias("rest_fitness"))


def health_days(spark: SparkSession, root: str) -> DataFrame:
    metrics = typed_at(("metrics",), METRICS_TYPE)
    value = lambda t: pl.number(pl.typed_entry(metrics, "type", t)["value"])
    return by_calendar_day(spark, root, "health").select(
        *KEYS, value("HR").alias("hr_health"), value("HRV").alias("hrv_health"),
        value("RESPIRATION").alias("resp_health"), value("SPO2").alias("spo2_health"),
    )


def wellness_days(spark: SparkSession, root: str) -> DataFrame:
    """Of several snapshots of a day the one with the longest list; ties to the later one."""
    entries = typed_at(("summaryTypeDataList",), WELLNESS_TYPE)
    rows = with_day(export_records(spark, root, "wellness"), calendar_day())
    rows = rows.withColumn("entries", entries)
    size = F.coalesce(F.size("entries"), F.lit(0))
    rows = keep_last(rows, KEYS, [size, F.col("file"), F.col("pos")])

    def value(t: str, f: str = "avgValue") -> Column:
        return pl.number(pl.typed_entry(F.col("entries"), "summaryType", t)[f])

    return rows.select(
        *KEYS, value("STRESS").alias("stress_snap"), value("HEART_RATE", "minValue").alias("hr_min_snap"),
        value("HEART_RATE", "maxValue").alias("hr_max_snap"), value("HEART_RATE").alias("hr_snap"),
        value("RMSSD_HRV").alias("hrv_snap"), value("RESPIRATION").alias("resp_snap"), value("SPO2").alias("spo2_snap"),
    )


def export_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Sessions of the export: milliseconds become seconds, times become ISO text, undated ones drop."""
    containers = export_records(spark, root, "sessions").select(
        ENTITY, F.explode(pl.objects_only(F.try_variant_get("rec", "$['summarizedActivitiesExport']", "array<variant>"))).alias("rec")
    )
    containers = with_timestamps(containers, {"_local": "startTimeLocal", "_begin": "beginTimestamp", "_gmt": "startTimeGmt"})
    rows = with_day(containers, F.to_date(F.coalesce("_local", "_begin", "_gmt")))
    iso = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")
    start = F.coalesce(iso("_local"), iso("_gmt"))
    seconds = number_at("duration") / 1000.0
    given = {
        "session_name": F.nullif(F.trim(text_at("name")), F.lit("")),
        "start_time": start,
        "duration_min": F.coalesce(number_at("durationInMinutes"), seconds / 60.0),
        "avg_hr": number_at("avgHr"),
        "max_hr": number_at("maxHr"),
    }
    return session_columns(rows, F.col("rec"), pl.parsed(F.lit(None).cast("string")), given)


def export_daily(spark: SparkSession, root: str, sessions: DataFrame | None = None) -> DataFrame:
    """Wearable days from all export sources.

    The sources are stacked and grouped once by (entity, day), one exchange instead of a chain of
    outer joins.
    """
    sessions = export_sessions(spark, root) if sessions is None else sessions
    sources = [
        summary_days(spark, root), sleep_days(spark, root), fitness_days(spark, root), health_days(spark, root),
        wellness_days(spark, root), session_daily(sessions), session_counts(sessions),
    ]
    return combine_daily(sources)


def combine_daily(sources: list[DataFrame]) -> DataFrame:
    """Union of the days of all sources, each field from the first source that has it."""
    stacked = sources[0]
    for s in sources[1:]:
        stacked = stacked.unionByName(s, allowMissingColumns=True)
    fields = [c for c in stacked.columns if c not in KEYS]
    one = stacked.groupBy(*KEYS).agg(*(F.first(c, ignorenulls=True).alias(c) for c in fields))
    c = F.col
    one = one.withColumns(
        {
            "w_resting_hr": first_truthy(c("rest_now"), c("rest_day"), c("rest_fitness")),
            "w_avg_stress": first_truthy(c("stress_day"), c("stress_snap")),
            "w_hr_min": first_truthy(c("hr_min"), c("hr_min_snap")),
            "w_hr_max": first_truthy(c("hr_max"), c("hr_max_snap")),
            "w_hr_avg": first_truthy(c("hr_health"), c("hr_snap")),
            "w_hrv": first_truthy(c("hrv_health"), c("hrv_snap")),
            "w_respiration": first_truthy(c("resp_health"), c("resp_sleep"), c("resp_snap"), c("resp_day")),
            "w_spo2": first_truthy(c("spo2_health"), c("spo2_sleep"), c("spo2_day"), c("spo2_snap")),
        }
    )
    return conform(one, WEARABLE_TYPES)
