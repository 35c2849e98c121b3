"""Normalise landed endpoint payloads into daily, session and sample rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS, SAMPLE_TYPES, SESSION_TYPES, WEARABLE_TYPES, conform, keep_last
from daypanel.functions import payloads as pl
from daypanel.functions.scalars import session_group
from daypanel.operators.sessions import session_counts, session_daily

# The endpoints landed per day.
ENDPOINTS = [
    "summary", "sleep", "stress", "heart_rate", "intensity", "body_battery", "activity", "respiration", "spo2",
    "hrv", "training_readiness", "training_status",
]

# Candidate key paths in the payloads, tried in this order.
DAILY_PATHS = {
    "w_steps": ("summary", [("totalSteps",), ("steps",), ("summary", "steps")]),
    "w_distance_m": ("summary", [("totalDistanceMeters",), ("distanceInMeters",), ("summary", "distanceMeters")]),
    "w_active_kcal": ("summary", [("activeKilocalories",), ("activeCalories",), ("summary", "activeKilocalories")]),
    "w_floors": ("summary", [("floorsClimbed",), ("floorsAscended",), ("summary", "floorsClimbed")]),
    "w_resting_hr": ("heart_rate", [("restingHeartRate",), ("statistics", "restingHeartRate"), ("value",)]),
    "w_sleep_seconds": (
        "sleep", [("sleepTimeSeconds",), ("dailySleepDTO", "sleepTimeSeconds"), ("summary", "sleepTimeSeconds")]
    ),
    "w_sleep_score": (
        "sleep",
        [("overallSleepScore",), ("sleepScores", "overall", "value"), ("dailySleepDTO", "sleepScores", "overall", "value")],
    ),
    "w_avg_stress": (
        "stress",
        [("avgStressLevel",), ("averageStressLevel",), ("overallAverageStressLevel",), ("summary", "averageStressLevel")],
    ),
    "w_respiration": (
        "respiration",
        [("avgWakingRespirationValue",), ("avgSleepRespirationValue",), ("averageRespiration",), ("value",)],
    ),
    "w_spo2": ("spo2", [("averageSpO2",), ("avgSpo2",), ("spo2Value",), ("value",)]),
    "w_readiness": ("training_readiness", [("score",), ("value",), ("trainingReadinessScore",)]),
}
STATUS_PATHS = [("mostRecentTrainingStatus", "trainingStatusType"), ("trainingStatusType",), ("status",), ("value",)]
# Key paths of the intensity minutes.
MINUTE_PATHS = {
    "moderate": [("moderateIntensityMinutes",), ("minutes", "moderate"), ("moderateIntensityMinutes", "value")],
    "vigorous": [("vigorousIntensityMinutes",), ("minutes", "vigorous"), ("vigorousIntensityMinutes", "value")],
}
SECOND_PATHS = {
    "moderate": [("moderateIntensityDurationInSeconds",), ("moderateIntensityDuration",), ("durations", "moderateSeconds")],
    "vigorous": [("vigorousIntensityDurationInSeconds",), ("vigorousIntensityDuration",), ("durations", "vigorousSeconds")],
}
# Key paths and keys of body battery, activity lists and HRV.
BATTERY_MAX_PATHS = [("bodyBatteryMax",), ("maxBodyBattery",), ("summary", "bodyBatteryMax"), ("summary", "maxBodyBattery")]
BATTERY_MIN_PATHS = [("bodyBatteryMin",), ("minBodyBattery",), ("summary", "bodyBatteryMin"), ("summary", "minBodyBattery")]
BATTERY_KEYS = ["bodyBattery", "bodyBatteryLevel", "charged", "chargedBodyBattery", "value"]
COUNT_PATHS = [("activityCount",), ("summary", "activityCount"), ("totalActivities",)]
LIST_PATHS = [("activities",), ("activityList",), ("items",), ("data",)]
TOTAL_PATHS = [("total",), ("count",), ("paging", "totalResults"), ("page", "totalElements")]
HRV_PATHS = [
    ("lastNightAvg",), ("weeklyAvg",), ("avgOvernightHrv",), ("hrvValue",), ("value",), ("summary", "lastNightAvg"),
    ("summary", "avgOvernightHrv"), ("hrvSummary", "lastNightAvg"), ("hrvSummary", "avgOvernightHrv"),
]
HRV_LISTS = ["hrvSummaries", "summaries", "data", "items", "values"]
HRV_DATES = ["calendarDate", "date", "measurementDate", "calendar_date"]
HRV_ENTRY_PATHS = [
    ("lastNightAvg",), ("avgOvernightHrv",), ("hrvValue",), ("value",), ("summary", "lastNightAvg"),
    ("summary", "avgOvernightHrv"),
]
HRV_KEYS = ["lastNightAvg", "avgOvernightHrv", "hrvValue", "rmssd", "rmssdHrv", "value", "weeklyAvg"]
SAMPLE_LIST_PATHS = [("heartRateValues",), ("heartRateValuesArray",), ("allMetrics",), ("samples",)]
SAMPLE_TIME_PATHS = [("timestampGMT",), ("timestampLocal",), ("calendarDate",), ("time",)]
SAMPLE_VALUE_PATHS = [("value",), ("heartRate",), ("bpm",)]
SESSION_ID_PATHS = [("activityId",), ("summaryId",), ("id",)]
SESSION_TEXT_PATHS = {
    "session_name": [("activityName",), ("summaryDTO", "activityName"), ("metadataDTO", "activityName")],
    "session_type": [
        ("activityType", "typeKey"), ("activityType", "typeKeyLocale", "key"), ("activityTypeDTO", "typeKey"),
        ("activityTypeDTO", "typeKeyLocale", "key"), ("activityType",), ("activityTypeDTO",),
    ],
    "start_time": [
        ("startTimeLocal",), ("startTimeGMT",), ("summaryDTO", "startTimeLocal"), ("summaryDTO", "startTimeGMT"),
    ],
}
SESSION_MINUTE_PATHS = [
    ("duration",), ("durationInMinutes",), ("summaryDTO", "duration"), ("summaryDTO", "durationInMinutes"),
]
SESSION_SECOND_PATHS = [
    ("durationInSeconds",), ("movingDuration",), ("elapsedDuration",), ("summaryDTO", "durationInSeconds"),
    ("summaryDTO", "movingDuration"),
]
SESSION_NUMBER_PATHS = {
    "kcal": [("calories",), ("summaryDTO", "calories"), ("activityCalories",)],
    "distance_m": [("distance",), ("distanceInMeters",), ("summaryDTO", "distance"), ("summaryDTO", "distanceInMeters")],
    "avg_hr": [("averageHR",), ("averageHeartRate",), ("summaryDTO", "averageHR"), ("summaryDTO", "averageHeartRate")],
    "max_hr": [("maxHR",), ("maxHeartRate",), ("summaryDTO", "maxHR"), ("summaryDTO", "maxHeartRate")],
    "training_effect": [("aerobicTrainingEffect",), ("trainingEffect",), ("summaryDTO", "aerobicTrainingEffect")],
    "training_load": [("activityTrainingLoad",), ("trainingLoad",), ("summaryDTO", "activityTrainingLoad")],
}


def is_full(payload: Column) -> Column:
    """An empty payload counts as none."""
    return F.coalesce(~F.trim(payload).isin("", "{}", "[]", "null"), F.lit(False))


def landing(landed: DataFrame) -> list[Column]:
    """What decides which of several payloads of a day and endpoint is the newest.

    A full one before an empty one, then the landing time if the table has ``landed_at``, then a hash of the text, so that the
    choice never depends on the order of the rows.
    """
    at = F.col("landed_at").cast("timestamp") if "landed_at" in landed.columns else F.lit(None).cast("timestamp")
    return [is_full(F.col("payload")).alias("_full"), at.alias("_landed"), F.xxhash64("payload").alias("_tie")]


NEWEST = ["_full", "_landed", "_tie"]
# Optional column of landed payloads: which page of a day's list a payload holds.
PAGE = "page"


def payloads_by_endpoint(landed: DataFrame) -> DataFrame:
    """(entity, day) rows with one text column per endpoint, the newest landing of each; the texts themselves are exchanged.

    ``normalise`` does not need this form: it parses before it exchanges anything.
    """
    rows = landed.select(*KEYS, "endpoint", "payload", *landing(landed))
    of = lambda e: F.when(F.col("_full") & (F.col("endpoint") == e), F.struct("_landed", "_tie"))
    return rows.groupBy(*KEYS).agg(*(F.max_by("payload", of(e)).alias(e) for e in ENDPOINTS))


def as_landed(payloads: DataFrame) -> DataFrame:
    """Landed rows (entity, day, endpoint, payload), also from the form with one column per endpoint."""
    if "endpoint" in payloads.columns:
        return payloads
    have = [e for e in ENDPOINTS if e in payloads.columns]
    return payloads.select(*KEYS, F.inline(F.array(*(F.struct(F.lit(e).alias("endpoint"), F.col(e).alias("payload")) for e in have))))


def of_endpoint(payloads: DataFrame, endpoint: str) -> DataFrame:
    """Full payloads of one endpoint; the filter reaches the scan of a landed table."""
    landed = as_landed(payloads).where(F.col("endpoint") == endpoint)
    return landed.select(*KEYS, page_of(landed), "payload", *landing(landed)).where("_full")


def is_paged(payloads: DataFrame) -> bool:
    return PAGE in payloads.columns


def page_of(landed: DataFrame) -> Column:
    """Number of the page that a payload holds; where the table has no pages, each payload is the whole of its day."""
    return (F.coalesce(F.col(PAGE).cast("int"), F.lit(0)) if is_paged(landed) else F.lit(0)).alias("_page")


def newest_landing(rows: DataFrame) -> DataFrame:
    """Of the rows that each payload of a day and page gave, those of its newest payload."""
    order = Window.partitionBy(*KEYS, "_page").orderBy(F.col("_landed").desc_nulls_last(), F.col("_tie").desc())
    return rows.withColumn("_r", F.rank().over(order)).where("_r = 1").drop("_r")


def battery_bounds(payload: Column, v: Column) -> tuple[Column, Column]:
    """Largest and smallest body battery: direct keys, else over the samples within 0..100."""
    samples = F.filter(pl.numbers_under(payload, BATTERY_KEYS), lambda x: x.between(0, 100))
    high = F.coalesce(pl.number_value(v, BATTERY_MAX_PATHS), F.array_max(samples))
    low = F.coalesce(pl.number_value(v, BATTERY_MIN_PATHS), F.array_min(samples))
    return high, low


def listed_count(activity: Column) -> Column:
    """Length of the list of an activity payload, else a total field; a count given in the day's summary comes before it."""
    return F.coalesce(F.size(pl.list_at(activity, LIST_PATHS)), pl.int_value(activity, TOTAL_PATHS))


def is_number(v: Column, path: pl.Path) -> Column:
    """Double at the path if the JSON value there is a number (not text holding one)."""
    kind = F.schema_of_variant(F.try_variant_get(v, pl.path_text(path), "variant"))
    numeric = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|INT|SMALLINT|TINYINT)")
    return F.when(numeric, F.try_variant_get(v, pl.path_text(path), "double"))


def hrv_value(payload: Column, v: Column, day: Column) -> Column:
    """HRV from direct paths, else from the list entry of the day, else from any known key."""
    first_hit = None
    for p in HRV_PATHS:
        here = F.try_variant_get(v, pl.path_text(p), "string").isNotNull()
        first_hit = F.when(here, is_number(v, p)) if first_hit is None else first_hit.when(here, is_number(v, p))
    lists = [F.try_variant_get(v, "$", "array<variant>")]
    lists += [F.try_variant_get(v, pl.path_text([k]), "array<variant>") for k in HRV_LISTS]
    none = F.array().cast("array<variant>")
    entries = F.concat(*(F.coalesce(x, none) for x in lists))

    def entry_value(e: Column) -> Column:
        given = F.coalesce(*(F.nullif(F.try_variant_get(e, pl.path_text([k]), "string"), F.lit("")) for k in HRV_DATES))
        same_day = F.coalesce(F.substring_index(given, "T", 1) == day.cast("string"), F.lit(True))
        return F.when(same_day, F.coalesce(*(is_number(e, p) for p in HRV_ENTRY_PATHS)))

    listed = F.try_element_at(F.filter(F.transform(entries, entry_value), lambda x: x.isNotNull()), F.lit(1))
    anywhere = [F.try_element_at(pl.numbers_under(payload, [k]), F.lit(1)) for k in HRV_KEYS]
    return F.coalesce(first_hit, listed, *anywhere)


def session_items(activity: Column) -> Column:
    """The session objects of an activity payload."""
    return pl.objects_only(pl.list_at(activity, LIST_PATHS))


def session_rows(payloads: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """One row per landed session; keys of a landed detail payload override the summary's.

    ``payloads`` are landed rows or rows by endpoint; ``details`` has (entity, session_id, payload).  A day's newest payload holds
    all its sessions, so an empty list there leaves the day without any.  Where the table has a column ``page``, each page has its newest
    payload, and a session that stands on several pages counts once, as the newest of them gives it.
    """
    rows = of_endpoint(payloads, "activity").select(*KEYS, "_page", *NEWEST, pl.parsed(F.col("payload")).alias("_a")).select(
        *KEYS, "_page", *NEWEST, F.explode_outer(session_items(F.col("_a"))).alias("_s")
    )
    # single items go through the exchange, never a text or the list
    rows = newest_landing(rows).where(F.col("_s").isNotNull())
    rows = rows.withColumn("_sid", pl.int_value(F.col("_s"), SESSION_ID_PATHS))
    if is_paged(payloads):
        copies = Window.partitionBy(*KEYS, "_sid").orderBy(F.col("_landed").desc_nulls_last(), F.col("_page").desc())
        rows = rows.withColumn("_k", F.row_number().over(copies)).where("_sid IS NULL OR _k = 1").drop("_k")
    rows = rows.drop("_page", *NEWEST)
    if details is not None:
        landed = details.select(
            ENTITY, F.col("session_id").cast("bigint").alias("_sid"), pl.parsed(F.col("payload")).alias("_d")
        )
        rows = rows.join(landed, [ENTITY, "_sid"], "left")
    else:
        rows = rows.withColumn("_d", pl.parsed(F.lit(None).cast("string")))
    return session_columns(rows, F.col("_s"), F.col("_d"))


def session_columns(
    rows: DataFrame, summary: Column, detail: Column, given: dict[str, Column] | None = None
) -> DataFrame:
    """The session columns from a summary and its detail; ``given`` columns replace the looked-up ones."""
    get = lambda paths: pl.merged_text(detail, summary, paths)
    text = {c: F.nullif(F.trim(get(p)), F.lit("")) for c, p in SESSION_TEXT_PATHS.items()}
    numbers = {c: pl.number(get(p)) for c, p in SESSION_NUMBER_PATHS.items()}
    minutes = F.coalesce(pl.number(get(SESSION_MINUTE_PATHS)), pl.number(get(SESSION_SECOND_PATHS)) / 60.0)
    looked_up = {"session_id": get(SESSION_ID_PATHS).try_cast("bigint"), **text, "duration_min": minutes, **numbers}
    looked_up |= given or {}
    rows = rows.select(*KEYS, *(e.alias(c) for c, e in looked_up.items()))
    rows = rows.withColumn("session_group", session_group(F.col("session_type"), include_cardio=True))
    return conform(rows, SESSION_TYPES)


def sample_items(v: Column) -> Column:
    """Samples of a parsed heart-rate payload as array<struct<sample_ts, bpm>>.

    A list of objects under a known key; otherwise an object whose keys are digits.
    """
    held = pl.list_at(v, SAMPLE_LIST_PATHS, bare=False)
    as_array = "array<struct<sample_ts:string,bpm:double>>"
    from_list = F.transform(
        pl.objects_only(held),
        lambda s: F.struct(
            pl.text_value(s, SAMPLE_TIME_PATHS).alias("sample_ts"), pl.number_value(s, SAMPLE_VALUE_PATHS).alias("bpm")
        ),
    ).cast(as_array)
    entries = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    digits = F.filter(entries, lambda e: e["key"].rlike("^[0-9]+$"))
    from_keys = F.transform(
        digits, lambda e: F.struct(e["key"].alias("sample_ts"), is_number(e["value"], []).alias("bpm"))
    ).cast(as_array)
    items = F.when(held.isNotNull(), from_list).otherwise(from_keys)
    return F.filter(items, lambda i: i["sample_ts"].isNotNull() & i["bpm"].isNotNull())


def sample_rows(payloads: DataFrame) -> DataFrame:
    """One row per intraday sample of the newest heart-rate payload of each day."""
    rows = of_endpoint(payloads, "heart_rate").select(*KEYS, "_page", *NEWEST, pl.parsed(F.col("payload")).alias("_v"))
    rows = rows.select(*KEYS, "_page", *NEWEST, F.inline_outer(sample_items(F.col("_v"))))
    return conform(newest_landing(rows).where("sample_ts is not null"), SAMPLE_TYPES)


def known(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def total_of(values: Column) -> Column:
    return F.aggregate(known(values), F.lit(0.0), lambda a, x: a + x)


def mean_of(values: Column) -> Column:
    return F.try_divide(total_of(values), F.nullif(F.size(known(values)), F.lit(0)))


def session_summary(items: Column) -> dict[str, Column]:
    """The daily session summary straight from the day's session objects, no join needed."""
    each = lambda paths: F.transform(items, lambda s: pl.number_value(s, paths))
    minutes = F.transform(items, lambda s: pl.duration_minutes(s, SESSION_MINUTE_PATHS, SESSION_SECOND_PATHS))
    some = F.size(items) > 0
    return {
        "w_session_min": F.when(some, total_of(minutes)),
        "w_session_kcal": F.when(some, total_of(each(SESSION_NUMBER_PATHS["kcal"]))),
        "w_session_avg_hr": F.when(some, mean_of(each(SESSION_NUMBER_PATHS["avg_hr"]))),
        "w_session_max_hr": F.when(some, F.array_max(each(SESSION_NUMBER_PATHS["max_hr"]))),
    }


def daily_rows(payloads: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """The flat wearable day: payload fields plus the summaries of its samples and sessions.

    Every landed row is parsed where it is read and gives the few numbers of its endpoint; only these are exchanged.  The newest landing per
    endpoint wins, then one aggregate puts a day together.  Only when session details override the summaries, or sessions come
    in pages, the daily session totals come from ``sessions``.
    """
    landed = as_landed(payloads)
    if is_paged(landed) and sessions is None:
        sessions = session_rows(landed)
    rows = landed.select(*KEYS, "endpoint", "payload", *landing(landed))
    rows = rows.withColumn("_v", pl.parsed(F.when(F.col("_full"), F.col("payload"))))
    v, at = F.col("_v"), lambda e: F.col("endpoint") == e
    rows = rows.withColumns({
        "_samples": F.when(at("heart_rate"), sample_items(v)), "_sessions": F.when(at("activity"), session_items(v)),
    })
    text = F.when(F.col("_full"), F.col("payload"))
    high, low = battery_bounds(text, v)
    bpm = F.col("_samples.bpm")
    level = lambda k: pl.duration_minutes(v, MINUTE_PATHS[k], SECOND_PATHS[k])
    fields = {c: F.when(at(e), pl.number_value(v, paths)) for c, (e, paths) in DAILY_PATHS.items()}
    fields |= {
        "w_body_battery_max": F.when(at("body_battery"), high),
        "w_body_battery_min": F.when(at("body_battery"), low),
        "_has_intensity": F.when(at("intensity"), v.isNotNull()),
        **{f"_{e}_{k}": F.when(at(e), level(k)) for e in ("intensity", "summary") for k in ("moderate", "vigorous")},
        "_count_given": F.when(at("summary"), pl.int_value(v, COUNT_PATHS).cast("int")),
        "_count_listed": F.when(at("activity"), listed_count(v).cast("int")),
        "w_hr_min": F.array_min(bpm),
        "w_hr_max": F.array_max(bpm),
        "w_hr_avg": mean_of(bpm),
        "w_hrv": F.when(at("hrv"), hrv_value(text, v, F.col(DAY))),
        "w_training_status": F.when(at("training_status"), pl.text_value(v, STATUS_PATHS)),
    }
    if sessions is None:
        fields |= {c: F.when(at("activity"), e) for c, e in session_summary(F.col("_sessions")).items()}
    parsed = rows.select(*KEYS, "endpoint", *NEWEST, *(e.alias(c) for c, e in fields.items()))
    newest = keep_last(parsed, [*KEYS, "endpoint"], [F.col(c) for c in NEWEST])
    days = newest.groupBy(*KEYS).agg(*(F.max(c).alias(c) for c in fields))
    has = F.coalesce("_has_intensity", F.lit(False))
    flat = days.withColumns({
        **{f"w_{k}_min": F.when(has, F.col(f"_intensity_{k}")).otherwise(F.col(f"_summary_{k}")) for k in ("moderate", "vigorous")},
        "w_session_count": F.coalesce("_count_given", "_count_listed"),
    })
    if sessions is not None:
        flat = flat.join(session_daily(sessions), KEYS, "left")
    if is_paged(landed):
        counted = session_counts(sessions).withColumnRenamed("w_session_count", "_counted")
        flat = flat.join(counted, KEYS, "left").withColumn("w_session_count", F.coalesce("_count_given", "_counted", "_count_listed"))
    return conform(flat, WEARABLE_TYPES)


def normalise(landed: DataFrame, details: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Daily, session and sample rows of landed payloads (entity, day, endpoint, payload and, if known, landed_at)."""
    sessions = session_rows(landed, details)
    daily = daily_rows(landed, sessions if details is not None or is_paged(landed) else None)
    return daily, sessions, sample_rows(landed)
