"""Panels built from the star-schema and event tables, standing in for the personal tables.

Constants only move values into plausible ranges.  They are decimal fractions with many factors
of two, so that means of small groups do not end on a rounding half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, KEYS
from daypanel.operators.panel import finish_daily

INTAKE = ["energy", "protein", "carbs", "fat", "fiber", "sodium", "water"]
SPLIT_DAY = "2024-01-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def total(kind: str) -> Column:
    return F.round(F.sum(F.when(F.col("event_type") == kind, F.col("value"))), 2)


def top(kind: str) -> Column:
    return F.max(F.when(F.col("event_type") == kind, F.col("value")))


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def event_columns() -> dict[str, Column]:
    return {
        "energy": 1400 + 4 * F.round(F.sum("value"), 2),
        "protein": 0.32 * zero(total("click")),
        "carbs": 0.32 * zero(total("purchase")),
        "fat": 0.16 * zero(total("signup")),
        "fiber": 0.032 * zero(total("error")),
        "sodium": 3.2 * zero(total("view")) + 0.32 * zero(total("click")),
        "water": 0.32 * (zero(total("signup")) + zero(total("error"))),
        "weight": 78 + 0.032 * top("view"),
        "w_steps": 96 * total("signup"),
        "w_distance_m": 64 * total("signup") + 8 * zero(total("click")),
        "w_active_kcal": 4 * total("click"),
        "w_resting_hr": 50 + 0.064 * top("purchase"),
        "w_sleep_seconds": 18000 + 96 * top("view"),
        "w_sleep_score": 40 + 0.064 * top("error"),
        "w_avg_stress": 0.32 * top("error"),
        "w_body_battery_max": 60 + 0.064 * top("signup"),
        "w_body_battery_min": 0.064 * top("click"),
        "w_moderate_min": 0.16 * total("purchase"),
        "w_vigorous_min": 0.064 * total("error"),
        "w_session_count": F.count(F.when(F.col("event_type") == "click", 1)).cast("int"),
        "w_hrv": 30 + 0.064 * top("signup"),
        "w_respiration": 12 + 0.016 * top("view"),
    }


def event_days(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per user and day; partial sums shrink a hot user before the exchange."""
    chosen = {c: e for c, e in event_columns().items() if not columns or c in columns}
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ENTITY), F.col("ts").cast("date").alias(DAY), "event_type", "value"
    )
    return events.groupBy(*KEYS).agg(*(e.alias(c) for c, e in chosen.items()))


def three_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Intake, long biometrics (weights and readings in other units) and wearable days."""
    intake = event_days(spark, sf_dir, *INTAKE)
    days = event_days(spark, sf_dir, "weight", "w_hrv")
    readings = F.array(
        F.struct(F.lit("Weight").alias("metric"), F.lit("kg").alias("unit"), F.col("weight").alias("amount")),
        F.struct(F.lit("Body Fat").alias("metric"), F.lit("%").alias("unit"), (F.col("w_hrv") / 2).alias("amount")),
    )
    biometrics = days.select(*KEYS, F.inline(readings)).filter("amount is not null")
    wearable = event_days(spark, sf_dir, *(c for c in event_columns() if c.startswith("w_"))).filter(
        "w_steps is not null or w_avg_stress is not null"
    )
    return intake, biometrics, wearable


def readings_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same inputs with every single reading: several weights a day, each with its time and number, in no order."""
    intake, _, wearable = three_inputs(spark, sf_dir)
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "error"))
    weight = F.col("event_type") == "view"
    biometrics = events.select(
        F.col("user_id").alias(ENTITY), F.col("ts").cast("date").alias(DAY), F.when(weight, "Weight").otherwise("Body Fat").alias("metric"),
        F.when(weight, "kg").otherwise("%").alias("unit"), F.when(weight, 78 + 0.032 * F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.date_format("ts", "HH:mm").alias("reading_ts"), F.col("event_id").cast("bigint").alias("reading_no"),
    )
    return intake, biometrics, wearable


def processed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event panel, filled and rolled like the processed daily table."""
    return finish_daily(event_days(spark, sf_dir))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and order date: few entities with years of days."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias(DAY))
        .agg(F.max("o_totalprice").alias("price"), F.count(F.lit(1)).alias("n"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    price, balance, n = F.max("price"), F.max("c_acctbal"), F.sum("n")
    return joined.groupBy(F.col("c_nationkey").cast("bigint").alias(ENTITY), DAY).agg(
        (1500 + 0.0128 * price).alias("energy"),
        (60 + 0.0032 * balance).alias("weight"),
        (0.0128 * balance).alias("protein"),
        (128.0 * n).alias("carbs"),
        (0.00032 * price).alias("fat"),
        n.cast("double").alias("fiber"),
        (0.32 * balance).alias("sodium"),
        (0.0032 * price).alias("water"),
    )


def processed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish_daily(order_days(spark, sf_dir))


# Session type standing for each event type.
SESSION_OF_EVENT = {
    "click": "Running", "view": "walking", "purchase": "strength_training", "signup": "road_biking", "error": "yoga",
}


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an activity session; each seventh has no durable id."""
    kind = None
    for event, name in SESSION_OF_EVENT.items():
        hit = F.col("event_type") == event
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ENTITY), F.col("ts").cast("date").alias(DAY),
        F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("session_id"),
        F.col("event_type").alias("session_name"), kind.alias("session_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.col("value").alias("duration_min"), (F.col("value") * 5).alias("kcal"),
        F.when(F.col("event_type") != "error", F.col("value") * 0.064 + 90).alias("avg_hr"),
        F.when(F.col("event_type") != "error", F.col("value") * 0.128 + 110).alias("max_hr"),
        (F.col("value") / 100).alias("training_effect"), (F.col("value") / 2).alias("training_load"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ENTITY), F.col("ts").cast("date").alias(DAY),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("sample_ts"), F.col("value").alias("bpm"),
    )


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Wearable history up to the split day, and later rows overlapping it by two days.

    The later rows carry corrected values and one column the history does not have.
    """
    columns = [c for c in event_columns() if c.startswith("w_") and c != "w_respiration"]
    days = event_days(spark, sf_dir, *columns)
    old = days.filter(F.col(DAY) <= F.lit(SPLIT_DAY).cast("date"))
    new = days.filter(F.col(DAY) >= F.date_sub(F.lit(SPLIT_DAY).cast("date"), 1))
    return old, new.withColumns({"w_steps": F.col("w_steps") + 1, "w_readiness": F.col("w_avg_stress") / 2})


def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a store holds of the event days before a sync: all but the last three landed days of every entity."""
    days = event_days(spark, sf_dir)
    from_last = Window.partitionBy(ENTITY).orderBy(F.col(DAY).desc())
    return days.withColumn("_k", F.row_number().over(from_last)).where("_k > 3").drop("_k")


def foods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their label: text as name, language as category."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("food_name"), F.col("lang").alias("category"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "Not Junk").otherwise("Junk").alias("label"))
    return docs.join(labels, "doc_id", "left")


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve endpoint payloads per user and day whose shape varies by user, from the event days."""
    days = event_days(spark, sf_dir)
    c, variant = F.col, F.col(ENTITY) % 3
    st = lambda **f: F.to_json(F.struct(*(v.alias(k) for k, v in f.items())))
    shape = lambda a, b, z: F.when(variant == 0, a).when(variant == 1, b).otherwise(z)
    day = c(DAY).cast("string")
    nest = lambda **f: F.struct(*(v.alias(k) for k, v in f.items()))
    payloads = {
        "summary": shape(
            st(totalSteps=c("w_steps"), totalDistanceMeters=c("w_distance_m"), activeKilocalories=c("w_active_kcal")),
            st(steps=c("w_steps"), distanceInMeters=c("w_distance_m"), activeCalories=c("w_active_kcal"), activityCount=F.lit(3)),
            st(summary=nest(steps=c("w_steps"), distanceMeters=c("w_distance_m"), activeKilocalories=c("w_active_kcal"))),
        ),
        "sleep": shape(
            st(sleepTimeSeconds=c("w_sleep_seconds"), overallSleepScore=c("w_sleep_score")),
            st(dailySleepDTO=nest(sleepTimeSeconds=c("w_sleep_seconds")), sleepScores=nest(overall=nest(value=c("w_sleep_score")))),
            st(summary=nest(sleepTimeSeconds=c("w_sleep_seconds")), dailySleepDTO=nest(sleepScores=nest(overall=nest(value=c("w_sleep_score"))))),
        ),
        "stress": shape(
            st(avgStressLevel=c("w_avg_stress")), st(averageStressLevel=c("w_avg_stress").cast("string")),
            st(summary=nest(averageStressLevel=c("w_avg_stress"))),
        ),
        "heart_rate": F.when(
            variant == 0,
            F.concat(
                F.lit('{"restingHeartRate":'), F.coalesce(c("w_resting_hr").cast("string"), F.lit("null")),
                F.lit(',"heartRateValues":[{"timestampGMT":"'), day, F.lit('T01:00:00","value":'), c("energy").cast("string"),
                F.lit('},7,{"time":" '), day, F.lit('T02:00:00 ","bpm":"'), c("protein").cast("string"),
                F.lit('"},{"time":"","value":1},{"timestampGMT":"x","value":"none"}]}'),
            ),
        ).otherwise(
            F.concat(
                F.lit('{"statistics":{"restingHeartRate":'), F.coalesce(c("w_resting_hr").cast("string"), F.lit("null")),
                F.lit('},"1000":'), c("energy").cast("string"), F.lit(',"2000":'), c("protein").cast("string"), F.lit(',"3000":"9","x4":5}'),
            )
        ),
        "intensity": shape(
            st(moderateIntensityMinutes=c("w_moderate_min"), vigorousIntensityDurationInSeconds=c("w_vigorous_min") * 60),
            st(minutes=nest(moderate=c("w_moderate_min"), vigorous=c("w_vigorous_min"))),
            F.lit("{}"),
        ),
        "body_battery": shape(
            st(bodyBatteryMax=c("w_body_battery_max"), bodyBatteryMin=c("w_body_battery_min")),
            F.to_json(F.array(
                nest(values=F.array(nest(bodyBatteryLevel=c("w_body_battery_max")), nest(bodyBatteryLevel=F.lit(250)))),
                nest(values=F.array(nest(bodyBatteryLevel=c("w_body_battery_min")))),
            )),
            st(summary=nest(maxBodyBattery=c("w_body_battery_max")), charged=c("w_body_battery_min")),
        ),
        "activity": shape(
            F.to_json(F.array(nest(activityId=F.lit(11)), nest(activityId=F.lit(12)))), F.lit('{"activities":[{"id":5}]}'),
            F.lit('{"paging":{"totalResults":4}}'),
        ),
        "respiration": st(avgWakingRespirationValue=c("w_respiration")),
        "spo2": shape(F.lit('{"averageSpO2":97.5}'), F.lit('{"avgSpo2":null,"spo2Value":96}'), F.lit("{}")),
        "hrv": shape(
            st(hrvSummary=nest(lastNightAvg=c("w_hrv"))),
            F.concat(
                F.lit('{"hrvSummaries":[{"calendarDate":"1999-01-01","lastNightAvg":1},{"calendarDate":"'), day,
                F.lit('T00:00:00","summary":{"avgOvernightHrv":'), F.coalesce(c("w_hrv").cast("string"), F.lit("null")), F.lit("}}]}"),
            ),
            F.concat(F.lit('{"deep":[{"other":2,"more":{"rmssd":'), F.coalesce(c("w_hrv").cast("string"), F.lit('"n/a"')), F.lit("}}]}")),
        ),
        "training_readiness": shape(F.lit('{"score":55}'), F.lit('{"trainingReadinessScore":"61"}'), F.lit('{"value":70.5}')),
        "training_status": shape(
            F.lit('{"mostRecentTrainingStatus":{"trainingStatusType":" PRODUCTIVE "}}'), F.lit('{"status":"  "}'), F.lit('{"value":7}'),
        ),
    }
    # every endpoint was fetched twice, first with values that the later landing corrects
    first = F.lit('{"totalSteps":1,"value":1,"score":1,"restingHeartRate":1,"activityCount":9,"heartRateValues":[{"time":"x","bpm":1}]}')
    at = lambda d: F.date_add(c(DAY), d).cast("timestamp").alias("landed_at")
    rows = [F.struct(F.lit(e).alias("endpoint"), p.alias("payload"), at(2)) for e, p in payloads.items()]
    rows += [F.struct(F.lit(e).alias("endpoint"), F.when(p != "{}", first).otherwise(p).alias("payload"), at(1)) for e, p in payloads.items()]
    return days.select(*KEYS, F.inline(F.array(*rows)))


# Name, expression over the orders of a nation and day, and when it is missing: where (day of the year + shift) is a multiple of the step.
LONG_COLUMNS = [
    ("energy", "1400 + 0.0032 * price", 0, 1), ("protein", "0.00032 * price", 0, 1), ("carbs", "32 * n + 0.0032 * price", 0, 1), ("fat", "0.00032 * price", 0, 1),
    ("fiber", "2 * n", 0, 1), ("sodium", "0.032 * price", 0, 1), ("water", "0.0032 * price", 0, 1), ("weight", "78 + 0.0032 * balance", 6, 0),
    ("w_steps", "0.032 * price", 5, 1), ("w_distance_m", "8 * n + 0.032 * price", 7, 2), ("w_active_kcal", "0.0032 * price", 4, 3), ("w_resting_hr", "50 + 0.0032 * balance", 5, 4),
    ("w_sleep_seconds", "18000 + 0.032 * price", 3, 5), ("w_sleep_score", "40 + 0.00032 * price", 4, 6), ("w_avg_stress", "20 + 0.0032 * balance", 5, 0),
    ("w_body_battery_max", "60 + 0.00032 * price", 4, 1), ("w_body_battery_min", "5 + 0.0032 * balance", 6, 2), ("w_moderate_min", "0.00032 * price", 3, 0),
    ("w_vigorous_min", "0.0032 * abs(balance)", 4, 0), ("w_hrv", "30 + 0.00032 * price", 4, 5), ("w_respiration", "12 + 0.00032 * balance", 5, 6),
]


def long_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of days of few entities, with gaps in weight and in every wearable column."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias(DAY), "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias(ENTITY), "c_acctbal")
    days = orders.join(customers, "o_custkey").groupBy(*KEYS).agg(F.max("o_totalprice").alias("price"), F.max("c_acctbal").alias("balance"), F.count(F.lit(1)).alias("n"))

    def value(text: str, step: int, shift: int) -> Column:
        whole = F.expr(text).cast("double")
        return F.when((F.dayofyear(DAY) + shift) % step != 0, whole) if step else whole

    return days.select(*KEYS, *(value(text, step, shift).alias(c) for c, text, step, shift in LONG_COLUMNS), F.col("n").cast("int").alias("w_session_count"))


# Session type standing for each order priority.
SESSION_OF_PRIORITY = {"1-URGENT": "Running", "2-HIGH": "walking", "3-MEDIUM": "strength_training", "4-NOT SPECIFIED": "road_biking", "5-LOW": "yoga"}


def long_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order but a share as a session of its customer's nation."""
    kind = F.lit("other")
    for priority, name in SESSION_OF_PRIORITY.items():
        kind = F.when(F.col("o_orderpriority") == priority, name).otherwise(kind)
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias(ENTITY))
    price = F.col("o_totalprice")
    return orders.join(customers, "o_custkey").select(
        ENTITY, F.col("o_orderdate").cast("date").alias(DAY), F.col("o_orderkey").cast("bigint").alias("session_id"), F.col("o_orderstatus").alias("session_name"), kind.alias("session_type"),
        F.lit("08:00").alias("start_time"), (price * 0.00032).alias("duration_min"), (price * 0.0032).alias("kcal"),
        F.when(F.col("o_orderkey") % 4 != 0, 90 + price * 0.00032).alias("avg_hr"), F.when(F.col("o_orderkey") % 4 != 0, 110 + price * 0.00032).alias("max_hr"),
        (price * 0.00032).alias("training_effect"), (price * 0.00064).alias("training_load"),
    )
