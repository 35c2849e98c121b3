"""Weight trends, projections, scenarios, goal progress and burn-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.core import DAY, ENTITY, ensure_columns, rank_from_end, tail_rows, up_to_here, whole
from daypanel.functions import scalars as sc
from daypanel.operators import energy
from daypanel.operators.metrics import Goals
from daypanel.operators.rollup import first_value, last_value

# Scenario name and its distance from the estimated expenditure.
SCENARIOS = [("aggressive", -750.0), ("standard", -500.0), ("slow", -250.0)]
CURRENT_SCENARIO = "current average"
PROJECTION_DAYS = 90


def axis_limits(daily: DataFrame, target: float, padding: float = 2.0) -> DataFrame:
    """Lower and upper chart limit per entity from the weights and the target."""
    out = daily.groupBy(ENTITY).agg(F.min("weight").alias("_lo"), F.max("weight").alias("_hi"))
    return out.select(
        ENTITY,
        F.when(F.col("_lo").isNull(), F.lit(target - 10.0))
        .otherwise(F.least(F.col("_lo"), F.lit(target)) - padding).alias("y_min"),
        F.when(F.col("_lo").isNull(), F.lit(target + 10.0)).otherwise(F.col("_hi") + padding).alias("y_max"),
    )


def weight_trends(daily: DataFrame, recent_rows: int = 90) -> DataFrame:
    """All-time and recent linear trend of weight by day number, with change and band labels."""
    rows = daily.select(ENTITY, DAY, "weight").withColumns(
        {"_back": rank_from_end(), "_first": F.min(DAY).over(whole())}
    )
    recent = F.col("_back") <= recent_rows
    rows = rows.withColumn("_first_recent", F.min(F.when(recent, F.col(DAY))).over(whole()))
    w = F.col("weight")
    x_all = F.datediff(DAY, "_first").cast("double")
    x_rec = F.when(recent, F.datediff(DAY, "_first_recent").cast("double"))
    out = rows.groupBy(ENTITY).agg(
        F.count("weight").alias("n"),
        F.regr_slope(w, x_all).alias("_slope"),
        F.regr_intercept(w, x_all).alias("_icept"),
        F.count(F.when(recent, F.lit(1))).alias("recent_rows"),
        F.count(F.when(recent, w)).alias("recent_n"),
        F.regr_slope(F.when(recent, w), x_rec).alias("_rslope"),
        F.regr_intercept(F.when(recent, w), x_rec).alias("_ricept"),
        first_value("weight").alias("start_weight"),
        last_value("weight").alias("current_weight"),
    )
    ok = F.col("n") > 1
    rok = (F.col("recent_rows") > 7) & (F.col("recent_n") > 1)
    change = F.col("current_weight") - F.col("start_weight")
    return out.select(
        ENTITY, "n", F.when(ok, F.col("_slope")).alias("slope"), F.when(ok, F.col("_icept")).alias("intercept"),
        "recent_n", F.when(rok, F.col("_rslope")).alias("recent_slope"),
        F.when(rok, F.col("_ricept")).alias("recent_intercept"), "start_weight", "current_weight",
        change.alias("total_change"), F.when(change < 0, "lost").otherwise("gained").alias("direction"),
    )


def fit_columns(rows: int = 30) -> dict[str, Column]:
    """What the fit needs of every row: its rank from the end, and among the last known smoothed points its position."""
    known = (rank_from_end() <= rows) & F.col("weight_smoothed").isNotNull()
    return {"_back": rank_from_end(), "_i": F.when(known, F.count(F.when(known, F.lit(1))).over(up_to_here()) - 1).cast("double")}


def fit_parts(rows: int = 30) -> dict[str, Column]:
    """Aggregates of the line through the last smoothed points by position, over the columns of :func:`fit_columns`.

    The squares left over by a line are Syy - Sxy²/Sxx, so the deviation of the residuals needs no second pass.
    """
    i, recent = F.col("_i"), F.col("_back") <= rows
    y = F.when(i.isNotNull(), F.col("weight_smoothed"))
    left = F.regr_syy(y, i) - F.try_divide(F.pow(F.regr_sxy(y, i), F.lit(2.0)), F.nullif(F.regr_sxx(y, i), F.lit(0.0)))
    return {
        "points": F.count(i), "slope": F.regr_slope(y, i), "intercept": F.regr_intercept(y, i),
        "deviation": F.sqrt(F.greatest(left, F.lit(0.0)) / F.nullif(F.count(i), F.lit(0))), "last_weight": F.max_by("weight_smoothed", i),
        "last_day": F.max(DAY), "recent_intake": F.avg(F.when(recent, F.col("energy"))),
    }


def smoothed_fit(daily: DataFrame, rows: int = 30) -> DataFrame:
    """Line through the last smoothed points by position, with the deviation of the residuals, in one aggregate."""
    daily = ensure_columns(daily, {"energy": "double"}).select(ENTITY, DAY, "weight_smoothed", "energy").withColumns(fit_columns(rows))
    return daily.groupBy(ENTITY).agg(*(e.alias(c) for c, e in fit_parts(rows).items())).filter("points > 1")


def future_days(df: DataFrame, last_day: Column, days: int = PROJECTION_DAYS) -> DataFrame:
    """One row per coming day; the calendar is a generated sequence, not a join."""
    return df.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(days)))).withColumn(
        DAY, F.date_add(last_day, F.col("ahead"))
    )


def projection(daily: DataFrame, days: int = PROJECTION_DAYS) -> DataFrame:
    """Continuation of the smoothed line with a 95 % band."""
    rows = future_days(smoothed_fit(daily), F.col("last_day"), days)
    middle = F.col("slope") * (F.col("points") + F.col("ahead") - 1) + F.col("intercept")
    return rows.select(
        ENTITY, DAY, "ahead", middle.alias("projected"),
        (middle - F.col("deviation") * 1.96).alias("lower"), (middle + F.col("deviation") * 1.96).alias("upper"),
    )


def scenarios(daily: DataFrame, target: float) -> DataFrame:
    """:func:`scenario_summary` from the daily rows with the energy columns: fit and estimates are one aggregate of one scan."""
    parts = energy.estimate_parts() | fit_parts()
    rows = daily.withColumns({"_stable_intake": energy.stable_windows(), **fit_columns()})
    one = energy.estimate_values(rows.groupBy(ENTITY).agg(*(e.alias(c) for c, e in parts.items())))
    return scenario_rows(one.filter("points > 1 AND weighted_average IS NOT NULL"), target)


def scenario_summary(daily: DataFrame, est: DataFrame, target: float) -> DataFrame:
    """Four intake scenarios per entity: intake, daily change, days and date to the target; from estimates made elsewhere."""
    known = est.select(ENTITY, "weighted_average").filter("weighted_average is not null")
    return scenario_rows(smoothed_fit(daily).join(known, ENTITY), target)


def scenario_rows(base: DataFrame, target: float) -> DataFrame:
    best = F.col("weighted_average")
    choices = [F.struct(F.lit(n).alias("scenario"), (best + d).alias("kcal")) for n, d in SCENARIOS]
    choices.append(F.struct(F.lit(CURRENT_SCENARIO).alias("scenario"), F.col("recent_intake").alias("kcal")))
    rows = base.select(ENTITY, "last_day", "last_weight", "weighted_average", F.inline(F.array(*choices)))
    rows = rows.withColumn("daily_kg", (F.col("kcal") - F.col("weighted_average")) / sc.KCAL_PER_KG)
    gap, rate = F.col("last_weight") - target, F.col("daily_kg")
    reaches = (F.abs(rate) > 1e-5) & (gap * rate < 0)
    rows = rows.withColumn("days_to_target", F.when(reaches, F.abs(F.try_divide(gap, F.nullif(rate, F.lit(0.0))))))
    return rows.select(
        ENTITY, "scenario", "kcal", "last_day", "last_weight", "daily_kg", "days_to_target",
        day_after("last_day", F.col("days_to_target")).alias("target_day"),
    )


def scenario_paths(summary: DataFrame, days: int = PROJECTION_DAYS) -> DataFrame:
    rows = future_days(summary, F.col("last_day"), days)
    return rows.select(
        ENTITY, "scenario", DAY, "ahead", (F.col("last_weight") + F.col("daily_kg") * F.col("ahead")).alias("projected")
    )


def trend_parts(inside: Column) -> dict[str, Column]:
    """Aggregates for the trend over the rows inside: ends of the smoothed weight, span of the rows."""
    known = F.when(inside & F.col("weight_smoothed").isNotNull(), F.col(DAY))
    day = F.when(inside, F.col(DAY))
    return {
        "_n": F.count(known),
        "_s0": F.min_by("weight_smoothed", known),
        "_s1": F.max_by("weight_smoothed", known),
        "_span": F.greatest(F.datediff(F.max(day), F.min(day)), F.lit(1)),
    }


def trend_value() -> Column:
    """Change per week between the ends, 0 with fewer than two values."""
    return F.when(F.col("_n") >= 2, (F.col("_s1") - F.col("_s0")) / F.col("_span") * 7).otherwise(0.0)


def with_recent(daily: DataFrame, rows: int = 30) -> DataFrame:
    return daily.withColumn("_recent", rank_from_end() <= rows)


def goal_progress(daily: DataFrame, target: float) -> DataFrame:
    """Share complete, distance, trend, status and expected completion per entity, in one pass."""
    rows = with_recent(daily.select(ENTITY, DAY, "weight", "weight_smoothed"))
    return goal_values(rows.groupBy(ENTITY).agg(*(e.alias(c) for c, e in goal_parts(F.col("_recent")).items())), target)


def goal_parts(recent: Column) -> dict[str, Column]:
    return {"start_weight": first_value("weight"), "current_weight": last_value("weight"), "last_day": F.max(DAY), **trend_parts(recent)}


def goal_values(rows: DataFrame, target: float, *further: str) -> DataFrame:
    rows = rows.filter("start_weight is not null").withColumn("trend_kg_week", trend_value())
    start, now, goal = F.col("start_weight"), F.col("current_weight"), F.lit(target)
    loss = start > goal
    needed = F.when(loss, start - goal).otherwise(goal - start)
    done = F.when(loss, start - now).otherwise(now - start)
    complete = F.when(
        F.abs(needed) > 0.1,
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(done, F.nullif(needed, F.lit(0.0))))),
    ).otherwise(0.0)
    trend = F.col("trend_kg_week")
    status = sc.goal_status(now, goal, trend)
    days = F.when(
        status == "On Track", F.abs(now - goal) / F.nullif(F.abs(trend), F.lit(0.0)) * 7
    )
    rows = rows.withColumn("days_to_goal", days)
    return rows.select(
        ENTITY, "start_weight", "current_weight", "trend_kg_week", complete.alias("complete"),
        (now - goal).alias("kg_remaining"), status.alias("status"), "days_to_goal", "last_day",
        day_after("last_day", F.col("days_to_goal")).alias("goal_day"), *further,
    )


def day_after(day: str, days: Column) -> Column:
    """The date so many whole days later; null only beyond 9999-12-31, the last day of the date type."""
    left = F.datediff(F.lit("9999-12-31").cast("date"), F.col(day))
    return F.when(F.floor(days) <= left, F.date_add(day, F.floor(days).try_cast("int")))


def cumulative_change(daily: DataFrame) -> DataFrame:
    """Weight change since the first known weight, on days with a weight."""
    first = F.first("weight", True).over(up_to_here())
    rows = daily.filter("weight is not null")
    return rows.select(ENTITY, DAY, (F.col("weight") - first).alias("cumulative_change"))


def burndown(daily: DataFrame, min_rows: int = 8) -> DataFrame:
    """Running sum of expenditure minus intake; a missing daily value takes the estimate.

    ``daily`` holds ``tdee_adaptive`` and ``est_weighted_average``.
    """
    best = F.col("est_weighted_average")
    rows = daily.filter(best.isNotNull()).withColumn("_n", F.count(F.lit(1)).over(whole())).filter(F.col("_n") >= min_rows)
    day_deficit = F.coalesce("tdee_adaptive", best) - F.col("energy")
    return rows.withColumn("daily_deficit", day_deficit).select(
        ENTITY, DAY, "daily_deficit", F.sum("daily_deficit").over(up_to_here()).alias("cumulative_deficit")
    )


def burndown_targets(burn: DataFrame, progress: DataFrame) -> DataFrame:
    """Where the burn-down stands and the deficit still to go, with the projected end."""
    now = burn.groupBy(ENTITY).agg(last_value("cumulative_deficit").alias("current_deficit"))
    remaining = F.abs("kg_remaining") * sc.KCAL_PER_KG
    return now.join(progress.select(ENTITY, "kg_remaining", "goal_day"), ENTITY).select(
        ENTITY, "current_deficit", remaining.alias("remaining_deficit"),
        (F.col("current_deficit") + remaining).alias("target_deficit"), F.col("goal_day").alias("projected_end"),
    )


def burndown_state(daily: DataFrame, target: float, min_rows: int = 8) -> DataFrame:
    """:func:`burndown_targets` from the daily rows with the energy columns, in one aggregate of one scan.

    The running sum's last value is the sum of all daily deficits: adaptive expenditure where known, else the estimate, less intake.
    The estimate is one value an entity, so it enters as a multiple of the days that need it.
    """
    intake, spent = F.col("energy"), F.col("tdee_adaptive")
    open_day = spent.isNull() & intake.isNotNull()
    parts = {
        **energy.estimate_parts(), **{f"_goal{c}": e for c, e in goal_parts(F.col("_back") <= 30).items()}, "_rows": F.count(F.lit(1)),
        "_known": F.sum(spent - intake), "_open_days": F.count(F.when(open_day, F.lit(1))), "_open_intake": F.sum(F.when(open_day, intake)),
    }
    rows = daily.withColumns({"_stable_intake": energy.stable_windows(), "_back": rank_from_end()})
    one = energy.estimate_values(rows.groupBy(ENTITY).agg(*(e.alias(c) for c, e in parts.items())))
    best = F.col("weighted_average")
    some = F.col("_known").isNotNull() | (F.col("_open_days") > 0)
    current = F.coalesce("_known", F.lit(0.0)) + best * F.col("_open_days") - F.coalesce("_open_intake", F.lit(0.0))
    one = one.filter(best.isNotNull() & (F.col("_rows") >= min_rows)).withColumn("current_deficit", F.when(some, current))
    goal = one.select(ENTITY, "current_deficit", *(F.col(f"_goal{c}").alias(c) for c in goal_parts(F.lit(True))))
    progress = goal_values(goal, target, "current_deficit")
    remaining = F.abs("kg_remaining") * sc.KCAL_PER_KG
    return progress.select(
        ENTITY, "current_deficit", remaining.alias("remaining_deficit"), (F.col("current_deficit") + remaining).alias("target_deficit"),
        F.col("goal_day").alias("projected_end"),
    )


def status_summary(daily: DataFrame, goals: Goals) -> DataFrame:
    """Current state per entity: weight, band, trend, intake, deficit, adherence of the last rows."""
    rows = tail_rows(daily, 30)
    now = rows.groupBy(ENTITY).agg(
        F.max_by("weight", DAY).alias("current_weight"),
        F.max_by("bmi", DAY).alias("current_bmi"),
        F.avg("energy").alias("recent_intake"),
        F.avg("deficit").alias("recent_deficit"),
        (F.avg(F.col("on_track").cast("double")) * 100).alias("recent_adherence_pct"),
        *(e.alias(c) for c, e in trend_parts(F.lit(True)).items()),
    )
    now = now.withColumn("trend_kg_week", trend_value()).drop("_n", "_s0", "_s1", "_span")
    trend, weight = F.col("trend_kg_week"), F.col("current_weight")
    goal = F.lit(goals.target_weight)
    toward = sc.moving_toward(weight, goal, trend)
    eta = F.when(
        (F.abs(trend) > 0.01) & toward, F.abs(weight - goal) / F.nullif(F.abs(trend), F.lit(0.0)) * 7
    )
    return now.withColumns(
        {
            "bmi_band": F.coalesce(sc.bmi_band(F.col("current_bmi")), F.lit("Unknown")),
            "trend_word": sc.trend_word(trend),
            "days_to_goal": eta,
        }
    )
