"""Energy-expenditure estimates from intake and smoothed weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daypanel.core import ENTITY, frame, rank_from_end, whole
from daypanel.functions.scalars import KCAL_PER_KG, in_open_range
from daypanel.functions.stats import block_order, drop_blocks, ewm, with_blocks

# Smoothing spans, plausible ranges, method weights.
WEIGHT_SPAN, WEIGHT_MIN = 10, 3
ESTIMATE_SPAN, ESTIMATE_MIN = 14, 7
PLAUSIBLE = (1200.0, 4000.0)
REGRESSION_RANGE = (1000.0, 5000.0)
METHOD_WEIGHTS = {
    "adaptive": 0.35,
    "rolling_30d": 0.25,
    "stable_periods": 0.15,
    "regression": 0.15,
    "recent_30d": 0.10,
}
METHOD_LABELS = {
    "adaptive": "Adaptive EMA",
    "rolling_30d": "Rolling 30d",
    "rolling_14d": "Rolling 14d",
    "stable_periods": "Stable Periods",
    "regression": "Regression",
    "recent_30d": "Recent 30d",
}


def smooth_weight(daily: DataFrame, span: int = WEIGHT_SPAN) -> DataFrame:
    """Add ``weight_smoothed``."""
    return drop_blocks(ewm(with_blocks(daily), "weight", "weight_smoothed", span, WEIGHT_MIN))


def energy_columns(daily: DataFrame) -> DataFrame:
    """Add weight_smoothed, smoothed_delta, tdee_adaptive, tdee_14d and tdee_30d.

    All windows after the row positions use one order, so there is one sort for them.
    """
    order = block_order()
    daily = ewm(with_blocks(daily), "weight", "weight_smoothed", WEIGHT_SPAN, WEIGHT_MIN)
    daily = daily.withColumn("smoothed_delta", F.col("weight_smoothed") - F.lag("weight_smoothed").over(order))
    daily = daily.withColumn("_raw", F.col("energy") - F.col("smoothed_delta") * KCAL_PER_KG)
    daily = ewm(daily, "_raw", "tdee_adaptive", ESTIMATE_SPAN, ESTIMATE_MIN)
    daily = daily.withColumns(
        {"tdee_14d": rolling_balance(order, 14, 7), "tdee_30d": rolling_balance(order, 30, 14)}
    )
    return drop_blocks(daily).drop("_raw")


def rolling_balance(order: WindowSpec, window: int, min_rows: int) -> Column:
    """Mean intake minus the energy of the mean smoothed change, over rows."""
    spec = order.rowsBetween(1 - window, Window.currentRow)
    return F.when(
        F.count(F.lit(1)).over(spec) >= min_rows,
        F.avg("energy").over(spec) - F.avg("smoothed_delta").over(spec) * KCAL_PER_KG,
    )


def stable_windows(window: int = 14, tolerance_kg: float = 0.5) -> Column:
    """Mean intake of each full window in which smoothed weight stays within the tolerance."""
    spec = frame(window)
    spread = F.max("weight_smoothed").over(spec) - F.min("weight_smoothed").over(spec)
    intake = F.avg("energy").over(spec)
    full = F.count(F.lit(1)).over(spec) == window
    return F.when(full & (spread <= tolerance_kg) & (intake > 0), intake)


def regression_parts() -> dict[str, Column]:
    energy, delta = F.col("energy"), F.col("smoothed_delta")
    return {
        "_n": F.count(F.when(energy.isNotNull() & delta.isNotNull(), F.lit(1))),
        "_slope": F.regr_slope(delta, energy),
        "_icept": F.regr_intercept(delta, energy),
        "_r2": F.regr_r2(delta, energy),
    }


def regression_result(df: DataFrame) -> DataFrame:
    """x-intercept of the fit, where there are enough points and it lies in a sensible range."""
    fits = (F.col("_n") >= 14) & (F.abs("_slope") >= 1e-8)
    x0 = in_open_range(F.try_divide(-F.col("_icept"), F.nullif(F.col("_slope"), F.lit(0.0))), *REGRESSION_RANGE)
    df = df.withColumn("regression", F.when(fits, x0))
    return df.withColumn("regression_r2", F.when(F.col("regression").isNotNull(), F.col("_r2"))).drop(
        "_n", "_slope", "_icept", "_r2"
    )


def stable_estimate(daily: DataFrame) -> DataFrame:
    """Per entity: mean intake over stable windows and how many there were."""
    return (
        daily.withColumn("_stable", stable_windows())
        .groupBy(ENTITY)
        .agg(F.avg("_stable").alias("stable_periods"), F.count("_stable").alias("stable_periods_count"))
    )


def regression_estimate(daily: DataFrame) -> DataFrame:
    parts = regression_parts()
    return regression_result(daily.groupBy(ENTITY).agg(*(e.alias(a) for a, e in parts.items())))


ESTIMATE_COLUMNS = [
    "adaptive", "rolling_14d", "rolling_30d", "stable_periods", "stable_periods_count", "regression", "regression_r2",
    "recent_30d", "weighted_average",
]


def estimate_parts() -> dict[str, Column]:
    """Aggregates over the rows of an entity from which every method follows."""
    recent = F.col("_back") <= 30
    energy, delta = F.col("energy"), F.col("smoothed_delta")
    return {
        "_adaptive": F.avg("tdee_adaptive"),
        "_roll14": F.avg("tdee_14d"),
        "_roll30": F.avg("tdee_30d"),
        "_stable": F.avg("_stable_intake"),
        "_stable_n": F.count("_stable_intake"),
        "_recent_n": F.count(F.when(recent, energy)),
        "_recent_in": F.avg(F.when(recent, energy)),
        "_recent_delta": F.avg(F.when(recent, delta)),
        **regression_parts(),
    }


def estimate_values(one: DataFrame) -> DataFrame:
    """Methods in their plausible range and their weighted average, from the aggregates."""
    one = regression_result(one)
    recent_value = F.when(F.col("_recent_n") > 7, F.col("_recent_in") - F.col("_recent_delta") * KCAL_PER_KG)
    one = one.withColumns(
        {
            "adaptive": in_open_range(F.col("_adaptive"), *PLAUSIBLE),
            "rolling_14d": in_open_range(F.col("_roll14"), *PLAUSIBLE),
            "rolling_30d": in_open_range(F.col("_roll30"), *PLAUSIBLE),
            "stable_periods": in_open_range(F.col("_stable"), *PLAUSIBLE),
            "recent_30d": in_open_range(recent_value, *PLAUSIBLE),
        }
    )
    one = one.withColumn(
        "stable_periods_count", F.when(F.col("stable_periods").isNotNull(), F.col("_stable_n"))
    )
    value = {m: in_open_range(F.col(m), *PLAUSIBLE) for m in METHOD_WEIGHTS}
    total, weights = F.lit(0.0), F.lit(0.0)
    for method, weight in METHOD_WEIGHTS.items():
        total = total + F.coalesce(value[method] * weight, F.lit(0.0))
        weights = weights + F.when(value[method].isNotNull(), weight).otherwise(0.0)
    return one.withColumn("weighted_average", F.try_divide(total, F.nullif(weights, F.lit(0.0))))


def estimates(daily: DataFrame) -> DataFrame:
    """One row per entity with every method and the weighted average, null where not usable.

    ``daily`` holds the columns of :func:`energy_columns`.  All methods come from one aggregate.
    """
    rows = daily.withColumns({"_stable_intake": stable_windows(), "_back": rank_from_end()})
    one = rows.groupBy(ENTITY).agg(*(e.alias(a) for a, e in estimate_parts().items()))
    return estimate_values(one).select(ENTITY, *ESTIMATE_COLUMNS)


def with_estimates(daily: DataFrame) -> DataFrame:
    """Daily rows with the per-entity estimates next to them (``est_*`` columns).

    The same aggregates as window functions over the entity: the rows are partitioned by it
    already, so neither a join nor a second computation of the daily columns is needed.
    """
    columns = daily.columns
    rows = daily.withColumns({"_stable_intake": stable_windows(), "_back": rank_from_end()})
    rows = rows.withColumns({a: e.over(whole()) for a, e in estimate_parts().items()})
    rows = estimate_values(rows)
    return rows.select(*columns, *(F.col(c).alias(f"est_{c}") for c in ESTIMATE_COLUMNS))


def method_bars(est: DataFrame) -> DataFrame:
    """One row per entity and usable method, with its label."""
    structs = [
        F.struct(F.lit(m).alias("method"), F.lit(label).alias("label"), in_open_range(F.col(m), *PLAUSIBLE).alias("kcal"))
        for m, label in METHOD_LABELS.items()
    ]
    return est.select(ENTITY, F.inline(F.array(*structs))).filter("kcal is not null")


def recommendation(est: DataFrame, intake: str = "recent_intake", best: str = "weighted_average") -> DataFrame:
    """Numeric recommendation columns from the gap between recent intake and the estimate."""
    gap = F.col(intake) - F.col(best)
    return est.withColumns(
        {
            "gap": gap,
            "advice": F.when(gap > 200, "reduce").when(gap < -200, "in deficit").when(gap.isNotNull(), "maintenance"),
            "gap_kg_per_week": F.when(F.abs(gap) > 200, F.abs(gap) / KCAL_PER_KG * 7),
            "kcal_for_half_kg_loss": F.col(best) - 500,
            "kcal_for_quarter_kg_loss": F.col(best) - 250,
        }
    )


def recommendation_text(rows: DataFrame) -> DataFrame:
    """The same as sentences; presentation, last step."""
    gap, week = F.col("gap"), F.col("gap_kg_per_week")
    text = (
        F.when(
            F.col("advice") == "reduce",
            F.format_string("Reduce by ~%.0f kcal/day to maintain; surplus gives ~%+.2f kg/week", gap, week),
        )
        .when(
            F.col("advice") == "in deficit",
            F.format_string("In deficit of ~%.0f kcal/day; expected loss ~%.2f kg/week", F.abs(gap), week),
        )
        .when(F.col("advice") == "maintenance", F.lit("Intake is near expenditure (maintenance)"))
    )
    return rows.withColumn("advice_text", text)
