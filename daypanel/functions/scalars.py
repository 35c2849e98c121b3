"""Column expressions: body measures, shares, calendar fields, classes, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Body-mass bands, healthy range, energy per gram, energy per kg of body mass.
BMI_BANDS = [(18.5, "Underweight"), (25.0, "Normal"), (30.0, "Overweight")]
BMI_TOP = "Obese"
HEALTHY_BMI = (18.5, 24.9)
KCAL_PER_GRAM = {"protein": 4, "carbs": 4, "fat": 9}
KCAL_PER_KG = 7000.0

# Activity group by text found in the session type, tested in this order.
GROUP_TESTS = [
    ("walks", ["walk"], ["walking", "hiking"]),
    ("runs", ["run"], ["running", "trail_running"]),
    ("cycling", ["cycl"], ["road_biking", "indoor_cycling"]),
    ("gym/resistance training", ["strength", "gym", "resistance", "weight"], []),
]
CARDIO_GROUP, CARDIO_TOKEN = "gym/resistance training", "cardio"
OTHER_GROUP = "other"
SESSION_GROUPS = [g for g, _, _ in GROUP_TESTS] + [OTHER_GROUP]

DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def bmi(weight: Column, height_cm: float) -> Column:
    return weight / F.lit((height_cm / 100.0) ** 2)


def bmi_band(value: Column) -> Column:
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, label in BMI_BANDS:
        out = out.when(value < limit, label)
    return out.otherwise(BMI_TOP)


def healthy_weight_range(height_cm: float) -> tuple[float, float]:
    square = (height_cm / 100.0) ** 2
    return HEALTHY_BMI[0] * square, HEALTHY_BMI[1] * square


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or null."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def macro_share(grams: Column, macro: str, energy: Column) -> Column:
    return ratio(grams * KCAL_PER_GRAM[macro], energy) * 100


def within_tolerance(energy: Column, target: float, tolerance: float) -> Column:
    low, high = target * (1 - tolerance), target * (1 + tolerance)
    return F.coalesce(energy.between(low, high), F.lit(False))


def in_open_range(value: Column, low: float, high: float) -> Column:
    """The value if strictly between the limits, else null."""
    return F.when((value > low) & (value < high), value)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def weekday_name(index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in DAY_NAMES)), index + 1)


def week_label(week: Column) -> Column:
    """Month-day of the last day (Sunday) of the week."""
    return F.date_format(F.date_add(week, 6), "MM-dd")


def iso_week_label(day: Column) -> Column:
    """Calendar year with ISO week number, as the calendar heat map labels its columns."""
    return F.format_string("%d-W%02d", F.year(day), F.weekofyear(day))


def week_of_month(day: Column) -> Column:
    first = F.trunc(day, "month")
    return F.floor((F.dayofmonth(day) + F.weekday(first) - 1) / 7).cast("int")


def session_group(session_type: Column, include_cardio: bool = False) -> Column:
    text = F.lower(F.trim(F.coalesce(session_type, F.lit(""))))
    out = None
    for group, tokens, names in GROUP_TESTS:
        if include_cardio and group == CARDIO_GROUP:
            tokens = [*tokens, CARDIO_TOKEN]
        hit = text.rlike("|".join(tokens))
        if names:
            hit = hit | text.isin(names)
        out = F.when(hit, group) if out is None else out.when(hit, group)
    return out.otherwise(OTHER_GROUP)


def adherence_status(on_track: Column, deficit: Column) -> Column:
    """1 on track, 0.5 under target, 0 over target."""
    return F.when(on_track, 1.0).when(deficit > 0, 0.5).otherwise(0.0)


def trend_word(kg_per_week: Column) -> Column:
    return F.when(kg_per_week < -0.05, "losing").when(kg_per_week > 0.05, "gaining").otherwise("maintaining")


def moving_toward(current: Column, target: Column, kg_per_week: Column) -> Column:
    return F.coalesce(
        ((current > target) & (kg_per_week < 0)) | ((current < target) & (kg_per_week > 0)), F.lit(False)
    )


def goal_status(current: Column, target: Column, kg_per_week: Column) -> Column:
    trending = F.abs(kg_per_week) > 0.01
    return (
        F.when(trending & moving_toward(current, target, kg_per_week), "On Track")
        .when(trending, "Off Track")
        .otherwise("Stalled")
    )


def fixed_text(value: Column, decimals: int = 1, sign: bool = False) -> Column:
    """Fixed-decimals text, null as ``--``; presentation only, used as the very last step."""
    pattern = f"%{'+' if sign else ''}.{decimals}f"
    return F.coalesce(F.when(value.isNotNull(), F.format_string(pattern, value.cast("double"))), F.lit("--"))


def cell_text(value: Column, kind: str, max_chars: int = 28) -> Column:
    """Compact cell text: kind is ``number``, ``date``, ``bool`` or ``text``."""
    if kind == "number":
        v = value.cast("double")
        text = (
            F.when(F.abs(v) >= 1000, F.format_number(v, 0))
            .when(F.abs(v) >= 10, F.format_string("%.0f", v))
            .otherwise(F.format_string("%.2f", v))
        )
    elif kind == "date":
        text = F.date_format(value, "yyyy-MM-dd")
    elif kind == "bool":
        text = F.when(value, "Yes").otherwise("No")
    else:
        text = F.when(
            F.length(value) > max_chars, F.concat(F.substring(value, 1, max_chars - 1), F.lit("…"))
        ).otherwise(value)
    return F.when(value.isNull(), "--").otherwise(text)


def plain_label(label: Column) -> Column:
    return F.replace(label, F.lit("_"), F.lit(" "))


def any_timestamp(number: Column, text: Column) -> Column:
    """UTC timestamp from epoch milliseconds, epoch seconds or ISO text.

    ``number`` is the value as a double (null if it was text), ``text`` the value as text.
    Magnitudes over 10^12 are milliseconds.
    """
    millis = F.when(F.abs(number) > 1e12, number).otherwise(number * 1000.0)
    return F.when(number.isNotNull(), F.timestamp_millis(millis.cast("bigint"))).otherwise(
        F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))
    )


def first_truthy(*values: Column) -> Column:
    """First value that is neither null nor zero; the last one may be zero."""
    *head, last = values
    return F.coalesce(*(F.nullif(v, F.lit(0.0)) for v in head), last)
