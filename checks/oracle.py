"""SQL counterparts of the registered queries, written from the operators' definitions.

Formulas differ from the library's where one exists: the exponential mean is a self-join, the
p-value series uses the log-gamma function, sessions and payloads come straight from the tables.
"""

from __future__ import annotations

import re

from checks.queries import GOALS, ORDER_GOALS, SAMPLE_SIZE
from daypanel.core import NUTRIENTS
from daypanel.operators.correlate import LAG_METRICS
from daypanel.plans.panels import SESSION_OF_EVENT, SPLIT_DAY

CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}
# Bodies as registered, for counterparts over another panel.
BODIES: dict[str, tuple] = {}

W = "PARTITION BY entity ORDER BY day"
BACK = "row_number() OVER (PARTITION BY entity ORDER BY day DESC)"


def rows(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


UPTO = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WEEK = "CAST(date_trunc('week', day) AS DATE)"
MONTH = "CAST(date_trunc('month', day) AS DATE)"
DOW = "(isodow(day) - 1)"


def needed(sql: str, seen: dict[str, None]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            needed(CTES[name], seen)
            seen[name] = None


def oracle(name: str, body: str, floats: str = "", ints: str = "", digits: int = 6) -> None:
    """Register a query; ``floats`` are rounded and ``ints`` widened as the Spark side does."""
    BODIES[name] = (body, floats, ints, digits)
    seen: dict[str, None] = {}
    needed(body, seen)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in seen)
    change = [f"CASE WHEN round({c}, {digits}) = 0 THEN 0::DOUBLE ELSE round({c}, {digits}) END AS {c}" for c in floats.split()]
    change += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    star = f"* REPLACE ({', '.join(change)})" if change else "*"
    ORACLE[name] = (f"WITH {ctes} " if ctes else "") + f"SELECT {star} FROM ({body}) AS final"


def total(kind: str) -> str:
    return f"round(sum(value) FILTER (WHERE event_type = '{kind}'), 2)"


def top(kind: str) -> str:
    return f"max(value) FILTER (WHERE event_type = '{kind}')"


def zero(x: str) -> str:
    return f"coalesce({x}, 0)"


EVENT_COLUMNS = {
    "energy": "1400 + 4 * round(sum(value), 2)",
    "protein": f"0.32::DOUBLE * {zero(total('click'))}",
    "carbs": f"0.32::DOUBLE * {zero(total('purchase'))}",
    "fat": f"0.16::DOUBLE * {zero(total('signup'))}",
    "fiber": f"0.032::DOUBLE * {zero(total('error'))}",
    "sodium": f"3.2::DOUBLE * {zero(total('view'))} + 0.32::DOUBLE * {zero(total('click'))}",
    "water": f"0.32::DOUBLE * ({zero(total('signup'))} + {zero(total('error'))})",
    "weight": f"78 + 0.032::DOUBLE * {top('view')}",
    "w_steps": f"96 * {total('signup')}",
    "w_distance_m": f"64 * {total('signup')} + 8 * {zero(total('click'))}",
    "w_active_kcal": f"4 * {total('click')}",
    "w_resting_hr": f"50 + 0.064::DOUBLE * {top('purchase')}",
    "w_sleep_seconds": f"18000 + 96 * {top('view')}",
    "w_sleep_score": f"40 + 0.064::DOUBLE * {top('error')}",
    "w_avg_stress": f"0.32::DOUBLE * {top('error')}",
    "w_body_battery_max": f"60 + 0.064::DOUBLE * {top('signup')}",
    "w_body_battery_min": f"0.064::DOUBLE * {top('click')}",
    "w_moderate_min": f"0.16::DOUBLE * {total('purchase')}",
    "w_vigorous_min": f"0.064::DOUBLE * {total('error')}",
    "w_session_count": "count(*) FILTER (WHERE event_type = 'click')",
    "w_hrv": f"30 + 0.064::DOUBLE * {top('signup')}",
    "w_respiration": f"12 + 0.016::DOUBLE * {top('view')}",
}
EVENT_FLOATS = " ".join(c for c in EVENT_COLUMNS if c != "w_session_count")
WEARABLE_FLOATS = [c for c in EVENT_COLUMNS if c.startswith("w_") and c != "w_session_count"]

CTES["ev"] = (
    "SELECT user_id AS entity, CAST(ts AS DATE) AS day, "
    + ", ".join(f"CAST({e} AS {'BIGINT' if c == 'w_session_count' else 'DOUBLE'}) AS {c}" for c, e in EVENT_COLUMNS.items())
    + " FROM events GROUP BY 1, 2"
)
CTES["od_raw"] = (
    "SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(o_orderdate AS DATE) AS day, count(*) AS n, max(o_totalprice) AS price, max(c_acctbal) AS balance "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
)
CTES["od"] = (
    "SELECT entity, day, 1500 + 0.0128::DOUBLE * price AS energy, 60 + 0.0032::DOUBLE * balance AS weight, 0.0128::DOUBLE * balance AS protein, "
    "CAST(128 * n AS DOUBLE) AS carbs, 0.00032::DOUBLE * price AS fat, CAST(n AS DOUBLE) AS fiber, 0.32::DOUBLE * balance AS sodium, "
    "0.0032::DOUBLE * price AS water FROM od_raw"
)


def processed_sql(src: str) -> str:
    filled = (
        f"SELECT * REPLACE (coalesce(first_value(weight IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS weight) "
        f"FROM {src}"
    )
    return (
        f"SELECT *, CASE WHEN count(energy) OVER {rows(7)} = 7 THEN avg(energy) OVER {rows(7)} END AS energy_avg_7, "
        f"CASE WHEN count(energy) OVER {rows(30)} = 30 THEN avg(energy) OVER {rows(30)} END AS energy_avg_30, "
        f"lead(weight) OVER ({W}) - weight AS weight_change, row_number() OVER ({W}) AS rn FROM ({filled})"
    )


def metrics_sql(src: str, goals) -> str:
    low, high = goals.target_energy * (1 - goals.tolerance), goals.target_energy * (1 + goals.tolerance)
    slope = f"CASE WHEN count(weight) OVER {rows(7)} = 7 THEN regr_slope(weight, rn) OVER {rows(7)} * 7 END"
    return (
        f"SELECT *, weight / {(goals.height_cm / 100.0) ** 2!r}::DOUBLE AS bmi, {slope} AS weight_velocity_7d, "
        "protein * 4 / nullif(energy, 0) * 100 AS protein_pct, carbs * 4 / nullif(energy, 0) * 100 AS carbs_pct, "
        "fat * 9 / nullif(energy, 0) * 100 AS fat_pct, "
        f"{goals.target_energy} - energy AS deficit, coalesce(energy BETWEEN {low} AND {high}, false) AS on_track, "
        f"protein / nullif(weight, 0) AS protein_per_kg, CAST(month(day) AS BIGINT) AS month, CAST({DOW} AS BIGINT) AS weekday, "
        f"{DOW} >= 5 AS is_weekend FROM {src}"
    )


def ewm_sql(src: str, value: str, span: int, least: int, out: str) -> str:
    q = f"(1 - 2.0 / {span + 1})::DOUBLE"
    return (
        f"SELECT a.entity, a.day, CASE WHEN count(b.x) >= {least} THEN sum(b.x * pow({q}, a.rn - b.rn)) / sum(pow({q}, a.rn - b.rn)) END AS {out} "
        f"FROM {src} a LEFT JOIN (SELECT entity, rn, {value} AS x FROM {src} WHERE {value} IS NOT NULL) b "
        "ON a.entity = b.entity AND b.rn <= a.rn GROUP BY a.entity, a.day"
    )


BAND = (
    "CASE WHEN bmi IS NULL THEN NULL WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25 THEN 'Normal' "
    "WHEN bmi < 30 THEN 'Overweight' ELSE 'Obese' END"
)


def chain(p: str, src: str, goals) -> None:
    """Processed, prepared, smoothed and expenditure CTEs of one panel."""
    CTES[f"{p}p"] = processed_sql(src)
    CTES[f"{p}m"] = metrics_sql(f"{p}p", goals)
    CTES[f"{p}s0"] = ewm_sql(f"{p}m", "weight", 10, 3, "weight_smoothed")
    CTES[f"{p}s"] = (
        f"SELECT *, weight_smoothed - lag(weight_smoothed) OVER ({W}) AS smoothed_delta FROM {p}m JOIN {p}s0 USING (entity, day)"
    )
    CTES[f"{p}t0"] = f"SELECT *, energy - smoothed_delta * 7000 AS raw FROM {p}s"
    CTES[f"{p}t1"] = ewm_sql(f"{p}t0", "raw", 14, 7, "tdee_adaptive")

    def balance(n: int, least: int) -> str:
        return (
            f"CASE WHEN count(*) OVER {rows(n)} >= {least} THEN avg(energy) OVER {rows(n)} - avg(smoothed_delta) OVER {rows(n)} * 7000 END"
        )

    stable = (
        f"CASE WHEN count(*) OVER {rows(14)} = 14 AND max(weight_smoothed) OVER {rows(14)} - min(weight_smoothed) OVER {rows(14)} <= 0.5 "
        f"AND avg(energy) OVER {rows(14)} > 0 THEN avg(energy) OVER {rows(14)} END"
    )
    CTES[f"{p}e"] = (
        f"SELECT *, {balance(14, 7)} AS tdee_14d, {balance(30, 14)} AS tdee_30d, {stable} AS stable_intake, {BACK} AS back "
        f"FROM {p}s JOIN {p}t1 USING (entity, day)"
    )
    CTES[f"{p}reg"] = (
        "SELECT entity, CASE WHEN n >= 14 AND abs(slope) >= 1e-8 AND -icept / slope > 1000 AND -icept / slope < 5000 THEN -icept / slope END AS regression, "
        "CASE WHEN n >= 14 AND abs(slope) >= 1e-8 AND -icept / slope > 1000 AND -icept / slope < 5000 THEN r2 END AS regression_r2 FROM ("
        "SELECT entity, count(*) FILTER (WHERE energy IS NOT NULL AND smoothed_delta IS NOT NULL) AS n, regr_slope(smoothed_delta, energy) AS slope, "
        f"regr_intercept(smoothed_delta, energy) AS icept, regr_r2(smoothed_delta, energy) AS r2 FROM {p}e GROUP BY entity)"
    )
    ok = lambda x: f"CASE WHEN {x} > 1200 AND {x} < 4000 THEN {x} END"
    CTES[f"{p}one"] = (
        "SELECT entity, avg(tdee_adaptive) AS a, avg(tdee_14d) AS r14, avg(tdee_30d) AS r30, avg(stable_intake) AS st, count(stable_intake) AS st_n, "
        "CASE WHEN count(energy) FILTER (WHERE back <= 30) > 7 THEN avg(energy) FILTER (WHERE back <= 30) "
        f"- avg(smoothed_delta) FILTER (WHERE back <= 30) * 7000 END AS rec FROM {p}e GROUP BY entity"
    )
    CTES[f"{p}est0"] = (
        f"SELECT entity, {ok('a')} AS adaptive, {ok('r14')} AS rolling_14d, {ok('r30')} AS rolling_30d, {ok('st')} AS stable_periods, "
        f"CASE WHEN st > 1200 AND st < 4000 THEN st_n END AS stable_periods_count, regression, regression_r2, {ok('rec')} AS recent_30d "
        f"FROM {p}one JOIN {p}reg USING (entity)"
    )
    parts = [("adaptive", 0.35), ("rolling_30d", 0.25), ("stable_periods", 0.15), ("regression", 0.15), ("recent_30d", 0.10)]
    top = " + ".join(f"coalesce(({ok(m)}) * {w}, 0)" for m, w in parts)
    bottom = " + ".join(f"CASE WHEN {m} > 1200 AND {m} < 4000 THEN {w} ELSE 0 END" for m, w in parts)
    CTES[f"{p}est"] = f"SELECT *, ({top}) / nullif(({bottom})::DOUBLE, 0) AS weighted_average FROM {p}est0"


chain("ev", "ev", GOALS)
chain("od", "od", ORDER_GOALS)

DAILY_FLOATS = f"{EVENT_FLOATS} energy_avg_7 energy_avg_30 weight_change"
CTES["three"] = (
    f"SELECT i.entity, i.day, {', '.join('i.' + c for c in NUTRIENTS)}, b.weight, "
    + ", ".join(f"w.{c}" for c in EVENT_COLUMNS if c.startswith("w_"))
    + " FROM ev i LEFT JOIN (SELECT entity, day, weight FROM ev WHERE weight IS NOT NULL) b USING (entity, day) "
    "LEFT JOIN (SELECT * FROM ev WHERE w_steps IS NOT NULL OR w_avg_stress IS NOT NULL) w USING (entity, day)"
)
oracle("processed_daily", f"SELECT * EXCLUDE (rn) FROM ({processed_sql('three')})", DAILY_FLOATS, "w_session_count")

CTES["kg"] = (
    "SELECT user_id AS entity, CAST(ts AS DATE) AS day, 78 + 0.032::DOUBLE * value AS weight, "
    "row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY strftime(ts, '%H:%M'), event_id) AS reading, "
    "row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY strftime(ts, '%H:%M') DESC, event_id DESC) AS from_last "
    "FROM events WHERE event_type = 'view' AND value IS NOT NULL"
)
for label, chosen in (("last", "(SELECT entity, day, weight FROM kg WHERE from_last = 1)"), ("every", "(SELECT entity, day, weight, reading FROM kg)")):
    CTES[f"{label}_reading"] = (
        f"SELECT i.entity, i.day, {', '.join('i.' + c for c in NUTRIENTS)}, b.weight, {'b.reading, ' if label == 'every' else ''}"
        + ", ".join(f"w.{c}" for c in EVENT_COLUMNS if c.startswith("w_"))
        + f" FROM ev i LEFT JOIN {chosen} b USING (entity, day) LEFT JOIN (SELECT * FROM ev WHERE w_steps IS NOT NULL OR w_avg_stress IS NOT NULL) w USING (entity, day)"
    )
oracle("processed_daily_readings", f"SELECT * EXCLUDE (rn) FROM ({processed_sql('last_reading')})", DAILY_FLOATS, "w_session_count")
oracle(
    "processed_daily_all_readings", f"SELECT * EXCLUDE (rn) FROM ({processed_sql('every_reading').replace(W, W + ', reading NULLS FIRST')})",
    DAILY_FLOATS, "w_session_count reading",
)

METRIC_LIST = "entity, day, bmi, weight_velocity_7d, protein_pct, carbs_pct, fat_pct, deficit, on_track, protein_per_kg, month, weekday, is_weekend"
METRIC_FLOATS = "bmi weight_velocity_7d protein_pct carbs_pct fat_pct deficit protein_per_kg"
oracle("prepared_metrics", f"SELECT {METRIC_LIST}, {BAND} AS bmi_band FROM evm", METRIC_FLOATS)
oracle("prepared_metrics_orders", f"SELECT {METRIC_LIST}, {BAND} AS bmi_band FROM odm", METRIC_FLOATS)

for p, src in (("ev", "ev"), ("od", "od")):
    CTES[f"{p}rn"] = f"SELECT entity, day, weight, row_number() OVER ({W}) AS rn FROM {src}"
    CTES[f"{p}rs"] = ewm_sql(f"{p}rn", "weight", 10, 3, "weight_smoothed")
oracle("ewm_weight", "SELECT entity, day, weight, weight_smoothed FROM evrn JOIN evrs USING (entity, day)", "weight weight_smoothed")
oracle("ewm_weight_orders", "SELECT entity, day, weight, weight_smoothed FROM odrn JOIN odrs USING (entity, day)", "weight weight_smoothed")
WEARABLE_REPORT = [
    "w_steps", "w_sleep_seconds", "w_avg_stress", "w_body_battery_max", "w_body_battery_min", "w_resting_hr", "w_moderate_min",
    "w_vigorous_min", "w_session_count",
]
oracle("has_wearable_data", f"SELECT entity, bool_or({' OR '.join(c + ' IS NOT NULL' for c in WEARABLE_REPORT)}) AS has_data FROM ev GROUP BY entity")

# --- expenditure
oracle("adaptive_tdee", "SELECT entity, day, weight_smoothed, tdee_adaptive FROM eve", "weight_smoothed tdee_adaptive", digits=5)
oracle("adaptive_tdee_orders", "SELECT entity, day, weight_smoothed, tdee_adaptive FROM ode", "weight_smoothed tdee_adaptive", digits=5)
oracle("rolling_tdee", "SELECT entity, day, tdee_14d, tdee_30d FROM eve", "tdee_14d tdee_30d", digits=5)
oracle("stable_tdee", "SELECT entity, st AS stable_periods, st_n AS stable_periods_count FROM odone", "stable_periods", digits=5)
oracle("regression_tdee", "SELECT * FROM evreg", "regression regression_r2", digits=4)
EST = "adaptive rolling_14d rolling_30d stable_periods regression regression_r2 recent_30d weighted_average"
oracle("tdee_estimates", "SELECT * FROM evest", EST, "stable_periods_count", 4)
oracle("tdee_estimates_orders", "SELECT * FROM odest", EST, "stable_periods_count", 4)
LABELS = {
    "adaptive": "Adaptive EMA", "rolling_30d": "Rolling 30d", "rolling_14d": "Rolling 14d", "stable_periods": "Stable Periods",
    "regression": "Regression", "recent_30d": "Recent 30d",
}
oracle(
    "expenditure_methods",
    " UNION ALL ".join(
        f"SELECT entity, '{m}' AS method, '{label}' AS label, {m} AS kcal FROM evest WHERE {m} > 1200 AND {m} < 4000" for m, label in LABELS.items()
    ),
    "kcal", digits=4,
)
ADVICE = (
    "gap, CASE WHEN gap > 200 THEN 'reduce' WHEN gap < -200 THEN 'in deficit' WHEN gap IS NOT NULL THEN 'maintenance' END AS advice, "
    "CASE WHEN abs(gap) > 200 THEN abs(gap) / 7000 * 7 END AS gap_kg_per_week, weighted_average - 500 AS kcal_for_half_kg_loss, "
    "weighted_average - 250 AS kcal_for_quarter_kg_loss"
)
oracle(
    "expenditure_advice",
    f"SELECT entity, weighted_average, recent_intake, {ADVICE} FROM (SELECT entity, weighted_average, recent_intake, recent_intake - weighted_average AS gap "
    "FROM evest JOIN (SELECT entity, avg(energy) AS recent_intake FROM eve WHERE back <= 30 GROUP BY entity) USING (entity))",
    "weighted_average recent_intake gap gap_kg_per_week kcal_for_half_kg_loss kcal_for_quarter_kg_loss", digits=4,
)
oracle(
    "expenditure_line",
    f"SELECT entity, day, intake_7d, tdee_adaptive, intake_7d <= tdee_adaptive AS in_deficit FROM (SELECT entity, day, avg(energy) OVER {rows(7)} AS intake_7d, "
    "tdee_adaptive, max(day) OVER (PARTITION BY entity) AS newest FROM ode) JOIN odest USING (entity) "
    "WHERE weighted_average IS NOT NULL AND day >= newest - INTERVAL 6 MONTH",
    "intake_7d tdee_adaptive", digits=5,
)

# --- correlations


def long_sql(src: str, metrics: dict[str, str], target: str) -> str:
    return " UNION ALL ".join(
        f"SELECT entity, day, '{label}' AS metric, {c} AS x, {target} AS y FROM {src}" for label, c in metrics.items()
    )


def corr_sql(src: str, metrics: dict[str, str], target: str, max_lag: int, need: int) -> str:
    lagged = " UNION ALL ".join(
        f"SELECT entity, metric, {k} AS lag, y, lag(x, {k}) OVER (PARTITION BY entity, metric ORDER BY day) AS x FROM long" for k in range(max_lag + 1)
    )
    return (
        f"WITH long AS ({long_sql(src, metrics, target)}), pairs AS ({lagged}) "
        f"SELECT entity, metric, CAST(lag AS BIGINT) AS lag, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n, "
        f"CASE WHEN count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) >= {need} THEN covar_pop(y, x) / "
        "nullif((stddev_pop(x) FILTER (WHERE y IS NOT NULL)) * (stddev_pop(y) FILTER (WHERE x IS NOT NULL)), 0) END AS r "
        "FROM pairs GROUP BY entity, metric, lag"
    )


def p_sql(src: str) -> str:
    even = "list_sum(list_transform(range(0, CAST((n - 2) // 2 AS BIGINT)), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1.0) - 0.5 * ln(pi())) * pow(1 - r * r, k)))"
    odd = "coalesce(list_sum(list_transform(range(0, CAST((n - 3) // 2 AS BIGINT)), lambda k: exp(lgamma(k + 1.0) - lgamma(k + 1.5) + 0.5 * ln(pi())) / 2 * pow(1 - r * r, k))), 0)"
    p = (
        f"CASE WHEN r IS NULL OR n < 3 THEN NULL WHEN abs(r) >= 1 THEN 0 WHEN n % 2 = 0 THEN greatest(0, 1 - abs(r) * {even}) "
        f"ELSE greatest(0, 1 - 2 / pi() * (asin(abs(r)) + abs(r) * sqrt(1 - r * r) * {odd})) END"
    )
    return f"SELECT *, coalesce(p < 0.05, false) AS significant FROM (SELECT *, {p} AS p FROM {src})"


NUT = {n: n for n in NUTRIENTS}
CTES["c0"] = corr_sql("evp", NUT, "weight_change", 0, 3)
CTES["c0o"] = corr_sql("odp", NUT, "weight_change", 0, 3)
CTES["c3"] = corr_sql("evp", NUT, "weight_change", 3, 11)
CTES["c3p"] = p_sql("c3")
oracle("nutrient_corr", f"SELECT * EXCLUDE (lag) FROM ({p_sql('c0')}) WHERE n > 2", "r p")
oracle("nutrient_corr_orders", f"SELECT * EXCLUDE (lag) FROM ({p_sql('c0o')}) WHERE n > 2", "r p")
oracle("lagged_corr", "SELECT * FROM c3p", "r p")
Z = 1.959963984540054
BOUNDS = ", ".join(
    f"CASE WHEN abs(r) >= 1 THEN r ELSE tanh(atanh(CASE WHEN abs(r) < 1 THEN r END) {s} {Z} / sqrt(n - 3)) END AS {c}"
    for s, c in (("-", "ci_low"), ("+", "ci_high"))
)
CTES["c3i"] = f"SELECT *, {BOUNDS} FROM c3p WHERE n > 3"
oracle("corr_ci", "SELECT * EXCLUDE (lag) FROM c3i WHERE lag = 0 AND n > 10", "r p ci_low ci_high")
CTES["bars"] = (
    "SELECT s.entity, s.metric, s.r AS r_lag0, s.p AS p_lag0, s.significant AS significant_lag0, s.n AS n_lag0, s.ci_low AS ci_low_lag0, "
    "s.ci_high AS ci_high_lag0, b.lag AS best_lag, b.r AS best_r, b.ci_low, b.ci_high FROM (SELECT * FROM c3i WHERE lag = 0 AND n > 10) s "
    "LEFT JOIN (SELECT * FROM c3i WHERE r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity, metric ORDER BY round(abs(r), 12) DESC, lag) = 1) b "
    "USING (entity, metric)"
)
oracle("best_lag_bars", "SELECT * FROM bars", "r_lag0 p_lag0 ci_low_lag0 ci_high_lag0 best_r ci_low ci_high")
oracle(
    "strongest_driver",
    "SELECT entity, metric AS nutrient, r_lag0 AS r, p_lag0 AS p, significant_lag0 AS significant, best_lag, best_r, "
    "CASE WHEN r_lag0 > 0 THEN 'positively' ELSE 'negatively' END AS direction, "
    "CASE WHEN metric IN ('sodium', 'carbs', 'water') THEN 'water retention' ELSE 'energy balance' END AS mechanism "
    "FROM bars WHERE r_lag0 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY round(abs(r_lag0), 12) DESC, metric) = 1",
    "r p best_r",
)

# --- sessions and report inputs
KIND = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{s}'" for e, s in SESSION_OF_EVENT.items()) + " END"
GROUP = (
    "CASE WHEN session_type = 'walking' THEN 'walks' WHEN session_type = 'Running' THEN 'runs' WHEN session_type = 'road_biking' THEN 'cycling' "
    "WHEN session_type = 'strength_training' THEN 'gym/resistance training' ELSE 'other' END"
)
CTES["ss0"] = (
    "SELECT user_id AS entity, CAST(ts AS DATE) AS day, CASE WHEN event_id % 7 <> 0 THEN event_id END AS session_id, event_type AS session_name, "
    f"{KIND} AS session_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time, value AS duration_min, value * 5 AS kcal, "
    "CASE WHEN event_type <> 'error' THEN value * 0.064::DOUBLE + 90 END AS avg_hr, CASE WHEN event_type <> 'error' THEN value * 0.128::DOUBLE + 110 END AS max_hr, "
    "value / 100 AS training_effect, value / 2 AS training_load FROM events"
)
CTES["ss"] = f"SELECT *, {GROUP} AS session_group FROM ss0"
CTES["ssd"] = (
    "SELECT entity, day, coalesce(sum(duration_min), 0) AS w_session_min, coalesce(sum(kcal), 0) AS w_session_kcal, avg(avg_hr) AS w_session_avg_hr, "
    "max(max_hr) AS w_session_max_hr FROM ss GROUP BY entity, day"
)
CTES["rin0"] = (
    "SELECT *, w_sleep_seconds / 3600 AS w_sleep_hours, coalesce(w_moderate_min, 0) + coalesce(w_vigorous_min, 0) AS w_total_intensity_min "
    "FROM eve LEFT JOIN ssd USING (entity, day)"
)
CTES["rin1"] = (
    "SELECT *, CASE WHEN count(w_active_kcal) OVER (PARTITION BY entity) > 0 THEN w_active_kcal ELSE coalesce(w_steps, 0) * 0.04 "
    "+ w_total_intensity_min * 5 + coalesce(w_session_min, 0) * 3 END AS activity_proxy FROM rin0"
)
CTES["rin"] = (
    f"SELECT *, avg(activity_proxy) OVER {rows(7)} AS activity_proxy_7d, lead(weight_smoothed, 7) OVER ({W}) - weight_smoothed AS trend_change_7d, "
    f"{WEEK} AS week FROM rin1"
)
oracle(
    "report_inputs",
    "SELECT entity, day, w_sleep_hours, w_total_intensity_min, w_session_min, w_session_kcal, w_session_avg_hr, w_session_max_hr, activity_proxy, "
    "activity_proxy_7d, trend_change_7d, week FROM rin",
    "w_sleep_hours w_total_intensity_min w_session_min w_session_kcal w_session_avg_hr w_session_max_hr activity_proxy activity_proxy_7d trend_change_7d",
    digits=5,
)
CTES["lagall"] = corr_sql("rin", LAG_METRICS, "weight_change", 7, 11)
CTES["lagtrend"] = corr_sql("rin", LAG_METRICS, "trend_change_7d", 7, 11)
CTES["rin30"] = "SELECT * FROM rin WHERE back <= 30"
CTES["lagrec"] = corr_sql("rin30", LAG_METRICS, "weight_change", 7, 5)


def best_sql(src: str) -> str:
    return (
        f"SELECT k.entity, k.metric, b.lag AS best_lag, b.r AS best_r, CASE WHEN b.r >= 0 THEN 'positive' WHEN b.r < 0 THEN 'negative' ELSE 'na' END AS sign, "
        f"coalesce(b.n, 0) AS sample_size FROM (SELECT DISTINCT entity, metric FROM {src}) k LEFT JOIN (SELECT * FROM {src} WHERE r IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY entity, metric ORDER BY round(abs(r), 12) DESC, lag) = 1) b USING (entity, metric)"
    )


oracle("lag_best", best_sql("lagall"), "best_r", "best_lag sample_size")


def matrix_sql(src: str) -> str:
    return "SELECT entity, metric, " + ", ".join(f"max(r) FILTER (WHERE lag = {k}) AS lag_{k}" for k in range(8)) + f" FROM {src} GROUP BY entity, metric"


# Event panels have at most 30 days, of which a lag of 7 and a target 7 days ahead leave few: fewer pairs are asked for than in the long panel.
CTES["lag5trend"] = corr_sql("rin", LAG_METRICS, "trend_change_7d", 7, 5)
oracle("lag_matrix", matrix_sql("lag5trend"), " ".join(f"lag_{k}" for k in range(8)), digits=5)
CTES["lag8a"] = corr_sql("rin", LAG_METRICS, "weight_change", 7, 8)
CTES["lag8b"] = corr_sql("rin", LAG_METRICS, "trend_change_7d", 7, 8)
oracle("lag_two_targets", "SELECT *, 'change' AS target FROM lag8a UNION ALL SELECT *, 'trend' AS target FROM lag8b", "r")
oracle(
    "lag_summary",
    f"SELECT a.entity, a.metric, a.best_lag AS all_time_lag, a.best_r AS all_time_r, b.best_lag AS recent_lag, b.best_r AS recent_r "
    f"FROM ({best_sql('lagall')}) a FULL JOIN ({best_sql('lagrec')}) b ON a.entity = b.entity AND a.metric = b.metric",
    "all_time_r recent_r", "all_time_lag recent_lag",
)

# --- attribution and regimes
ZS = {"carbs": "carbs", "sodium": "sodium", "water": "water", "sleep_score": "w_sleep_score", "stress": "w_avg_stress", "steps": "w_steps", "active_kcal": "w_active_kcal"}


def outlier_sql(src: str, have: bool = True) -> str:
    col = lambda c: c if have or not c.startswith("w_") else "NULL::DOUBLE"
    z = ", ".join(
        f"({col(c)} - avg({col(c)}) OVER e) / nullif(stddev_pop({col(c)}) OVER e, 0) AS {n}_z" for n, c in ZS.items()
    )
    base = (
        f"SELECT entity, day, weight_change AS weight_delta, {z}, {col('w_resting_hr')} - lag({col('w_resting_hr')}) OVER ({W}) AS resting_hr_delta, "
        f"{col('w_hrv')} - lag({col('w_hrv')}) OVER ({W}) AS hrv_delta, {col('w_body_battery_min')} AS body_battery_min, {col('w_active_kcal')} AS active_kcal "
        f"FROM {src} WINDOW e AS (PARTITION BY entity)"
    )
    return (
        "SELECT * EXCLUDE (rec, act, hyd), CASE WHEN coalesce(hyd >= rec AND hyd >= act, false) THEN 'glycogen / sodium / hydration' "
        "WHEN coalesce(rec >= act, false) THEN 'recovery / sleep / stress' ELSE 'activity load' END AS tag FROM ("
        "SELECT *, greatest(abs(sleep_score_z), abs(stress_z), abs(hrv_delta), abs(resting_hr_delta)) AS rec, greatest(abs(steps_z), abs(active_kcal_z)) AS act, "
        f"greatest(abs(sodium_z), abs(carbs_z), abs(water_z)) AS hyd FROM ({base}) WHERE abs(weight_delta) >= 0.6)"
    )


OUT_FLOATS = "weight_delta " + " ".join(f"{n}_z" for n in ZS) + " resting_hr_delta hrv_delta body_battery_min active_kcal"
oracle("zscore_outliers", outlier_sql("evp"), OUT_FLOATS)
oracle(
    "largest_spikes",
    f"SELECT entity, day, row_number() OVER (PARTITION BY entity ORDER BY abs(weight_delta) DESC, day) AS position, weight_delta, carbs_z, sodium_z, water_z, tag "
    f"FROM ({outlier_sql('odp', have=False)}) QUALIFY position <= 10",
    "weight_delta carbs_z sodium_z water_z",
)
REGIME_VALUES = {
    "mean_intake": "energy", "mean_weight_change": "weight_change", "mean_active_kcal": "w_active_kcal", "mean_resting_hr": "w_resting_hr", "mean_hrv": "w_hrv",
}
CTES["rgm"] = (
    "SELECT *, " + ", ".join(f"quantile_cont({c}, 0.5) OVER (PARTITION BY entity) AS m_{n}" for n, c in (("stress", "w_avg_stress"), ("step", "w_steps"), ("hrv", "w_hrv")))
    + " FROM rin"
)
REGIMES = {
    "sleep <6h": "w_sleep_hours < 6", "sleep 6 to 8h": "w_sleep_hours >= 6 AND w_sleep_hours < 8", "sleep >8h": "w_sleep_hours >= 8",
    "high stress days": "w_avg_stress >= m_stress", "low stress days": "w_avg_stress < m_stress", "high step days": "w_steps >= m_step",
    "low step days": "w_steps < m_step", "high HRV days": "w_hrv >= m_hrv", "low HRV days": "w_hrv < m_hrv",
}
oracle(
    "regimes",
    " UNION ALL ".join(
        f"SELECT entity, '{label}' AS regime, " + ", ".join(f"avg({c}) FILTER (WHERE {m}) AS {n}" for n, c in REGIME_VALUES.items())
        + f", count(*) FILTER (WHERE {m}) AS days FROM rgm GROUP BY entity"
        for label, m in REGIMES.items()
    ),
    " ".join(REGIME_VALUES),
)


def box_cols(x: str) -> str:
    names = [("low", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1)]
    return f"count({x}) AS n, " + ", ".join(f"quantile_cont({x}, {p}) AS {n}" for n, p in names)


BOX_FLOATS = "low q1 median q3 high"
CTES["bx"] = (
    "SELECT entity, day, weight_change, w_sleep_score, w_avg_stress, w_steps, w_hrv, "
    + ", ".join(f"count({c}) OVER (PARTITION BY entity) AS n_{c}, quantile_cont({c}, 0.5) OVER (PARTITION BY entity) AS m_{c}" for c in ("w_sleep_score", "w_avg_stress", "w_steps", "w_hrv"))
    + ", row_number() OVER (PARTITION BY entity ORDER BY w_sleep_score NULLS LAST, day) AS rk FROM evp"
)
CTES["bxl"] = (
    "SELECT entity, 'sleep score quartiles' AS panel, 'Q' || CAST(greatest(1, ceil(round(4.0 * (rk - 1) / (n_w_sleep_score - 1), 12))) AS BIGINT) AS bin, weight_change AS v "
    "FROM bx WHERE w_sleep_score IS NOT NULL AND n_w_sleep_score >= 8 UNION ALL "
    + " UNION ALL ".join(
        f"SELECT entity, '{t}', CASE WHEN {c} >= m_{c} THEN 'High' ELSE 'Low' END, weight_change FROM bx WHERE n_{c} >= 8"
        for t, c in (("stress high vs low", "w_avg_stress"), ("steps high vs low", "w_steps"), ("HRV high vs low", "w_hrv"))
    )
)
oracle("recovery_boxes", f"SELECT entity, panel, bin, {box_cols('v')} FROM bxl WHERE v IS NOT NULL GROUP BY entity, panel, bin", BOX_FLOATS)
CTES["rg0"] = (
    f"SELECT entity, day, CASE WHEN count(activity_proxy_7d) OVER {rows(14)} >= 5 THEN avg(activity_proxy_7d) OVER {rows(14)} END AS level FROM rin"
)
CTES["rg1"] = (
    "SELECT entity, day, CASE WHEN level <= quantile_cont(level, 0.33) OVER (PARTITION BY entity) THEN 'low' "
    "WHEN level >= quantile_cont(level, 0.67) OVER (PARTITION BY entity) THEN 'high' ELSE 'normal' END AS regime FROM rg0"
)
oracle(
    "activity_regime_runs",
    "SELECT entity, regime, min(day) AS start_day, max(day) AS end_day, count(*) AS days FROM (SELECT *, "
    f"row_number() OVER ({W}) - row_number() OVER (PARTITION BY entity, regime ORDER BY day) AS g FROM rg1) "
    "WHERE regime <> 'normal' GROUP BY entity, regime, g HAVING count(*) >= 4",
)


def bias_sql(need: int) -> str:
    return (
        f"SELECT entity, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n, CASE WHEN count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) >= {need} "
        "THEN covar_pop(y, x) / nullif((stddev_pop(x) FILTER (WHERE y IS NOT NULL)) * (stddev_pop(y) FILTER (WHERE x IS NOT NULL)), 0) END AS r "
        "FROM (SELECT entity, activity_proxy AS x, energy - tdee_adaptive AS y FROM rin WHERE back <= 30) GROUP BY entity"
    )


oracle("bias_signal", bias_sql(5), "r")
SCATTER = {
    "sleep duration": "w_sleep_hours", "sleep score": "w_sleep_score", "stress": "w_avg_stress", "HRV": "w_hrv", "resting HR": "w_resting_hr",
    "body battery min": "w_body_battery_min",
}
oracle(
    "recovery_scatter",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT entity, day, weight_change, carbs AS color, '{label}' AS metric, {c} AS x FROM rin" for label, c in SCATTER.items()
    ) + ") WHERE x IS NOT NULL AND weight_change IS NOT NULL AND color IS NOT NULL QUALIFY count(*) OVER (PARTITION BY entity, metric) >= 5",
    "weight_change color x",
)

# --- rollups


def weeks_kept(body: str, n: int) -> str:
    return f"SELECT * FROM ({body}) QUALIFY dense_rank() OVER (PARTITION BY entity ORDER BY week DESC) <= {n}"


def weekly_table_sql(src: str, n: int, wearable: bool) -> str:
    extra = (
        ", avg(w_steps) AS steps, avg(w_sleep_seconds) / 3600 AS sleep_hours, avg(w_avg_stress) AS stress, "
        "sum(coalesce(w_moderate_min, 0) + coalesce(w_vigorous_min, 0)) AS intensity_min, CAST(sum(w_session_count) AS DOUBLE) AS sessions"
        if wearable else ""
    )
    body = (
        f"SELECT entity, {WEEK} AS week, avg(energy) AS avg_intake, avg(tdee_adaptive) AS avg_tdee, arg_min(weight, day) AS weight_start, "
        f"arg_max(weight, day) AS weight_end, avg(CAST(on_track AS INT)) * 100 AS adherence_pct{extra}, avg(energy) - avg(tdee_adaptive) AS deficit, "
        f"arg_max(weight, day) - arg_min(weight, day) AS weight_delta FROM {src} GROUP BY 1, 2"
    )
    return weeks_kept(body, n)


WT = "avg_intake avg_tdee weight_start weight_end adherence_pct deficit weight_delta"
oracle("weekly_table", weekly_table_sql("eve", 8, True), WT + " steps sleep_hours stress intensity_min sessions", digits=5)
oracle("weekly_table_orders", weekly_table_sql("ode", 8, False), WT, digits=5)
WD = {
    "avg_weight": "weight", "avg_intake": "energy", "avg_protein": "protein", "avg_carbs": "carbs", "avg_sodium": "sodium", "avg_steps": "w_steps",
    "avg_sleep_hours": "w_sleep_hours", "avg_sleep_score": "w_sleep_score", "avg_stress": "w_avg_stress", "avg_resting_hr": "w_resting_hr",
    "avg_body_battery_min": "w_body_battery_min", "avg_hrv": "w_hrv",
}
FIRST = "arg_min({0}, day) FILTER (WHERE {0} IS NOT NULL)"
LAST = "arg_max({0}, day) FILTER (WHERE {0} IS NOT NULL)"
oracle(
    "weekly_decision",
    weeks_kept(
        "SELECT entity, week, " + ", ".join(f"avg({c}) AS {n}" for n, c in WD.items())
        + f", {FIRST.format('weight')} AS week_start_weight, {LAST.format('weight')} AS week_end_weight, coalesce(sum(w_active_kcal), 0) AS total_active_kcal, "
        f"avg(CAST(on_track AS INT)) AS avg_adherence, ({LAST.format('weight')}) - ({FIRST.format('weight')}) AS weight_delta, "
        f"({LAST.format('weight_smoothed')}) - ({FIRST.format('weight_smoothed')}) AS trend_slope, "
        "CASE WHEN avg(CAST(on_track AS INT)) >= 0.8 THEN 'on track' ELSE 'watch' END AS adherence_flag FROM rin GROUP BY entity, week", 8,
    ),
    " ".join(WD) + " week_start_weight week_end_weight total_active_kcal avg_adherence weight_delta trend_slope", digits=5,
)


def waterfall_sql(src: str) -> str:
    weekly = f"SELECT entity, {WEEK} AS week, arg_min(weight, day) AS first_weight, arg_max(weight, day) AS last_weight FROM {src} WHERE weight IS NOT NULL GROUP BY 1, 2"
    return weeks_kept(
        "SELECT *, last_weight - first_weight AS change, sum(last_weight - first_weight) OVER (PARTITION BY entity ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative "
        f"FROM ({weekly})", 16,
    )


for name, src in (("waterfall", "evp"), ("waterfall_orders", "odp")):
    oracle(name, waterfall_sql(src), "first_weight last_weight change cumulative")
oracle(
    "weekly_activity",
    weeks_kept(
        f"SELECT entity, {WEEK} AS week, coalesce(sum(w_steps), 0) AS steps, coalesce(sum(w_moderate_min), 0) + coalesce(sum(w_vigorous_min), 0) AS intensity_min, "
        f"CAST(sum(w_session_count) AS DOUBLE) AS sessions FROM (SELECT * FROM ev QUALIFY {BACK} <= 56) GROUP BY 1, 2", 8,
    ),
    "steps intensity_min sessions",
)
oracle(
    "dow_stats",
    "SELECT e.entity, d.day_num, d.day_name, avg(energy) AS mean, quantile_cont(energy, 0.5) AS median, stddev_samp(energy) AS std, count(x.entity) AS days "
    "FROM (SELECT DISTINCT entity FROM ev) e CROSS JOIN (VALUES (0, 'Mon'), (1, 'Tue'), (2, 'Wed'), (3, 'Thu'), (4, 'Fri'), (5, 'Sat'), (6, 'Sun')) d(day_num, day_name) "
    f"LEFT JOIN (SELECT entity, energy, {DOW} AS dn FROM ev) x ON x.entity = e.entity AND x.dn = d.day_num GROUP BY ALL",
    "mean median std", "day_num",
)
oracle("intake_variation", "SELECT entity, CASE WHEN count(energy) >= 2 THEN stddev_samp(energy) / nullif(avg(energy), 0) * 100 END AS cv_pct FROM od GROUP BY entity", "cv_pct")
WEEKEND = f"avg(energy) FILTER (WHERE {DOW} >= 5)"
WEEKDAY = f"avg(energy) FILTER (WHERE {DOW} < 5)"
oracle(
    "weekend_difference",
    f"SELECT entity, {WEEKEND} AS weekend_mean, {WEEKDAY} AS weekday_mean, ({WEEKEND}) - ({WEEKDAY}) AS difference FROM od GROUP BY entity",
    "weekend_mean weekday_mean difference",
)
COVERAGE = "weight_pct sleep_pct hrv_pct body_battery_pct session_pct body_composition_pct"


def pct(cond: str, name: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 100.0 ELSE 0 END)::DOUBLE AS {name}"


oracle(
    "coverage_month",
    f"SELECT entity, {MONTH} AS month, {pct('weight IS NOT NULL', 'weight_pct')}, {pct('w_sleep_seconds IS NOT NULL', 'sleep_pct')}, {pct('w_hrv IS NOT NULL', 'hrv_pct')}, "
    f"{pct('w_body_battery_min IS NOT NULL', 'body_battery_pct')}, {pct('has', 'session_pct')}, {pct('weight IS NOT NULL', 'body_composition_pct')} FROM ev "
    "LEFT JOIN (SELECT DISTINCT entity, day, true AS has FROM ss) USING (entity, day) GROUP BY 1, 2",
    COVERAGE,
)
oracle(
    "coverage_month_orders",
    f"SELECT entity, {MONTH} AS month, {pct('weight IS NOT NULL', 'weight_pct')}, 0::DOUBLE AS sleep_pct, 0::DOUBLE AS hrv_pct, 0::DOUBLE AS body_battery_pct, "
    f"0::DOUBLE AS session_pct, {pct('weight IS NOT NULL', 'body_composition_pct')} FROM od GROUP BY 1, 2",
    COVERAGE,
)
oracle("weekday_boxes", f"SELECT entity, CAST({DOW} AS BIGINT) AS day_num, {box_cols('energy')} FROM od GROUP BY 1, 2", BOX_FLOATS)
oracle(
    "hist_weekend",
    "SELECT entity, CAST(coalesce(least(floor(29.0::DOUBLE * (x - lo) / nullif(hi - lo, 0)) + 1, 29), 29) AS BIGINT) AS bin, count(*) FILTER (WHERE NOT we) AS weekday_days, "
    "count(*) FILTER (WHERE we) AS weekend_days, min(lo) AS range_low, max(hi) AS range_high FROM (SELECT entity, weight_change AS x, "
    f"{DOW} >= 5 AS we, min(weight_change) OVER (PARTITION BY entity) AS lo, max(weight_change) OVER (PARTITION BY entity) AS hi FROM odp WHERE weight_change IS NOT NULL) GROUP BY 1, 2",
    "range_low range_high",
)
CTES["adh"] = (
    "SELECT entity, day, CAST(year(day) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(day) AS VARCHAR), 2, '0') AS year_week, "
    f"CAST({DOW} AS BIGINT) AS weekday, CASE WHEN on_track THEN 1.0 WHEN deficit > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS status "
    "FROM (SELECT *, max(day) OVER (PARTITION BY entity) AS newest FROM odm) WHERE day >= newest - 180"
)
oracle("adherence_days", "SELECT * FROM adh", "status")
oracle(
    "adherence_counts",
    "SELECT *, on_track_days * 100.0 / days AS on_track_pct, under_days * 100.0 / days AS under_pct, over_days * 100.0 / days AS over_pct FROM ("
    "SELECT entity, count(*) AS days, count(*) FILTER (WHERE status = 1) AS on_track_days, count(*) FILTER (WHERE status = 0.5) AS under_days, "
    "count(*) FILTER (WHERE status = 0) AS over_days FROM adh GROUP BY entity)",
    "on_track_pct under_pct over_pct",
)
CTES["ins0"] = (
    f"SELECT entity, energy, on_track, w_steps, w_body_battery_max, w_sleep_seconds / 3600 AS sl, w_avg_stress AS st FROM evm QUALIFY {BACK} <= 60"
)
CTES["ins1"] = (
    "SELECT *, quantile_cont(sl, 0.5) OVER (PARTITION BY entity) AS sc, quantile_cont(st, 0.5) OVER (PARTITION BY entity) AS tc FROM ins0"
)
CTES["ins"] = (
    "SELECT entity, count(sl) AS nsl, count(st) AS nst, count(w_steps) AS nstep, count(w_body_battery_max) AS nbb, max(sc) AS sleep_cut, max(tc) AS stress_cut, "
    "avg(CAST(on_track AS INT)) FILTER (WHERE sl >= sc) * 100 AS a, avg(CAST(on_track AS INT)) FILTER (WHERE sl < sc) * 100 AS b, "
    f"avg(CASE WHEN energy > {GOALS.target_energy} THEN 1 ELSE 0 END) FILTER (WHERE st >= tc) * 100 AS c, "
    f"avg(CASE WHEN energy > {GOALS.target_energy} THEN 1 ELSE 0 END) FILTER (WHERE st < tc) * 100 AS d, "
    "avg(w_steps) FILTER (WHERE on_track) AS e, avg(w_steps) FILTER (WHERE NOT on_track) AS f, avg(w_body_battery_max) AS g FROM ins1 GROUP BY entity"
)
S1, S2 = "nsl >= 6 AND a IS NOT NULL AND b IS NOT NULL", "nst >= 6 AND c IS NOT NULL AND d IS NOT NULL"
S3 = "nstep >= 6 AND e IS NOT NULL AND f IS NOT NULL"
INSIGHT = {
    "sleep_cut": (S1, "sleep_cut"), "long_sleep_hit_pct": (S1, "a"), "short_sleep_hit_pct": (S1, "b"), "stress_cut": (S2, "stress_cut"),
    "high_stress_over_pct": (S2, "c"), "low_stress_over_pct": (S2, "d"), "on_track_steps": (S3, "e"), "off_track_steps": (S3, "f"), "peak_battery": ("nbb >= 6", "g"),
}
oracle("adherence_insights", "SELECT entity, " + ", ".join(f"CASE WHEN {k} THEN {v} END AS {n}" for n, (k, v) in INSIGHT.items()) + " FROM ins", " ".join(INSIGHT))
MACROS = ["protein", "carbs", "fat", "protein_pct", "carbs_pct", "fat_pct"]
oracle(
    "recent_macros",
    f"SELECT entity, {', '.join(f'avg({c}) AS avg_{c}' for c in MACROS)} FROM (SELECT * FROM evm QUALIFY {BACK} <= 30) GROUP BY entity",
    " ".join(f"avg_{c}" for c in MACROS),
)
KEY_FLOATS = (
    "avg_weight avg_intake tdee surplus trend_kg_week expected_kg_week discrepancy_kg_week protein_g fiber_g weekend_diff intake_cv_pct adherence_pct"
)


def key_sql(label: str, cond: str, tdee: bool) -> str:
    t = LAST.format("tdee_adaptive") if tdee else "NULL::DOUBLE"
    inner = (
        f"SELECT entity, avg(weight) AS avg_weight, avg(energy) AS avg_intake, {t} AS tdee, CASE WHEN count(weight_smoothed) >= 2 THEN "
        f"(({LAST.format('weight_smoothed')}) - ({FIRST.format('weight_smoothed')})) / greatest(max(day) - min(day), 1) * 7 END AS trend_kg_week, "
        f"avg(protein) AS protein_g, avg(fiber) AS fiber_g, ({WEEKEND}) - ({WEEKDAY}) AS weekend_diff, "
        "CASE WHEN count(energy) >= 2 THEN stddev_samp(energy) / nullif(avg(energy), 0) * 100 END AS intake_cv_pct, avg(CAST(on_track AS INT)) * 100 AS adherence_pct "
        f"FROM eve WHERE {cond} GROUP BY entity"
    )
    return (
        f"SELECT entity, '{label}' AS time_window, avg_weight, avg_intake, tdee, avg_intake - tdee AS surplus, trend_kg_week, (avg_intake - tdee) / 7000 * 7 AS expected_kg_week, "
        f"trend_kg_week - (avg_intake - tdee) / 7000 * 7 AS discrepancy_kg_week, protein_g, fiber_g, weekend_diff, intake_cv_pct, adherence_pct FROM ({inner})"
    )


oracle(
    "key_figures",
    " UNION ALL ".join(key_sql(*a) for a in (("last_7", "back <= 7", True), ("last_30", "back <= 30", True), ("all_time", "true", False))),
    KEY_FLOATS, digits=5,
)
oracle(
    "month_calendar",
    f"SELECT entity, day, CAST(day(day) AS BIGINT) AS day_of_month, CAST({DOW} AS BIGINT) AS weekday, "
    f"CAST((day(day) + isodow({MONTH}) - 1 - 1) // 7 AS BIGINT) AS week, weight_change, w_sleep_score, w_avg_stress, w_steps FROM evp "
    f"QUALIFY {MONTH} = max({MONTH}) OVER (PARTITION BY entity)",
    "weight_change w_sleep_score w_avg_stress w_steps",
)
oracle(
    "macros_daily",
    f"SELECT entity, day, energy_avg_7, energy_avg_30, weight, avg(deficit) OVER {rows(7)} AS deficit_7d, "
    f"CASE WHEN count(*) OVER {rows(7)} = 7 THEN avg(CAST(on_track AS INT)) OVER {rows(7)} * 100 END AS adherence_7d_pct FROM odm",
    "energy_avg_7 energy_avg_30 weight deficit_7d adherence_7d_pct",
)
CTES["rec42"] = f"SELECT * FROM evm QUALIFY {BACK} <= 42"
oracle(
    "wearable_recovery",
    f"SELECT entity, day, avg(w_sleep_seconds / 3600) OVER w AS sleep_hours_7d, avg(w_avg_stress) OVER w AS stress_7d, w_body_battery_min, w_body_battery_max, "
    f"avg(w_body_battery_max) OVER w AS peak_battery_7d, avg(w_resting_hr) OVER w AS resting_hr_7d FROM rec42 WINDOW w AS {rows(7)}",
    "sleep_hours_7d stress_7d w_body_battery_min w_body_battery_max peak_battery_7d resting_hr_7d",
)

# --- sessions and samples
oracle("session_daily", "SELECT * FROM ssd", "w_session_min w_session_kcal w_session_avg_hr w_session_max_hr")
oracle(
    "session_groups",
    "SELECT entity, session_group, count(session_id) AS sessions, sum(duration_min) AS total_duration, sum(kcal) AS total_kcal, avg(avg_hr) AS average_hr, "
    "avg(weight_change) AS next_day_change FROM ss LEFT JOIN evp USING (entity, day) GROUP BY entity, session_group",
    "total_duration total_kcal average_hr next_day_change",
)
PIVOT = {"walks": "walks", "runs": "runs", "cycling": "cycling", "gym": "gym/resistance training", "other": "other"}
oracle(
    "session_week_pivot",
    weeks_kept(
        f"SELECT entity, {WEEK} AS week, " + ", ".join(f"coalesce(sum(kcal) FILTER (WHERE session_group = '{g}'), 0) AS kcal_{n}" for n, g in PIVOT.items())
        + " FROM ss GROUP BY 1, 2", 8,
    ),
    " ".join(f"kcal_{n}" for n in PIVOT),
)
oracle(
    "session_table",
    "SELECT entity, day, position, session_group, duration_min, kcal, avg_hr, max_hr, training_effect, training_load, energy AS same_day_intake, "
    "weight_change AS next_day_change FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY day DESC, session_id DESC NULLS LAST, start_time DESC, "
    "session_name DESC, session_type DESC, duration_min DESC, kcal DESC) AS position FROM ss QUALIFY position <= 12) s LEFT JOIN "
    "(SELECT entity, day, energy, weight_change FROM evp) p USING (entity, day)",
    "duration_min kcal avg_hr max_hr training_effect training_load same_day_intake next_day_change",
)
HR = "SELECT user_id AS entity, CAST(ts AS DATE) AS day, min(value) AS w_hr_min, max(value) AS w_hr_max, avg(value) AS w_hr_avg FROM events GROUP BY 1, 2"
oracle("hr_daily", HR, "w_hr_min w_hr_max w_hr_avg")
oracle("hr_daily_stream", HR, "w_hr_min w_hr_max w_hr_avg")

# --- incremental history
HISTORY = [c for c in EVENT_COLUMNS if c.startswith("w_") and c != "w_respiration"]
CTES["g_old"] = f"SELECT entity, day, {', '.join(HISTORY)} FROM ev WHERE day <= DATE '{SPLIT_DAY}'"
CTES["g_new"] = (
    f"SELECT entity, day, {', '.join('w_steps + 1 AS w_steps' if c == 'w_steps' else c for c in HISTORY)}, w_avg_stress / 2 AS w_readiness FROM ev "
    f"WHERE day >= DATE '{SPLIT_DAY}' - 1"
)
CTES["g_all"] = (
    "SELECT *, NULL::DOUBLE AS w_readiness FROM g_old WHERE (entity, day) NOT IN (SELECT (entity, day) FROM g_new) UNION ALL BY NAME SELECT * FROM g_new"
)
MERGED = (
    f"SELECT *, sum(w_steps) OVER {rows(7)} AS w_weekly_steps, avg(w_avg_stress) OVER {rows(7)} AS w_weekly_avg_stress, "
    f"sum(coalesce(w_moderate_min, 0) + coalesce(w_vigorous_min, 0)) OVER {rows(7)} AS w_weekly_intensity_min FROM g_all"
)
MERGED_FLOATS = " ".join(c for c in HISTORY if c != "w_session_count") + " w_readiness w_weekly_steps w_weekly_avg_stress w_weekly_intensity_min"
oracle("merge_daily", MERGED, MERGED_FLOATS, "w_session_count")
oracle(
    "merge_stream",
    MERGED.replace("SELECT *,", f"SELECT * REPLACE (CASE WHEN day >= DATE '{SPLIT_DAY}' - 1 THEN w_avg_stress / 2 END AS w_readiness),"),
    MERGED_FLOATS, "w_session_count",
)
CTES["sm0"] = f"SELECT *, 0 AS src FROM ss WHERE day <= DATE '{SPLIT_DAY}' + 3 UNION ALL BY NAME SELECT * REPLACE (kcal + 1 AS kcal), 1 AS src FROM ss WHERE day >= DATE '{SPLIT_DAY}'"
CTES["sm"] = (
    "SELECT * EXCLUDE (src) FROM sm0 QUALIFY row_number() OVER (PARTITION BY entity, coalesce('id::' || CAST(session_id AS VARCHAR), "
    "concat_ws('::', CAST(day AS VARCHAR), start_time, session_name, session_type, CAST(duration_min AS VARCHAR))) ORDER BY src DESC) = 1"
)
oracle(
    "merge_sessions",
    "SELECT *, NULL::DOUBLE AS distance_m FROM sm",
    "duration_min kcal avg_hr max_hr training_effect training_load distance_m", "session_id",
)
oracle(
    "store_roundtrip",
    "SELECT entity, day, session_group, count(*) AS sessions, round(sum(kcal), 3) AS kcal FROM sm GROUP BY ALL", "kcal",
)
oracle(
    "merge_samples",
    f"SELECT user_id AS entity, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS sample_ts, "
    f"max(value + CASE WHEN CAST(ts AS DATE) >= DATE '{SPLIT_DAY}' THEN 0.5 ELSE 0 END) AS bpm FROM events GROUP BY 1, 2, 3",
    "bpm",
)
CTES["g_stored"] = f"SELECT * FROM ev QUALIFY {BACK} > 3"
START, END = "DATE '2024-01-01'", "DATE '2024-01-30'"
oracle(
    "sync_bounds",
    f"SELECT entity, coalesce(greatest({START}, newest - 2), {START}) AS sync_start, {END} AS sync_end FROM (SELECT DISTINCT entity FROM ev) "
    "LEFT JOIN (SELECT entity, max(day) AS newest FROM g_stored GROUP BY entity) USING (entity)",
)
CTES["bounds"] = f"SELECT entity, greatest({START}, max(day) - 2) AS sync_start FROM g_stored GROUP BY entity"


def gap(c: str) -> str:
    before = f"count({c}) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0"
    after = f"count({c}) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > 0"
    return f"CASE WHEN {c} IS NULL AND {before} AND {after} THEN 1 ELSE 0 END"


WATCHED = [c for c in EVENT_COLUMNS if c.startswith("w_")]
for name, src in (("gapn", "g_stored"), ("gapn_all", "ev")):
    CTES[name] = f"SELECT entity, day, {' + '.join(gap(c) for c in WATCHED)} AS missing FROM {src}"
CTES["gaps"] = (
    "SELECT entity, day FROM gapn JOIN bounds USING (entity) "
    f"WHERE missing >= 1 AND day BETWEEN {START} AND {END} AND day < sync_start QUALIFY {BACK} <= 30"
)
oracle("gap_dates", "SELECT * FROM gaps")
oracle("gap_dates_several", f"SELECT entity, day FROM gapn_all WHERE missing >= 2 AND day BETWEEN {START} AND {END} QUALIFY {BACK} <= 30")
CTES["bounds_all"] = (
    f"SELECT entity, coalesce(sync_start, {START}) AS sync_start FROM (SELECT DISTINCT entity FROM ev) LEFT JOIN bounds USING (entity)"
)
oracle(
    "sync_dates",
    f"SELECT entity, CAST(unnest(generate_series(sync_start, {END}, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds_all UNION SELECT entity, day FROM gaps",
)

# --- payloads
V = "entity % 3"
W3 = lambda a, b, c: f"CASE {V} WHEN 0 THEN {a} WHEN 1 THEN {b} ELSE {c} END"
PAYLOAD = {
    "w_steps": "w_steps", "w_distance_m": "w_distance_m", "w_active_kcal": "w_active_kcal", "w_floors": "NULL::DOUBLE", "w_resting_hr": "w_resting_hr",
    "w_sleep_seconds": "w_sleep_seconds", "w_sleep_score": "w_sleep_score", "w_avg_stress": "w_avg_stress",
    "w_body_battery_max": W3("w_body_battery_max", "greatest(w_body_battery_max, w_body_battery_min)", "coalesce(w_body_battery_max, w_body_battery_min)"),
    "w_body_battery_min": W3("w_body_battery_min", "least(w_body_battery_max, w_body_battery_min)", "w_body_battery_min"),
    "w_moderate_min": W3("w_moderate_min", "w_moderate_min", "NULL"), "w_vigorous_min": W3("w_vigorous_min", "w_vigorous_min", "NULL"),
    "w_session_count": W3("2", "3", "4"), "w_session_min": W3("0", "0", "NULL") + "::DOUBLE", "w_session_kcal": W3("0", "0", "NULL") + "::DOUBLE",
    "w_session_avg_hr": "NULL::DOUBLE", "w_session_max_hr": "NULL::DOUBLE",
    "w_hr_min": "least(energy, protein)", "w_hr_max": "greatest(energy, protein)", "w_hr_avg": "(energy + protein) / 2",
    "w_hrv": W3("w_hrv", "coalesce(w_hrv, 1)", "w_hrv"), "w_respiration": "w_respiration", "w_spo2": W3("97.5", "96", "NULL") + "::DOUBLE",
    "w_readiness": W3("55", "61", "70.5") + "::DOUBLE", "w_training_status": W3("'PRODUCTIVE'", "NULL", "'7'"),
}
oracle(
    "payload_daily", "SELECT entity, day, " + ", ".join(f"{e} AS {c}" for c, e in PAYLOAD.items()) + " FROM ev",
    " ".join(c for c in PAYLOAD if c not in ("w_session_count", "w_training_status")), "w_session_count",
)
oracle(
    "payload_samples",
    f"SELECT entity, day, {W3('CAST(day AS VARCHAR) || ' + repr('T01:00:00'), repr('1000'), repr('1000'))} AS sample_ts, energy AS bpm FROM ev UNION ALL "
    f"SELECT entity, day, {W3('CAST(day AS VARCHAR) || ' + repr('T02:00:00'), repr('2000'), repr('2000'))}, protein FROM ev",
    "bpm",
)
DETAIL = "coalesce(session_id % 2 = 0, false)"
oracle(
    "payload_sessions",
    f"SELECT entity, day, session_id, session_name, session_type, session_group, start_time, duration_min, CASE WHEN {DETAIL} THEN session_id % 100 ELSE kcal END::DOUBLE AS kcal, "
    f"NULL::DOUBLE AS distance_m, CASE WHEN {DETAIL} AND {V} = 0 THEN NULL ELSE avg_hr END AS avg_hr, CASE WHEN {DETAIL} THEN 150 END::DOUBLE AS max_hr, "
    f"NULL::DOUBLE AS training_effect, CASE WHEN {V} = 2 THEN training_load END AS training_load FROM ss",
    "duration_min kcal distance_m avg_hr max_hr training_effect training_load",
)

oracle(
    "payload_session_days",
    "SELECT entity, day, sum(duration_min) AS w_session_min, sum(kcal) AS w_session_kcal, avg(avg_hr) AS w_session_avg_hr, NULL::DOUBLE AS w_session_max_hr FROM ss GROUP BY 1, 2",
    "w_session_min w_session_kcal w_session_avg_hr w_session_max_hr",
)

# --- trends and goals
CTES["wt"] = (
    f"SELECT *, {BACK} AS back, min(day) OVER (PARTITION BY entity) AS d0, min(day) FILTER (WHERE back90) OVER (PARTITION BY entity) AS d90 "
    f"FROM (SELECT entity, day, weight, {BACK} <= 90 AS back90 FROM odp)"
)
oracle(
    "weight_trends",
    "SELECT *, current_weight - start_weight AS total_change, CASE WHEN current_weight < start_weight THEN 'lost' ELSE 'gained' END AS direction FROM ("
    "SELECT entity, count(weight) AS n, CASE WHEN count(weight) > 1 THEN regr_slope(weight, day - d0) END AS slope, CASE WHEN count(weight) > 1 THEN regr_intercept(weight, day - d0) END AS intercept, "
    "count(weight) FILTER (WHERE back90) AS recent_n, CASE WHEN count(*) FILTER (WHERE back90) > 7 THEN regr_slope(weight, day - d90) FILTER (WHERE back90) END AS recent_slope, "
    "CASE WHEN count(*) FILTER (WHERE back90) > 7 THEN regr_intercept(weight, day - d90) FILTER (WHERE back90) END AS recent_intercept, "
    f"{FIRST.format('weight')} AS start_weight, {LAST.format('weight')} AS current_weight FROM wt GROUP BY entity)",
    "slope intercept recent_slope recent_intercept start_weight current_weight total_change",
)
oracle(
    "axis_limits",
    "SELECT entity, CASE WHEN min(weight) IS NULL THEN 69.0 ELSE least(min(weight), 79.0) - 2 END::DOUBLE AS y_min, CASE WHEN min(weight) IS NULL THEN 89.0 ELSE max(weight) + 2 END::DOUBLE AS y_max "
    "FROM ev GROUP BY entity",
    "y_min y_max",
)
for p in ("ev", "od"):
    CTES[f"{p}fit0"] = (
        f"SELECT *, row_number() OVER ({W}) - 1 AS i FROM (SELECT entity, day, weight_smoothed AS y, max(day) OVER (PARTITION BY entity) AS last_day FROM {p}s "
        f"QUALIFY {BACK} <= 30) WHERE y IS NOT NULL"
    )
    CTES[f"{p}fit1"] = (
        f"SELECT entity, count(*) AS points, regr_slope(y, i) AS slope, regr_intercept(y, i) AS icept, arg_max(y, day) AS last_weight, max(last_day) AS last_day "
        f"FROM {p}fit0 GROUP BY entity HAVING count(*) > 1"
    )
    CTES[f"{p}fit"] = (
        f"SELECT f.*, d.deviation FROM {p}fit1 f JOIN (SELECT a.entity, stddev_pop(a.y - (b.slope * a.i + b.icept)) AS deviation FROM {p}fit0 a "
        f"JOIN {p}fit1 b USING (entity) GROUP BY a.entity) d USING (entity)"
    )
    goals = GOALS if p == "ev" else ORDER_GOALS
    CTES[f"{p}scn"] = (
        f"SELECT *, (kcal - weighted_average) / 7000 AS daily_kg FROM (SELECT entity, last_day, last_weight, weighted_average, unnest(['aggressive', 'standard', 'slow', 'current average']) AS scenario, "
        "unnest([weighted_average - 750, weighted_average - 500, weighted_average - 250, recent_intake]) AS kcal "
        f"FROM {p}fit JOIN {p}est USING (entity) JOIN (SELECT entity, avg(energy) AS recent_intake FROM {p}e WHERE back <= 30 GROUP BY entity) USING (entity) "
        "WHERE weighted_average IS NOT NULL)"
    )
    CTES[f"{p}scn2"] = (
        "SELECT entity, scenario, kcal, last_day, last_weight, daily_kg, CASE WHEN abs(daily_kg) > 1e-5 AND "
        f"(last_weight - {goals.target_weight}) * daily_kg < 0 THEN abs((last_weight - {goals.target_weight}) / daily_kg) END AS days_to_target FROM {p}scn"
    )
    CTES[f"{p}trend"] = (
        f"SELECT entity, CASE WHEN count(weight_smoothed) >= 2 THEN (({LAST.format('weight_smoothed')}) - ({FIRST.format('weight_smoothed')})) / greatest(max(day) - min(day), 1) * 7 ELSE 0 END AS trend_kg_week "
        f"FROM (SELECT * FROM {p}s QUALIFY {BACK} <= 30) GROUP BY entity"
    )
    g = goals.target_weight
    CTES[f"{p}goal0"] = (
        f"SELECT entity, s AS start_weight, c AS current_weight, trend_kg_week, last_day, CASE WHEN abs(s - {g}) > 0.1 THEN "
        f"least(1, greatest(0, CASE WHEN s > {g} THEN (s - c) / (s - {g}) ELSE (c - s) / ({g} - s) END)) ELSE 0 END AS complete, c - {g} AS kg_remaining, "
        f"CASE WHEN abs(trend_kg_week) > 0.01 AND ((c > {g} AND trend_kg_week < 0) OR (c < {g} AND trend_kg_week > 0)) THEN 'On Track' "
        "WHEN abs(trend_kg_week) > 0.01 THEN 'Off Track' ELSE 'Stalled' END AS status "
        f"FROM (SELECT entity, {FIRST.format('weight')} AS s, {LAST.format('weight')} AS c, max(day) AS last_day FROM {p}s GROUP BY entity) JOIN {p}trend USING (entity)"
    )
    CTES[f"{p}goal"] = (
        "SELECT *, CASE WHEN floor(days_to_goal) <= DATE '9999-12-31' - last_day THEN last_day + CAST(floor(days_to_goal) AS INT) END AS goal_day FROM (SELECT *, "
        f"CASE WHEN status = 'On Track' THEN abs(kg_remaining) / abs(trend_kg_week) * 7 END AS days_to_goal FROM {p}goal0)"
    )
oracle(
    "weight_projection",
    "SELECT entity, last_day + CAST(ahead AS INT) AS day, ahead, slope * (points + ahead - 1) + icept AS projected, slope * (points + ahead - 1) + icept - 1.96 * deviation AS lower, "
    "slope * (points + ahead - 1) + icept + 1.96 * deviation AS upper FROM (SELECT *, unnest(range(1, 91)) AS ahead FROM odfit)",
    "projected lower upper", digits=5,
)
oracle(
    "weight_scenarios",
    "SELECT *, CASE WHEN floor(days_to_target) <= DATE '9999-12-31' - last_day THEN last_day + CAST(floor(days_to_target) AS INT) END AS target_day FROM odscn2",
    "kcal last_weight daily_kg days_to_target", digits=4,
)
oracle(
    "scenario_paths",
    "SELECT entity, scenario, last_day + CAST(ahead AS INT) AS day, ahead, last_weight + daily_kg * ahead AS projected FROM (SELECT *, unnest(range(1, 91)) AS ahead FROM evscn2)",
    "projected", digits=4,
)
oracle("goal_progress", "SELECT * FROM odgoal", "start_weight current_weight trend_kg_week complete kg_remaining days_to_goal", digits=5)
oracle(
    "goal_change",
    f"SELECT entity, day, weight - first_value(weight) OVER ({W}) AS cumulative_change FROM ev WHERE weight IS NOT NULL", "cumulative_change",
)
CTES["burn"] = (
    f"SELECT entity, day, d AS daily_deficit, sum(d) OVER {UPTO} AS cumulative_deficit FROM (SELECT entity, day, coalesce(tdee_adaptive, weighted_average) - energy AS d "
    "FROM eve JOIN evest USING (entity) WHERE weighted_average IS NOT NULL QUALIFY count(*) OVER (PARTITION BY entity) >= 8)"
)
oracle("burndown", "SELECT * FROM burn", "daily_deficit cumulative_deficit", digits=3)
oracle(
    "burndown_targets",
    "SELECT entity, current_deficit, abs(kg_remaining) * 7000 AS remaining_deficit, current_deficit + abs(kg_remaining) * 7000 AS target_deficit, goal_day AS projected_end FROM "
    "(SELECT entity, arg_max(cumulative_deficit, day) AS current_deficit FROM burn GROUP BY entity) JOIN evgoal USING (entity)",
    "current_deficit remaining_deficit target_deficit", digits=3,
)
oracle(
    "status_summary",
    "SELECT entity, current_weight, bmi AS current_bmi, recent_intake, recent_deficit, recent_adherence_pct, trend_kg_week, "
    f"coalesce({BAND}, 'Unknown') AS bmi_band, CASE WHEN trend_kg_week < -0.05 THEN 'losing' WHEN trend_kg_week > 0.05 THEN 'gaining' ELSE 'maintaining' END AS trend_word, "
    f"CASE WHEN abs(trend_kg_week) > 0.01 AND ((current_weight > {ORDER_GOALS.target_weight} AND trend_kg_week < 0) OR (current_weight < {ORDER_GOALS.target_weight} AND trend_kg_week > 0)) "
    f"THEN abs(current_weight - {ORDER_GOALS.target_weight}) / abs(trend_kg_week) * 7 END AS days_to_goal FROM (SELECT entity, arg_max(weight, day) AS current_weight, arg_max(bmi, day) AS bmi, "
    "avg(energy) AS recent_intake, avg(deficit) AS recent_deficit, avg(CAST(on_track AS INT)) * 100 AS recent_adherence_pct FROM ode WHERE back <= 30 GROUP BY entity) JOIN odtrend USING (entity)",
    "current_weight current_bmi recent_intake recent_deficit recent_adherence_pct trend_kg_week days_to_goal", digits=5,
)

CTES["page"] = (
    f"SELECT s.*, e.weighted_average, w.difference AS weekend_diff, s.recent_intake - e.weighted_average AS gap FROM ({BODIES['status_summary'][0]}) s "
    f"LEFT JOIN odest e USING (entity) JOIN ({BODIES['weekend_difference'][0]}) w USING (entity)"
)
oracle(
    "report_summary",
    "SELECT page.*, CASE WHEN gap > 200 THEN 'reduce' WHEN gap < -200 THEN 'in deficit' WHEN gap IS NOT NULL THEN 'maintenance' END AS advice, "
    "CASE WHEN abs(gap) > 200 THEN abs(gap) / 7000 * 7 END AS gap_kg_per_week, weighted_average - 500 AS kcal_for_half_kg_loss, weighted_average - 250 AS kcal_for_quarter_kg_loss, "
    "CASE WHEN abs(weekend_diff) > 300 THEN 'improve weekend consistency' ELSE 'consistent' END AS weekend_advice, t.metric AS strongest_nutrient, t.r AS strongest_r FROM page "
    "LEFT JOIN (SELECT entity, metric, r FROM c0o WHERE n > 2 AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY round(abs(r), 12) DESC, metric DESC) = 1) t USING (entity)",
    "current_weight current_bmi recent_intake recent_deficit recent_adherence_pct trend_kg_week days_to_goal weighted_average weekend_diff gap gap_kg_per_week "
    "kcal_for_half_kg_loss kcal_for_quarter_kg_loss strongest_r", digits=4,
)

# --- text labelling
CTES["quotas"] = (
    f"SELECT source, least(n, f + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= {SAMPLE_SIZE} - sum(f) OVER () THEN 1 ELSE 0 END) AS quota FROM (SELECT source, n, "
    f"n * {SAMPLE_SIZE} // t AS f, n * {SAMPLE_SIZE} % t AS rest FROM (SELECT source, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS t FROM documents GROUP BY source))"
)
oracle("stratum_quotas", "SELECT * FROM quotas", ints="quota")
oracle(
    "stratified_sample",
    "SELECT source, doc_id, n_chars, text FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id) AS k FROM documents) "
    "JOIN quotas USING (source) WHERE k <= quota",
)
oracle("text_preview", "SELECT doc_id, lang, text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id LIMIT 10")
oracle(
    "text_prepare",
    "SELECT doc_id, lower(cat) AS category, CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 THEN 0 ELSE 1 END AS label, md5(lower(text) || ' - ' || lower(cat)) AS combined_md5 "
    "FROM (SELECT *, coalesce(lang, 'Miscellaneous') AS cat FROM documents) LEFT JOIN labels USING (doc_id)",
    ints="label",
)
oracle("text_classify", "SELECT doc_id, true AS in_range, true AS label_follows, true AS accurate, true AS separates FROM documents")

# Counterparts of the queries over files and over the long panel register themselves.
from checks import file_oracle, long_oracle  # noqa: E402,F401
