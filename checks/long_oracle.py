"""SQL counterparts over the long panel: the same bodies, with every CTE that rests on the event panel or its sessions anew."""

from __future__ import annotations

import re

from checks.oracle import BODIES, CTES, GROUP, bias_sql, matrix_sql, oracle

# Name, expression over the orders of a nation and day, and when it is missing: where (day of the year + shift) is a multiple of the step.
COLUMNS = [
    ("energy", "1400 + 0.0032 * price", 0, 1), ("protein", "0.00032 * price", 0, 1), ("carbs", "32 * n + 0.0032 * price", 0, 1), ("fat", "0.00032 * price", 0, 1),
    ("fiber", "2 * n", 0, 1), ("sodium", "0.032 * price", 0, 1), ("water", "0.0032 * price", 0, 1), ("weight", "78 + 0.0032 * balance", 6, 0),
    ("w_steps", "0.032 * price", 5, 1), ("w_distance_m", "8 * n + 0.032 * price", 7, 2), ("w_active_kcal", "0.0032 * price", 4, 3), ("w_resting_hr", "50 + 0.0032 * balance", 5, 4),
    ("w_sleep_seconds", "18000 + 0.032 * price", 3, 5), ("w_sleep_score", "40 + 0.00032 * price", 4, 6), ("w_avg_stress", "20 + 0.0032 * balance", 5, 0),
    ("w_body_battery_max", "60 + 0.00032 * price", 4, 1), ("w_body_battery_min", "5 + 0.0032 * balance", 6, 2), ("w_moderate_min", "0.00032 * price", 3, 0),
    ("w_vigorous_min", "0.0032 * abs(balance)", 4, 0), ("w_hrv", "30 + 0.00032 * price", 4, 5), ("w_respiration", "12 + 0.00032 * balance", 5, 6),
]


def value(text: str, step: int, shift: int) -> str:
    return f"CAST(CASE WHEN (dayofyear(day) + {shift}) % {step} <> 0 THEN {text} END AS DOUBLE)" if step else f"CAST({text} AS DOUBLE)"


BASE = {"ev": "long_ev", "ss": "long_ss"}
CTES["long_ev"] = (
    "SELECT entity, day, " + ", ".join(f"{value(text, step, shift)} AS {c}" for c, text, step, shift in COLUMNS) + ", CAST(n AS BIGINT) AS w_session_count FROM "
    "(SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS price, max(c_acctbal) AS balance, count(*) AS n "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
)
CTES["long_ss"] = (
    f"SELECT *, {GROUP} AS session_group FROM (SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(o_orderdate AS DATE) AS day, o_orderkey AS session_id, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Running' WHEN '2-HIGH' THEN 'walking' WHEN '3-MEDIUM' THEN 'strength_training' WHEN '4-NOT SPECIFIED' THEN 'road_biking' "
    "WHEN '5-LOW' THEN 'yoga' ELSE 'other' END AS session_type, o_totalprice * 0.00032 AS duration_min, o_totalprice * 0.0032 AS kcal, "
    "CASE WHEN o_orderkey % 4 <> 0 THEN 90 + o_totalprice * 0.00032 END AS avg_hr, CASE WHEN o_orderkey % 4 <> 0 THEN 110 + o_totalprice * 0.00032 END AS max_hr "
    "FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 0)"
)


def relabel(sql: str, names: dict[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(sorted(names, key=len, reverse=True)) + r")\b", lambda m: names[m[1]], sql)


def rests_on(sql: str, names: dict[str, str]) -> bool:
    return re.search(r"\b(" + "|".join(names) + r")\b", sql) is not None


# In the order of definition, so that what a CTE rests on is known before it.
NAMES = dict(BASE)
for name in list(CTES):
    if name not in BASE and not name.startswith("long_") and rests_on(CTES[name], NAMES):
        NAMES[name] = f"long_{name}"
for name, new in NAMES.items():
    if name not in BASE:
        CTES[new] = relabel(CTES[name], NAMES)
# Bodies that ask for fewer pairs over the event panel.
DEFAULT_COUNTS = {"bias_signal": bias_sql(11), "lag_matrix": matrix_sql("lagtrend")}
for name in (
    "weekly_table", "weekly_decision", "weekly_activity", "session_week_pivot", "coverage_month", "adherence_insights", "bias_signal", "lag_matrix", "lag_summary",
):
    body, floats, ints, digits = BODIES[name]
    body = DEFAULT_COUNTS.get(name, body)
    oracle(f"{name}_long", relabel(body, NAMES), floats, ints, digits)
