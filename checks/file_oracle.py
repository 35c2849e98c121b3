"""SQL counterparts of the queries over files: straight from the tables, without any file."""

from __future__ import annotations

from checks.oracle import CTES, DAILY_FLOATS, W, oracle, processed_sql, rows

THREE = "SELECT * REPLACE (CASE WHEN entity % 4 = 1 THEN 0 ELSE sodium END AS sodium) FROM three"
CTES["three_csv"] = THREE
oracle("csv_daily", f"SELECT * EXCLUDE (rn) REPLACE (CAST(entity AS VARCHAR) AS entity) FROM ({processed_sql('three_csv')})", DAILY_FLOATS, "w_session_count")
# entity, day, seven nutrients and the flag, whose cell holds two fields more
oracle("csv_bad_records", "SELECT CAST(entity AS VARCHAR) AS entity, CAST(day AS VARCHAR) AS day, CAST(12 AS BIGINT) AS fields FROM ev WHERE dayofmonth(day) IN (5, 17)")
oracle("daily_file", f"SELECT * EXCLUDE (rn) FROM ({processed_sql('three')})", DAILY_FLOATS, "w_session_count")
oracle(
    "published_run",
    f"SELECT entity, day, '/run_date=2024-05-06/daily' AS folder, energy, sodium, weight, w_steps, energy_avg_7, weight_change FROM ({processed_sql('three')})",
    "energy sodium weight w_steps energy_avg_7 weight_change",
)
oracle(
    "report_files",
    "SELECT 'by_day' AS dataset, CAST(day AS VARCHAR) AS name, count(*) AS n, sum(energy) AS energy FROM ev GROUP BY day "
    "UNION ALL SELECT 'by_user', CAST(entity AS VARCHAR), count(*), NULL FROM ev GROUP BY entity",
    "energy",
)
oracle(
    "session_file",
    "SELECT CASE event_type WHEN 'click' THEN 'Running' WHEN 'view' THEN 'walking' WHEN 'purchase' THEN 'strength_training' WHEN 'signup' THEN 'road_biking' ELSE 'yoga' END AS session_type, "
    "count(*) AS sessions, sum(value * 5) AS kcal, count(*) FILTER (WHERE event_id % 7 <> 0) AS with_id FROM events GROUP BY 1",
    "kcal",
)
oracle(
    "food_file",
    "SELECT doc_id, lower(cat) AS category, CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 THEN 0 ELSE 1 END AS label, md5(lower(text) || ' - ' || lower(cat)) AS combined_md5 "
    "FROM (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'Miscellaneous' ELSE coalesce(lang, 'Miscellaneous') END AS cat FROM documents) LEFT JOIN labels USING (doc_id)",
    ints="label",
)
oracle("payload_file", "SELECT entity, day, 'summary' AS endpoint, w_steps, true AS undated FROM ev", "w_steps")

# --- exports: the winning record of each household and day, of the later file and then the later user
CTES["xd"] = "SELECT *, entity % 12 AS hh, CASE WHEN entity % 5 < 3 THEN 1 ELSE 2 END AS n, entity % 2 = 1 AS odd, entity % 3 = 0 AS third FROM ev"


def winner(where: str = "true", first: str = "") -> str:
    return f"SELECT * FROM xd WHERE {where} QUALIFY row_number() OVER (PARTITION BY hh, day ORDER BY {first}n DESC, entity DESC) = 1"


STAGES = "CASE WHEN w_avg_stress IS NOT NULL OR w_moderate_min IS NOT NULL THEN coalesce(w_avg_stress * 60, 0) + coalesce(w_moderate_min * 60, 0) END"
CTES["xsum"] = (
    "SELECT hh, day, w_steps, w_distance_m, w_active_kcal, w_moderate_min, w_vigorous_min, CASE WHEN odd THEN w_resting_hr ELSE 0 END AS rest_now, "
    "CASE WHEN third THEN w_hrv END AS rest_day, w_respiration + 30 AS hr_min, w_sleep_score + 60 AS hr_max, CASE WHEN odd THEN 95 END AS spo2_day, w_avg_stress AS stress_day, "
    f"greatest(w_body_battery_max, w_body_battery_min) AS bb_max, least(w_body_battery_max, w_body_battery_min) AS bb_min, w_respiration AS resp_day FROM ({winner()})"
)
CTES["xsleep"] = (
    f"SELECT hh, day, CASE WHEN odd THEN coalesce(w_sleep_seconds, {STAGES}) ELSE {STAGES} END AS w_sleep_seconds, w_sleep_score, "
    f"CASE WHEN third THEN 0 ELSE w_respiration END AS resp_sleep, CASE WHEN third THEN 93::DOUBLE END AS spo2_sleep FROM ({winner('entity % 5 <> 0')})"
)
CTES["xfit"] = f"SELECT hh, day, w_resting_hr AS rest_fitness FROM ({winner('entity % 7 <> 0')})"
CTES["xhealth"] = (
    "SELECT hh, day, w_resting_hr AS hr_health, CASE WHEN third THEN 0 ELSE w_hrv END AS hrv_health, NULL::DOUBLE AS resp_health, NULL::DOUBLE AS spo2_health "
    f"FROM ({winner()})"
)
CTES["xwell"] = (
    "SELECT hh, day, CASE WHEN odd THEN w_avg_stress ELSE 7 END AS stress_snap, CASE WHEN NOT odd THEN w_respiration END AS hr_min_snap, CASE WHEN NOT odd THEN w_sleep_score END AS hr_max_snap, "
    "CASE WHEN NOT odd THEN w_resting_hr END AS hr_snap, CASE WHEN NOT odd THEN w_hrv END AS hrv_snap, CASE WHEN NOT odd THEN w_respiration END AS resp_snap, NULL::DOUBLE AS spo2_snap "
    f"FROM ({winner(first='odd, ')})"
)
CTES["xses"] = (
    "SELECT user_id % 12 AS hh, CAST(ts AS DATE) AS day, date_trunc('second', ts) AS moment, CASE WHEN event_id % 7 <> 0 THEN event_id END AS session_id, event_type AS session_name, "
    "CASE event_type WHEN 'click' THEN 'Running' WHEN 'view' THEN 'walking' WHEN 'purchase' THEN 'strength_training' WHEN 'signup' THEN 'road_biking' ELSE 'yoga' END AS session_type, "
    "CASE event_type WHEN 'click' THEN 'runs' WHEN 'view' THEN 'walks' WHEN 'purchase' THEN 'gym/resistance training' WHEN 'signup' THEN 'cycling' ELSE 'other' END AS session_group, "
    "value AS duration_min, value * 5 AS kcal, value * 100 AS distance_m, CASE WHEN event_type <> 'error' THEN value * 0.064::DOUBLE + 90 END AS avg_hr, "
    "CASE WHEN event_type <> 'error' THEN value * 0.128::DOUBLE + 110 END AS max_hr FROM events WHERE event_id % 4 < 3 OR event_id % 3 <> 0"
)
CTES["xsd"] = (
    "SELECT hh, day, coalesce(sum(duration_min), 0) AS s_min, coalesce(sum(kcal), 0) AS s_kcal, avg(avg_hr) AS s_avg, max(max_hr) AS s_max, count(*) AS s_n FROM xses GROUP BY hh, day"
)


def truthy(*values: str) -> str:
    return f"coalesce({', '.join([*(f'nullif({v}, 0)' for v in values[:-1]), values[-1]])})"


JOINED = " ".join(f"FULL JOIN {t} USING (hh, day)" for t in ("xsleep", "xfit", "xhealth", "xwell", "xsd"))
CTES["xdaily"] = (
    "SELECT CAST(hh AS VARCHAR) AS entity, day, w_steps, w_distance_m, w_active_kcal, NULL::DOUBLE AS w_floors, "
    f"{truthy('rest_now', 'rest_day', 'rest_fitness')} AS w_resting_hr, w_sleep_seconds, w_sleep_score, {truthy('stress_day', 'stress_snap')} AS w_avg_stress, "
    "bb_max AS w_body_battery_max, bb_min AS w_body_battery_min, w_moderate_min, w_vigorous_min, s_n AS w_session_count, s_min AS w_session_min, s_kcal AS w_session_kcal, "
    f"s_avg AS w_session_avg_hr, s_max AS w_session_max_hr, {truthy('hr_min', 'hr_min_snap')} AS w_hr_min, {truthy('hr_max', 'hr_max_snap')} AS w_hr_max, "
    f"{truthy('hr_health', 'hr_snap')} AS w_hr_avg, {truthy('hrv_health', 'hrv_snap')} AS w_hrv, {truthy('resp_health', 'resp_sleep', 'resp_snap', 'resp_day')} AS w_respiration, "
    f"{truthy('spo2_health', 'spo2_sleep', 'spo2_day', 'spo2_snap')} AS w_spo2, NULL::DOUBLE AS w_readiness, NULL::VARCHAR AS w_training_status FROM xsum {JOINED}"
)
WEARABLE = (
    "w_steps w_distance_m w_active_kcal w_resting_hr w_sleep_seconds w_sleep_score w_avg_stress w_body_battery_max w_body_battery_min w_moderate_min w_vigorous_min "
    "w_session_min w_session_kcal w_session_avg_hr w_session_max_hr w_hr_min w_hr_max w_hr_avg w_hrv w_respiration w_spo2 w_floors w_readiness"
)
oracle("export_daily", "SELECT * FROM xdaily", WEARABLE, "w_session_count")
oracle(
    "export_sessions",
    "SELECT CAST(hh AS VARCHAR) AS entity, day, session_id, session_name, session_type, session_group, duration_min, kcal, distance_m, avg_hr, max_hr, "
    "NULL::DOUBLE AS training_effect, NULL::DOUBLE AS training_load FROM xses",
    "duration_min kcal distance_m avg_hr max_hr training_effect training_load", "session_id",
)
oracle(
    "export_timestamps",
    "SELECT CAST(hh AS VARCHAR) AS entity, strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS \"at\", count(*) AS n FROM xses GROUP BY ALL "
    "UNION ALL SELECT CAST(hh AS VARCHAR), CAST(day AS VARCHAR), CAST(1 AS BIGINT) FROM xfit",
)
oracle(
    "export_typed_entries", "SELECT * EXCLUDE (hh), CAST(hh AS VARCHAR) AS entity FROM xhealth FULL JOIN xwell USING (hh, day)",
    "hr_health hrv_health resp_health spo2_health stress_snap hr_min_snap hr_max_snap hr_snap hrv_snap resp_snap spo2_snap",
)
oracle("export_sleep", "SELECT * EXCLUDE (hh), CAST(hh AS VARCHAR) AS entity FROM xsleep", "w_sleep_seconds w_sleep_score resp_sleep spo2_sleep")

# --- whole jobs: what the first run stored, what the second one asked for, the newer row wins
CTES["j1"] = (
    "SELECT entity, day, w_steps + 1 AS w_steps, w_distance_m, w_active_kcal FROM ev WHERE day <= DATE '2024-01-20' AND (entity % 5 <> 0 OR dayofmonth(day) <> 10)"
)
CTES["jstart"] = (
    "SELECT entity, coalesce(greatest(DATE '2024-01-01', newest - 2), DATE '2024-01-01') AS start FROM (SELECT DISTINCT entity FROM ev) "
    "LEFT JOIN (SELECT entity, max(day) AS newest FROM j1 GROUP BY entity) USING (entity)"
)
interior = lambda c: (
    f"({c} IS NULL AND count({c}) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 AND count({c}) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) > 0)"
)
CTES["jgaps"] = (
    f"SELECT entity, day FROM (SELECT entity, day, {' OR '.join(interior(c) for c in ('w_steps', 'w_distance_m', 'w_active_kcal'))} AS gap FROM j1) JOIN jstart USING (entity) "
    "WHERE gap AND day < start"
)
CTES["j2"] = (
    "SELECT ev.entity, ev.day, w_steps, w_distance_m, w_active_kcal FROM ev JOIN jstart USING (entity) "
    "WHERE day >= start OR EXISTS (SELECT 1 FROM jgaps g WHERE g.entity = ev.entity AND g.day = ev.day)"
)
CTES["jall"] = "SELECT * FROM j2 UNION ALL SELECT * FROM j1 ANTI JOIN j2 USING (entity, day)"
oracle(
    "sync_job",
    f"SELECT *, sum(w_steps) OVER {rows(7)} AS w_weekly_steps, 0::DOUBLE AS w_weekly_intensity_min FROM jall",
    "w_steps w_distance_m w_active_kcal w_weekly_steps w_weekly_intensity_min",
)
oracle(
    "seed_job",
    "SELECT entity, day, w_steps, w_resting_hr, w_session_count, "
    f"sum(w_steps) OVER {rows(7)} AS w_weekly_steps, avg(w_avg_stress) OVER {rows(7)} AS w_weekly_avg_stress, "
    f"sum(coalesce(w_moderate_min, 0) + coalesce(w_vigorous_min, 0)) OVER {rows(7)} AS w_weekly_intensity_min, w_session_count AS stored_sessions FROM xdaily",
    "w_steps w_resting_hr w_weekly_steps w_weekly_avg_stress w_weekly_intensity_min", "w_session_count stored_sessions",
)

# --- what no other query uses
oracle(
    "calendar_days",
    "SELECT d.day, coalesce(users, 0) AS users, d.day > last - 7 AS recent, strftime(CAST(date_trunc('week', d.day) AS DATE) + 6, '%m-%d') AS week FROM "
    "(SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ev) d, (SELECT max(day) AS last FROM ev) "
    "LEFT JOIN (SELECT day, count(*) AS users FROM ev GROUP BY day) e ON e.day = d.day",
)
oracle(
    "healthy_weights",
    "SELECT entity, count(*) FILTER (WHERE weight BETWEEN 18.5 * 1.75 * 1.75 AND 24.9 * 1.75 * 1.75) AS healthy, count(weight) AS weighed, "
    "18.5::DOUBLE * 3.0625 AS low, 24.9::DOUBLE * 3.0625 AS high FROM ev GROUP BY entity",
    "low high",
)
oracle(
    "gap_dates_text",
    f"SELECT entity, day FROM (SELECT entity, day, {interior('w_avg_stress')} AS gap FROM ev) WHERE gap QUALIFY row_number() OVER (PARTITION BY entity ORDER BY day DESC) <= 30",
)
