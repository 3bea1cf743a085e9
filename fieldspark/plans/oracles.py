"""DuckDB SQL that must give the same rows as each registered query."""

from __future__ import annotations

from fieldspark.operators.quality import ACCEPTED_VALUES, NOT_NULL
from fieldspark.plans.queries import SINGLE_PRECISION

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
IRRIGATION_AS_OF = "TIMESTAMP '2024-01-30 23:59:59'"
CUTOFF = "TIMESTAMP '2024-01-16 00:00:00'"


def avg(x: str) -> str:
    return f"avg({x})"


def cut(column: str, precision: int, scale: int) -> str:
    return f"CAST(floor({column} * 1e{scale}) / 1e{scale} AS DECIMAL({precision}, {scale})) AS {column}"


def pct(x: str, p: float) -> str:
    return f"round(percentile_cont({p}) WITHIN GROUP (ORDER BY {x}), 6)"


CTES = {
    "weather": """
        SELECT event_id AS id, CAST(40 + user_id % 5 AS DOUBLE) AS latitude,
               CAST(-120 - user_id % 3 AS DOUBLE) AS longitude, epoch_us(ts) * 1000 AS timestamp,
               value - 60 AS temperature, value % 100 AS humidity, value * 2 AS solar_radiation,
               CAST(950 + user_id AS DOUBLE) AS pressure, epoch_us(ts) * 1000 AS created_at
        FROM events WHERE event_type IN ('view', 'click')""",
    "soil": """
        SELECT event_id AS id, epoch_us(ts) * 1000 AS timestamp, value / 3 AS t_0_cm, value / 4 AS t_10_cm,
               value - 5 AS moisture, ph AS ph_0_5cm,
               ph + 1e0 / 10 AS ph_5_15cm, ph + 2e0 / 10 AS ph_15_30cm, ph + 3e0 / 10 AS ph_30_60cm,
               ph + 4e0 / 10 AS ph_60_100cm, ph + 5e0 / 10 AS ph_100_200cm, epoch_us(ts) * 1000 AS created_at
        FROM (SELECT *, 5e0 + CAST(user_id % 4 AS DOUBLE) * 5e-1 AS ph
              FROM events WHERE event_type NOT IN ('view', 'click'))""",
    "crop_yield": """
        SELECT n_name AS area, p_type AS item, CAST(year(o_orderdate) + 12 AS INTEGER) AS year,
               l_extendedprice AS hg_ha_yield, p_retailprice AS average_rain_fall_mm_per_year,
               l_quantity AS pesticides_tonnes, CAST(p_size AS DOUBLE) AS avg_temp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "predictions": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey, l_linenumber, n_name AS area,
               p_type AS crop_type, CAST(year(o_orderdate) + 12 AS INTEGER) AS year,
               CASE l_linenumber % 4 WHEN 0 THEN 'baseline' WHEN 1 THEN 'optimistic'
                    WHEN 2 THEN 'pessimistic' ELSE 'conservative' END AS scenario,
               l_extendedprice AS actual, l_extendedprice * (1 - l_discount) AS predicted,
               l_extendedprice * (1 - l_discount) AS predicted_yield_hg_ha,
               l_extendedprice * (1 - l_discount) / 10 AS predicted_yield_kg_ha,
               l_extendedprice * (1 - l_discount) / 10000 AS predicted_yield_tonnes_ha,
               o_orderdate AS prediction_date, l_tax AS tax, l_discount AS discount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "stg_weather": """
        SELECT * REPLACE (make_timestamp(timestamp // 1000) AS timestamp,
                          make_timestamp(created_at // 1000) AS created_at) FROM weather""",
    "stg_soil": """
        SELECT * REPLACE (make_timestamp(timestamp // 1000) AS timestamp,
                          make_timestamp(created_at // 1000) AS created_at) FROM soil""",
    "stg_crop_yield": """
        SELECT area, item, year, hg_ha_yield, average_rain_fall_mm_per_year AS average_rainfall_mm_per_year,
               pesticides_tonnes, avg_temp FROM crop_yield""",
    "soil_daily": """
        SELECT date_day, soil_temp_surface, soil_temp_10cm, soil_moisture, ph_surface FROM (
            SELECT date_trunc('day', timestamp) AS date_day, t_0_cm AS soil_temp_surface,
                   t_10_cm AS soil_temp_10cm, moisture AS soil_moisture, ph_0_5cm AS ph_surface,
                   row_number() OVER (PARTITION BY date_trunc('day', timestamp)
                                      ORDER BY timestamp DESC, id DESC) AS rn
            FROM stg_soil) WHERE rn = 1""",
    "unified": """
        SELECT date_trunc('hour', w.timestamp) AS reading_timestamp, w.latitude, w.longitude,
               w.temperature AS air_temp, w.humidity, w.solar_radiation, w.pressure,
               s.soil_temp_surface, s.soil_temp_10cm, s.soil_moisture, s.ph_surface
        FROM stg_weather w JOIN soil_daily s ON date_trunc('day', w.timestamp) = s.date_day""",
    "daily": f"""
        SELECT date_trunc('day', reading_timestamp) AS date, {avg('air_temp')} AS avg_daily_temp,
               min(air_temp) AS min_daily_temp, max(air_temp) AS max_daily_temp,
               {avg('humidity')} AS avg_humidity, {avg('soil_moisture')} AS avg_soil_moisture,
               {avg('ph_surface')} AS avg_ph,
               sum(solar_radiation) AS total_solar_radiation,
               count(*) AS reading_count
        FROM unified GROUP BY 1""",
    "summary": """
        SELECT date, avg_daily_temp, avg_humidity, avg_soil_moisture, avg_ph, reading_count,
               avg_daily_temp - lag(avg_daily_temp) OVER (ORDER BY date) AS temp_change_24h,
               CASE WHEN reading_count < 20 THEN 'WARNING' ELSE 'HEALTHY' END AS sensor_status
        FROM daily""",
    "flagged": """
        SELECT reading_timestamp, air_temp, humidity, soil_moisture, ph_surface,
               CASE WHEN air_temp < -50 OR air_temp > 60 THEN 'ANOMALY' ELSE 'OK' END AS temp_flag,
               CASE WHEN soil_moisture < 0 OR soil_moisture > 100 THEN 'ANOMALY' ELSE 'OK' END AS moisture_flag,
               CASE WHEN soil_moisture < 20 THEN 'LOW_MOISTURE_ALERT'
                    WHEN soil_moisture > 80 THEN 'HIGH_MOISTURE_ALERT' ELSE 'NORMAL' END AS irrigation_alert
        FROM unified""",
    "monitoring": f"SELECT * FROM flagged WHERE reading_timestamp >= {AS_OF} - INTERVAL 7 DAY",
    "in_range": """
        SELECT * FROM flagged
        WHERE CAST(reading_timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "with_alerts": """
        SELECT *, concat_ws(', ',
                 CASE WHEN temp_flag = 'ANOMALY' THEN 'High Temp (' || CAST(air_temp AS VARCHAR) || '°C)' END,
                 CASE WHEN moisture_flag = 'ANOMALY'
                      THEN 'Abnormal Moisture (' || CAST(soil_moisture AS VARCHAR) || '%)' END,
                 CASE WHEN irrigation_alert <> 'NORMAL' THEN 'Irrigation Needed' END) AS alerts
        FROM monitoring""",
    "irrigation": f"""
        SELECT *, CASE WHEN current_moisture < 30 AND current_temp > 25 THEN 'IRRIGATE_NOW'
                       WHEN current_moisture < 40 AND current_temp > 20 THEN 'IRRIGATE_SOON'
                       WHEN current_moisture > 70 THEN 'SKIP_IRRIGATION' ELSE 'MONITOR' END AS recommendation,
               CASE WHEN current_moisture < 30 THEN (40 - current_moisture) * 10 ELSE 0e0 END AS estimated_water_mm
        FROM (SELECT CAST({IRRIGATION_AS_OF} AS DATE) AS recommendation_date,
                     {avg('soil_moisture')} AS current_moisture, {avg('air_temp')} AS current_temp
              FROM unified WHERE reading_timestamp >= {IRRIGATION_AS_OF} - INTERVAL 2 HOUR)""",
    "features": """
        SELECT *, hg_ha_yield / nullif(average_rainfall_mm_per_year, 0) AS yield_per_mm_rain,
               pesticides_tonnes / nullif(hg_ha_yield, 0) AS pesticides_per_yield_unit,
               CASE WHEN avg_temp < 15 THEN 'cold' WHEN avg_temp BETWEEN 15 AND 25 THEN 'optimal'
                    ELSE 'hot' END AS temp_category
        FROM stg_crop_yield""",
    "training": """
        SELECT hg_ha_yield AS target_yield, area, item AS crop_type, year, average_rainfall_mm_per_year,
               pesticides_tonnes, avg_temp,
               hg_ha_yield / nullif(average_rainfall_mm_per_year, 0) AS yield_efficiency,
               pesticides_tonnes / nullif(average_rainfall_mm_per_year, 0) AS pesticide_intensity,
               CAST(year % 10 AS INTEGER) AS year_in_decade,
               CASE WHEN year >= 2010 THEN 'modern' ELSE 'historical' END AS era
        FROM features WHERE hg_ha_yield > 0""",
    "base": f"""
        SELECT area, item AS crop_type, {avg('average_rainfall_mm_per_year')} AS baseline_rainfall,
               {avg('pesticides_tonnes')} AS baseline_pesticides, {avg('avg_temp')} AS baseline_temp
        FROM stg_crop_yield WHERE year >= 2008 GROUP BY area, item""",
    "scenarios": """
        SELECT area, crop_type, 'baseline' AS scenario, baseline_rainfall AS rain,
               baseline_pesticides AS pest, baseline_temp AS temp FROM base
        UNION ALL SELECT area, crop_type, 'optimistic', baseline_rainfall * 1.15e0,
               baseline_pesticides * 1.10e0, baseline_temp - 0.5e0 FROM base
        UNION ALL SELECT area, crop_type, 'pessimistic', baseline_rainfall * 0.75e0,
               baseline_pesticides * 1.20e0, baseline_temp + 1.5e0 FROM base
        UNION ALL SELECT area, crop_type, 'conservative', baseline_rainfall * 0.95e0,
               baseline_pesticides * 0.80e0, baseline_temp FROM base""",
    "conditions": f"""
        SELECT area, crop_type, CAST(2025 AS INTEGER) AS year, scenario, rain AS average_rainfall_mm_per_year,
               pest AS pesticides_tonnes, temp AS avg_temp, pest / nullif(rain, 0) AS pesticide_intensity,
               CAST(5 AS INTEGER) AS year_in_decade, 'modern' AS era, {AS_OF} AS prediction_requested_at
        FROM scenarios WHERE rain > 0""",
    "benchmarks": f"""
        SELECT item AS crop_type, {avg('hg_ha_yield')} AS avg_yield, {pct('hg_ha_yield', 0.25)} AS p25_yield,
               {pct('hg_ha_yield', 0.75)} AS p75_yield, max(hg_ha_yield) AS max_yield,
               {avg('avg_temp')} AS optimal_temp, round(stddev_samp(avg_temp), 4) AS temp_stddev,
               {avg('average_rainfall_mm_per_year')} AS optimal_rainfall,
               {avg('pesticides_tonnes')} AS typical_pesticide_use, count(*) AS sample_size
        FROM stg_crop_yield GROUP BY item HAVING count(*) >= 10""",
    "errors": """
        SELECT *, actual - predicted AS error, abs(actual - predicted) AS absolute_error,
               abs((actual - predicted) / nullif(actual, 0)) * 100 AS percentage_error
        FROM predictions""",
    "hourly": "SELECT * REPLACE (date_trunc('hour', timestamp) AS timestamp) FROM stg_weather",
    "split": """
        SELECT *, CASE WHEN ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8))::BIGINT % 5 = 0
                       THEN 'test' ELSE 'train' END AS split
        FROM predictions""",
    # Documents as they are delivered, then as rows with a reason where they are put aside.
    "weather_hours": """
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END AS run_id,
               CASE WHEN event_id % 41 <> 0 THEN CAST(40 + user_id % 5 AS DOUBLE) END AS latitude,
               CAST(-120 - user_id % 3 AS DOUBLE) AS longitude,
               epoch_us(date_trunc('hour', ts) + to_seconds(shift)) * 1000 AS timestamp,
               CASE WHEN event_id % 7 <> 0 THEN (value - 32) * 5e0 / 9e0 END AS temperature,
               CASE WHEN event_id % 50 = 0 THEN 100000 ELSE value % 100 END AS humidity,
               value * 2 AS solar_radiation, CAST(950 + user_id AS DOUBLE) AS pressure
        FROM events, (VALUES (0), (3600)) AS s(shift) WHERE event_type IN ('view', 'click') AND event_id % 97 <> 3""",
    "weather_judged": """
        SELECT *, concat_ws(', ', CASE WHEN latitude IS NULL THEN 'NULL in latitude' END,
               CASE WHEN abs(humidity) >= 1000 THEN 'humidity out of range' END) AS reason FROM weather_hours""",
    "weather_decimals": """
        SELECT run_id, CAST(latitude AS DECIMAL(8, 5)) AS latitude, CAST(longitude AS DECIMAL(8, 5)) AS longitude, timestamp,
               CAST(temperature AS DECIMAL(5, 2)) AS temperature, CAST(humidity AS DECIMAL(5, 2)) AS humidity,
               CAST(solar_radiation AS DECIMAL(8, 2)) AS solar_radiation, CAST(pressure AS DECIMAL(7, 2)) AS pressure
        FROM weather_judged WHERE reason = ''""",
    "landed_weather": f"""
        SELECT row_number() OVER (ORDER BY run_id, timestamp, latitude, longitude) AS id, latitude, longitude, timestamp,
               temperature, humidity, solar_radiation, pressure, epoch_us({AS_OF}) * 1000 AS created_at, run_id
        FROM (SELECT * FROM weather_decimals QUALIFY row_number() OVER (PARTITION BY latitude, longitude, timestamp ORDER BY run_id,
               temperature NULLS FIRST, humidity NULLS FIRST, solar_radiation NULLS FIRST, pressure NULLS FIRST) = 1)""",
    "soil_judged": """
        SELECT *, concat_ws(', ', CASE WHEN timestamp IS NULL THEN 'NULL in timestamp' END,
               CASE WHEN abs(t_10_cm) >= 1000 THEN 't_10_cm out of range' END) AS reason
        FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END AS run_id,
                     CASE WHEN event_id % 43 <> 0 THEN epoch_us(date_trunc('second', ts)) * 1000 END AS timestamp,
                     value + 1 AS t_0_cm, CASE WHEN event_id % 60 = 5 THEN -5000 ELSE value END AS t_10_cm,
                     CASE WHEN event_id % 3 <> 0 THEN value % 100 END AS moisture, 5e0 + CAST(user_id % 4 AS DOUBLE) * 5e-1 AS ph
              FROM events WHERE event_type NOT IN ('view', 'click') AND event_id % 97 <> 3)""",
    "landed_soil": f"""
        SELECT row_number() OVER (ORDER BY run_id, timestamp, t_0_cm, t_10_cm, moisture NULLS FIRST, ph_0_5cm) AS id, *,
               epoch_us({AS_OF}) * 1000 AS created_at
        FROM (SELECT run_id, timestamp, CAST(t_0_cm AS DECIMAL(5, 2)) AS t_0_cm, CAST(t_10_cm AS DECIMAL(5, 2)) AS t_10_cm,
                     CAST(moisture AS DECIMAL(5, 2)) AS moisture, CAST(ph AS DECIMAL(5, 2)) AS ph_0_5cm,
                     CAST(ph + 0.1 AS DECIMAL(5, 2)) AS ph_5_15cm, CAST(ph + 0.2 AS DECIMAL(5, 2)) AS ph_15_30cm,
                     CAST(ph + 0.3 AS DECIMAL(5, 2)) AS ph_30_60cm, CAST(ph + 0.4 AS DECIMAL(5, 2)) AS ph_60_100cm,
                     CAST(ph + 0.5 AS DECIMAL(5, 2)) AS ph_100_200cm
              FROM soil_judged WHERE reason = '')""",
    "landed_daily": """
        SELECT date_trunc('day', make_timestamp(w.timestamp // 1000)) AS date, avg(CAST(w.temperature AS DOUBLE)) AS avg_daily_temp,
               avg(CAST(w.humidity AS DOUBLE)) AS avg_humidity, avg(CAST(s.moisture AS DOUBLE)) AS avg_soil_moisture,
               avg(CAST(s.ph_0_5cm AS DOUBLE)) AS avg_ph, count(*) AS reading_count
        FROM landed_weather w JOIN (
          SELECT * FROM landed_soil
          QUALIFY row_number() OVER (PARTITION BY timestamp // 86400000000000 ORDER BY timestamp DESC, id DESC) = 1
        ) s ON s.timestamp // 86400000000000 = w.timestamp // 86400000000000 GROUP BY 1""",
    "panel_split": """
        SELECT CASE WHEN ('0x' || md5(concat_ws('|', area, crop_type, CAST(year AS VARCHAR)))[1:8])::BIGINT % 5 = 0
                    THEN 'test' ELSE 'train' END AS split FROM training""",
    "readings": """
        SELECT event_id AS id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS sensor,
               CASE WHEN event_id % 17 <> 0 THEN event_type END AS status, CASE WHEN event_id % 13 <> 0 THEN value END AS value
        FROM events""",
}

# Model names of the data tests and their CTEs.
MODEL_CTES = {
    "stg_weather": "stg_weather",
    "stg_soil": "stg_soil",
    "stg_crop_yield": "stg_crop_yield",
    "int_sensor_readings_unified": "unified",
    "int_daily_conditions": "daily",
    "int_crop_yield_features": "features",
    "fct_ml_training_dataset": "training",
    "fct_current_conditions": "conditions",
    "fct_sensor_monitoring": "monitoring",
    "dim_crop_benchmarks": "benchmarks",
    "rpt_daily_farm_summary": "summary",
    "rpt_irrigation_recommendations": "irrigation",
}


def sql(body: str) -> str:
    """Prefix the shared table definitions (unused ones cost nothing)."""
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in CTES.items())
    return f"WITH {ctes}\n{body}"


def check(table: str, name: str, column: str, violations: str, source: str, severity: str = "error") -> str:
    failed = "fail" if severity == "error" else "warn"
    return f"""
        SELECT '{table}' AS table_name, '{name}' AS check_name, '{column}' AS column_name,
               '{severity}' AS severity, CAST(v AS BIGINT) AS violations,
               CASE WHEN v > 0 THEN '{failed}' ELSE 'pass' END AS status
        FROM (SELECT {violations} AS v FROM {source})"""


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


NOT_NULL_CHECKS = [
    check(t, "not_null", c, f"count(*) - count({c})", MODEL_CTES[t]) for t, columns in NOT_NULL.items() for c in columns
]
UNIQUE_CHECKS = [
    check(t, "unique", c, "count(*)",
          f"(SELECT {c} FROM {MODEL_CTES[t]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    for t, c in (("int_daily_conditions", "date"), ("rpt_daily_farm_summary", "date"), ("dim_crop_benchmarks", "crop_type"))
]
ACCEPTED_CHECKS = [
    check(t, "accepted_values", c, "count(*) FILTER (WHERE {} NOT IN ({}))".format(c, ", ".join(f"'{v}'" for v in allowed)),
          MODEL_CTES[t])
    for t, values in ACCEPTED_VALUES.items() for c, allowed in values.items()
]
TRAINING_RELATION = check(
    "fct_ml_training_dataset", "relationships", "crop_type", "count(*)",
    "(SELECT 1 FROM training t ANTI JOIN benchmarks b ON t.crop_type = b.crop_type WHERE t.crop_type IS NOT NULL)", "warn",
)


def metrics(by: str, source: str, predicted: str = "predicted") -> str:
    error = f"(actual - {predicted})"
    ape = f"abs({error} / nullif(actual, 0)) * 100"
    return f"""
        SELECT {by}, count(*) AS n, sqrt(avg({error} * {error})) AS rmse, {avg(f'abs({error})')} AS mae,
               1 - avg({error} * {error}) / nullif(var_pop(actual), 0) AS r2, {avg(ape)} AS mean_ape,
               percentile_cont(0.5) WITHIN GROUP (ORDER BY {ape}) AS median_ape
        FROM {source} GROUP BY {by}"""


def histogram(column: str, source: str, bins: int) -> str:
    return f"""
        SELECT CAST(k AS INTEGER) AS bin, round(low + k * width, 6) AS bin_start, count(x) AS n
        FROM (SELECT min({column}) AS low, (max({column}) - min({column})) / {bins} AS width FROM {source})
        CROSS JOIN (SELECT unnest(range({bins})) AS k)
        LEFT JOIN (SELECT {column} AS x FROM {source})
          ON coalesce(least(CAST(floor((x - low) / nullif(width, 0)) AS INTEGER), {bins - 1}), 0) = k AND x IS NOT NULL
        GROUP BY k, low, width"""


def describe(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
        SELECT '{column}' AS column_name, count({column}) AS n, {avg(column)} AS mean,
               round(stddev_samp({x}), 4) AS std, min({x}) AS min, {pct(x, 0.25)} AS p25, {pct(x, 0.5)} AS p50,
               {pct(x, 0.75)} AS p75, max({x}) AS max FROM training"""


def label(column: str) -> str:
    return f"""
        SELECT '{column}' AS feature, {column} AS label, CAST(row_number() OVER (ORDER BY {column}) - 1 AS BIGINT) AS code
        FROM (SELECT DISTINCT {column} FROM training)"""


NUMERIC = [
    "target_yield", "year", "average_rainfall_mm_per_year", "pesticides_tonnes",
    "avg_temp", "yield_efficiency", "pesticide_intensity", "year_in_decade",
]
CORRELATED = [
    "target_yield", "yield_efficiency", "pesticide_intensity", "average_rainfall_mm_per_year", "avg_temp",
]
SUMMARY_COLUMNS = [
    "date", "avg_daily_temp", "avg_humidity", "avg_soil_moisture", "avg_ph", "reading_count",
    "temp_change_24h", "sensor_status",
]
LATEST_ORDER = "reading_timestamp DESC, air_temp DESC, humidity DESC, soil_moisture DESC, ph_surface DESC"
PREDICTION_COLUMNS = """
    area, crop_type, year, scenario, predicted AS predicted_yield_hg_ha, predicted / 10 AS predicted_yield_kg_ha,
    predicted / 10000 AS predicted_yield_tonnes_ha, 'v1.0' AS model_version"""
EXTREME = """
    SELECT l_orderkey, l_linenumber, area, crop_type, scenario, predicted_yield_kg_ha
    FROM predictions ORDER BY predicted_yield_kg_ha {}, l_orderkey, l_linenumber LIMIT 5"""
WEATHER_HOUR = """
    SELECT CAST(40 + user_id % 5 AS DOUBLE) AS latitude, CAST(-120 - user_id % 3 AS DOUBLE) AS longitude,
           make_timestamp((epoch_us(ts) // 1000000 + {0}) * 1000000) AS timestamp,
           CASE WHEN event_id % 7 <> 0 THEN (value - 32) * 5e0 / 9e0 END AS temperature, value % 100 AS humidity,
           value + {0} AS solar_radiation, CASE WHEN event_id % 5 <> 0 THEN 950e0 + user_id END AS pressure
    FROM events WHERE event_type IN ('view', 'click')"""

BODIES = {
    "scan_weather": "SELECT * REPLACE ({}) FROM weather".format(", ".join([
        cut("latitude", 8, 5), cut("longitude", 8, 5), cut("temperature", 5, 2), cut("humidity", 5, 2),
        cut("solar_radiation", 8, 2), cut("pressure", 7, 2)])),
    "scan_soil": "SELECT * REPLACE ({}) FROM soil".format(", ".join(
        cut(c, 5, 2) for c in ("t_0_cm", "t_10_cm", "moisture", "ph_0_5cm", "ph_5_15cm", "ph_15_30cm", "ph_30_60cm",
                               "ph_60_100cm", "ph_100_200cm"))),
    "scan_crop_yield": "SELECT * FROM crop_yield",
    "csv_roundtrip": "SELECT * FROM flagged",
    "sql_text_query": "SELECT * EXCLUDE (prediction_requested_at) FROM conditions WHERE pesticide_intensity IS NOT NULL",
    "flatten_weather_json": _union(WEATHER_HOUR.format(s) for s in (0, 3600, 86400)),
    "flatten_soil_json": """
        SELECT make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS timestamp, value + 274 AS t_0_cm,
               value + 273 AS t_10_cm, CASE WHEN event_id % 3 <> 0 THEN value / 500 END AS moisture,
               ph + 0e0 AS ph_0_5cm, ph + 1e0 / 10 AS ph_5_15cm, ph + 2e0 / 10 AS ph_15_30cm,
               ph + 3e0 / 10 AS ph_30_60cm, ph + 4e0 / 10 AS ph_60_100cm, ph + 5e0 / 10 AS ph_100_200cm
        FROM (SELECT *, 5e0 + CAST(user_id % 4 AS DOUBLE) * 5e-1 AS ph
              FROM events WHERE event_type NOT IN ('view', 'click'))""",
    "parquet_roundtrip": f"""
        SELECT {PREDICTION_COLUMNS}, {AS_OF} AS prediction_date, CAST({AS_OF} AS DATE) AS snapshot_date
        FROM predictions""",
    "append_ignore_conflicts": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY latitude, longitude, timestamp ORDER BY id) AS rn FROM hourly)
        WHERE rn = 1""",
    "append_plain": "SELECT * FROM stg_soil",
    "incremental_batch": f"""
        SELECT w.*, CAST(CASE WHEN timestamp < {CUTOFF} THEN -1 ELSE m END AS INTEGER) AS after_id
        FROM stg_weather w, (SELECT max(id) AS m FROM stg_weather WHERE timestamp < {CUTOFF})
        WHERE timestamp < {CUTOFF} OR id > m""",
    "incremental_cursor": """
        SELECT 'weather' AS source, max(id) AS last_id, count(*) AS rows_copied FROM weather
        UNION ALL SELECT 'soil', max(id), count(*) FROM soil
        UNION ALL SELECT 'predictions', max(id), count(*) FROM predictions""",
    "lowercase_columns": "SELECT area, crop_type, year, scenario, predicted_yield_hg_ha FROM predictions",
    "stg_weather": "SELECT * FROM stg_weather",
    "stg_soil": "SELECT * FROM stg_soil",
    "stg_crop_yield": "SELECT * FROM stg_crop_yield",
    "crop_yield_features": "SELECT * FROM features",
    "ml_training_dataset": "SELECT * FROM training",
    "drop_leakage": "SELECT * EXCLUDE (yield_efficiency, pesticide_intensity) FROM training",
    "feature_select": """
        SELECT area, crop_type, year, average_rainfall_mm_per_year, pesticides_tonnes, avg_temp, year_in_decade, era
        FROM training""",
    "soil_daily_latest": "SELECT * FROM soil_daily",
    "sensor_unified": "SELECT * FROM unified",
    "daily_conditions": "SELECT * FROM daily",
    "dq_faulty_rows": _union([
        *[check("readings", "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)", "readings") for c in ("id", "sensor", "status", "value")],
        check("readings", "accepted_values", "status", "count(*) FILTER (WHERE status NOT IN ('view', 'click', 'purchase'))", "readings"),
        check("readings", "expression", "value >= 10", "count(*) FILTER (WHERE NOT value >= 10)", "readings", "warn"),
        check("readings", "expression", "value < 1000", "count(*) FILTER (WHERE NOT value < 1000)", "readings", "warn"),
        *[check("readings", "unique", c, "count(*)", f"(SELECT {c} FROM readings WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
          for c in ("sensor", "id")],
        check("readings", "relationships", "sensor", "count(*)",
              "(SELECT 1 FROM readings ANTI JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON sensor = c_custkey WHERE sensor IS NOT NULL)"),
    ]),
    "landed_weather": "SELECT * FROM landed_weather",
    "landed_soil": "SELECT * FROM landed_soil",
    "landing_quarantine": """
        SELECT table_name, reason, run_id, count(*) AS n FROM (
          SELECT 'weather' AS table_name, reason, run_id FROM weather_judged WHERE reason <> ''
          UNION ALL SELECT 'soil', reason, run_id FROM soil_judged WHERE reason <> ''
          UNION ALL SELECT CASE WHEN event_type IN ('view', 'click') THEN 'weather' ELSE 'soil' END, 'corrupt document',
            CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END FROM events WHERE event_id % 97 = 3)
        GROUP BY ALL""",
    "landing_farm_summary": """
        SELECT date, avg_daily_temp, avg_humidity, avg_soil_moisture, avg_ph, reading_count,
               avg_daily_temp - lag(avg_daily_temp) OVER (ORDER BY date) AS temp_change_24h,
               CASE WHEN reading_count < 20 THEN 'WARNING' ELSE 'HEALTHY' END AS sensor_status
        FROM landed_daily""",
    "training_job": f"""
        SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') AS train_size, count(*) FILTER (split = 'test') AS test_size,
               CAST(8 AS INTEGER) AS features, {AS_OF} AS run_date, CAST(100 AS INTEGER) AS param_trees, CAST(20 AS INTEGER) AS param_depth,
               'v2' AS production_version, CAST(0 AS BIGINT) AS scored_differently, true AS has_metrics
        FROM panel_split""",
    "forecast_job": f"""
        SELECT run_id, row_number() OVER (ORDER BY run_id, area, crop_type, scenario) AS id, area, crop_type, year, scenario,
               true AS units_agree, true AS copied, 'v1' AS model_version, {AS_OF} AS prediction_date,
               2 * (SELECT count(*) FROM conditions) AS cursor
        FROM conditions, (VALUES ('first'), ('second')) AS r(run_id)""",
    "daily_farm_summary": "SELECT * FROM summary ORDER BY date DESC",
    "rolling_7d_temp": """
        SELECT date, avg_daily_temp,
               avg(avg_daily_temp) OVER w AS temp_7day_avg
        FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "sensor_monitoring": "SELECT * FROM monitoring",
    "irrigation_recommendation": "SELECT * FROM irrigation",
    "sensor_range": "SELECT * FROM in_range",
    "latest_reading": f"SELECT * FROM in_range ORDER BY {LATEST_ORDER} LIMIT 1",
    "active_alerts": "SELECT * FROM with_alerts",
    "live_status": f"""
        SELECT * FROM with_alerts
        WHERE CAST(reading_timestamp AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-30'
        ORDER BY {LATEST_ORDER} LIMIT 1""",
    "trend_series": _union(
        f"SELECT reading_timestamp, '{m}' AS metric, {m} AS value FROM in_range"
        for m in ("air_temp", "humidity", "soil_moisture", "ph_surface")
    ),
    "base_scenarios": "SELECT * FROM base",
    "current_conditions": "SELECT * FROM conditions",
    "crop_benchmarks": "SELECT * FROM benchmarks",
    "dq_not_null": _union(NOT_NULL_CHECKS),
    "dq_unique": _union(UNIQUE_CHECKS),
    "dq_accepted_values": _union(ACCEPTED_CHECKS),
    "dq_relationships": _union([
        TRAINING_RELATION,
        check("orders", "relationships", "o_custkey", "count(*)",
              "(SELECT 1 FROM orders ANTI JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c"
              " ON o_custkey = c.c_custkey WHERE o_custkey IS NOT NULL)"),
    ]),
    "dq_composite_unique": _union(
        check(name, "unique", "latitude,longitude,timestamp", "count(*)",
              f"(SELECT 1 FROM {source} GROUP BY latitude, longitude, timestamp HAVING count(*) > 1)")
        for name, source in (("weather", "stg_weather"), ("weather_hourly", "hourly"))
    ),
    "dq_recency": _union([
        check("int_daily_conditions", "recency", "date",
              f"CASE WHEN max(date) >= {AS_OF} - INTERVAL 7 DAY THEN 0 ELSE 1 END", "daily", "warn"),
        check("int_daily_conditions", "recency", "date",
              "CASE WHEN max(date) >= TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 7 DAY THEN 0 ELSE 1 END", "daily"),
        check("fct_sensor_monitoring", "recency", "reading_timestamp",
              f"CASE WHEN max(reading_timestamp) >= {AS_OF} - INTERVAL 2 DAY THEN 0 ELSE 1 END", "monitoring", "warn"),
    ]),
    "dq_equal_rowcount": _union([
        check("int_crop_yield_features", "equal_rowcount", "*",
              "abs((SELECT count(*) FROM features) - count(*))", "crop_yield", "warn"),
        check("int_sensor_readings_unified", "equal_rowcount", "*",
              "abs((SELECT count(*) FROM unified) - count(*))", "daily", "warn"),
    ]),
    "dq_expression": _union([
        check("fct_ml_training_dataset", "expression", "target_yield > 0",
              "count(*) FILTER (WHERE NOT target_yield > 0)", "training", "warn"),
        check("int_sensor_readings_unified", "expression", "soil_moisture <= 100",
              "count(*) FILTER (WHERE NOT soil_moisture <= 100)", "unified"),
    ]),
    "dq_all_checks": _union([*NOT_NULL_CHECKS, *UNIQUE_CHECKS, *ACCEPTED_CHECKS, TRAINING_RELATION]),
    "distinct_counts": """
        SELECT count(*) AS row_count, count(DISTINCT area) AS n_area, count(DISTINCT crop_type) AS n_crop_type,
               count(DISTINCT era) AS n_era FROM training""",
    "distinct_values": "SELECT DISTINCT crop_type FROM training",
    "describe_numeric": _union(describe(c) for c in NUMERIC),
    "null_profile": _union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) > count({c}) AS has_nulls FROM summary"
        for c in SUMMARY_COLUMNS
    ),
    "correlation_matrix": _union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM training"
        for a in CORRELATED for b in CORRELATED
    ),
    "sample_rows": """
        SELECT l_orderkey, l_linenumber, crop_type, actual FROM predictions
        ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, 42)), crop_type, actual LIMIT 5""",
    "histogram_yield": histogram("target_yield", "training", 30),
    "latest_n": "SELECT * FROM stg_weather ORDER BY timestamp DESC, id DESC LIMIT 10",
    "latest_soil": "SELECT * FROM stg_soil ORDER BY timestamp DESC, id DESC LIMIT 10",
    "latest_100_readings": """
        SELECT * FROM unified
        ORDER BY reading_timestamp DESC, latitude DESC, longitude DESC, pressure DESC, air_temp DESC LIMIT 100""",
    "prediction_output": f"SELECT {PREDICTION_COLUMNS}, {AS_OF} AS prediction_date FROM predictions",
    "scenario_summary": f"""
        SELECT scenario, round_even({avg('predicted_yield_kg_ha')}, 0) AS mean_kg_ha,
               round_even(min(predicted_yield_kg_ha), 0) AS min_kg_ha,
               round_even(max(predicted_yield_kg_ha), 0) AS max_kg_ha
        FROM predictions GROUP BY scenario""",
    "prediction_summary": f"""
        SELECT {avg('predicted')} AS avg_prediction, min(predicted) AS min_prediction,
               max(predicted) AS max_prediction, count(*) AS n_predictions FROM predictions""",
    "top_predictions": EXTREME.format("DESC"),
    "bottom_predictions": EXTREME.format("ASC"),
    "predictions_by_crop": f"""
        SELECT crop_type, {avg('predicted_yield_kg_ha')} AS avg_yield_kg_ha, count(*) AS n_predictions
        FROM predictions GROUP BY crop_type""",
    "forecast_kpis": f"""
        SELECT {avg("CASE WHEN scenario = 'baseline' THEN predicted_yield_kg_ha END")} AS baseline_avg_kg_ha,
               max(predicted_yield_kg_ha) AS max_kg_ha,
               strftime(max(prediction_date), '%Y-%m-%d') AS prediction_date
        FROM predictions WHERE prediction_date = (SELECT max(prediction_date) FROM predictions)""",
    "yield_by_crop_scenario": "SELECT crop_type, {} FROM predictions GROUP BY crop_type".format(", ".join(
        f"sum(predicted_yield_kg_ha) FILTER (WHERE scenario = '{s}') AS {s}"
        for s in ("baseline", "optimistic", "pessimistic", "conservative")
    )),
    "latest_predictions": """
        SELECT * FROM predictions WHERE prediction_date = (SELECT max(prediction_date) FROM predictions)""",
    "prediction_errors": """
        SELECT l_orderkey, l_linenumber, crop_type, area, year, actual, predicted, error, absolute_error, percentage_error
        FROM errors""",
    "errors_by_crop": f"""
        SELECT crop_type, {avg('percentage_error')} AS mean_ape, {pct('percentage_error', 0.5)} AS median_ape,
               count(percentage_error) AS n, {avg('absolute_error')} AS mean_ae,
               {pct('absolute_error', 0.5)} AS median_ae
        FROM errors GROUP BY crop_type""",
    "errors_by_year": f"""
        SELECT year, {avg('percentage_error')} AS mean_ape, count(percentage_error) AS n
        FROM errors GROUP BY year""",
    "error_distribution": f"""
        SELECT count(*) AS n, {avg('absolute_error')} AS mean_ae, {pct('absolute_error', 0.5)} AS median_ae,
               round(stddev_samp(absolute_error), 4) AS std_ae, {avg('percentage_error')} AS mean_ape,
               {pct('percentage_error', 0.5)} AS median_ape, {pct('percentage_error', 0.75)} AS p75_ape,
               {pct('percentage_error', 0.95)} AS p95_ape
        FROM errors""",
    "error_thresholds": _union(
        f"""SELECT CAST({t} AS INTEGER) AS threshold_pct,
                   count(*) FILTER (WHERE round(percentage_error, 6) <= {t}) AS n_within,
                   count(*) FILTER (WHERE round(percentage_error, 6) <= {t}) * 100e0 / count(*) AS share_pct FROM errors"""
        for t in (5, 10, 20)
    ),
    "histogram_errors": histogram("error", "(SELECT round(error, 4) AS error FROM errors)", 50),
    "worst_errors": """
        SELECT l_orderkey, l_linenumber, actual, predicted, error, crop_type, area
        FROM errors ORDER BY absolute_error DESC, l_orderkey, l_linenumber LIMIT 5""",
    "regression_metrics": f"""
        SELECT split, n, round(rmse, 4) AS rmse, mae, round(r2, 8) AS r2,
               mean_ape, round(median_ape, 6) AS median_ape
        FROM ({metrics('split', 'split')})""",
    "model_comparison": """
        SELECT m.model, round(m.r2, 8) AS r2, round(m.rmse, 4) AS rmse, m.mae AS mae,
               m.mean_ape AS mean_ape, round(m.median_ape, 6) AS median_ape,
               round((m.r2 - b.r2) / b.r2 * 100, 4) AS r2_change_pct,
               round((m.rmse - b.rmse) * -1 / b.rmse * 100, 4) AS rmse_change_pct,
               round((m.mae - b.mae) * -1 / b.mae * 100, 4) AS mae_change_pct
        FROM ({0}) m, (SELECT * FROM ({0}) WHERE model = 'discounted') b""".format(metrics("model", """(
            SELECT 'discounted' AS model, actual, predicted AS value FROM predictions
            UNION ALL SELECT 'taxed', actual, predicted * (tax + 1) FROM predictions
            UNION ALL SELECT 'middle', actual, (predicted + predicted * (tax + 1)) / 2 FROM predictions)""", "value")),
    "label_codes": _union(f"SELECT * FROM ({label(c)})" for c in ("area", "crop_type", "era")),
    "encode_labels": """
        SELECT l_orderkey, l_linenumber, area, crop_type,
               CAST(dense_rank() OVER (ORDER BY area) - 1 AS BIGINT) AS area_code,
               CAST(dense_rank() OVER (ORDER BY crop_type) - 1 AS BIGINT) AS crop_type_code
        FROM predictions""",
    "decode_labels": """
        SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY crop_type) - 1 AS BIGINT) AS crop_type_code,
               crop_type AS crop_name
        FROM predictions""",
    "train_test_split": "SELECT l_orderkey, l_linenumber, crop_type, actual, split FROM split",
    "split_counts": "SELECT split, count(*) AS n FROM split GROUP BY split",
    "standardize": """
        SELECT l_orderkey, l_linenumber, actual, predicted, split,
               round((actual - ma) / sa, 6) AS actual_scaled, round((predicted - mp) / sp, 6) AS predicted_scaled
        FROM split, (SELECT avg(actual) AS ma, stddev_pop(actual) AS sa, avg(predicted) AS mp, stddev_pop(predicted) AS sp
                     FROM split WHERE split = 'train')""",
}

# Streaming queries give the rows of their batch forms.
BODIES |= {
    "stream_ingest": BODIES["stg_weather"],
    "stream_dedupe": "SELECT DISTINCT latitude, longitude, timestamp FROM hourly",
    "stream_alerts": "SELECT * FROM flagged",
    "stream_unified": BODIES["sensor_unified"],
    "stream_daily_conditions": BODIES["daily_conditions"],
    "stream_irrigation": f"""
        SELECT *, CASE WHEN current_moisture < 30 AND current_temp > 25 THEN 'IRRIGATE_NOW'
                       WHEN current_moisture < 40 AND current_temp > 20 THEN 'IRRIGATE_SOON'
                       WHEN current_moisture > 70 THEN 'SKIP_IRRIGATION' ELSE 'MONITOR' END AS recommendation,
               CASE WHEN current_moisture < 30 THEN (40 - current_moisture) * 10 ELSE 0e0 END AS estimated_water_mm
        FROM (SELECT window_start, {avg('soil_moisture')} AS current_moisture, {avg('air_temp')} AS current_temp
              FROM (SELECT *, reading_timestamp AS window_start FROM unified
                    UNION ALL SELECT *, reading_timestamp - INTERVAL 1 HOUR FROM unified)
              GROUP BY window_start)""",
}


def oracle_sql() -> dict[str, str]:
    found = {name: sql(body) for name, body in BODIES.items()}
    for name, columns in SINGLE_PRECISION.items():
        casts = ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in columns)
        found[name] = f"SELECT * REPLACE ({casts}) FROM ({found[name]})"
    return found
