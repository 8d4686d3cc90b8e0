"""SQL counterparts of the registered queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

_TRIPS = """
trips AS (
  SELECT event_type,
         CASE WHEN event_type = 'signup' THEN NULL ELSE event_id END AS vendor_id,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS pickup_ts,
         CAST(value - 2.0 AS DECIMAL(12,2)) AS trip_distance,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(user_id % 30 AS INTEGER) END AS zone_id
  FROM events)"""

_CLEAN = _TRIPS + """,
clean AS (
  SELECT *, CAST(pickup_ts AS DATE) AS date_str, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
         date_trunc('minute', pickup_ts) AS minute_start
  FROM trips
  WHERE pickup_ts IS NOT NULL AND trip_distance > 0 AND zone_id IS NOT NULL)"""

_DEMAND = _CLEAN + """,
demand AS (
  SELECT date_str, pickup_hour, zone_id AS PULocationID, count(vendor_id) AS trip_count,
         CAST(sum(trip_distance) AS DOUBLE) AS avg_distance
  FROM clean GROUP BY date_str, pickup_hour, zone_id)"""

_LABEL = ("'[' || strftime({0}, '%Y-%m-%d %H:%M:%S') || ', ' || "
          "strftime({0} + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') || ')'")

_MINUTES = f"""
SELECT {_LABEL.format('minute_start')} AS "window", pickup_hour, zone_id AS PULocationID,
       count(vendor_id) AS trip_count, CAST(sum(trip_distance) AS DOUBLE) AS avg_distance
FROM clean"""

_ZONES = """
zones AS (
  SELECT n_nationkey AS location_id,
         CASE WHEN n_nationkey = 7 THEN 'Unknown' ELSE n_name END AS zone_name,
         r_name AS borough,
         CASE WHEN n_nationkey % 5 IN (0, 1) THEN 'Unknown' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_REQUESTS = """
requests AS (
  SELECT event_id AS request_id, CAST(user_id % 30 AS INTEGER) AS zone,
         CAST(CASE WHEN minute(ts) = 59 THEN 24 ELSE hour(ts) END AS INTEGER) AS "hour",
         CASE second(ts) WHEN 0 THEN '2025-02-30' WHEN 1 THEN strftime(ts, '%Y%m%d')
                         WHEN 2 THEN '' WHEN 3 THEN NULL
                         WHEN 4 THEN strftime(ts, '%Y-%m-%d') || chr(10) ELSE strftime(ts, '%Y-%m-%d') END AS "date"
  FROM events),
checked AS (
  SELECT *, CASE WHEN zone < 1 THEN 'bad_zone' WHEN "hour" NOT BETWEEN 0 AND 23 THEN 'bad_hour'
                 WHEN "date" IS NULL OR NOT regexp_matches("date", '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
                      OR TRY_CAST("date" AS DATE) IS NULL THEN 'bad_date' END AS reject_reason
  FROM requests)"""

_CACHE = """
stored AS (
  SELECT CAST(user_id % 30 AS INTEGER) AS zone, CAST(hour(ts) AS INTEGER) AS "hour",
         strftime(ts, '%Y-%m-%d') AS "date", value AS prediction,
         TIMESTAMP '2024-02-01 00:00:00'
           - to_seconds(CASE WHEN minute(ts) % 10 = 0 THEN -60 ELSE 555 + second(ts) END) AS cached_at
  FROM events),
fresh AS (
  SELECT zone, "hour", "date", prediction AS cached FROM (
    SELECT *, row_number() OVER (PARTITION BY zone, "hour", "date" ORDER BY cached_at DESC, prediction DESC) AS nr
    FROM stored WHERE cached_at > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 600 SECOND
      AND cached_at <= TIMESTAMP '2024-02-01 00:00:00')
  WHERE nr = 1)"""

_SCORED = f"""{_REQUESTS},{_CACHE},{_ZONES},
parsed AS (SELECT *, CAST("date" AS DATE) AS d FROM checked WHERE reject_reason IS NULL),
scored AS (
  SELECT p.request_id, p.zone, p."hour", p."date",
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, CAST(month(d) AS INTEGER) AS month,
         isodow(d) >= 6 AS is_weekend, f.cached,
         CAST(20 + 15 * CAST(isodow(d) >= 6 AS INTEGER) + abs(12 - p."hour")
              + isodow(d) - 1 + month(d) AS DOUBLE) + CAST(0.125 AS DOUBLE) * (p.zone % 5) AS prediction
  FROM parsed p LEFT JOIN fresh f ON p.zone = f.zone AND p."hour" = f."hour" AND p."date" = f."date")"""

_RESPONSE = """
       CASE WHEN cached IS NULL THEN 'model_inference' ELSE 'cache_redis' END AS source, zone,
       coalesce(zone_name, 'Unknown') AS zone_name, coalesce(borough, 'Unknown') AS borough,
       coalesce(service_zone, 'Unknown') AS service_zone, "hour", "date", day_of_week, month, is_weekend,
       coalesce(cached, round(prediction, 2)) AS predicted_demand
FROM scored LEFT JOIN zones ON zone = location_id"""

_BATCH_TYPES = "event_type NOT IN ('view', 'error')"
_STREAM_TYPES = "event_type IN ('view', 'error')"

_RAW_STREAM = f"""
raw_stream AS (
  SELECT CAST(pickup_ts AS DATE) AS date_str, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
         zone_id AS PULocationID, count(trip_distance) AS trip_count, sum(trip_distance) AS avg_distance
  FROM trips WHERE {_STREAM_TYPES} AND pickup_ts IS NOT NULL AND zone_id IS NOT NULL GROUP BY 1, 2, 3)"""

_SPLIT = """
split AS (
  SELECT date_str, pickup_hour, PULocationID, trip_count,
         ('0x' || substr(md5('42|' || date_str || '|' || pickup_hour || '|' || PULocationID), 1, 8))::BIGINT
           % 100 < 80 AS is_train
  FROM demand)"""

_CALENDAR = """CAST(isodow(date_str) - 1 AS INTEGER) AS day_of_week, CAST(month(date_str) AS INTEGER) AS month,
       CAST(isodow(date_str) >= 6 AS INTEGER) AS is_weekend"""

_LINE_DEMAND = """
SELECT CAST(l_shipdate AS DATE) AS date_str, CAST(hour(l_shipdate) AS INTEGER) AS pickup_hour,
       l_suppkey AS PULocationID, count(l_linenumber) AS trip_count, sum(l_quantity) AS avg_distance
FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity > 0 AND l_suppkey IS NOT NULL
GROUP BY 1, 2, 3"""

ORACLE: dict[str, str] = {
    "scan_trips": "SELECT l_linenumber, l_shipdate, l_quantity, l_suppkey FROM lineitem",
    "scan_unlike_types": """SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_shipdate, l_quantity, CAST(l_suppkey AS BIGINT) AS l_suppkey
FROM lineitem""",
    "explore_types": """SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT * FROM events)""",
    "explore_rows": "SELECT * FROM events ORDER BY ts, event_id LIMIT 5",
    "preview_head": "SELECT * FROM events ORDER BY ts, event_id LIMIT 5",
    "clean_trips": f"""WITH {_CLEAN}
SELECT vendor_id, pickup_ts, CAST(trip_distance AS DOUBLE) AS trip_distance, zone_id FROM clean""",
    "trip_features": f"""WITH {_CLEAN}
SELECT vendor_id, pickup_ts, CAST(trip_distance AS DOUBLE) AS trip_distance, zone_id,
       pickup_ts AS pickup_datetime, pickup_hour, CAST(dayofweek(pickup_ts) + 1 AS INTEGER) AS pickup_day,
       CAST(month(pickup_ts) AS INTEGER) AS pickup_month, date_str
FROM clean""",
    "quality_report": f"""WITH {_DEMAND}
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE pickup_ts IS NULL) AS missing_time,
       count(*) FILTER (WHERE pickup_ts IS NOT NULL AND NOT trip_distance > 0) AS bad_distance,
       count(*) FILTER (WHERE pickup_ts IS NOT NULL AND trip_distance > 0 AND zone_id IS NULL) AS missing_zone,
       (SELECT count(*) FROM clean) AS clean_rows,
       count(*) - (SELECT count(*) FROM clean) AS removed_rows,
       (SELECT count(*) FROM demand) AS demand_rows
FROM trips""",
    "demand_hourly": f"WITH {_DEMAND} SELECT * FROM demand",
    "demand_lineitem": _LINE_DEMAND,
    "demand_unlike_types": _LINE_DEMAND,
    "demand_etl_periods": _LINE_DEMAND,
    "demand_period_again": f"""WITH {_CLEAN}
SELECT date_str, pickup_hour, zone_id AS PULocationID, count(vendor_id) AS trip_count, CAST(sum(trip_distance) AS DOUBLE) AS avg_distance
FROM clean
WHERE date_str NOT BETWEEN DATE '2024-01-11' AND DATE '2024-01-20' OR event_type NOT IN ('view', 'error')
GROUP BY date_str, pickup_hour, zone_id""",
    "demand_range": f"SELECT * FROM ({_LINE_DEMAND}) WHERE date_str BETWEEN DATE '1996-02-10' AND DATE '1997-02-09'",
    "demand_audited": f"""WITH {_TRIPS},
reasons AS (
  SELECT *, CASE WHEN pickup_ts IS NULL THEN 'missing_time' WHEN NOT trip_distance > 0 THEN 'bad_distance'
                 WHEN zone_id IS NULL THEN 'missing_zone' END AS reject_reason FROM trips)
SELECT reject_reason,
       CASE WHEN reject_reason IS NULL THEN CAST(pickup_ts AS DATE) END AS date_str,
       CASE WHEN reject_reason IS NULL THEN CAST(hour(pickup_ts) AS INTEGER) END AS pickup_hour,
       CASE WHEN reject_reason IS NULL THEN zone_id END AS PULocationID,
       count(vendor_id) AS trip_count, CAST(sum(trip_distance) AS DOUBLE) AS avg_distance, count(*) AS input_rows
FROM reasons GROUP BY 1, 2, 3, 4""",
    "demand_1min": f"WITH {_CLEAN} {_MINUTES} GROUP BY minute_start, pickup_hour, zone_id",
    "demand_roundtrip": f"WITH {_DEMAND} SELECT * FROM demand",
    "demand_etl": _LINE_DEMAND,
    "demand_one_file": f"WITH {_DEMAND} SELECT * FROM demand",
    "explore_schema": """SELECT * FROM (
SELECT 'event_id' AS column_name, count(event_id) AS filled FROM events
UNION ALL SELECT 'ts', count(ts) FROM events UNION ALL SELECT 'user_id', count(user_id) FROM events
UNION ALL SELECT 'event_type', count(event_type) FROM events UNION ALL SELECT 'value', count("value") FROM events
UNION ALL SELECT 'props', count(props) FROM events)""",
    "required_columns": f"""WITH {_DEMAND}
SELECT *, 'date_str,pickup_hour,PULocationID,trip_count,avg_distance' AS lacking FROM demand""",
    "demand_stream": f"""WITH {_CLEAN} {_MINUTES}
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max(pickup_ts) FROM clean) - INTERVAL 10 MINUTE
GROUP BY minute_start, pickup_hour, zone_id""",
    "demand_stream_late": f"""WITH {_CLEAN} {_MINUTES}
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max(pickup_ts) FROM clean) - INTERVAL 10 MINUTE
GROUP BY minute_start, pickup_hour, zone_id""",
    "demand_stream_repeats": f"""WITH {_CLEAN} {_MINUTES}
WHERE minute_start + INTERVAL 1 MINUTE <= (SELECT max(pickup_ts) FROM clean) - INTERVAL 10 MINUTE
GROUP BY minute_start, pickup_hour, zone_id""",
    "window_label_date": f"""WITH {_CLEAN}
SELECT DISTINCT {_LABEL.format('minute_start')} AS "window", pickup_hour, zone_id AS PULocationID,
       date_str AS date_from_struct, date_str AS date_from_text
FROM clean""",
    "stream_raw_demand": f"""WITH {_TRIPS},{_RAW_STREAM.replace(_STREAM_TYPES + " AND ", "")}
SELECT date_str, pickup_hour, PULocationID, trip_count,
       CAST(coalesce(avg_distance, 0) AS DOUBLE) AS avg_distance FROM raw_stream""",
    "stream_window_rollup": f"WITH {_DEMAND} SELECT * FROM demand",
    "demand_merge_increment": f"WITH {_DEMAND} SELECT * FROM demand",
    "demand_merge": f"WITH {_DEMAND} SELECT * FROM demand",
    "demand_merge_raw": f"""WITH {_CLEAN},{_RAW_STREAM},
both_sources AS (
  SELECT date_str, pickup_hour, zone_id AS PULocationID, count(vendor_id) AS trip_count,
         sum(trip_distance) AS avg_distance
  FROM clean WHERE {_BATCH_TYPES} GROUP BY 1, 2, 3
  UNION ALL SELECT * FROM raw_stream)
SELECT date_str, pickup_hour, PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count,
       CAST(coalesce(sum(avg_distance), 0) AS DOUBLE) AS avg_distance
FROM both_sources GROUP BY 1, 2, 3""",
    "demand_merge_files": f"""WITH {_DEMAND}
SELECT *, 'both' AS origin FROM demand
UNION ALL
SELECT date_str, pickup_hour, zone_id AS PULocationID, count(vendor_id) AS trip_count,
       CAST(sum(trip_distance) AS DOUBLE) AS avg_distance, 'batch' AS origin
FROM clean WHERE {_BATCH_TYPES} GROUP BY date_str, pickup_hour, zone_id""",
    "zone_dim": f"WITH {_ZONES} SELECT * FROM zones",
    "zone_file": f"""WITH {_ZONES}
SELECT location_id, CASE WHEN location_id % 3 = 0 THEN zone_name || ' "A", ' || chr(10) || 'north'
                         ELSE zone_name END AS zone_name, borough, service_zone FROM zones""",
    "zones_by_borough": f"WITH {_ZONES} SELECT * FROM zones WHERE lower(borough) = 'asia' ORDER BY location_id",
    "zones_search": f"""WITH {_ZONES}
SELECT * FROM zones WHERE contains(lower(zone_name), 'nation_1') ORDER BY location_id""",
    "zones_borough_and_search": f"""WITH {_ZONES}
SELECT * FROM zones WHERE lower(borough) = 'asia' AND contains(lower(zone_name), 'nation_1') ORDER BY location_id""",
    "zone_counts": f"""WITH {_ZONES}
SELECT count(*) FILTER (WHERE contains(lower(zone_name), 'nation_1')) AS total, count(*) AS total_zones,
       count(*) > 0 AS zones_loaded FROM zones""",
    "zone_lookup_ids": f"""WITH {_TRIPS},{_ZONES}
SELECT z.* FROM trips JOIN zones z ON zone_id = location_id WHERE zone_name <> 'Unknown'""",
    "zone_enrich": f"""WITH {_DEMAND},{_ZONES}
SELECT d.*, coalesce(zone_name, 'Unknown') AS zone_name, coalesce(borough, 'Unknown') AS borough,
       coalesce(service_zone, 'Unknown') AS service_zone
FROM demand d LEFT JOIN zones ON PULocationID = location_id""",
    "date_features": f"WITH {_DEMAND} SELECT *, {_CALENDAR} FROM demand",
    "feature_matrix": f"WITH {_DEMAND} SELECT {_CALENDAR}, pickup_hour, PULocationID, trip_count FROM demand",
    "holdout_split": f"""WITH {_DEMAND},{_SPLIT}
SELECT * REPLACE (CAST(is_train AS INTEGER) AS is_train) FROM split""",
    "holdout_exact": f"""WITH {_DEMAND}
SELECT date_str, pickup_hour, PULocationID, trip_count, CAST(row_number() OVER (
  ORDER BY ('0x' || substr(md5('42|' || date_str || '|' || pickup_hour || '|' || PULocationID), 1, 15))::BIGINT DESC
) > ceil(count(*) OVER () / 5.0) AS INTEGER) AS is_train FROM demand""",
    "target_stats": f"""WITH {_DEMAND}
SELECT count(*) AS samples, min(trip_count) AS min_target, max(trip_count) AS max_target,
       avg(trip_count) AS mean_target FROM demand""",
    "regression_metrics": f"""WITH {_DEMAND},{_SPLIT},
means AS (
  SELECT pickup_hour, PULocationID, avg(trip_count) AS prediction FROM split WHERE is_train GROUP BY 1, 2)
SELECT round(sqrt(avg(pow(trip_count - prediction, 2))), 6) AS rmse,
       round(avg(abs(trip_count - prediction)), 6) AS mae
FROM split JOIN means USING (pickup_hour, PULocationID) WHERE NOT is_train""",
    "score_validate": f"WITH {_REQUESTS} SELECT * FROM checked",
    "cache_lookup": f"""WITH {_REQUESTS},{_CACHE}
SELECT request_id, r.zone, r."hour", r."date", cached,
       CASE WHEN cached IS NULL THEN 'model_inference' ELSE 'cache_redis' END AS source,
       concat_ws(':', 'demand', r.zone, r."hour", r."date") AS key
FROM requests r LEFT JOIN fresh f ON r.zone = f.zone AND r."hour" = f."hour" AND r."date" = f."date\"""",
    "score_requests": f"WITH {_SCORED} SELECT request_id, {_RESPONSE}",
    "score_job": f"WITH {_SCORED} SELECT {_RESPONSE}",
    "cache_after_scoring": f"""WITH {_SCORED}
SELECT zone, "hour", "date", prediction FROM stored
UNION ALL
SELECT zone, "hour", "date", max(prediction) AS prediction FROM scored WHERE cached IS NULL
GROUP BY zone, "hour", "date\"""",
    "cache_new_entries": f"""WITH {_SCORED}
SELECT zone, "hour", "date", max(prediction) AS prediction FROM scored WHERE cached IS NULL
GROUP BY zone, "hour", "date\"""",
}

_FIVE = "[dow, mon, wend, pickup_hour, PULocationID]"


def _boosted(rounds: int, depth: int, rate: float) -> str:
    """Boosted trees of squared error fitted in SQL: ``preds`` has a prediction ``p`` per combination of the five features.

    Each level takes, per node, the cut with the greatest fall of the variance; cuts lie halfway between neighbouring values
    of the training part. The first tree has weight 1; later ones fit twice the error and have weight ``rate``.
    """
    parts = [f"""WITH {_DEMAND},{_SPLIT},
featured AS (
  SELECT *, CAST(isodow(date_str) - 1 AS INTEGER) AS dow, CAST(month(date_str) AS INTEGER) AS mon,
         CASE WHEN isodow(date_str) > 5 THEN 1 ELSE 0 END AS wend FROM split),
combos AS MATERIALIZED (
  SELECT dow, mon, wend, pickup_hour, PULocationID, CAST(count(*) FILTER (is_train) AS DOUBLE) AS w,
         avg(trip_count) FILTER (is_train) AS y FROM featured GROUP BY ALL),
cuts AS MATERIALIZED (
  SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2.0 AS cut
  FROM (SELECT DISTINCT unnest([0, 1, 2, 3, 4]) AS f, unnest({_FIVE}) AS v FROM combos WHERE w > 0)),
r0_0 AS MATERIALIZED (SELECT *, y AS r, 0.0::DOUBLE AS p, 1 AS node FROM combos)"""]
    for k in range(rounds):
        for level in range(depth):
            parts.append(f"""best{k}_{level} AS MATERIALIZED (
  SELECT node, f, cut FROM (
    SELECT node, f, cut, row_number() OVER (PARTITION BY node ORDER BY round(gain, 10) DESC, f, v) AS place FROM (
      SELECT node, f, v, cut, (tq - ts * ts / tw) / tw - (lq - ls * ls / lw) / tw - ((tq - lq) - (ts - ls) * (ts - ls) / (tw - lw)) / tw AS gain
      FROM (
        SELECT node, f, v, sum(w) OVER upto AS lw, sum(s) OVER upto AS ls, sum(q) OVER upto AS lq,
               sum(w) OVER whole AS tw, sum(s) OVER whole AS ts, sum(q) OVER whole AS tq
        FROM (SELECT node, f, v, sum(w) AS w, sum(w * r) AS s, sum(w * r * r) AS q
              FROM (SELECT node, w, r, unnest([0, 1, 2, 3, 4]) AS f, unnest({_FIVE}) AS v FROM r{k}_{level} WHERE w > 0) GROUP BY node, f, v)
        WINDOW upto AS (PARTITION BY node, f ORDER BY v), whole AS (PARTITION BY node, f))
      JOIN cuts USING (f, v) WHERE lw < tw) WHERE gain > 0) WHERE place = 1),
r{k}_{level + 1} AS MATERIALIZED (
  SELECT a.* REPLACE (CASE WHEN b.f IS NULL THEN a.node ELSE a.node * 2 + CASE WHEN {_FIVE}[b.f + 1] > b.cut THEN 1 ELSE 0 END END AS node)
  FROM r{k}_{level} a LEFT JOIN best{k}_{level} b USING (node))""")
        weight = 1.0 if k == 0 else rate
        parts.append(f"""leaf{k} AS MATERIALIZED (SELECT node, sum(w * r) / sum(w) AS value FROM r{k}_{depth} WHERE w > 0 GROUP BY node),
r{k + 1}_0 AS MATERIALIZED (
  SELECT a.* REPLACE (2 * (y - (p + {weight} * value)) AS r, p + {weight} * value AS p, 1 AS node) FROM r{k}_{depth} a JOIN leaf{k} USING (node))""")
    return ",\n".join(parts) + f",\npreds AS (SELECT * FROM r{rounds}_0)"


_WEEKDAY = f"""WITH {_DEMAND},{_SPLIT},
means AS (SELECT isodow(date_str) AS d, avg(trip_count) AS mean FROM split WHERE is_train GROUP BY 1)"""

ORACLE |= {
    "zone_lookup_large": ORACLE["zone_lookup_ids"],
    "zone_enrich_large": ORACLE["zone_enrich"],
    "cache_lookup_large": ORACLE["cache_lookup"],
    "cache_expired": f"""WITH {_CACHE}
SELECT zone, "hour", "date", prediction FROM stored
WHERE cached_at > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 600 SECOND""",
    "demand_model_features": f"""{_boosted(3, 3, 0.3)}
SELECT date_str, pickup_hour, PULocationID, trip_count, round(p, 6) AS prediction
FROM featured JOIN preds USING (dow, mon, wend, pickup_hour, PULocationID) WHERE NOT is_train""",
    "demand_model_nodes": f"""WITH {_DEMAND},{_SPLIT}
SELECT date_str, pickup_hour, PULocationID, trip_count, true AS same FROM split WHERE NOT is_train""",
    "cache_batches": f"""WITH {_CACHE}
SELECT zone, "hour", "date", prediction FROM stored
WHERE cached_at > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 600 SECOND""",
    "model_published": f"""{_WEEKDAY}
SELECT date_str, pickup_hour, PULocationID, trip_count, round(mean, 6) AS prediction, 2 AS version,
       (SELECT max(date_str) FROM demand) AS last_date, (SELECT count(*) FROM demand) AS samples
FROM split JOIN means ON d = isodow(date_str) WHERE NOT is_train""",
    "demand_model_weekday": f"""{_WEEKDAY}
SELECT date_str, pickup_hour, PULocationID, trip_count, round(mean, 6) AS prediction
FROM split JOIN means ON d = isodow(date_str) WHERE NOT is_train""",
    "demand_model_error": f"""{_WEEKDAY}
SELECT (SELECT count(*) FROM demand) AS samples, (SELECT min(trip_count) FROM demand) AS min_target,
       (SELECT max(trip_count) FROM demand) AS max_target,
       (SELECT round(avg(trip_count), 6) FROM demand) AS mean_target,
       round(sqrt(avg(pow(trip_count - mean, 2))), 6) AS rmse, round(avg(abs(trip_count - mean)), 6) AS mae
FROM split JOIN means ON d = isodow(date_str) WHERE NOT is_train""",
    "demand_model_hour_zone": f"""WITH {_DEMAND},{_SPLIT}
SELECT date_str, pickup_hour, PULocationID, CAST(20 + abs(12 - pickup_hour) AS INTEGER) AS level,
       CAST(20 + abs(12 - pickup_hour) AS DOUBLE) AS prediction
FROM split WHERE NOT is_train""",
    "model_roundtrip": f"WITH {_DEMAND} SELECT date_str, pickup_hour, PULocationID, trip_count, true AS same FROM demand",
    "score_requests_trees": f"""{_WEEKDAY}, {_SCORED.replace("scored AS (", "formula AS (")},
scored AS (SELECT f.* REPLACE (mean AS prediction) FROM formula f JOIN means ON d = day_of_week + 1)
SELECT request_id, {_RESPONSE}""",
}
