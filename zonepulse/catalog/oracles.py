"""Plain SQL that states what each catalogued query must return."""

import re


def _filled(columns: str, direction: str, partition: str = "") -> str:
    """Whole-frame fill, stated as one window over all cells in (zone, hour) order."""
    sort = "zone_id, hour_bucket" if direction == "forward" else "zone_id DESC, hour_bucket DESC"
    return ", ".join(
        f"round(coalesce(last_value({c} IGNORE NULLS) OVER ({partition} ORDER BY {sort} "
        f"ROWS UNBOUNDED PRECEDING), 0), 6) {c}" for c in columns.split())


# Named steps, each building on earlier ones; ``_sql`` prepends the chain a query needs.
STEPS = {
    "e": """SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS INT) k FROM events""",
    "trips": """SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END tpep_pickup_datetime,
       ts + to_seconds(k * 45) tpep_dropoff_datetime,
       CAST(CASE WHEN user_id = 149 THEN 264 ELSE user_id % 6 + 1 END AS BIGINT) PULocationID,
       CAST((k * 3) % 266 AS BIGINT) DOLocationID,
       value / 5.0 trip_distance, 2.0 + value fare_amount, event_id % 8 passenger_count
FROM e, LATERAL (SELECT unnest(range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)))""",
    "timed": """SELECT *, (epoch(date_trunc('second', tpep_dropoff_datetime))
       - epoch(date_trunc('second', tpep_pickup_datetime))) / 60.0 trip_duration_min FROM trips""",
    "speedy": """SELECT *, CASE WHEN trip_duration_min <> 0
       THEN trip_distance / (trip_duration_min / 60.0) END avg_speed_mph FROM timed""",
    "valid": """SELECT * FROM speedy
WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
  AND PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263
  AND trip_distance > 0.1 AND trip_distance < 100 AND fare_amount > 2.5 AND fare_amount < 500
  AND passenger_count BETWEEN 1 AND 6 AND trip_duration_min BETWEEN 1 AND 180
  AND avg_speed_mph < 80""",
    "clean": """SELECT *, hour(tpep_pickup_datetime) hour_of_day,
       dayofweek(tpep_pickup_datetime) + 1 day_of_week, month(tpep_pickup_datetime) AS month,
       dayofweek(tpep_pickup_datetime) IN (0, 6) is_weekend
FROM (SELECT * FROM valid QUALIFY row_number() OVER (
        PARTITION BY tpep_pickup_datetime, PULocationID, trip_distance
        ORDER BY tpep_dropoff_datetime, DOLocationID, fare_amount, passenger_count) = 1)""",
    "cells": """SELECT PULocationID zone_id, date_trunc('hour', tpep_pickup_datetime) hour_bucket,
       count(*) trip_count, avg(avg_speed_mph) avg_speed, stddev_samp(avg_speed_mph) speed_stddev,
       avg(trip_distance) avg_distance, avg(trip_duration_min) avg_duration,
       avg(fare_amount) avg_fare, CAST(sum(passenger_count) AS BIGINT) total_passengers,
       any_value(hour_of_day) hour_of_day, any_value(day_of_week) day_of_week,
       any_value(is_weekend) is_weekend
FROM clean GROUP BY 1, 2""",
    "labelled": """SELECT *, CASE WHEN avg_speed >= 25 THEN 0 WHEN avg_speed >= 15 THEN 1
       WHEN avg_speed >= 8 THEN 2 ELSE 3 END congestion_level FROM cells""",
    "grid": """SELECT *, hour_bucket AS "timestamp", avg_speed - prev_hour_speed speed_delta
FROM (SELECT *, lag(avg_speed) OVER w prev_hour_speed, lag(trip_count) OVER w prev_hour_trips
      FROM labelled WINDOW w AS (PARTITION BY zone_id ORDER BY hour_bucket))""",
    "features": """SELECT *,
       CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 17 AND 19 THEN 1::BIGINT ELSE 0 END is_rush_hour,
       CASE WHEN hour_of_day < 6 OR hour_of_day >= 22 THEN 1::BIGINT ELSE 0 END is_overnight,
       sin(2 * pi() * hour_of_day / 24) hour_sin, cos(2 * pi() * hour_of_day / 24) hour_cos,
       sin(2 * pi() * day_of_week / 7) dow_sin, cos(2 * pi() * day_of_week / 7) dow_cos,
       avg_speed / (avg(avg_speed) OVER (PARTITION BY zone_id) + 1e-6) speed_to_zone_avg,
       lag(avg_speed, 1) OVER w lag1_speed, lag(avg_speed, 2) OVER w lag2_speed,
       CAST(lag(trip_count, 1) OVER w AS DOUBLE) lag1_trips,
       avg(avg_speed) OVER (PARTITION BY zone_id ORDER BY hour_bucket ROWS 2 PRECEDING) rolling_avg_speed_3h,
       trip_count / 60.0 trips_per_minute, trip_count / (avg_speed + 1e-6) congestion_ratio,
       greatest(0.0, avg_duration - avg_distance / 30.0 * 60) delay_minutes
FROM grid WINDOW w AS (PARTITION BY zone_id ORDER BY hour_bucket)""",
    "placed": """SELECT zone_id, hour_bucket, congestion_level, delay_minutes,
       row_number() OVER (ORDER BY digest) pos, count(*) OVER () n,
       row_number() OVER (PARTITION BY congestion_level ORDER BY digest) class_pos,
       count(*) OVER (PARTITION BY congestion_level) class_n
FROM (SELECT *, md5(zone_id || '|' || strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') || '|42') digest FROM features)""",
    "mean_split": """SELECT delay_minutes y, pos > (n * 20 + 99) // 100 is_train,
       avg(delay_minutes) FILTER (pos > (n * 20 + 99) // 100) OVER () p FROM placed""",
    "trend": """SELECT congestion_level lab, CASE WHEN rolling_avg_speed_3h >= 25 THEN 0
       WHEN rolling_avg_speed_3h >= 15 THEN 1 WHEN rolling_avg_speed_3h >= 8 THEN 2 ELSE 3 END pred
FROM features""",
    "per_class": """SELECT c AS class, count(*) FILTER (lab = c AND pred = c) hit,
       count(*) FILTER (lab = c) support, count(*) FILTER (pred = c) predicted,
       coalesce(hit / nullif(predicted, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) recall,
       coalesce(2 * hit / nullif(support + predicted, 0), 0) f1
FROM trend, (SELECT unnest(range(4)) c) GROUP BY c HAVING support + predicted > 0""",
    "spikes": """SELECT zone_id, quantile_disc(trip_count, 0.95) spike_trips FROM grid GROUP BY 1""",
    "flagged": """SELECT f.*, s.spike_trips,
       trip_count >= spike_trips AND coalesce(speed_delta < 0, false) is_hotspot
FROM features f JOIN spikes s USING (zone_id)""",
    "metrics": """SELECT zone_id, "timestamp", avg_speed, trip_count, congestion_level,
       delay_minutes predicted_delay_minutes, is_hotspot, hour_of_day, day_of_week FROM flagged""",
    "recent": """SELECT * FROM metrics
WHERE "timestamp" >= (SELECT max("timestamp") FROM metrics) - INTERVAL 2 HOURS""",
    "listed": """SELECT * FROM recent ORDER BY "timestamp" DESC, zone_id LIMIT 5000""",
    "alerting": """SELECT * FROM metrics, (SELECT max("timestamp") newest FROM metrics WHERE is_hotspot)
WHERE "timestamp" BETWEEN newest - INTERVAL 2 HOURS AND newest""",
    "messages": """SELECT 'T' || event_id trip_id, user_id pickup_zone, (k * 3) % 266 dropoff_zone,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') pickup_datetime, event_id % 8 passenger_count,
       value / 5.0 trip_distance, 2.0 + value fare_amount, ts kafka_timestamp, ts event_time
FROM e WHERE event_type IN ('view', 'click', 'purchase')""",
    "panes": """SELECT user_id zone_id, event_id, ts, value, event_type, k,
       time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(i) window_start
FROM e, LATERAL (SELECT unnest(range(5)) i)""",
    "waves": """SELECT *, least(third + CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END, 2) wave
FROM (SELECT *, least((day(ts) - 1) // 10, 2) third FROM panes)""",
    "wave_ends": """SELECT wave, max(max(ts)) OVER (ORDER BY wave) - INTERVAL 2 MINUTE AS mark
FROM waves GROUP BY wave""",
}

# Which steps each step reads, in order.
CHAINS = {
    "e": [], "trips": ["e"], "timed": ["trips"], "speedy": ["timed"], "valid": ["speedy"],
    "clean": ["valid"], "cells": ["clean"], "labelled": ["cells"], "grid": ["labelled"],
    "features": ["grid"], "placed": ["features"],
    "mean_split": ["placed"], "trend": ["features"], "per_class": ["trend"], "spikes": ["grid"], "flagged": ["features", "spikes"],
    "metrics": ["flagged"], "recent": ["metrics"], "listed": ["recent"], "alerting": ["metrics"], "messages": ["e"], "panes": ["e"],
    "waves": ["panes"], "wave_ends": ["waves"],
}


def _needs(step: str, seen: list[str]) -> list[str]:
    for earlier in CHAINS[step]:
        _needs(earlier, seen)
    if step not in seen:
        seen.append(step)
    return seen


def _sql(body: str, *steps: str) -> str:
    order: list[str] = []
    for step in steps:
        _needs(step, order)
    # Materialized, so that a chain is computed once however often it is named.
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in order)
    return f"WITH {ctes}\n{body}"


def _rounded(columns: str) -> str:
    return ", ".join(f"round({c}, 6) {c}" for c in columns.split())


RAW = ("tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, "
       + _rounded("trip_distance fare_amount") + ", passenger_count")
CLOCK = ("CAST(hour_of_day AS BIGINT) hour_of_day, CAST(day_of_week AS BIGINT) day_of_week")
CELL = ("zone_id, hour_bucket, trip_count, "
        + _rounded("avg_speed speed_stddev avg_distance avg_duration avg_fare")
        + f", total_passengers, {CLOCK}, is_weekend")
LEVEL = "CAST(congestion_level AS BIGINT) congestion_level"
RECENT = ('zone_id, "timestamp", ' + _rounded("avg_speed") + f", trip_count, {LEVEL}, "
          + _rounded("predicted_delay_minutes") + f", is_hotspot, {CLOCK}")


ORACLES = {
    "clean_nulls": _sql(f"""SELECT {RAW} FROM trips WHERE tpep_pickup_datetime IS NOT NULL
AND tpep_dropoff_datetime IS NOT NULL AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
AND trip_distance IS NOT NULL""", "trips"),
    "clean_zone_bounds": _sql(f"""SELECT {RAW} FROM trips
WHERE PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263""", "trips"),
    "clean_range_filters": _sql(f"""SELECT {RAW} FROM trips
WHERE trip_distance > 0.1 AND trip_distance < 100 AND fare_amount > 2.5 AND fare_amount < 500
AND passenger_count BETWEEN 1 AND 6""", "trips"),
    "trip_duration": _sql(f"""SELECT {RAW}, {_rounded("trip_duration_min")} FROM timed
WHERE trip_duration_min BETWEEN 1 AND 180""", "timed"),
    "trip_speed": _sql(f"""SELECT {RAW}, {_rounded("trip_duration_min avg_speed_mph")} FROM speedy
WHERE avg_speed_mph < 80""", "speedy"),
    "time_features": _sql(f"""SELECT {RAW}, hour(tpep_pickup_datetime) hour_of_day,
dayofweek(tpep_pickup_datetime) + 1 day_of_week, month(tpep_pickup_datetime) AS month,
dayofweek(tpep_pickup_datetime) IN (0, 6) is_weekend FROM trips""", "trips"),
    "trip_dedup": _sql(f"""SELECT {RAW} FROM trips WHERE tpep_pickup_datetime IS NOT NULL QUALIFY row_number() OVER (
PARTITION BY tpep_pickup_datetime, PULocationID, trip_distance
ORDER BY tpep_dropoff_datetime, DOLocationID, fare_amount, passenger_count) = 1""", "trips"),
    "clean_trips": _sql(f"""SELECT {RAW}, {_rounded("trip_duration_min avg_speed_mph")}, {CLOCK},
CAST(month AS BIGINT) AS month, is_weekend FROM clean""", "clean"),
    "retention_report": _sql("""SELECT raw_count, clean_count,
round(clean_count * 100.0 / raw_count, 6) retention_pct
FROM (SELECT (SELECT count(*) FROM trips) raw_count, (SELECT count(*) FROM clean) clean_count)""",
                             "trips", "clean"),
    "zone_hour_agg": _sql(f"SELECT {CELL} FROM cells", "cells"),
    "zone_hour_congestion": _sql(f"SELECT {CELL}, {LEVEL} FROM labelled", "labelled"),
    "zone_hour_lags": _sql(f"""SELECT zone_id, hour_bucket, trip_count, prev_hour_trips,
{_rounded("avg_speed prev_hour_speed speed_delta")} FROM grid""", "grid"),
    "zone_metrics_projection": _sql(f"""SELECT zone_id, "timestamp", {_rounded("avg_speed")},
trip_count, {LEVEL}, CAST(NULL AS DOUBLE) predicted_delay_minutes, false is_hotspot,
CAST(NULL AS VARCHAR) weather_condition, CAST(NULL AS DOUBLE) temperature, {CLOCK} FROM grid""", "grid"),
    "pruned_month": _sql("""SELECT CAST(month AS BIGINT) AS month, PULocationID, count(*) trips,
round(sum(trip_distance), 6) miles FROM clean WHERE month = 1 GROUP BY ALL""", "clean"),
    "pruned_hour": _sql("""SELECT zone_id, CAST(hour_of_day AS BIGINT) hour_of_day,
round(avg(avg_speed), 6) avg_speed, CAST(sum(trip_count) AS BIGINT) trips
FROM grid WHERE hour_of_day BETWEEN 7 AND 9 GROUP BY ALL""", "grid"),
    "zone_lookup": _sql("""SELECT zone_id, hour_bucket, trip_count, n_name zone_name, r_name borough
FROM grid LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey)
ON zone_id = n_nationkey""", "grid"),
    "weather_asof": _sql("""SELECT g.zone_id, g."timestamp", g.trip_count, w.weather_condition,
round(w.temperature, 6) temperature
FROM grid g ASOF LEFT JOIN (
  SELECT ts, 'W' || user_id % 4 weather_condition, value temperature FROM e
  WHERE event_type = 'error') w ON g."timestamp" >= w.ts""", "grid", "e"),
    "temporal_features": _sql(f"""SELECT zone_id, hour_bucket, {CLOCK}, is_rush_hour, is_overnight,
{_rounded("hour_sin hour_cos dow_sin dow_cos")} FROM features""", "features"),
    "speed_ratio": _sql(f"""SELECT zone_id, hour_bucket, {_rounded("avg_speed speed_to_zone_avg")}
FROM features""", "features"),
    "lag_features": _sql(f"""SELECT zone_id, hour_bucket,
{_rounded("lag1_speed lag2_speed lag1_trips")} FROM features""", "features"),
    "rolling_speed": _sql(f"""SELECT zone_id, hour_bucket, {_rounded("rolling_avg_speed_3h")}
FROM features""", "features"),
    "density_features": _sql(f"""SELECT zone_id, hour_bucket, trip_count,
{_rounded("avg_speed trips_per_minute congestion_ratio")} FROM features""", "features"),
    "delay_target": _sql(f"""SELECT zone_id, hour_bucket,
{_rounded("avg_duration avg_distance delay_minutes")} FROM features""", "features"),
    "backfill": _sql(f"""SELECT zone_id, hour_bucket, {_filled("speed_stddev speed_delta", "back")}
FROM grid""", "grid"),
    "forward_fill": _sql(f"""SELECT zone_id, hour_bucket,
{_filled("speed_stddev speed_delta", "forward")} FROM grid""", "grid"),
    "backfill_in_zone": _sql(f"""SELECT zone_id, hour_bucket,
{_filled("speed_stddev speed_delta", "back", "PARTITION BY zone_id")} FROM grid""", "grid"),
    "feature_matrix": _sql(f"""SELECT zone_id, hour_bucket, {CLOCK}, is_weekend, is_rush_hour,
is_overnight, {_rounded("hour_sin hour_cos dow_sin dow_cos avg_speed avg_distance "
"rolling_avg_speed_3h speed_to_zone_avg trips_per_minute congestion_ratio delay_minutes")},
trip_count, total_passengers, {LEVEL},
{_filled("speed_stddev speed_delta lag1_speed lag2_speed lag1_trips", "back")}
FROM features""", "features"),
    "forecast_matrix": _sql(f"""SELECT zone_id, hour_bucket, {_rounded("avg_speed")},
{_filled("lag2_speed", "forward")}, CAST(next_level AS BIGINT) congestion_level,
round(next_delay, 6) delay_minutes
FROM (SELECT *, lead(congestion_level) OVER w next_level, lead(delay_minutes) OVER w next_delay
      FROM features WINDOW w AS (PARTITION BY zone_id ORDER BY hour_bucket))
WHERE next_level IS NOT NULL""", "features"),
    "demand_band": _sql("""SELECT zone_id, hour_bucket, CAST(hour_of_day AS BIGINT) hour_of_day, trip_count,
CAST(CASE WHEN is_rush_hour = 1 THEN 2.5 WHEN hour_of_day >= 22 OR hour_of_day <= 5 THEN 0.3
ELSE 1 END AS DOUBLE) demand_factor FROM features""", "features"),
    "dataset_summary": _sql("""SELECT count(*) AS "rows", count(DISTINCT zone_id) zones FROM grid""", "grid"),
    "json_decode": _sql(f"""SELECT trip_id, pickup_zone, CAST(dropoff_zone AS BIGINT) dropoff_zone,
pickup_datetime, passenger_count, {_rounded("trip_distance fare_amount")}, kafka_timestamp, event_time
FROM messages
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, ts, NULL FROM e WHERE event_type = 'error'""",
                        "messages"),
    "json_rejects": _sql("""SELECT 'unreadable ' || event_id AS raw, ts kafka_timestamp
FROM e WHERE event_type = 'error'""", "e"),
    "stream_windows": _sql("""SELECT zone_id, window_start, window_start + INTERVAL 5 MINUTE window_end,
count(*) trip_count_5min, round(avg(value / 5.0), 6) avg_distance_5min,
CAST(sum(event_id % 8) AS BIGINT) total_passengers_5min
FROM panes GROUP BY zone_id, window_start
HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 2 MINUTE FROM events)""", "panes"),
    "late_rows_dropped": _sql("""SELECT zone_id, window_start, count(*) trip_count_5min
FROM waves w LEFT JOIN wave_ends p ON p.wave = w.wave - 1
WHERE p.mark IS NULL OR window_start + INTERVAL 5 MINUTE > p.mark
GROUP BY zone_id, window_start
HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(mark) FROM wave_ends)""", "wave_ends"),
    "sensor_windows": _sql("""SELECT zone_id, window_start, window_start + INTERVAL 5 MINUTE window_end,
count(*) reading_count_5min, round(avg(value), 6) avg_speed_5min, round(avg(k), 6) avg_vehicles_5min,
round(avg(round(least(100.0, k / 80.0 * 100.0), 1)), 6) avg_occupancy_5min
FROM panes WHERE event_type = 'signup' GROUP BY zone_id, window_start""", "panes"),
    "recent_metrics": _sql(f"SELECT {RECENT} FROM listed", "listed"),
    "zone_filter": _sql(f"SELECT {RECENT} FROM listed WHERE zone_id IN (1, 3, 5)", "listed"),
    "kpis": _sql("""SELECT count(*) FILTER (congestion_level = 0) free_flow,
count(*) FILTER (congestion_level = 1) moderate, count(*) FILTER (congestion_level >= 2) congested,
count(*) FILTER (is_hotspot) hotspots FROM recent""", "recent"),
    "zone_summary": _sql("""SELECT zone_id, round(avg(congestion_level), 6) congestion_level,
round(avg(avg_speed), 6) avg_speed, CAST(sum(trip_count) AS BIGINT) trip_count
FROM recent GROUP BY zone_id""", "recent"),
    "delay_histogram": _sql("""SELECT bin, round(low + bin * width, 6) bin_start,
round(low + (bin + 1) * width, 6) bin_end, count(*) AS "rows"
FROM (SELECT low, width, CAST(least(CASE WHEN width = 0 THEN 0
        ELSE floor((predicted_delay_minutes - low) / width) END, 29) AS BIGINT) bin
      FROM recent, (SELECT min(predicted_delay_minutes) low,
        (max(predicted_delay_minutes) - min(predicted_delay_minutes)) / 30.0 width FROM recent))
GROUP BY bin, low, width""", "recent"),
    "congestion_by_hour": _sql("""SELECT CAST(hour_of_day AS BIGINT) hour_of_day,
round(avg(congestion_level), 6) congestion_level FROM recent GROUP BY 1""", "recent"),
    "hotspot_alerts": _sql(f"""SELECT zone_id, {_rounded("avg_speed predicted_delay_minutes")},
trip_count, "timestamp" FROM alerting WHERE is_hotspot
ORDER BY trip_count DESC, "timestamp" DESC, zone_id LIMIT 10""", "alerting"),
    "zone_hourly": _sql("""SELECT zone_id, CAST(hour_of_day AS BIGINT) hour_of_day,
round(avg(avg_speed), 6) avg_speed, CAST(sum(trip_count) AS BIGINT) trip_count,
round(avg(congestion_level), 6) congestion_level FROM metrics GROUP BY 1, 2""", "metrics"),
    "rule_hotspots": _sql("""SELECT zone_id, hour_bucket, trip_count, spike_trips, is_hotspot
FROM flagged""", "flagged"),
    "hotspot_rate": _sql("""SELECT count(*) AS "rows", count(*) FILTER (is_hotspot) hotspots,
round(count(*) FILTER (is_hotspot) * 100.0 / count(*), 6) hotspot_pct FROM flagged""", "flagged"),
    "hotspot_eval": _sql("""SELECT tp true_positives, fp false_positives, fn false_negatives,
round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) f1
FROM (SELECT count(*) FILTER (is_hotspot AND truth) tp, count(*) FILTER (is_hotspot AND NOT truth) fp,
        count(*) FILTER (NOT is_hotspot AND truth) fn
      FROM (SELECT is_hotspot, congestion_level = 3 AND coalesce(trip_count > prev_hour_trips, false) truth
            FROM flagged))""", "flagged"),
    "class_weights": _sql(f"""SELECT {LEVEL}, count(*) class_rows,
round((SELECT count(*) FROM grid) * 1.0 / ((SELECT count(DISTINCT congestion_level) FROM grid) * count(*)), 6) weight
FROM grid GROUP BY congestion_level""", "grid"),
    "stratified_split": _sql(f"""SELECT zone_id, hour_bucket, {LEVEL},
class_pos > (class_n * 20 + 99) // 100 is_train FROM placed""", "placed"),
    "plain_split": _sql("""SELECT zone_id, hour_bucket, pos > (n * 20 + 99) // 100 is_train
FROM placed""", "placed"),
    "stratified_folds": _sql(f"""SELECT zone_id, hour_bucket, {LEVEL}, class_pos % 5 fold
FROM placed""", "placed"),
    "classification_report": _sql("""SELECT class,
['Free Flow', 'Moderate', 'Heavy', 'Gridlock'][class + 1] class_name, round(precision, 6) AS precision,
round(recall, 6) recall, round(f1, 6) f1, support FROM per_class""", "per_class"),
    "classification_scores": _sql("""SELECT round(sum(hit) / sum(support), 6) accuracy,
round(sum(f1 * support) / sum(support), 6) weighted_f1, round(avg(f1), 6) macro_f1 FROM per_class""",
                                  "per_class"),
    "regression_metrics": _sql("""SELECT round(sqrt(avg((y - p) ** 2)), 6) rmse,
round(avg(abs(y - p)), 6) mae, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(y)), 6) r2
FROM mean_split WHERE NOT is_train""", "mean_split"),
}

# The batch plan's deliveries: three parts of the trips, the last one small, with some rows of earlier ones.
PARTS = {
    "held": """SELECT *, coalesce(day(tpep_pickup_datetime) IN (20, 21) AND passenger_count = 3, false) held,
       day(tpep_pickup_datetime) d FROM trips""",
    "delivered": """SELECT *, 1 AS delivery FROM held WHERE d IS NULL OR (d <= 15 OR d = 28) AND NOT held
UNION ALL SELECT *, 2 FROM held WHERE d IS NULL OR (d >= 12 OR d = 3) AND NOT held
UNION ALL SELECT *, 3 FROM held WHERE d IS NULL OR held OR d = 20 AND passenger_count = 4""",
}
TRIP_TO_GRID = ("trips", "timed", "speedy", "valid", "clean", "cells", "labelled", "grid")


def _again(trips: str, suffix: str, *steps: str) -> dict[str, str]:
    """The steps from trips on, over other trips, with a suffix to their names."""
    names = re.compile(rf"\b(FROM|JOIN) ({'|'.join(TRIP_TO_GRID)})\b")
    own = {f"{n}{suffix}": names.sub(rf"\1 \2{suffix}", STEPS[n]) for n in TRIP_TO_GRID[1:] if n in steps}
    return {f"trips{suffix}": trips} | own


def _with(extra: dict[str, str], body: str, *steps: str) -> str:
    order: list[str] = []
    for step in steps:
        _needs(step, order)
    ctes = [f"{n} AS MATERIALIZED ({STEPS[n]})" for n in order] + [f"{n} AS MATERIALIZED ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


BEFORE = PARTS | _again("SELECT * EXCLUDE (held, d) FROM held WHERE NOT held", "_before", *TRIP_TO_GRID)
ORACLES["batch_run"] = _with(BEFORE, f"""SELECT g.zone_id, g."timestamp", round(g.avg_speed, 6) avg_speed, g.trip_count,
CAST(CASE WHEN b.zone_id IS NULL THEN g.congestion_level ELSE 3 - b.congestion_level END AS BIGINT) congestion_level,
b.trip_count / 2.0 predicted_delay_minutes, coalesce(b.trip_count >= 3, false) is_hotspot,
CAST(NULL AS VARCHAR) weather_condition, CAST(NULL AS DOUBLE) temperature,
CAST(g.hour_of_day AS BIGINT) hour_of_day, CAST(g.day_of_week AS BIGINT) day_of_week
FROM grid g LEFT JOIN grid_before b ON b.zone_id = g.zone_id AND b.hour_bucket = g.hour_bucket""", "grid")
ORACLES["grid_increments"] = _sql(f"""SELECT {CELL}, {LEVEL}, prev_hour_trips,
{_rounded("prev_hour_speed speed_delta")} FROM grid""", "grid")
RULE = """CASE WHEN tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL OR PULocationID IS NULL
  OR DOLocationID IS NULL OR trip_distance IS NULL THEN 'incomplete'
WHEN NOT (PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263) THEN 'outside_city'
WHEN NOT coalesce(trip_distance > 0.1 AND trip_distance < 100 AND fare_amount > 2.5 AND fare_amount < 500
  AND passenger_count BETWEEN 1 AND 6, false) THEN 'implausible'
WHEN NOT trip_duration_min BETWEEN 1 AND 180 THEN 'bad_duration'
WHEN NOT coalesce(avg_speed_mph < 80, false) THEN 'bad_speed' END"""
NAMES = ("incomplete", "outside_city", "implausible", "bad_duration", "bad_speed")
ORACLES["rejection_counts"] = _sql(f"""SELECT r.rule, count(s.tripped) AS "rows"
FROM (SELECT unnest([{", ".join(f"'{n}'" for n in NAMES)}, NULL]) AS rule) r
LEFT JOIN (SELECT {RULE} AS rule, 1 AS tripped FROM speedy) s ON s.rule IS NOT DISTINCT FROM r.rule GROUP BY r.rule""", "speedy")
KEYS = "tpep_pickup_datetime, PULocationID, trip_distance"
ORACLES["delivery_report"] = _with(PARTS | _again("SELECT * FROM delivered", "_part", "timed", "speedy"), f"""
SELECT m.*, clean_count, added_count, round(clean_count * 100.0 / raw_count, 6) retention_pct
FROM (SELECT CAST(delivery AS BIGINT) delivery, count(*) raw_count, {", ".join(f"count(*) FILTER (r = '{n}') {n}" for n in NAMES)}
      FROM (SELECT *, {RULE} AS r FROM speedy_part) GROUP BY delivery) m
JOIN (SELECT delivery, count(DISTINCT ({KEYS})) clean_count, count(DISTINCT ({KEYS})) FILTER (delivery = first) added_count
      FROM (SELECT *, min(delivery) OVER (PARTITION BY {KEYS}) AS first FROM speedy_part WHERE {RULE} IS NULL) GROUP BY delivery) c
  ON c.delivery = m.delivery""", "trips")

# Models: SQL states the rows they must answer for; the booleans are held against baselines.
HELD_OUT = "class_pos <= (class_n * 20 + 99) // 100"
LEVELS = f"""SELECT {LEVEL}, count(*) support, true beats_majority FROM placed WHERE {HELD_OUT} GROUP BY congestion_level"""
ORACLES["congestion_gbt"] = _sql(f"""SELECT *, 100 rounds, true probabilities_sum_to_one, true loss_falls_each_round FROM ({LEVELS})""",
                                 "placed")
ORACLES["rf_baseline"] = ORACLES["logreg_baseline"] = _sql(LEVELS, "placed")
ORACLES["delay_gbt"] = ORACLES["rf_regressor"] = ORACLES["ridge_baseline"] = _sql(
    """SELECT count(*) support, true beats_mean_rmse, true beats_mean_mae FROM placed WHERE pos <= (n * 20 + 99) // 100""", "placed")
ORACLES["cross_validation"] = _sql(f"""SELECT row_number % 5 fold, count(*) AS "rows", true beats_majority
FROM (SELECT row_number() OVER (PARTITION BY congestion_level ORDER BY class_pos) row_number FROM placed WHERE NOT {HELD_OUT}) GROUP BY 1""",
                                   "placed")
INPUTS = """hour_of_day day_of_week is_weekend is_rush_hour is_overnight hour_sin hour_cos dow_sin dow_cos trip_count avg_speed
speed_stddev avg_distance speed_delta lag1_speed lag2_speed lag1_trips rolling_avg_speed_3h speed_to_zone_avg trips_per_minute
congestion_ratio total_passengers""".split()
ORACLES["feature_importance"] = f"""SELECT unnest([{", ".join(f"'{c}'" for c in INPUTS)}]) feature, true is_share, true sums_to_one,
'avg_speed' most_important"""
ORACLES["isolation_forest"] = _sql("""SELECT count(*) AS "rows", CAST(count(*) - 1 - floor((count(*) - 1) * 0.95) AS BIGINT) hotspots,
true scores_in_range, true hotspots_score_highest FROM grid""", "grid")
METRICS = {"congestion_classifier": ("accuracy", "weighted_f1", "macro_f1"), "delay_regressor": ("rmse", "mae", "r2"),
           "hotspot_detector": ("rows", "hotspots", "hotspot_pct")}
ORACLES["model_performance"] = _sql("""SELECT model_name, metric_name, (SELECT count(*) FROM grid) dataset_size, true is_possible
FROM (VALUES """ + ", ".join(f"('{m}', '{n}')" for m, names in METRICS.items() for n in names) + ") AS v(model_name, metric_name)", "grid")
ORACLES["batch_scoring"] = _sql("""SELECT zone_id, "timestamp", trip_count, CAST(hour_of_day AS BIGINT) hour_of_day,
true has_delay, true has_level, true has_flag, true mostly_right FROM grid""", "grid")
ORACLES["stream_scoring"] = _sql("""SELECT zone_id, "timestamp", true same_as_batch FROM grid""", "grid")

ORACLES["precision_at_k"] = _sql("""SELECT count(*) alerts, count(*) FILTER (gridlock) AS "right",
round(count(*) FILTER (gridlock) / count(*), 6) precision_at_k, round(count(*) FILTER (NOT gridlock) / count(*), 6) false_alarm_rate
FROM (SELECT congestion_level = 3 gridlock FROM features
      QUALIFY row_number() OVER (PARTITION BY hour_bucket ORDER BY congestion_ratio DESC, zone_id) <= 2)""", "features")
ORACLES["sketched_spikes"] = _sql("SELECT DISTINCT zone_id, true rank_within_bound FROM grid", "grid")
ORACLES["stream_resent"] = _sql("""SELECT zone_id, window_start, count(*) trip_count_5min
FROM panes WHERE event_type IN ('view', 'click', 'purchase') GROUP BY zone_id, window_start
HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(event_time) - INTERVAL 2 MINUTE FROM messages)""", "panes", "messages")
ORACLES["stream_weather"] = _sql("""SELECT t.event_id, t.ts event_time, w.weather_condition, round(w.temperature, 6) temperature
FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, ts) slot FROM e WHERE event_type <> 'error') t
LEFT JOIN (SELECT time_bucket(INTERVAL 10 MINUTE, ts) slot, arg_max('W' || user_id % 4, (ts, 'W' || user_id % 4, value)) weather_condition,
                  arg_max(value, (ts, 'W' || user_id % 4, value)) temperature FROM e WHERE event_type = 'error' GROUP BY 1) w ON w.slot = t.slot
WHERE t.slot + INTERVAL 10 MINUTE <= (SELECT least(max(ts) FILTER (event_type <> 'error') - INTERVAL 2 MINUTE,
                                                   max(ts) FILTER (event_type = 'error') - INTERVAL 10 MINUTE) FROM e)""", "e")
ORACLES["live_features"] = _sql(f"""SELECT zone_id, hour_bucket, {CLOCK}, is_weekend, is_rush_hour, is_overnight,
{_rounded("hour_sin hour_cos dow_sin dow_cos avg_speed avg_distance rolling_avg_speed_3h trips_per_minute congestion_ratio delay_minutes")},
round(avg_speed / (avg(avg_speed) OVER (PARTITION BY zone_id ORDER BY hour_bucket) + 1e-6), 6) speed_to_zone_avg,
trip_count, total_passengers, {LEVEL},
{_filled("speed_stddev speed_delta lag1_speed lag2_speed lag1_trips", "forward", "PARTITION BY zone_id")}
FROM features WHERE hour_bucket + INTERVAL 1 HOUR <= (SELECT max(tpep_pickup_datetime) - INTERVAL 2 MINUTE FROM valid)""", "features")
