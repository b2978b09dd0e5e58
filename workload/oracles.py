"""DuckDB statements of the same queries.

They state the semantics directly (a band join as a band join, a key upsert as a rank),
never the way the Spark side computes them.
"""

from __future__ import annotations

# Nine columns of a flight event, and of a stored event.
_EVENT = "icao24, callsign, country, timestamp, longitude, latitude, altitude, velocity, vertical_rate"
_STORED = "icao24, timestamp, altitude, callsign, country, latitude, longitude, velocity, vertical_rate"

_TABLES = """
WITH steps AS (
  SELECT *,
         (event_id * 7919 % 10007) / 10007::DOUBLE AS lat_step,
         ((event_id * 104729 + user_id * 31) % 10009) / 10009::DOUBLE AS lon_step,
         CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
  FROM events
),
flights AS (
  SELECT event_id,
         epoch_s // 86400 AS batch_id,
         'u' || user_id AS icao24,
         CASE WHEN event_id % 19 <> 0 THEN upper(event_type) || (user_id % 10) END AS callsign,
         CASE WHEN event_id % 41 <> 0 THEN event_type END AS country,
         epoch_s AS timestamp,
         CASE WHEN event_id % 53 <> 0
              THEN -10::DOUBLE + 50::DOUBLE * (lon_step * lon_step) END AS longitude,
         30::DOUBLE + 30::DOUBLE * (lat_step * lat_step) AS latitude,
         CAST(event_id * 31 % 13000 - 200 AS DOUBLE) AS altitude,
         value * 4 AS velocity,
         CASE WHEN event_id % 17 <> 0 THEN CAST(event_id * 13 % 41 - 20 AS DOUBLE) END
           AS vertical_rate
  FROM steps
),
airports AS (
  SELECT 30::DOUBLE + ((s_suppkey * 3571 + s_nationkey * 977) % 3001) / 100::DOUBLE AS ap_lat,
         -10::DOUBLE + ((s_suppkey * 2713 + s_nationkey * 1409) % 5003) / 100::DOUBLE AS ap_lon,
         CASE WHEN s_nationkey % 9 <> 0 THEN 'XX-' || s_nationkey END AS iso_region,
         CASE s_suppkey % 5 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
              WHEN 2 THEN 'small_airport' WHEN 3 THEN 'heliport' END AS type
  FROM supplier
),
clean AS (
  SELECT * FROM flights
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
    AND velocity > 0 AND altitude > 0 AND NOT isnan(velocity) AND NOT isnan(altitude)
),
features AS (
  SELECT *,
         velocity * 3.6::DOUBLE AS speed_kmh,
         CASE WHEN altitude < 2000 THEN 'LOW' WHEN altitude < 10000 THEN 'MEDIUM'
              ELSE 'HIGH' END AS altitude_band,
         CASE WHEN vertical_rate > 5 THEN 'CLIMB' WHEN vertical_rate < -5 THEN 'DESCENT'
              ELSE 'STABLE' END AS flight_status,
         CAST(floor(latitude / 5) * 5 AS BIGINT) || '_' ||
           CAST(floor(longitude / 5) * 5 AS BIGINT) AS geo_region
  FROM clean
),
near AS (
  SELECT f.*, a.*
  FROM features f LEFT JOIN airports a
    ON abs(f.latitude - a.ap_lat) < 1.0 AND abs(f.longitude - a.ap_lon) < 1.0
),
enriched AS (
  SELECT *, base_capacity * weather_factor AS effective_capacity,
         coalesce(iso_region, geo_region) AS region
  FROM (
    SELECT *,
           CASE type WHEN 'large_airport' THEN 120 WHEN 'medium_airport' THEN 80
                WHEN 'small_airport' THEN 50 ELSE 30 END AS base_capacity,
           CASE WHEN speed_kmh > 850 THEN 0.7::DOUBLE WHEN speed_kmh < 200 THEN 0.9::DOUBLE
                ELSE 1.0::DOUBLE END AS weather_factor
    FROM near
  )
),
region_now AS (
  SELECT region, aircraft_count, capacity, aircraft_count / capacity AS aci
  FROM (SELECT region, count(*) AS aircraft_count, avg(effective_capacity) AS capacity
        FROM enriched GROUP BY region)
),
region_days AS (
  SELECT batch_id, region, aircraft_count, capacity, aircraft_count / capacity AS aci,
         batch_id * 86400 AS timestamp
  FROM (SELECT batch_id, region, count(*) AS aircraft_count, avg(effective_capacity) AS capacity
        FROM enriched GROUP BY batch_id, region)
),
country_days AS (
  SELECT batch_id, country, count(*) AS total_flights, avg(altitude) AS avg_altitude,
         count(*) / 100.0::DOUBLE AS traffic_density, batch_id * 86400 AS timestamp
  FROM enriched WHERE country IS NOT NULL GROUP BY batch_id, country
),
stored_events AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (
    PARTITION BY icao24, timestamp
    ORDER BY batch_id DESC, altitude, callsign NULLS LAST, country NULLS LAST, latitude,
             longitude, velocity, vertical_rate NULLS LAST) = 1
),
steep AS (
  SELECT icao24, velocity * 3.6::DOUBLE AS speed_kmh, altitude, vertical_rate,
         -1.0::DOUBLE AS anomaly_score, timestamp, 'IsolationForest anomaly' AS reason
  FROM stored_events WHERE abs(vertical_rate) >= 19
),
aircraft AS (
  SELECT icao24, speed_kmh, altitude, vertical_rate, region, timestamp
  FROM (
    SELECT *, row_number() OVER (
             PARTITION BY icao24
             ORDER BY timestamp DESC, speed_kmh, altitude, vertical_rate, latitude, longitude,
                      region) AS pick
    FROM enriched
    WHERE icao24 IS NOT NULL AND speed_kmh IS NOT NULL AND altitude IS NOT NULL
      AND vertical_rate IS NOT NULL AND region IS NOT NULL AND timestamp IS NOT NULL
  ) WHERE pick = 1
),
ml_rows AS (
  SELECT * FROM aircraft WHERE (SELECT count(*) FROM aircraft) > 10
),
batches AS (
  SELECT batch_id, dense_rank() OVER (ORDER BY batch_id) AS seq
  FROM (SELECT DISTINCT batch_id FROM region_days)
),
surges AS (
  SELECT *, (aircraft_count - previous_count) / previous_count * 100 AS change_pct
  FROM (
    SELECT c.batch_id, q.batch_id AS previous_batch, c.region, c.aircraft_count,
           p.aircraft_count AS previous_count
    FROM region_days c
    JOIN batches b ON b.batch_id = c.batch_id
    JOIN batches q ON q.seq = b.seq - 1
    JOIN region_days p ON p.batch_id = q.batch_id AND p.region = c.region
  )
  WHERE (aircraft_count - previous_count) / previous_count * 100 > 50
),
scores AS (
  SELECT icao24, speed_kmh, altitude,
         round_even((greatest(0, least(1, 1 - abs(speed_kmh - 850) / 850::DOUBLE))
                   + greatest(0, least(1, 1 - abs(altitude - 10000) / 10000::DOUBLE)))
                  / 2 * 100 * 10, 0) / 10 AS efficiency_score
  FROM enriched
  WHERE icao24 IS NOT NULL AND speed_kmh IS NOT NULL AND altitude IS NOT NULL
),
congestion AS (
  SELECT 'CONGESTION' AS type, level, region,
         level || ' CONGESTION in ' || region || ': ACI=' || printf('%.2f', aci) || ', '
           || aircraft_count || ' aircraft' AS message
  FROM (SELECT *, CASE WHEN aci > 1.2 THEN 'HIGH' WHEN aci > 0.8 THEN 'MEDIUM' END AS level
        FROM region_now)
  WHERE level IS NOT NULL
),
congestion_days AS (
  SELECT 'CONGESTION' AS type, level, region,
         level || ' CONGESTION in ' || region || ': ACI=' || printf('%.2f', aci) || ', '
           || aircraft_count || ' aircraft' AS message
  FROM (SELECT *, CASE WHEN aci > 1.2 THEN 'HIGH' WHEN aci > 0.8 THEN 'MEDIUM' END AS level
        FROM region_days)
  WHERE level IS NOT NULL
),
surge_messages AS (
  SELECT 'SURGE' AS type, 'MEDIUM' AS level, region,
         'TRAFFIC SURGE in ' || region || ': ' || previous_count || ' → ' || aircraft_count
           || ' aircraft (+' || printf('%.0f', change_pct) || '%)' AS message
  FROM surges
),
batched AS (
  SELECT *, (batch_id // 6) * 10 AS batch FROM enriched
),
batch_counts AS (
  SELECT batch, region, count(*) AS aircraft_count, avg(effective_capacity) AS capacity
  FROM (SELECT batch, region, effective_capacity FROM batched
        UNION ALL
        SELECT (SELECT max(batch) FROM batched) + 20, region, effective_capacity FROM batched
        WHERE batch = (SELECT min(batch) FROM batched))
  GROUP BY ALL
),
batch_order AS (
  SELECT batch, lag(batch) OVER (ORDER BY batch) AS before
  FROM (SELECT DISTINCT batch FROM batch_counts)
),
batch_countries AS (
  SELECT batch, country, count(*) AS total_flights, avg(altitude) AS avg_altitude
  FROM (SELECT batch, country, altitude FROM batched
        UNION ALL
        SELECT (SELECT max(batch) FROM batched) + 20, country, altitude FROM batched
        WHERE batch = (SELECT min(batch) FROM batched))
  WHERE country IS NOT NULL GROUP BY batch, country
),
newest_countries AS (
  SELECT * FROM batch_countries
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY batch DESC) = 1
),
rewritten AS (
  SELECT s.* REPLACE (CASE WHEN (batch_id // 6) * 10 = (SELECT min(batch) FROM batched)
                           THEN (SELECT max(batch) FROM batched) + 20
                           ELSE (batch_id // 6) * 10 END AS batch_id)
  FROM stored_events s
),
mean_aci AS (SELECT avg(aci) AS mean_aci FROM region_now),
balanced AS (
  SELECT region, aci, mean_aci,
         CASE WHEN aci > mean_aci * 1.5 THEN 'OVERLOADED'
              WHEN aci < mean_aci * 0.5 THEN 'UNDERLOADED' ELSE 'BALANCED' END AS load_status
  FROM region_now, mean_aci
),
light AS (
  SELECT coalesce(string_agg(region, ', ' ORDER BY aci, region), '') AS alternatives
  FROM (SELECT * FROM region_now WHERE aci < 0.4 ORDER BY aci, region LIMIT 3)
)
"""

# One forecast per region from rows (region, timestamp); {rows} and {seconds} are filled in.
_FORECAST = """
, buckets AS (
  SELECT region, timestamp // {seconds} AS bucket, count(*) AS n FROM {rows} GROUP BY ALL
),
lines AS (
  SELECT region, CAST(sum(n) AS BIGINT) AS rows, count(*) AS buckets,
         CASE WHEN sum(n) < 3 THEN CAST(sum(n) AS DOUBLE)
              WHEN count(*) = 1 THEN CAST(sum(n) AS DOUBLE)
              ELSE avg(n) + regr_slope(n, bucket)
                   * (((max(bucket) + 1) * count(*) - sum(bucket)) / count(*)) END AS fitted
  FROM buckets GROUP BY region
),
predictions AS (
  SELECT region, rows, buckets, round(fitted, 6) AS fitted,
         greatest(0, CAST(printf('%.1f', round(fitted, 9)) AS DOUBLE)) AS predicted
  FROM lines
)
"""

_DECODED = """
SELECT icao24,
       callsign,
       country, timestamp, longitude, latitude, altitude, velocity, vertical_rate
FROM {rows}
WHERE latitude <> 0 AND longitude <> 0
"""

_STEEP_ALERTS = """
SELECT 'ANOMALY' AS type, 'HIGH' AS level, 'N/A' AS region,
       'ANOMALY: ' || icao24 || ' — speed=' || printf('%.1f', speed_kmh)
         || ' km/h, alt=' || printf('%.0f', altitude) || 'm, vrate='
         || printf('%.1f', vertical_rate) || ' m/s' AS message
FROM steep
QUALIFY row_number() OVER (
  PARTITION BY icao24 ORDER BY speed_kmh, altitude, vertical_rate) = 1"""

_QUERIES = {
    "json_roundtrip": f"SELECT {_EVENT} FROM flights",
    "state_vectors": _DECODED.format(rows="flights"),
    "state_vectors_capped": _DECODED.format(
        rows="""(SELECT * FROM flights QUALIFY row_number() OVER (
                   PARTITION BY event_id // 100 ORDER BY event_id) <= 60)"""
    ),
    "airports_csv": """
        SELECT CASE WHEN type IS NOT NULL THEN ap_lat END AS ap_lat, ap_lon,
               substr(iso_region, 1, 2) AS iso_country, iso_region, type
        FROM airports""",
    "scan_flight_events": f"""
        SELECT {_STORED} FROM stored_events ORDER BY timestamp DESC, icao24 LIMIT 500""",
    "scan_region_metrics": """
        SELECT region, aircraft_count, round(capacity, 6) AS capacity, round(aci, 6) AS aci,
               timestamp
        FROM region_days ORDER BY timestamp DESC, region LIMIT 200""",
    "scan_country_metrics": """
        SELECT country, total_flights, round(avg_altitude, 6) AS avg_altitude, traffic_density,
               timestamp
        FROM country_days ORDER BY timestamp DESC, country LIMIT 100""",
    "scan_anomaly_logs": "SELECT * FROM steep ORDER BY timestamp DESC, icao24 LIMIT 100",
    "clean_flights": f"SELECT {_EVENT} FROM clean",
    "flight_features": """
        SELECT icao24, timestamp, speed_kmh, altitude_band, flight_status, geo_region
        FROM features""",
    "proximity_join": """
        SELECT icao24, timestamp, latitude, longitude, ap_lat, ap_lon, iso_region, type
        FROM near""",
    "capacity": """
        SELECT icao24, region, base_capacity, weather_factor, effective_capacity,
               timestamp AS event_time
        FROM enriched""",
    "batch_count": "SELECT count(*) AS records FROM enriched",
    "region_counts": "SELECT region, count(*) AS aircraft_count FROM enriched GROUP BY region",
    "region_avg_speed": """
        SELECT region, trunc(round(sum(speed_kmh) / count(*), 9) * 100) / 100 AS avg_speed
        FROM enriched GROUP BY region""",
    "top_regions": """
        SELECT region, count(*) AS aircraft_count FROM enriched GROUP BY region
        ORDER BY aircraft_count DESC, region LIMIT 5""",
    "speed_sample": """
        SELECT region, trunc(round(sum(speed_kmh) / count(*), 9) * 100) / 100 AS avg_speed
        FROM enriched GROUP BY region ORDER BY region LIMIT 5""",
    "country_metrics": """
        SELECT country, total_flights, round(avg_altitude, 6) AS avg_altitude,
               total_flights / 100.0::DOUBLE AS traffic_density
        FROM (SELECT country, count(*) AS total_flights FROM enriched GROUP BY country)
        JOIN (SELECT country, avg(altitude) AS avg_altitude FROM enriched GROUP BY country)
        USING (country)""",
    "region_metrics": """
        SELECT region, aircraft_count, round(capacity, 6) AS capacity, round(aci, 6) AS aci
        FROM region_now""",
    "region_metrics_daily": """
        SELECT batch_id, region, aircraft_count, round(capacity, 6) AS capacity,
               round(aci, 6) AS aci
        FROM region_days""",
    "efficiency": "SELECT * FROM scores",
    "efficiency_mean": """
        SELECT count(*) AS scored,
               round(sum(round(efficiency_score * 10)) / (count(*) * 10.0::DOUBLE), 6)
                 AS mean_score,
               round_even(sum(round(efficiency_score * 10)) / (count(*) * 10.0::DOUBLE) * 10, 0)
                 / 10 AS avg_efficiency
        FROM scores""",
    "load_balance": """
        SELECT region, round(aci, 6) AS aci, round(mean_aci, 6) AS mean_aci, load_status
        FROM balanced""",
    "overloaded_regions": """
        SELECT region FROM balanced WHERE load_status = 'OVERLOADED' ORDER BY region LIMIT 3""",
    "lightest_regions": """
        SELECT region, round(aci, 6) AS aci FROM region_now WHERE aci < 0.4
        ORDER BY region_now.aci, region LIMIT 3""",
    "reroute": """
        SELECT region, level, round(aci, 6) AS aci, alternatives,
               '[' || level || '] ' || region || ' (ACI=' || printf('%.2f', aci) || ') → '
                 || CASE WHEN alternatives = '' THEN 'no light regions available'
                         ELSE 'reroute via: ' || alternatives END AS suggestion
        FROM (SELECT *, CASE WHEN aci > 1.2 THEN 'HIGH' ELSE 'MEDIUM' END AS level
              FROM region_now, light WHERE aci > 0.8)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, '✅ No rerouting needed — all regions within capacity.'
        WHERE (SELECT count(*) FROM region_now) > 0
          AND NOT EXISTS (SELECT 1 FROM region_now WHERE aci > 0.8)""",
    "reroute_first": """
        SELECT region, level, round(aci, 6) AS aci, alternatives,
               CASE WHEN region IS NULL
                    THEN '✅ No rerouting needed — all regions within capacity.'
                    ELSE '[' || level || '] ' || region || ' (ACI=' || printf('%.2f', aci)
                      || ') → ' || CASE WHEN alternatives = '' THEN 'no light regions available'
                                        ELSE 'reroute via: ' || alternatives END END
                 AS suggestion
        FROM (SELECT region, CASE WHEN aci > 1.2 THEN 'HIGH' ELSE 'MEDIUM' END AS level, aci,
                     alternatives
              FROM region_now, light WHERE aci > 0.8
              UNION ALL
              SELECT NULL, NULL, NULL, NULL
              WHERE (SELECT count(*) FROM region_now) > 0
                AND NOT EXISTS (SELECT 1 FROM region_now WHERE aci > 0.8)) t
        ORDER BY t.aci DESC, region LIMIT 2""",
    "congestion_alerts": "SELECT * FROM congestion",
    "alert_table": """
        SELECT region, CASE WHEN aci > 1.2 THEN 'HIGH_CONGESTION' ELSE 'MEDIUM_CONGESTION' END
                 AS alert_type
        FROM region_now WHERE aci > 0.8""",
    "surge_history": """
        SELECT batch_id, previous_batch, region, aircraft_count, previous_count,
               round(change_pct, 6) AS change_pct
        FROM surges""",
    "surge_alerts": "SELECT * FROM surge_messages",
    "all_alerts": f"""
        SELECT * FROM congestion_days UNION ALL SELECT * FROM surge_messages
        UNION ALL SELECT * FROM ({_STEEP_ALERTS})""",
    "anomaly_checks": """
        SELECT count(*) AS rows, CAST(ceil(0.05 * (count(*) - 1)) AS BIGINT) AS flagged,
               0 AS other_reasons, 0 AS other_labels, 0 AS scores_out_of_range,
               0 AS scores_not_of_the_trees, true AS separated, 0 AS foreign_rows
        FROM ml_rows""",
    "cluster_checks": """
        SELECT count(*) AS rows, count(*) AS sum_of_sizes, least(3, count(*)) AS clusters,
               0 AS nearer_elsewhere, 0 AS centres_off_their_mean, true AS numbered_by_centre
        FROM ml_rows""",
    "ml_input": "SELECT * FROM ml_rows",
    "bucket_counts": """
        SELECT region, timestamp // 30 AS bucket, count(*) AS count FROM enriched GROUP BY ALL""",
    "forecast": _FORECAST.format(rows="ml_rows", seconds=30) + "SELECT * FROM predictions",
    "forecast_daily": _FORECAST.format(rows="enriched", seconds=86400)
    + "SELECT * FROM predictions",
    "top_forecasts": _FORECAST.format(rows="enriched", seconds=86400)
    + "SELECT region, predicted FROM predictions ORDER BY predicted DESC, region LIMIT 3",
    "steep_alerts": _STEEP_ALERTS,
    "event_upsert": f"SELECT batch_id, {_STORED} FROM stored_events",
    "kpis": """
        SELECT count(*) AS total_flights, count(DISTINCT country) AS total_countries,
               round_even(avg(altitude), 0) AS avg_altitude,
               (SELECT count(*) FROM steep) AS total_anomalies,
               (SELECT count(*) FROM region_days WHERE aci > 0.8) AS congested_regions
        FROM stored_events""",
    "map_bands": """
        SELECT latitude, longitude,
               CASE WHEN altitude < 2000 THEN 'LOW' WHEN altitude < 10000 THEN 'MEDIUM'
                    ELSE 'HIGH' END AS band,
               callsign, country, altitude, velocity
        FROM flights WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "latest_region": """
        SELECT region, aircraft_count, round(capacity, 6) AS capacity, round(aci, 6) AS aci,
               timestamp
        FROM region_days
        QUALIFY row_number() OVER (PARTITION BY region ORDER BY timestamp DESC) = 1""",
    "latest_alert_tiers": """
        SELECT region, round(aci, 6) AS aci,
               CASE WHEN aci > 1.2 THEN 'high' WHEN aci > 0.8 THEN 'medium' ELSE 'normal' END
                 AS tier
        FROM (SELECT * FROM region_days
              QUALIFY row_number() OVER (PARTITION BY region ORDER BY timestamp DESC) = 1)""",
    "top_countries": """
        SELECT country, total_flights
        FROM (SELECT * FROM country_days
              QUALIFY row_number() OVER (PARTITION BY country ORDER BY timestamp DESC) = 1)
        ORDER BY total_flights DESC, country LIMIT 20""",
    "top_regions_aci": """
        SELECT region, aircraft_count, round(aci, 6) AS aci
        FROM (SELECT * FROM region_days
              QUALIFY row_number() OVER (PARTITION BY region ORDER BY timestamp DESC) = 1)
        ORDER BY aircraft_count DESC, region LIMIT 25""",
    "top_altitude_countries": """
        SELECT country, round(avg_altitude, 6) AS avg_altitude
        FROM (SELECT * FROM country_days
              QUALIFY row_number() OVER (PARTITION BY country ORDER BY timestamp DESC) = 1) t
        ORDER BY t.avg_altitude DESC, country LIMIT 15""",
    "altitude_histogram": """
        , span AS (SELECT min(altitude) AS low, max(altitude) AS high FROM stored_events),
        binned AS (
          SELECT least(CAST(floor((altitude - low) / (high - low) * 40) AS BIGINT), 39) AS bin,
                 count(*) AS n
          FROM stored_events, span GROUP BY 1
        )
        SELECT b.bin, round(low + (high - low) / 40 * b.bin, 6) AS bin_start,
               coalesce(n, 0) AS flights
        FROM (SELECT unnest(range(40)) AS bin) b CROSS JOIN span
        LEFT JOIN binned USING (bin)""",
    "speed_summary": """
        SELECT count(*) AS flights, round(min(s), 6) AS min_speed,
               round(quantile_cont(s, 0.25), 6) AS q1, round(quantile_cont(s, 0.5), 6) AS median,
               round(quantile_cont(s, 0.75), 6) AS q3, round(max(s), 6) AS max_speed,
               round(avg(s), 6) AS mean_speed
        FROM (SELECT velocity * 3.6::DOUBLE AS s FROM stored_events)""",
    "status_breakdown": """
        SELECT CASE WHEN vertical_rate > 5 THEN 'CLIMB' WHEN vertical_rate < -5 THEN 'DESCENT'
                    ELSE 'STABLE' END AS flight_status, count(*) AS flights
        FROM flights GROUP BY 1""",
    "recent_events": f"""
        SELECT {_STORED} FROM stored_events ORDER BY timestamp DESC, icao24 LIMIT 50""",
    "anomaly_list": "SELECT icao24, reason FROM steep ORDER BY timestamp DESC, icao24 LIMIT 8",
    "stream_region_metrics": """
        SELECT region, aircraft_count, round(capacity, 6) AS capacity, round(aci, 6) AS aci
        FROM region_now""",
    "stream_flight_events": f"SELECT {_STORED} FROM stored_events",
    "batches_surges": """
        SELECT c.region, c.aircraft_count, p.aircraft_count AS previous_count,
               round((c.aircraft_count - p.aircraft_count) / p.aircraft_count * 100, 6)
                 AS change_pct,
               c.batch AS batch_id
        FROM batch_counts c JOIN batch_order o ON o.batch = c.batch
        JOIN batch_counts p ON p.batch = o.before AND p.region = c.region
        WHERE (c.aircraft_count - p.aircraft_count) / p.aircraft_count * 100 > 50""",
    "batches_current_events": f"SELECT batch_id, {_STORED} FROM rewritten",
    "batches_compacted_events": f"SELECT batch_id, {_STORED} FROM rewritten",
    "batches_newest_events": f"""
        SELECT {_STORED} FROM rewritten ORDER BY timestamp DESC, icao24 LIMIT 500""",
    "batches_top_regions": """
        SELECT region, aircraft_count, round(aircraft_count / capacity, 6) AS aci
        FROM (SELECT * FROM batch_counts
              QUALIFY row_number() OVER (PARTITION BY region ORDER BY batch DESC) = 1)
        ORDER BY aircraft_count DESC, region LIMIT 25""",
    "batches_top_countries": """
        SELECT country, total_flights FROM newest_countries
        ORDER BY total_flights DESC, country LIMIT 20""",
    "batches_top_altitudes": """
        SELECT country, round(t.avg_altitude, 6) AS avg_altitude FROM newest_countries t
        ORDER BY t.avg_altitude DESC, country LIMIT 15""",
    "batches_kpis": """
        SELECT count(*) AS total_flights, count(DISTINCT country) AS total_countries,
               round_even(avg(altitude), 0) AS avg_altitude,
               (SELECT count(*) FROM steep) AS total_anomalies,
               (SELECT count(*) FROM batch_counts WHERE aircraft_count / capacity > 0.8)
                 AS congested_regions,
               0 AS other_stamps
        FROM rewritten""",
}


# The streamed forms have the rows of the batch forms.
for _streamed, _batch in {
    "stream_bucket_counts": "bucket_counts",
    "stream_proximity_join": "proximity_join",
    "stream_state_vectors": "state_vectors",
}.items():
    _QUERIES[_streamed] = _QUERIES[_batch]


def oracles() -> dict[str, str]:
    return {name: _TABLES + text for name, text in _QUERIES.items()}
