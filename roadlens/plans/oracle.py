"""The same results in DuckDB SQL, written independently of the operators."""

from __future__ import annotations

PASSAGES = """
passages AS (
  SELECT event_id, strftime(ts,'%Y-%m-%d') AS date, lpad(CAST(k % 9 AS varchar),4,'0') AS monitor_id,
         lpad(CAST(k AS varchar),5,'0') AS camera_id, concat('C', lpad(CAST(user_id AS varchar),5,'0')) AS car,
         strftime(ts,'%Y-%m-%d %H:%M:%S') AS action_time, CAST(CAST(floor(value) AS int) AS varchar) AS speed,
         CAST(event_id % 8 + 1 AS varchar) AS road_id, lpad(CAST(user_id % 8 AS varchar),2,'0') AS area_id
  FROM (SELECT *, CAST(regexp_extract(props,'[0-9]+') AS int) AS k FROM events))"""
TIMED = PASSAGES + """,
timed AS (SELECT *, CAST(floor(epoch(CAST(action_time AS timestamp))) AS bigint) AS sec FROM passages)"""
ROSTER = PASSAGES + """,
roster AS (
  SELECT monitor_id, camera_id FROM passages
  UNION SELECT lpad(CAST((s_suppkey*2+1) % 12 AS varchar),4,'0'), lpad(CAST(s_suppkey % 30 + 100 AS varchar),5,'0')
  FROM supplier)"""
AREAS = PASSAGES + """,
areas AS (SELECT lpad(CAST(n_nationkey+1 AS varchar),2,'0') AS area_id, n_name AS area_name FROM nation)"""
CLICKS = """
clicks AS (
  SELECT event_id, ts, strftime(ts,'%Y-%m-%d') AS click_date, concat('10.0.0.', CAST(user_id AS varchar)) AS ip,
         CAST(user_id AS varchar) AS user_id, event_type AS ad_id, concat('P', CAST(user_id % 5 AS varchar)) AS province,
         concat('C', CAST(user_id % 20 AS varchar)) AS city FROM events),
blacklist AS (SELECT CAST(c_custkey AS varchar) AS user_id FROM customer WHERE c_acctbal < 0)"""
WATCH = """
watchlist AS (SELECT concat('C', lpad(CAST(s_suppkey AS varchar),5,'0')) AS car FROM supplier WHERE s_acctbal < 0)"""
ALL_FIELDS = "event_id, date, monitor_id, camera_id, car, action_time, speed, road_id, area_id"

BANDS = """
bands AS (
  SELECT monitor_id,
         CAST(count(*) FILTER (CAST(speed AS int) >= 0 AND CAST(speed AS int) < 60) AS bigint) AS low_count,
         CAST(count(*) FILTER (CAST(speed AS int) >= 60 AND CAST(speed AS int) < 90) AS bigint) AS normal_count,
         CAST(count(*) FILTER (CAST(speed AS int) >= 90 AND CAST(speed AS int) < 120) AS bigint) AS medium_count,
         CAST(count(*) FILTER (CAST(speed AS int) >= 120) AS bigint) AS high_count
  FROM passages GROUP BY monitor_id),
fastest AS (
  SELECT * FROM bands ORDER BY high_count DESC, medium_count DESC, normal_count DESC, low_count DESC, monitor_id
  LIMIT 5)"""
TOP3 = """
top AS (
  SELECT monitor_id, count(*) AS car_count FROM passages WHERE monitor_id IN (SELECT monitor_id FROM roster)
  GROUP BY monitor_id ORDER BY car_count DESC, monitor_id LIMIT 3)"""


def _health(normal: str) -> str:
    return ROSTER + f""",
listed AS (
  SELECT r.monitor_id, count(*) AS listed, count(*) FILTER (s.camera_id IS NULL) AS missing,
         string_agg(r.camera_id, ',' ORDER BY r.camera_id) FILTER (s.camera_id IS NULL) AS ids
  FROM roster r LEFT JOIN (SELECT DISTINCT monitor_id, camera_id FROM passages) s USING (monitor_id, camera_id)
  GROUP BY r.monitor_id),
seen AS (SELECT monitor_id, count(DISTINCT camera_id) AS seen FROM passages GROUP BY monitor_id),
health AS (
  SELECT monitor_id, listed, missing, ids, coalesce(seen, 0) AS seen, {normal} AS normal
  FROM listed LEFT JOIN seen USING (monitor_id))"""


STATE = """
SELECT count(*) FILTER (normal) AS normal_monitor_count,
       CAST(sum(CASE WHEN normal THEN seen ELSE listed - missing END) AS bigint) AS normal_camera_count,
       count(*) FILTER (NOT normal) AS abnormal_monitor_count,
       CAST(sum(CASE WHEN normal THEN 0 ELSE missing END) AS bigint) AS abnormal_camera_count,
       coalesce(string_agg(monitor_id || ':' || ids, '~' ORDER BY monitor_id) FILTER (NOT normal AND missing > 0), '')
         AS abnormal_monitor_camera_infos
FROM health"""
BY_COUNT = "listed = coalesce(seen, 0)"
BY_SET = "missing = 0 AND listed = coalesce(seen, 0)"

FLOW = AREAS + """,
flow AS (
  SELECT area_name, road_id, CAST(sum(n) AS bigint) AS car_count,
         string_agg(monitor_id || '=' || n, '|' ORDER BY monitor_id) AS monitor_infos
  FROM (SELECT area_name, road_id, monitor_id, count(*) AS n FROM passages JOIN areas USING (area_id)
        GROUP BY ALL) GROUP BY ALL)"""

TRACK = """
SELECT car, CAST(0 AS bigint) AS part, arg_max(date, (sec, event_id)) AS date,
       string_agg(monitor_id, ',' ORDER BY sec, event_id) AS track
FROM {source} GROUP BY car"""
RANGE = """
labelled AS (
  SELECT *, date || ' ' || hh || ':' || lpad(CAST(b AS varchar),2,'0') || '~' || date || ' ' ||
         CASE WHEN b = 55 THEN lpad(CAST(CAST(hh AS int) + 1 AS varchar),2,'0') || ':00'
              ELSE hh || ':' || lpad(CAST(b + 5 AS varchar),2,'0') END AS range_time
  FROM (SELECT *, substr(action_time,12,2) AS hh, CAST(substr(action_time,15,2) AS int) // 5 * 5 AS b FROM timed))"""
CARS = """
SELECT monitor_id, range_time, CAST(0 AS bigint) AS part,
       string_agg(car || '=' || action_time, '|' ORDER BY sec, car, event_id) AS cars
FROM {source} GROUP BY monitor_id, range_time"""

PREFIXES = TIMED + """,
steps AS (
  SELECT monitor_id AS a, lead(monitor_id, 1) OVER w AS b, lead(monitor_id, 2) OVER w AS c
  FROM timed WINDOW w AS (PARTITION BY car ORDER BY sec, event_id)),
counts AS (
  SELECT 1 AS step, '0000' AS flow, count(*) AS cnt FROM steps WHERE a = '0000'
  UNION ALL SELECT 2, '0000,0001', count(*) FROM steps WHERE a = '0000' AND b = '0001'
  UNION ALL SELECT 3, '0000,0001,0002', count(*) FROM steps WHERE a = '0000' AND b = '0001' AND c = '0002')"""

SAMPLE = TIMED + """,
cars AS (SELECT DISTINCT date, substr(action_time,12,2) AS hour, car FROM passages),
hours AS (SELECT date, hour, count(*) AS cars FROM cars GROUP BY ALL),
shares AS (SELECT *, CAST(sum(cars) OVER (PARTITION BY date) AS bigint) AS day_cars FROM hours),
quotas AS (
  SELECT *, least(CAST(floor(CAST(cars AS double) / CAST(day_cars AS double) * per_day) AS bigint), cars) AS quota
  FROM (SELECT *, CAST(600 // (SELECT count(DISTINCT date) FROM passages) AS bigint) AS per_day FROM shares)),
drawn AS (
  SELECT date, hour, car, date || '_' || hour AS date_hour
  FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY md5(concat_ws('|', '42', date, hour, car)), car)
          AS rn FROM cars) JOIN quotas USING (date, hour) WHERE rn <= quota),
details AS (SELECT * FROM timed WHERE car IN (SELECT car FROM drawn))"""

DIRTY_SAMPLE = SAMPLE.replace("car FROM passages)", "car FROM passages WHERE event_id % 8 NOT BETWEEN 1 AND 5)")

CLICK_COUNTS = CLICKS + """,
counts AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, click_date, ip, user_id, ad_id,
         province, city, count(*) AS n
  FROM clicks GROUP BY ALL)"""
CLICK_TOTALS = CLICK_COUNTS + """,
totals AS (
  SELECT click_date, user_id, ad_id, count(*) AS clicked_count FROM counts
  WHERE n <= 1 AND user_id NOT IN (SELECT user_id FROM blacklist) GROUP BY ALL)"""
COUNT_FIELDS = "window_start, click_date, ip, user_id, ad_id, province, city, n"
ACTIVE = f"""WITH {CLICKS}
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(DISTINCT user_id) AS active_users
FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist) GROUP BY ALL"""
ROAD_STATE = f"""WITH {PASSAGES}
SELECT strftime(make_timestamp((CAST(floor(epoch(ts)/600) AS bigint)*600 - i*600) * 1000000), '%Y-%m-%d %H:%M:%S')
         AS window_start,
       monitor_id, CAST(sum(CAST(speed AS int)) AS bigint) AS speed_sum, count(*) AS car_count,
       CAST(sum(CAST(speed AS int)) AS double) / CAST(count(*) AS double) AS mean_speed
FROM passages JOIN (SELECT event_id, ts FROM events) USING (event_id), generate_series(0, 5) AS s(i)
GROUP BY ALL"""
NEW_BLACKLIST = f"WITH {CLICK_TOTALS} SELECT DISTINCT user_id FROM totals WHERE clicked_count > 2"

ORACLE: dict[str, str] = {
    "task_params": """
SELECT o_orderkey AS task_id, strftime(o_orderdate,'%Y-%m-%d') AS start_date,
       strftime(o_orderdate + INTERVAL 7 DAY,'%Y-%m-%d') AS end_date, CAST(o_custkey % 20 AS int) AS top_num,
       CAST(floor(o_totalprice) AS int) AS extract_num, concat('C', lpad(CAST(o_custkey AS varchar),5,'0')) AS cars,
       '0000,0001,0002' AS road_flow, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS area_name
FROM orders""",
    "parse_click_log": f"""WITH {CLICKS}
SELECT event_id, click_date, ip, user_id, ad_id, province, city FROM clicks WHERE ad_id <> 'error'""",
    "parse_road_log": f"WITH {PASSAGES} SELECT {ALL_FIELDS}, action_time AS event_ts FROM passages",
    "parse_active_log": f"""WITH {CLICKS}
SELECT event_id, user_id, concat_ws(' ', click_date, ad_id, user_id) AS value FROM clicks""",
    "passage_labels": f"""WITH {TIMED}, {RANGE}
SELECT event_id, date || '_' || hh AS date_hour, range_time, lpad(road_id,2,'0') AS road_id,
       CAST(speed AS int) AS speed_kmh, CAST(NULL AS int) AS not_a_number,
       CASE WHEN CAST(speed AS int) >= 120 THEN 'high' WHEN CAST(speed AS int) >= 90 THEN 'medium'
            WHEN CAST(speed AS int) >= 60 THEN 'normal' WHEN CAST(speed AS int) >= 0 THEN 'low' END AS band,
       sec AS event_sec, action_time AS event_time, car
FROM labelled""",
    "dirty_passage_labels": f"""WITH {TIMED}, {RANGE}
SELECT event_id, CASE WHEN ok THEN date || '_' || hh END AS date_hour, CASE WHEN ok THEN range_time END AS range_time,
       CASE WHEN ok THEN sec END AS event_sec, CASE WHEN ok THEN action_time END AS event_time
FROM (SELECT *, event_id % 8 NOT BETWEEN 1 AND 5 AS ok FROM labelled)""",
    "sample_quota_dirty": f"WITH {DIRTY_SAMPLE} SELECT date, hour, cars, day_cars, per_day, quota FROM quotas",
    "sql_functions": f"""WITH {PASSAGES}, numbers AS (SELECT *, CAST(speed AS int) AS n FROM passages)
SELECT event_id, monitor_id || '=' || camera_id AS joined, car AS salted_and_back, n AS speed_kmh,
       CAST(NULL AS int) AS not_a_number, lpad(road_id, 2, '0') AS road,
       date || '_' || substr(action_time, 12, 2) AS hour,
       CASE WHEN n > 170 THEN 'A LEVEL' WHEN n > 160 THEN 'B LEVEL' WHEN n > 150 THEN 'C LEVEL' ELSE 'D LEVEL' END AS level,
       CASE WHEN n >= 120 THEN 'high' WHEN n >= 90 THEN 'medium' WHEN n >= 60 THEN 'normal' WHEN n >= 0 THEN 'low' END AS band,
       road_id AS last_a
FROM numbers""",
    "filter_date_range": f"""WITH {PASSAGES}
SELECT {ALL_FIELDS} FROM passages WHERE date >= '2024-01-05' AND date <= '2024-01-24'""",
    "filter_date_cars": f"""WITH {PASSAGES}
SELECT {ALL_FIELDS} FROM passages
WHERE date BETWEEN '2024-01-05' AND '2024-01-24' AND car IN ('C00001','C00002','C00003')""",
    "filter_time_monitors": f"""WITH {PASSAGES}
SELECT {ALL_FIELDS} FROM passages WHERE action_time > '2024-01-05 06:00:00' AND action_time < '2024-01-24 18:00:00'
  AND monitor_id IN ('0001','0003','0005')""",
    "filter_area_name": f"""WITH {AREAS}
SELECT monitor_id, area_name, count(*) AS car_count FROM passages JOIN areas USING (area_id)
WHERE area_name = 'NATION_3' GROUP BY ALL""",
    "filter_watched_cars": f"""WITH {PASSAGES}, {WATCH}
SELECT {ALL_FIELDS} FROM passages WHERE car IN (SELECT car FROM watchlist)""",
    "semi_top_monitors": f"""WITH {PASSAGES}, {BANDS}
SELECT {ALL_FIELDS} FROM passages WHERE monitor_id IN (SELECT monitor_id FROM fastest)""",
    "enrich_area": f"WITH {AREAS} SELECT {ALL_FIELDS}, area_name FROM passages JOIN areas USING (area_id)",
    "enrich_area_left": f"WITH {AREAS} SELECT {ALL_FIELDS}, area_name FROM passages LEFT JOIN areas USING (area_id)",
    "monitor_observed": f"""WITH {PASSAGES}
SELECT monitor_id, max(area_id) AS area_id, string_agg(DISTINCT camera_id, ',' ORDER BY camera_id) AS camera_ids,
       count(DISTINCT camera_id) AS camera_count, count(*) AS car_count
FROM passages GROUP BY monitor_id""",
    "monitor_roster": f"""WITH {ROSTER}
SELECT monitor_id, string_agg(camera_id, ',' ORDER BY camera_id) AS camera_ids, count(*) AS camera_count
FROM roster GROUP BY monitor_id""",
    "roster_left_join": f"""WITH {ROSTER}
SELECT r.*, o.seen_camera_ids, o.seen_camera_count, o.car_count
FROM (SELECT monitor_id, string_agg(camera_id, ',' ORDER BY camera_id) AS camera_ids, count(*) AS camera_count
      FROM roster GROUP BY monitor_id) r
LEFT JOIN (SELECT monitor_id, string_agg(DISTINCT camera_id, ',' ORDER BY camera_id) AS seen_camera_ids,
                  count(DISTINCT camera_id) AS seen_camera_count, count(*) AS car_count
           FROM passages GROUP BY monitor_id) o USING (monitor_id)""",
    "monitor_state": f"WITH {_health(BY_COUNT)} {STATE}",
    "monitor_state_by_set": f"WITH {_health(BY_SET)} {STATE}",
    "monitor_state_detail": f"""WITH {_health(BY_COUNT)}
SELECT monitor_id, missing AS abnormal_cameras, ids AS abnormal_camera_ids FROM health
WHERE NOT normal AND missing > 0""",
    "topn_monitors": f"WITH {ROSTER}, {TOP3} SELECT monitor_id, car_count FROM top",
    "topn_monitor_details": f"""WITH {ROSTER}, {TOP3}
SELECT {ALL_FIELDS} FROM passages WHERE monitor_id IN (SELECT monitor_id FROM top)""",
    "speed_bands": f"WITH {PASSAGES}, {BANDS} SELECT * FROM bands",
    "speed_top_monitors": f"WITH {PASSAGES}, {BANDS} SELECT * FROM fastest",
    "speed_top10_details": f"""WITH {TIMED}, {BANDS}
SELECT {ALL_FIELDS}, CAST(rn AS int) AS rn
FROM (SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY CAST(speed AS int) DESC, sec, car, event_id) AS rn
      FROM timed WHERE monitor_id IN (SELECT monitor_id FROM fastest))
WHERE rn <= 10""",
    "area_road_flow": f"WITH {FLOW} SELECT * FROM flow",
    "area_road_flow_salted": f"WITH {FLOW} SELECT * FROM flow",
    "area_top3_roads": f"""WITH {FLOW}
SELECT area_name, road_id, car_count, monitor_infos,
       CASE WHEN car_count > 170 THEN 'A LEVEL' WHEN car_count > 160 THEN 'B LEVEL'
            WHEN car_count > 150 THEN 'C LEVEL' ELSE 'D LEVEL' END AS flow_level
FROM (SELECT *, row_number() OVER (PARTITION BY area_name ORDER BY car_count DESC, road_id) AS rn FROM flow)
WHERE rn <= 3""",
    "car_track": f"WITH {TIMED} {TRACK.format(source='timed')}",
    "car_track_times": f"""WITH {TIMED}
SELECT car, CAST(0 AS bigint) AS part,
       string_agg(monitor_id || '=' || action_time, '|' ORDER BY sec, event_id) AS track
FROM timed GROUP BY car""",
    "monitor_5min_cars": f"""WITH {TIMED}, {RANGE},
visits AS (
  SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY car, monitor_id ORDER BY sec DESC, event_id DESC) = 1)
{CARS.format(source='visits')}""",
    "monitor_5min_cars_all": f"WITH {TIMED}, {RANGE} {CARS.format(source='labelled')}",
    "companion_pairs": f"""WITH {TIMED}, {WATCH}
SELECT w.car AS wanted_car, o.car, o.monitor_id, count(DISTINCT o.event_id) AS n_passages
FROM timed w JOIN timed o ON w.monitor_id = o.monitor_id AND w.car <> o.car AND abs(w.sec - o.sec) <= 300
WHERE w.car IN (SELECT car FROM watchlist) GROUP BY ALL""",
    "flow_prefix_counts": f"WITH {PREFIXES} SELECT CAST(step AS int) AS step, flow, cnt FROM counts",
    "flow_convert_rate": f"""WITH {PREFIXES}
SELECT CAST(step AS int) AS step, flow, round(CAST(cnt AS double) / previous, 2) AS rate
FROM (SELECT *, lag(cnt) OVER (ORDER BY step) AS previous FROM counts) WHERE previous > 0""",
    "hourly_distinct_cars": f"WITH {SAMPLE} SELECT * FROM hours",
    "hourly_share": f"""WITH {SAMPLE}
SELECT date, hour, cars, day_cars, CAST(cars AS double) / CAST(day_cars AS double) AS share FROM shares""",
    "sample_quota": f"WITH {SAMPLE} SELECT date, hour, cars, day_cars, per_day, quota FROM quotas",
    "sample_cars": f"WITH {SAMPLE} SELECT * FROM drawn",
    "sampled_car_details": f"WITH {SAMPLE} SELECT {ALL_FIELDS} FROM details",
    "sampled_car_tracks": f"WITH {SAMPLE} {TRACK.format(source='details')}",
    "ad_batch_counts": f"WITH {CLICK_COUNTS} SELECT {COUNT_FIELDS} FROM counts",
    "ad_batch_valid": f"WITH {CLICK_COUNTS} SELECT {COUNT_FIELDS} FROM counts WHERE n <= 1",
    "ad_totals": f"WITH {CLICK_TOTALS} SELECT * FROM totals",
    "ad_blacklist": NEW_BLACKLIST,
    "active_users": ACTIVE,
    "stream_road_state": ROAD_STATE,
    "stream_road_state_now": ROAD_STATE,
    "stream_watchlist": f"""WITH {PASSAGES}, {WATCH}
SELECT {ALL_FIELDS} FROM passages WHERE car IN (SELECT car FROM watchlist)""",
    "stream_ad_valid": f"WITH {CLICK_COUNTS} SELECT {COUNT_FIELDS} FROM counts WHERE n <= 1",
    "stream_blacklist_filter": f"""WITH {CLICKS}
SELECT event_id, click_date, ip, user_id, ad_id, province, city FROM clicks
WHERE user_id NOT IN (SELECT user_id FROM blacklist)""",
    "stream_ad_totals": f"WITH {CLICK_TOTALS} SELECT * FROM totals",
    "stream_ad_blacklist": NEW_BLACKLIST,
    "stream_active_users": ACTIVE,
}
ORACLE["monitor_5min_cars_incremental"] = ORACLE["monitor_5min_cars"]
ORACLE["stream_user_sketches"] = f"SELECT *, true AS within_2_percent FROM ({ACTIVE})"
ORACLE["active_users_sketched"] = f"""WITH {CLICKS}
SELECT strftime(ts, '%Y-%m-%d 00:00:00') AS window_start, count(DISTINCT user_id) AS active_users, true AS within_2_percent
FROM clicks WHERE user_id NOT IN (SELECT user_id FROM blacklist) GROUP BY 1"""
