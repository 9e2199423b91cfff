"""DuckDB SQL for the registered queries, over the same supplied tables."""

from __future__ import annotations

from waykit import fixtures
from waykit.operators.similar import BAND
from waykit.registry import SAMPLE

_MICROS = "CAST(round_even({0} * 1000000.0E0, 0) AS BIGINT)".format

# Shared steps on top of the fixture views, each a CTE.
STEPS = f"""
o_actual AS (SELECT route_id, stop_id, CAST(row_number() OVER (PARTITION BY route_id
      ORDER BY actual_sequence_position, stop_id) - 1 AS BIGINT) AS pos FROM fx_sequences),
o_sequences AS (SELECT route_id, 'actual' AS variant, pos, stop_id FROM o_actual
    UNION ALL SELECT route_id, 'nn', CAST(row_number() OVER (PARTITION BY route_id ORDER BY lat, stop_id) - 1
      AS BIGINT), stop_id FROM fx_stops
    UNION ALL SELECT route_id, 'algo', CAST(row_number() OVER (PARTITION BY route_id ORDER BY lng, stop_id) - 1
      AS BIGINT), stop_id FROM fx_stops),
o_service AS (SELECT route_id, stop_id, CAST(sum({_MICROS('planned_service_time_seconds')}) AS BIGINT)
      AS service_us FROM fx_packages GROUP BY route_id, stop_id),
o_windows AS (SELECT route_id, stop_id, package_id, epoch_us(CAST(time_window_start AS TIMESTAMP)) AS opens_us,
      epoch_us(CAST(time_window_end AS TIMESTAMP)) AS closes_us FROM fx_packages
      WHERE time_window_start IS NOT NULL AND time_window_end IS NOT NULL),
o_departures AS (SELECT route_id, epoch_us(CAST(concat(date, ' ', departure_time_utc) AS TIMESTAMP))
      AS departure_us FROM fx_routes),
o_edges AS (SELECT route_id, from_stop_id, to_stop_id, {_MICROS('travel_seconds')} AS travel_us FROM fx_travel),
o_legs AS (SELECT *, lead(stop_id) OVER w AS next_stop_id, lag(stop_id) OVER w AS prev_stop_id FROM o_sequences
      WINDOW w AS (PARTITION BY route_id, variant ORDER BY pos)),
o_costs AS (SELECT l.*, t.travel_us, b.travel_us AS back_travel_us, coalesce(s.service_us, 0) AS service_us
    FROM o_legs l
    LEFT JOIN o_edges t ON t.route_id = l.route_id AND t.from_stop_id = l.stop_id AND t.to_stop_id = l.next_stop_id
    LEFT JOIN o_edges b ON b.route_id = l.route_id AND b.from_stop_id = l.stop_id AND b.to_stop_id = l.prev_stop_id
    LEFT JOIN o_service s ON s.route_id = l.route_id AND s.stop_id = l.stop_id),
o_clock AS (SELECT c.*, d.departure_us,
      CAST(coalesce(sum(travel_us + service_us) OVER (PARTITION BY c.route_id, variant ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_us,
      CAST(coalesce(sum(back_travel_us + service_us) OVER (PARTITION BY c.route_id, variant ORDER BY pos), 0)
        AS BIGINT) AS reverse_us
    FROM o_costs c JOIN o_departures d ON d.route_id = c.route_id),
o_met AS (SELECT c.route_id, c.variant, c.pos, c.stop_id, c.departure_us + c.offset_us AS arrival_us, w.opens_us,
      w.closes_us, w.package_id,
      c.departure_us + c.offset_us < w.opens_us OR c.departure_us + c.offset_us > w.closes_us AS broken
    FROM o_clock c JOIN o_windows w ON w.route_id = c.route_id AND w.stop_id = c.stop_id),
o_stop_broken AS (SELECT route_id, variant, pos, count(*) AS violations FROM o_met WHERE broken
      GROUP BY route_id, variant, pos),
o_timeline AS (SELECT c.route_id, c.variant, c.pos, c.stop_id, c.departure_us + c.offset_us AS arrival_us,
      CAST(sum(coalesce(b.violations, 0)) OVER (PARTITION BY c.route_id, c.variant ORDER BY c.pos) AS BIGINT)
        AS violations_so_far
    FROM o_clock c LEFT JOIN o_stop_broken b USING (route_id, variant, pos)),
o_scored AS (SELECT c.route_id, c.variant, max(c.offset_us) AS total_us,
      CAST(sum(coalesce(b.violations, 0)) AS INTEGER) AS violations
    FROM o_clock c LEFT JOIN o_stop_broken b USING (route_id, variant, pos) GROUP BY c.route_id, c.variant),
o_num_stops AS (SELECT route_id, CAST(count(*) AS INTEGER) AS num_stops FROM fx_stops GROUP BY route_id),
o_gold AS (SELECT n.route_id, s.num_stops, n.total_us / 1000000.0E0 AS nn_time_seconds,
      n.violations AS nn_violations, a.total_us / 1000000.0E0 AS algo_time_seconds,
      a.violations AS algo_violations, d.total_us / 1000000.0E0 AS actual_time_seconds,
      d.violations AS actual_violations, CAST(1 AS INTEGER) AS algo_passes_run,
      d.total_us - a.total_us AS saved_us, n.total_us AS nn_us, a.total_us AS algo_us, d.total_us AS actual_us
    FROM o_scored n JOIN o_scored a ON a.route_id = n.route_id AND a.variant = 'algo'
    JOIN o_scored d ON d.route_id = n.route_id AND d.variant = 'actual'
    JOIN o_num_stops s ON s.route_id = n.route_id WHERE n.variant = 'nn'),
o_failures AS (SELECT route_id, num_stops, algo_violations, algo_time_seconds, actual_time_seconds,
      algo_passes_run FROM o_gold WHERE algo_violations > 0),
o_kpi AS (SELECT count(*) AS total_routes, CAST(sum(saved_us) AS DOUBLE) / count(*) / 60000000.0E0
      AS avg_minutes_saved, CAST(count(*) FILTER (algo_time_seconds < actual_time_seconds) AS DOUBLE) / count(*)
      * 100 AS pct_algo_faster, CAST(count(*) FILTER (algo_violations = 0) AS DOUBLE) / count(*) * 100
      AS pct_zero_violations, CAST(sum(nn_violations) AS BIGINT) AS nn_total,
      CAST(sum(algo_violations) AS BIGINT) AS algo_total FROM o_gold),
o_stations AS (SELECT route_id, min(stop_id) AS start_stop_id FROM fx_stops WHERE stop_type = 'Station'
      GROUP BY route_id),
o_sample AS (SELECT route_id FROM fx_routes ORDER BY md5(concat('42:', route_id)), route_id LIMIT {SAMPLE}),
o_requests AS (SELECT concat('RouteID_', CAST(c_custkey AS STRING)) AS route_id FROM customer),
o_ranked AS (SELECT route_id, stop_id, row_number() OVER (PARTITION BY route_id ORDER BY stop_id) - 1 AS k
      FROM fx_stops),
o_halves AS (SELECT route_id, CAST(floor(count(*) / 2.0) AS BIGINT) AS half FROM fx_stops GROUP BY route_id),
o_similar AS (SELECT g.route_id, g.num_stops, count(f.route_id) AS num_similar_cases_found FROM o_gold g
      LEFT JOIN o_failures f ON abs(f.num_stops - g.num_stops) <= {BAND} GROUP BY g.route_id, g.num_stops),
o_checked AS (SELECT *, algo_violations <= nn_violations AS guardrail_passed,
      CASE WHEN algo_violations = 0 THEN 'SAFE' WHEN algo_violations <= nn_violations
        THEN 'GUARDRAIL_OK_BUT_UNRESOLVED' ELSE 'GUARDRAIL_FAILED' END AS status,
      round_even((actual_time_seconds - algo_time_seconds) / 60 * 10, 0) / 10 AS minutes_saved_by_algorithm,
      FROM o_gold),
o_labelled AS (SELECT *, CASE status WHEN 'SAFE' THEN 'SAFE' WHEN 'GUARDRAIL_OK_BUT_UNRESOLVED'
      THEN 'NEEDS REVIEW' ELSE 'GUARDRAIL FAILED' END AS label FROM o_checked),
o_depot_actual AS (SELECT c.* FROM o_clock c JOIN o_stations s ON s.route_id = c.route_id
      WHERE c.variant = 'actual'),
o_depot_score AS (SELECT s.route_id, s.violations, s.total_us FROM o_scored s WHERE s.variant = 'actual'),
o_depot_size AS (SELECT route_id, max(pos) AS last FROM o_depot_actual GROUP BY route_id),
o_moves AS (SELECT a.route_id, a.pos AS i, b.pos AS j, m.last,
      p.offset_us + p.service_us + enter.travel_us + b.reverse_us AS base_us,
      p.offset_us + p.service_us + enter.travel_us + b.reverse_us - a.reverse_us + a.service_us
        + leave.travel_us - f.offset_us AS shift_us,
      a.reverse_us AS turn_us, z.offset_us AS end_us
    FROM o_depot_actual a
    JOIN o_depot_size m ON m.route_id = a.route_id
    JOIN o_depot_actual b ON b.route_id = a.route_id AND b.pos > a.pos AND a.pos >= 1 AND a.pos < m.last
    JOIN o_depot_actual p ON p.route_id = a.route_id AND p.pos = a.pos - 1
    JOIN o_depot_actual z ON z.route_id = a.route_id AND z.pos = m.last
    JOIN o_edges enter ON enter.route_id = a.route_id AND enter.from_stop_id = p.stop_id
      AND enter.to_stop_id = b.stop_id
    LEFT JOIN o_depot_actual f ON f.route_id = a.route_id AND f.pos = b.pos + 1
    LEFT JOIN o_edges leave ON leave.route_id = a.route_id AND leave.from_stop_id = a.stop_id
      AND leave.to_stop_id = f.stop_id),
o_depot_windows AS (SELECT m.route_id, m.pos, c.offset_us, c.reverse_us, m.opens_us - c.departure_us AS opens_us,
      m.closes_us - c.departure_us AS closes_us
    FROM o_met m JOIN o_depot_actual c ON c.route_id = m.route_id AND c.pos = m.pos WHERE m.variant = 'actual'),
o_move_windows AS (SELECT m.route_id, m.i, m.j, m.base_us, m.shift_us, m.turn_us, m.last, m.end_us,
      count(*) FILTER (CASE WHEN w.pos < m.i THEN w.offset_us < w.opens_us OR w.offset_us > w.closes_us
        WHEN w.pos <= m.j THEN m.base_us - w.reverse_us < w.opens_us OR m.base_us - w.reverse_us > w.closes_us
        ELSE w.offset_us + m.shift_us < w.opens_us OR w.offset_us + m.shift_us > w.closes_us END) AS violations
    FROM o_moves m LEFT JOIN o_depot_windows w ON w.route_id = m.route_id GROUP BY ALL),
o_move_scores AS (SELECT route_id, i, j, violations,
      CASE WHEN j = last THEN base_us - turn_us ELSE end_us + shift_us END AS total_us FROM o_move_windows),
o_walk_stops AS MATERIALIZED (SELECT route_id, stop_id, lat, lng FROM fx_stops),
o_walk AS (SELECT s.route_id, CAST(0 AS INTEGER) AS pos, w.stop_id, w.lat, w.lng, [w.stop_id] AS seen
      FROM o_stations s JOIN o_walk_stops w ON w.route_id = s.route_id AND w.stop_id = s.start_stop_id
    UNION ALL
    SELECT route_id, pos, stop_id, lat, lng, list_append(seen, stop_id) FROM (
      SELECT a.route_id, a.pos + 1 AS pos, b.stop_id, b.lat, b.lng, a.seen,
        row_number() OVER (PARTITION BY a.route_id ORDER BY
          (abs(a.lat - b.lat) + abs(a.lng - b.lng)) * 2 + (a.lat * 13 + b.lng * 17) % 101, b.stop_id) AS nearness
      FROM o_walk a JOIN o_walk_stops b ON b.route_id = a.route_id AND NOT list_contains(a.seen, b.stop_id)) q
    WHERE nearness = 1),
o_walk_sequence AS (SELECT w.route_id, w.pos, w.stop_id, lead(w.stop_id) OVER (PARTITION BY w.route_id
      ORDER BY w.pos) AS next_stop_id FROM o_walk w),
o_walk_clock AS (SELECT w.*, d.departure_us + coalesce(sum(t.travel_us + coalesce(s.service_us, 0)) OVER (
      PARTITION BY w.route_id ORDER BY w.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS arrival_us,
      d.departure_us
    FROM o_walk_sequence w JOIN o_departures d ON d.route_id = w.route_id
    LEFT JOIN o_edges t ON t.route_id = w.route_id AND t.from_stop_id = w.stop_id AND t.to_stop_id = w.next_stop_id
    LEFT JOIN o_service s ON s.route_id = w.route_id AND s.stop_id = w.stop_id),
o_walk_scored AS (SELECT c.route_id, CAST(max(c.arrival_us - c.departure_us) AS BIGINT) AS total_us,
      CAST(coalesce(sum(v.violations), 0) AS INTEGER) AS violations
    FROM o_walk_clock c LEFT JOIN (SELECT k.route_id, k.pos, count(*) AS violations FROM o_walk_clock k
      JOIN o_windows w ON w.route_id = k.route_id AND w.stop_id = k.stop_id
      WHERE k.arrival_us < w.opens_us OR k.arrival_us > w.closes_us GROUP BY k.route_id, k.pos) v
      ON v.route_id = c.route_id AND v.pos = c.pos
    GROUP BY c.route_id)
"""

_GOLD = (
    "route_id, num_stops, nn_time_seconds, nn_violations, algo_time_seconds, algo_violations, "
    "actual_time_seconds, actual_violations, algo_passes_run"
)
_DIM_PACKAGES = "SELECT * FROM fx_packages"
_INVARIANTS = ("I1 permutation", "I2 first stop kept", "I3 not worse than baseline", "I4 score reproduced", "I5 no better move left")

BODIES: dict[str, str] = {
    # Sources and sinks
    "read_route_json": """SELECT r.route_id, station_code, date, CAST(n.num_stops AS BIGINT) AS stops,
        false AS malformed FROM fx_routes r JOIN o_num_stops n ON n.route_id = r.route_id""",
    "read_package_json": """SELECT route_id, count(DISTINCT stop_id) AS stops, count(*) AS packages
        FROM fx_packages GROUP BY route_id""",
    "read_sequence_json": """SELECT route_id, count(*) AS stops, max(actual_sequence_position) AS last_position
        FROM fx_sequences GROUP BY route_id""",
    "read_travel_json": """SELECT route_id, count(DISTINCT from_stop_id) AS departures, count(*) AS entries,
        CAST(sum(travel_us) AS BIGINT) AS travel_us FROM o_edges GROUP BY route_id""",
    "read_travel_fragments": """SELECT route_id, count(DISTINCT from_stop_id) AS departures, count(*) AS entries,
        CAST(sum(travel_us) AS BIGINT) AS travel_us FROM o_edges GROUP BY route_id""",
    "read_bronze": """SELECT 'routes' AS file, count(DISTINCT route_id) AS routes, CAST(0 AS BIGINT) AS malformed
        FROM fx_routes UNION ALL SELECT 'packages', count(DISTINCT route_id), 0 FROM fx_packages
        UNION ALL SELECT 'sequences', count(DISTINCT route_id), 0 FROM fx_sequences
        UNION ALL SELECT 'travel', count(DISTINCT route_id), 0 FROM fx_travel""",
    "read_table": "SELECT route_id, stop_id, stop_type FROM fx_stops",
    "read_csv": f"SELECT {_GOLD} FROM o_gold",
    "write_overwrite": "SELECT * FROM o_failures",
    "write_append_resumable": "SELECT route_id, CAST(1 AS BIGINT) AS copies, num_stops FROM o_gold",
    "gold_schema": f"SELECT {_GOLD} FROM o_gold",
    "incremental_evaluate": f"SELECT {_GOLD} FROM o_gold",
    # Projections and flattening
    "dim_routes": "SELECT * FROM fx_routes",
    "fact_stops": "SELECT * FROM fx_stops",
    "dim_packages": _DIM_PACKAGES,
    "fact_actual_sequences": "SELECT * FROM fx_sequences",
    "fact_travel_times": """SELECT route_id, from_stop_id, count(*) AS edges,
        CAST(sum(travel_us) AS BIGINT) AS travel_us, min(to_stop_id) AS first_to, max(to_stop_id) AS last_to
        FROM o_edges GROUP BY route_id, from_stop_id""",
    "parse_departure": """SELECT route_id,
        CAST(CAST(concat(date, ' ', departure_time_utc) AS TIMESTAMP) AS VARCHAR) AS departure FROM fx_routes""",
    "parse_windows": """SELECT route_id, stop_id, package_id,
        CAST(CAST(time_window_start AS TIMESTAMP) AS VARCHAR) AS opens,
        CAST(CAST(time_window_end AS TIMESTAMP) AS VARCHAR) AS closes FROM fx_packages""",
    "travel_lookup": """SELECT e.route_id, CAST(count(*) AS INTEGER) AS cells,
        CAST(sum(travel_us * (a.k * n.num_stops + b.k + 1)) AS BIGINT) AS digest
        FROM o_edges e JOIN o_num_stops n ON n.route_id = e.route_id
        JOIN o_stations s ON s.route_id = e.route_id
        JOIN o_ranked a ON a.route_id = e.route_id AND a.stop_id = e.from_stop_id
        JOIN o_ranked b ON b.route_id = e.route_id AND b.stop_id = e.to_stop_id GROUP BY e.route_id""",
    "actual_route_list": """SELECT route_id, pos // 4096 AS segment, string_agg(stop_id, ',' ORDER BY pos) AS stops
        FROM o_actual GROUP BY ALL""",
    "stops_by_route": """SELECT route_id, CAST(k // 4096 AS BIGINT) AS segment, CAST(count(*) AS INTEGER) AS n,
        string_agg(stop_id, ',' ORDER BY stop_id) AS stop_ids FROM o_ranked GROUP BY ALL""",
    "packages_by_stop": """SELECT s.route_id, s.stop_id, s.service_us, w.windows FROM o_service s LEFT JOIN (
          SELECT route_id, stop_id, string_agg(concat(opens_us, ':', closes_us, ':', n), ',' ORDER BY opens_us,
            closes_us) AS windows FROM (SELECT route_id, stop_id, opens_us, closes_us, count(*) AS n FROM o_windows
            GROUP BY ALL) d GROUP BY route_id, stop_id) w
        ON w.route_id = s.route_id AND w.stop_id = s.stop_id""",
    "minutes_saved": "SELECT route_id, (actual_time_seconds - algo_time_seconds) / 60 AS minutes_saved FROM o_gold",
    "scatter_points": """SELECT route_id, algo_time_seconds / 60 AS algo_minutes,
        actual_time_seconds / 60 AS actual_minutes, num_stops,
        (actual_time_seconds - algo_time_seconds) / 60 AS minutes_saved, algo_violations FROM o_gold""",
    # Filters
    "filter_sample": """SELECT route_id, stop_id, stop_type FROM fx_stops
        WHERE route_id IN (SELECT route_id FROM o_sample)""",
    "filter_pending": "SELECT * FROM fx_routes WHERE route_id NOT IN (SELECT route_id FROM o_sample)",
    "station_routes": "SELECT * FROM o_stations",
    "skipped_routes": "SELECT route_id FROM fx_routes WHERE route_id NOT IN (SELECT route_id FROM o_stations)",
    "valid_windows": "SELECT * FROM o_windows",
    "window_violated": """SELECT route_id, pos, stop_id, arrival_us, opens_us, closes_us, count(*) AS packages
        FROM o_met WHERE variant = 'actual' AND broken GROUP BY ALL""",
    "failure_routes": "SELECT * FROM o_failures",
    # Joins
    "join_leg_travel": """SELECT route_id, pos, stop_id, next_stop_id, travel_us / 1000000.0E0 AS travel_seconds
        FROM o_costs
        WHERE variant = 'actual'""",
    "join_stop_service": """SELECT route_id, pos, stop_id, service_us FROM o_costs WHERE variant = 'actual'""",
    "join_arrival_windows": """SELECT route_id, pos, stop_id, arrival_us, opens_us, closes_us,
        count(*) AS packages, broken FROM o_met WHERE variant = 'actual' GROUP BY ALL""",
    "join_route_info": """SELECT route_id, pos, departure_us, departure_us + offset_us AS arrival_us FROM o_clock
        WHERE variant = 'actual'""",
    "join_optional_packages": """SELECT r.route_id, count(p.package_id) AS packages FROM fx_routes r
        LEFT JOIN fx_packages p ON p.route_id = r.route_id GROUP BY r.route_id""",
    "join_variants": f"SELECT {_GOLD} FROM o_gold",
    "similar_cases": f"""SELECT w.num_stops AS for_num_stops, f.* FROM (SELECT DISTINCT num_stops FROM o_gold) w
        JOIN o_failures f ON abs(f.num_stops - w.num_stops) <= {BAND}""",
    "similar_case_count": "SELECT * FROM o_similar",
    "request_lookup": """SELECT r.route_id, CAST(g.num_stops AS DOUBLE) AS num_stops, CASE WHEN g.route_id IS NULL
        THEN concat('No route found with id ', r.route_id) END AS error
        FROM o_requests r LEFT JOIN o_gold g ON g.route_id = r.route_id""",
    # Aggregations
    "stop_service": "SELECT * FROM o_service",
    "route_violations": """SELECT route_id, CAST(violations AS BIGINT) AS violations FROM o_scored
        WHERE variant = 'actual'""",
    "route_total_time": "SELECT route_id, total_us FROM o_scored WHERE variant = 'actual'",
    "num_stops": "SELECT * FROM o_num_stops",
    "distinct_routes": "SELECT DISTINCT route_id FROM fx_travel",
    "final_findings": """SELECT count(*) AS total_routes, CAST(sum(-saved_us) AS DOUBLE) / count(*) / 60000000.0E0
        AS avg_time_diff_minutes, count(*) FILTER (algo_time_seconds < actual_time_seconds) AS routes_algo_faster,
        count(*) FILTER (algo_violations = 0) AS routes_zero_violations FROM o_gold""",
    "kpi_summary": "SELECT * FROM o_kpi",
    "kpi_verdict": """SELECT pct_zero_violations, CASE WHEN pct_zero_violations >= 95 THEN 'success'
        ELSE 'warning' END AS verdict, concat(printf('%.1f', pct_zero_violations),
        '% of routes finished with zero violations.') AS message FROM o_kpi""",
    "violation_reduction": """SELECT nn_total, algo_total, CASE WHEN algo_total < nn_total
        THEN CAST(nn_total - algo_total AS DOUBLE) / nn_total * 100 END AS reduction_pct FROM o_kpi""",
    "violation_bars": """SELECT 'Unconstrained' AS label, nn_total AS total FROM o_kpi
        UNION ALL SELECT 'Constrained', algo_total FROM o_kpi""",
    "axis_max": """SELECT greatest(max(algo_time_seconds / 60), max(actual_time_seconds / 60)) AS axis_max
        FROM o_gold""",
    "saved_histogram": """SELECT b.bin, s.low + b.bin * s.width AS bin_start, s.low + (b.bin + 1) * s.width AS bin_end,
        count(m.bin) AS routes FROM range(25) AS b(bin)
        JOIN (SELECT min(x) AS low, (max(x) - min(x)) / 25 AS width FROM
          (SELECT (actual_time_seconds - algo_time_seconds) / 60 AS x FROM o_gold) v) s ON true
        LEFT JOIN (SELECT least(CASE WHEN width > 0 THEN CAST(floor((x - low) / width) AS BIGINT) ELSE 0 END, 24)
            AS bin FROM (SELECT (actual_time_seconds - algo_time_seconds) / 60 AS x FROM o_gold) v
          JOIN (SELECT min(x) AS low, (max(x) - min(x)) / 25 AS width FROM
            (SELECT (actual_time_seconds - algo_time_seconds) / 60 AS x FROM o_gold) v) s ON true) m
        ON m.bin = b.bin GROUP BY ALL""",
    "nn_argmin": """SELECT e.route_id, arg_min(e.to_stop_id, struct_pack(us := e.travel_us, s := e.to_stop_id))
        AS nearest_stop_id, min(e.travel_us) AS travel_us
        FROM o_edges e JOIN o_stations s ON s.route_id = e.route_id AND s.start_stop_id = e.from_stop_id
        WHERE e.to_stop_id <> e.from_stop_id GROUP BY e.route_id""",
    # Windows
    "route_legs": "SELECT route_id, pos, stop_id, next_stop_id FROM o_legs WHERE variant = 'actual'",
    "arrival_times": "SELECT route_id, pos, stop_id, offset_us FROM o_clock WHERE variant = 'actual'",
    "violation_prefix": "SELECT route_id, pos, violations_so_far FROM o_timeline WHERE variant = 'actual'",
    "reverse_prefix": "SELECT route_id, pos, reverse_us FROM o_clock WHERE variant = 'actual'",
    "first_station": """SELECT f.route_id, f.stop_id, f.lat, f.lng FROM fx_stops f JOIN o_stations s
        ON s.route_id = f.route_id AND s.start_stop_id = f.stop_id""",
    # Sort, limit, top-k
    "sample_routes": "SELECT route_id FROM o_sample",
    "order_actual": "SELECT route_id, pos, stop_id FROM o_actual",
    "best_score": """SELECT route_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
        CAST(violations AS INTEGER) AS violations, total_us FROM (SELECT *, row_number() OVER (
          PARTITION BY route_id ORDER BY violations, total_us, i, j) AS rn FROM o_move_scores) q WHERE rn = 1""",
    # Arrays and sets
    "unvisited_set": """SELECT route_id, (k - 1) // 4096 AS segment, string_agg(stop_id, ',' ORDER BY k) AS unvisited
        FROM (SELECT f.route_id, f.stop_id, row_number() OVER (PARTITION BY f.route_id ORDER BY f.stop_id) AS k
          FROM fx_stops f JOIN o_halves h ON h.route_id = f.route_id
          JOIN o_actual a ON a.route_id = f.route_id AND a.stop_id = f.stop_id AND a.pos >= h.half) GROUP BY ALL""",
    "reverse_segment": """SELECT route_id, p // 4096 AS segment, string_agg(stop_id, ',' ORDER BY p) AS stops
        FROM (SELECT a.route_id, a.stop_id, CASE WHEN a.pos BETWEEN 1 AND h.half THEN h.half + 1 - a.pos
          ELSE a.pos END AS p FROM o_actual a JOIN o_halves h ON h.route_id = a.route_id) GROUP BY ALL""",
    "setdefault_append": """SELECT route_id, (k - 1) // 4096 AS segment,
        string_agg(concat(stop_id, '=', service_us), ',' ORDER BY k) AS service_by_stop
        FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY stop_id) AS k FROM o_service)
        GROUP BY ALL""",
    "permutation_check": """SELECT f.route_id, count(*) = count(a.stop_id) AND count(*) = count(DISTINCT a.stop_id)
        AS is_permutation FROM fx_stops f LEFT JOIN o_actual a ON a.route_id = f.route_id AND a.stop_id = f.stop_id
        GROUP BY f.route_id""",
    # Route operators
    "pack_routes": """SELECT n.route_id, n.num_stops AS n, n.num_stops, CAST(s.k AS INTEGER) AS start, l.last_stop_id,
        coalesce(v.service_us, 0) AS service_us, d.digest, coalesce(w.windowed, 0) AS windowed_packages,
        coalesce(w.windows_digest, 0) AS windows_digest
        FROM o_num_stops n
        JOIN (SELECT t.route_id, r.k FROM o_stations t JOIN o_ranked r ON r.route_id = t.route_id
          AND r.stop_id = t.start_stop_id) s ON s.route_id = n.route_id
        JOIN (SELECT route_id, max(stop_id) AS last_stop_id FROM fx_stops GROUP BY route_id) l
          ON l.route_id = n.route_id
        LEFT JOIN (SELECT o.route_id, CAST(sum(o.service_us) AS BIGINT) AS service_us FROM o_service o
          JOIN o_ranked r ON r.route_id = o.route_id AND r.stop_id = o.stop_id GROUP BY o.route_id) v
          ON v.route_id = n.route_id
        JOIN (SELECT e.route_id, CAST(sum(travel_us * (a.k * m.num_stops + b.k + 1)) AS BIGINT) AS digest
          FROM o_edges e JOIN o_num_stops m ON m.route_id = e.route_id
          JOIN o_ranked a ON a.route_id = e.route_id AND a.stop_id = e.from_stop_id
          JOIN o_ranked b ON b.route_id = e.route_id AND b.stop_id = e.to_stop_id GROUP BY e.route_id) d
          ON d.route_id = n.route_id
        LEFT JOIN (SELECT o.route_id, count(*) AS windowed,
            CAST(sum((o.opens_us - p.departure_us) * (r.k + 1)) AS BIGINT) AS windows_digest
          FROM o_windows o JOIN o_departures p ON p.route_id = o.route_id
          JOIN o_ranked r ON r.route_id = o.route_id AND r.stop_id = o.stop_id GROUP BY o.route_id) w
          ON w.route_id = n.route_id""",
    "nearest_neighbor": "SELECT route_id, pos, stop_id FROM o_walk",
    "evaluate_routes": """SELECT route_id, violations, total_us / 1000000.0E0 AS total_seconds FROM o_scored
        WHERE variant = 'actual'""",
    "evaluate_variants_long": """SELECT route_id, variant, violations, total_us / 1000000.0E0 AS total_seconds
        FROM o_scored""",
    "route_timeline": """SELECT route_id, pos, stop_id, arrival_us, violations_so_far FROM o_timeline
        WHERE variant = 'actual'""",
    "score_two_opt_moves": """SELECT route_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS best_j,
        CAST(violations AS INTEGER) AS violations, total_us, CAST(improving AS INTEGER) AS improving_moves FROM (
          SELECT m.route_id, m.i, m.j, m.violations, m.total_us,
            count(*) FILTER (m.violations < s.violations OR (m.violations = s.violations AND m.total_us < s.total_us))
              OVER (PARTITION BY m.route_id, m.i) AS improving,
            row_number() OVER (PARTITION BY m.route_id, m.i ORDER BY m.violations, m.total_us, m.j) AS rn
          FROM o_move_scores m JOIN o_depot_score s ON s.route_id = m.route_id) q WHERE rn = 1""",
    "route_comparison_baselines": """SELECT w.route_id, n.num_stops, w.total_us / 1000000.0E0 AS nn_time_seconds,
        w.violations AS nn_violations, a.total_us / 1000000.0E0 AS actual_time_seconds,
        a.violations AS actual_violations FROM o_walk_scored w JOIN o_num_stops n ON n.route_id = w.route_id
        JOIN o_scored a ON a.route_id = w.route_id AND a.variant = 'actual'""",
    "two_opt_invariants": " UNION ALL ".join(
        f"SELECT '{name}' AS invariant, CAST(0 AS BIGINT) AS broken, count(*) AS routes FROM o_stations"
        for name in _INVARIANTS
    ),
    # Guardrail and investigation
    "route_summary": """SELECT r.route_id, CAST(g.num_stops AS DOUBLE) AS num_stops, g.nn_time_seconds,
        CAST(g.nn_violations AS DOUBLE) AS nn_violations, g.algo_time_seconds,
        CAST(g.algo_violations AS DOUBLE) AS algo_violations, g.actual_time_seconds,
        CAST(g.actual_violations AS DOUBLE) AS actual_violations,
        CAST(g.algo_passes_run AS DOUBLE) AS algo_passes_run,
        CASE WHEN g.route_id IS NULL THEN concat('No route found with id ', r.route_id) END AS error
        FROM o_requests r LEFT JOIN o_gold g ON g.route_id = r.route_id""",
    "validate_routes": """SELECT route_id, algo_violations, nn_violations AS baseline_violations, guardrail_passed,
        status FROM o_checked""",
    "compare_to_actual": """SELECT route_id, round_even(algo_time_seconds / 60 * 10, 0) / 10 AS algorithm_minutes,
        round_even(actual_time_seconds / 60 * 10, 0) / 10 AS actual_driver_minutes, minutes_saved_by_algorithm,
        (actual_time_seconds - algo_time_seconds) / 60 > 0 AS algorithm_was_faster FROM o_checked""",
    "status_counts": "SELECT status, count(*) AS routes FROM o_checked GROUP BY status",
    "review_label": "SELECT route_id, label FROM o_labelled",
    "investigation_report": """SELECT r.route_id, CAST(g.num_stops AS DOUBLE) AS num_stops, g.nn_time_seconds,
        CAST(g.nn_violations AS DOUBLE) AS nn_violations, g.algo_time_seconds,
        CAST(g.algo_violations AS DOUBLE) AS algo_violations, g.actual_time_seconds,
        CAST(g.actual_violations AS DOUBLE) AS actual_violations, CAST(g.algo_passes_run AS DOUBLE) AS algo_passes_run,
        CAST(g.nn_violations AS DOUBLE) AS baseline_violations, g.guardrail_passed, g.status,
        round_even(g.algo_time_seconds / 60 * 10, 0) / 10 AS algorithm_minutes,
        round_even(g.actual_time_seconds / 60 * 10, 0) / 10 AS actual_driver_minutes,
        g.minutes_saved_by_algorithm,
        (g.actual_time_seconds - g.algo_time_seconds) / 60 > 0 AS algorithm_was_faster, CASE WHEN g.status <> 'SAFE' THEN CAST(s.num_similar_cases_found AS DOUBLE) END
          AS num_similar_cases_found, g.label,
        CASE WHEN g.route_id IS NULL THEN concat('No route found with id ', r.route_id) END AS error
        FROM o_requests r LEFT JOIN o_labelled g ON g.route_id = r.route_id
        LEFT JOIN o_similar s ON s.route_id = g.route_id""",
}


# Constrained 2-opt: one row per route, one step of the scan per round. A step takes the first end, from ``j0`` on, whose
# reversal from ``i`` is better; it is scored from the prefix sums ``arr`` (arrivals) and ``bk`` (driving backwards).
_MAX_PASSES = 10


def _sums(order: str, cost: str) -> str:
    """Prefix sums over an order of ``cost``, an expression of the position ``q`` before the leg."""
    return (
        f"list_transform(range(0, n), lambda p: CAST(coalesce(list_sum(list_transform(range(0, p), "
        f"lambda q: {cost.format(o=order)})), 0) AS BIGINT))"
    )


_ARRIVE = "mat[{o}[q + 1] * n + {o}[q + 2] + 1] + svc[{o}[q + 1] + 1]"
_BACK = "mat[{o}[q + 2] * n + {o}[q + 1] + 1] + svc[{o}[q + 2] + 1]"
_PLACES = "list_transform(win, lambda w: list_position({o}, w.k) - 1)"
_LATE = "CAST({t} < win[x].o OR {t} > win[x].c AS INTEGER)"


def _broken(arrival: str) -> str:
    return (
        "CAST(coalesce(list_sum(list_transform(range(1, len(win) + 1), lambda x: " + _LATE.format(t=f"({arrival})") + ")), 0) AS BIGINT)"
    )


TWO_OPT_STEPS = f"""
o_const AS MATERIALIZED (SELECT r.route_id, r.n, r.stops, r.svc, m.mat, coalesce(w.win, []) AS win
    FROM (SELECT k.route_id, count(*) AS n, list(k.stop_id ORDER BY k.k) AS stops,
        list(coalesce(s.service_us, 0) ORDER BY k.k) AS svc FROM o_ranked k
        LEFT JOIN o_service s ON s.route_id = k.route_id AND s.stop_id = k.stop_id GROUP BY k.route_id) r
    JOIN o_stations d ON d.route_id = r.route_id
    JOIN (SELECT route_id, list(travel_us ORDER BY from_stop_id, to_stop_id) AS mat FROM o_edges GROUP BY route_id) m
      ON m.route_id = r.route_id
    LEFT JOIN (SELECT w.route_id, list(struct_pack(k := k.k, o := w.opens_us - p.departure_us,
        c := w.closes_us - p.departure_us) ORDER BY w.package_id) AS win FROM o_windows w
        JOIN o_ranked k ON k.route_id = w.route_id AND k.stop_id = w.stop_id
        JOIN o_departures p ON p.route_id = w.route_id GROUP BY w.route_id) w ON w.route_id = r.route_id),
o_begin AS MATERIALIZED (SELECT *, {_broken("arr[wpos[x] + 1]")} AS viol, arr[n] AS total FROM (
    SELECT c.*, o.ord, {_sums("ord", _ARRIVE)} AS arr, {_sums("ord", _BACK)} AS bk, {_PLACES.format(o="ord")} AS wpos
    FROM o_const c JOIN (SELECT w.route_id, list(k.k ORDER BY w.pos) AS ord FROM o_walk w
      JOIN o_ranked k ON k.route_id = w.route_id AND k.stop_id = w.stop_id GROUP BY w.route_id) o ON o.route_id = c.route_id)),
o_scan AS (SELECT route_id, ord, arr, bk, wpos, viol, total, 1 AS i, 2 AS j0, false AS moved, 0 AS passes, false AS done
    FROM o_begin
  UNION ALL
  SELECT route_id, ord2,
    CASE WHEN hit IS NULL THEN arr ELSE {_sums("ord2", _ARRIVE)} END,
    CASE WHEN hit IS NULL THEN bk ELSE {_sums("ord2", _BACK)} END,
    CASE WHEN hit IS NULL THEN wpos ELSE {_PLACES.format(o="ord2")} END,
    coalesce(hit.v, viol), coalesce(hit.t, total),
    CASE WHEN at_end THEN 1 WHEN hit IS NULL OR hit.j = n - 1 THEN i + 1 ELSE i END,
    CASE WHEN at_end THEN 2 WHEN hit IS NULL OR hit.j = n - 1 THEN i + 2 ELSE CAST(hit.j + 1 AS INTEGER) END,
    CASE WHEN at_end THEN false ELSE moved OR hit IS NOT NULL END,
    CASE WHEN at_end THEN passes + 1 ELSE passes END,
    at_end AND (NOT moved OR passes + 1 >= {_MAX_PASSES})
  FROM (SELECT *, CASE WHEN hit IS NULL THEN ord
      ELSE list_concat(list_concat(ord[1:i], list_reverse(ord[i + 1:hit.j + 1])), ord[hit.j + 2:]) END AS ord2
    FROM (SELECT *, CASE WHEN at_end THEN NULL ELSE list_filter(
        list_transform(CASE WHEN viol = 0 THEN list_filter(ends, lambda m: m.t < total) ELSE ends END,
          lambda m: struct_pack(j := m.j, t := m.t, v := {_broken("CASE WHEN wpos[x] < i THEN arr[wpos[x] + 1] WHEN wpos[x] <= m.j THEN m.b - bk[wpos[x] + 1] ELSE arr[wpos[x] + 1] + m.s END")})),
        lambda m: m.v < viol OR (m.v = viol AND m.t < total))[1] END AS hit
      FROM (SELECT *, list_transform(bases, lambda m: struct_pack(j := m.j, b := m.b,
          s := m.b - bk[i + 1] + svc[ord[i + 1] + 1] + mat[ord[i + 1] * n + ord[m.j + 2] + 1] - arr[m.j + 2],
          t := CASE WHEN m.j = n - 1 THEN m.b - bk[i + 1] ELSE arr[n] + m.b - bk[i + 1] + svc[ord[i + 1] + 1]
            + mat[ord[i + 1] * n + ord[m.j + 2] + 1] - arr[m.j + 2] END)) AS ends
        FROM (SELECT z.*, c.n, c.mat, c.svc, c.win, z.i > c.n - 2 AS at_end,
            list_transform(CASE WHEN z.i > c.n - 2 THEN [] ELSE range(z.j0, c.n) END, lambda j: struct_pack(j := j,
              b := z.arr[z.i] + c.svc[z.ord[z.i] + 1] + c.mat[z.ord[z.i] * c.n + z.ord[j + 1] + 1] + z.bk[j + 1])) AS bases
          FROM o_scan z JOIN o_const c ON c.route_id = z.route_id WHERE NOT z.done))))),
o_improved AS (SELECT z.route_id, array_to_string(list_transform(z.ord, lambda k: c.stops[k + 1]), ',') AS algo_stops,
    CAST(z.viol AS INTEGER) AS algo_violations, z.total / 1000000.0E0 AS algo_time_seconds, z.passes AS algo_passes_run
    FROM o_scan z JOIN o_const c ON c.route_id = z.route_id WHERE z.done)
"""

TWO_OPT_BODIES = {
    "two_opt_constrained": "SELECT * FROM o_improved",
    "route_comparison": f"""SELECT {_GOLD} FROM (SELECT w.route_id, n.num_stops, w.total_us / 1000000.0E0 AS nn_time_seconds,
        w.violations AS nn_violations, i.algo_time_seconds, i.algo_violations,
        a.total_us / 1000000.0E0 AS actual_time_seconds, a.violations AS actual_violations, i.algo_passes_run
        FROM o_walk_scored w JOIN o_num_stops n ON n.route_id = w.route_id
        JOIN o_scored a ON a.route_id = w.route_id AND a.variant = 'actual' JOIN o_improved i ON i.route_id = w.route_id)""",
}


def oracle_sql() -> dict[str, str]:
    head = f"WITH RECURSIVE {fixtures.oracle_ctes()},\n{STEPS.strip()}"
    found = {name: f"{head}\n{body}" for name, body in BODIES.items()}
    return found | {name: f"{head},\n{TWO_OPT_STEPS.strip()}\n{body}" for name, body in TWO_OPT_BODIES.items()}
