from __future__ import annotations

import pytest

from networks import at, four_stops, network
from waykit.operators import clock, sequences


def scores(silver, segment=sequences.SEGMENT):
    seq = sequences.with_positions(silver.sequences, "actual_sequence_position", "actual", segment)
    rows = clock.evaluate_routes(seq, silver, segment).collect()
    return {r.route_id: (r.violations, r.total_seconds) for r in rows}


CASES = {
    "no packages": ([], (0, 500.0)),
    "late": ([("B", at(0), at(50), 0)], (1, 500.0)),
    "in time": ([("B", at(0), at(1000), 0)], (0, 500.0)),
    "service without window": ([("B", None, None, 50)], (0, 550.0)),
    "on opening": ([("B", at(100), at(1000), 0)], (0, 500.0)),
    "on closing": ([("B", at(0), at(100), 0)], (0, 500.0)),
    "early": ([("B", at(101), at(1000), 0)], (1, 500.0)),
    "one-sided": ([("B", at(200), None, 0), ("B", None, at(1), 0)], (0, 500.0)),
    "NaN window": ([("B", "NaN", '"NaN"', 0)], (0, 500.0)),
    "first stop counts": ([("A", at(1), at(10), 0)], (1, 500.0)),
    "last service not counted": ([("D", None, None, 70)], (0, 500.0)),
    "packages not stops": ([("C", at(0), at(1), 10), ("C", at(0), at(1), 10)], (2, 520.0)),
    "service delays later stops": ([("C", at(0), at(150), 20)], (1, 520.0)),
}


@pytest.fixture(scope="module")
def case_scores(spark):
    routes = {
        name: {"travel": four_stops(), "order": list("ABCD"), "packages": packages}
        for name, (packages, _) in CASES.items()
    }
    return scores(network(spark, routes)), scores(network(spark, routes), segment=2)


@pytest.mark.parametrize("name", CASES)
def test_known_answers(case_scores, name):
    for got in case_scores:
        assert got[name] == CASES[name][1]


def test_positions_need_not_be_dense_and_ties_go_by_stop(spark):
    silver = network(spark, {"R": {"travel": four_stops(), "order": list("ABCD"), "positions": [-3, 9, 9, 70000]}})
    seq = sequences.with_positions(silver.sequences, "actual_sequence_position", "actual", 3)
    assert [(r.pos, r.stop_id) for r in seq.orderBy("pos").collect()] == [(0, "A"), (1, "B"), (2, "C"), (3, "D")]


def test_single_stop(spark):
    assert scores(network(spark, {"R": {"travel": {("A", "A"): 0.0}, "order": ["A"]}})) == {"R": (0, 0.0)}


def test_segments_do_not_change_results(spark):
    stops = [f"S{k:02d}" for k in range(23)]
    travel = {(a, b): float((hash_(a) * 31 + hash_(b) * 17) % 97) / 10 for a in stops for b in stops}
    packages = [(s, at(k * 3), at(k * 5 + 40), k % 7) for k, s in enumerate(stops)]
    silver = network(spark, {"R": {"travel": travel, "order": stops[::-1], "packages": packages}})
    seq = sequences.actual_sequence(silver.sequences)
    for plan in (
        lambda n: clock.route_timeline(seq, silver, n).select("pos", "arrival_us", "violations_so_far"),
        lambda n: clock.reverse_prefix(seq, silver.travel, silver.packages, n).select("pos", "reverse_us"),
    ):
        whole = sorted(map(tuple, plan(sequences.SEGMENT).collect()))
        assert len(whole) == 23
        for length in (1, 5):
            assert sorted(map(tuple, plan(length).collect())) == whole


def hash_(stop: str) -> int:
    return int(stop[1:])


def test_missing_edge_and_bad_departure_are_rejected_with_a_reason(spark):
    gap = {k: v for k, v in four_stops().items() if k != ("B", "C")}
    silver = network(
        spark,
        {
            "good": {"travel": four_stops(), "order": list("ABCD")},
            "gap": {"travel": gap, "order": list("ABCD")},
            "undated": {"travel": four_stops(), "order": list("ABCD"), "departure": "9 o'clock"},
        },
    )
    seq = sequences.actual_sequence(silver.sequences)
    assert scores(silver) == {"good": (0, 500.0)}
    rejected = {r.route_id: r.reject_reason for r in clock.rejected_sequences(seq, silver).collect()}
    assert rejected == {"gap": "MISSING_EDGE", "undated": "BAD_DEPARTURE"}


def test_each_visit_counts_and_duplicates_are_reported(spark):
    silver = network(
        spark,
        {"R": {"travel": four_stops(), "order": ["A", "B", "A", "D"], "stops": list("ABCD"),
               "packages": [("A", at(1), at(5), 0)]}},
    )
    assert scores(silver)["R"][0] == 2
    visits = clock.duplicate_visits(sequences.actual_sequence(silver.sequences)).collect()
    assert [(r.stop_id, r.visits) for r in visits] == [("A", 2)]


def test_session_time_zone_does_not_matter(spark):
    routes = {"R": {"travel": four_stops(), "order": list("ABCD"), "packages": [("C", at(0), at(150), 20)]}}
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append(scores(network(spark, routes)))
        assert results == [{"R": (1, 520.0)}] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock_times_missing_in_spring_survive(spark):
    """02:30 on a clock-change night exists, since times carry no zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.createDataFrame([("R", "D", "2018-03-11", "02:30:00", 1.0, "x")], "route_id string, station_code string, date string, departure_time_utc string, executor_capacity_cm3 double, route_score string")
        assert clock.parse_departure(rows).selectExpr("cast(departure as string) d").first().d == "2018-03-11 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
