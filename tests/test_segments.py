"""Stop lists in segments, and single steps as library functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from networks import at, four_stops, network
from waykit.operators import nearest, packing, segments, sequences


@pytest.fixture(scope="module")
def silver(spark):
    odd = {"travel": four_stops(), "order": ["A", "B", "A"], "stops": list("ABC")}
    repeated = {"travel": four_stops(), "order": list("AB"), "stops": ["A", "B", "B"]}
    packages = [("C", at(0), at(9), 20), ("A", None, None, 5), ("C", None, None, 1)]
    return network(spark, {"R": {"travel": four_stops(), "order": list("DBCA"), "packages": packages}, "odd": odd, "twice": repeated})


def entries(df) -> dict:
    return {(r["route_id"], r["segment"]): [tuple(e) for e in r["entries"]] for r in df.collect()}


@pytest.mark.parametrize("segment", [2, 4096])
def test_lists_are_cut_into_segments(silver, segment):
    driven = entries(segments.actual_route_list(silver.sequences, segment))
    whole = [x for (r, _), v in sorted(driven.items()) if r == "R" for x in v]
    assert whole == [("D",), ("B",), ("C",), ("A",)] and len(driven) == (5 if segment == 2 else 3)
    stops = entries(segments.stops_by_route(silver.stops, segment))
    of = lambda route: [x for (r, _), v in sorted(stops.items()) if r == route for x in v]
    assert of("R") == [("A", "Dropoff"), ("B", "Dropoff"), ("C", "Dropoff"), ("D", "Station")]
    assert [s for s, _ in of("twice")] == ["A", "B", "B"]
    maps = {(r["route_id"], r["segment"]): r["services"] for r in segments.service_by_stop(silver.packages, segment).collect()}
    assert maps == {("R", 0): {"A": 5_000_000, "C": 21_000_000}}


def test_reversal_unvisited_and_permutations(silver):
    seq = sequences.actual_sequence(silver.sequences)
    turned = entries(segments.listed(segments.reversed_between(seq.where("route_id = 'R'"), F.lit(1), F.lit(3))))
    assert turned == {("R", 0): [("D",), ("A",), ("C",), ("B",)]}
    seen = seq.where("pos < 2").select("route_id", "stop_id")
    assert entries(segments.unvisited(silver.stops, seen)) == {("R", 0): [("A",), ("C",)], ("odd", 0): [("C",)]}
    judged = {r["route_id"]: r["is_permutation"] for r in segments.permutation_check(seq, silver.stops).collect()}
    assert judged == {"R": True, "odd": False, "twice": False}


def test_a_long_route_never_is_one_row(spark):
    n, segment = 30_000, 1_000
    number = (F.col("id") * 7) % n
    stop = F.format_string("S%06d", number)
    seq = spark.range(n).select(F.lit("R").alias("route_id"), stop.alias("stop_id"), F.col("id").alias("actual_sequence_position"))
    stops = seq.select("route_id", "stop_id", F.lit("Dropoff").alias("stop_type"))
    held = entries(segments.actual_route_list(seq, segment))
    assert len(held) == n // segment and all(len(v) == segment for v in held.values())
    assert [s for k in sorted(held) for (s,) in held[k]] == [f"S{i * 7 % n:06d}" for i in range(n)]
    by_id = entries(segments.stops_by_route(stops, segment))
    assert [s for k in sorted(by_id) for s, _ in by_id[k]] == [f"S{i:06d}" for i in range(n)]
    driven = sequences.with_positions(seq, "actual_sequence_position", "actual", segment)
    assert segments.permutation_check(driven, stops).first()["is_permutation"]
    assert not segments.permutation_check(driven.where("pos > 0"), stops).first()["is_permutation"]
    turned = segments.reversed_between(driven, F.lit(1), F.lit(n - 1))
    rows = entries(segments.listed(turned, segment=segment))
    assert max(map(len, rows.values())) == segment and rows[("R", 0)][1] == (f"S{(n - 1) * 7 % n:06d}",)


def test_single_steps(spark, silver):
    heads = packing.first_station(silver.stops).select("route_id", "stop_id")
    steps = {r["route_id"]: (r["nearest_stop_id"], r["travel_us"]) for r in nearest.nearest_step(heads, heads, silver.travel).collect()}
    assert steps["R"] == ("B", 100_000_000)  # B and C are equally near
    more = heads.union(spark.createDataFrame([("R", "B")], "route_id string, stop_id string"))
    assert nearest.nearest_step(heads, more, silver.travel).where("route_id = 'R'").first()["nearest_stop_id"] == "C"
    counted = {r["route_id"]: r["packages"] for r in packing.join_optional_packages(silver.routes, silver.packages).collect()}
    assert counted == {"R": 3, "odd": 0, "twice": 0}
