"""Travel as bucketed matrix blocks, ranks by splitters, and the plans that follow from them."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from networks import at, four_stops, network, random_travel
from waykit import fixtures, schemas
from waykit.operators import clock, nearest, packing, sequences
from waykit.plans import gold
from waykit.sources import silver_store, travel_blocks


def routes() -> dict[str, dict]:
    names = [f"S{k:02d}" for k in range(12)]
    gap = {k: v for k, v in four_stops().items() if k != ("B", "C")}
    foreign = dict(four_stops()) | {("A", "X"): 1.0, ("X", "A"): 1.0, ("Y", "Z"): 2.0}
    odd = dict(four_stops()) | {("A", "B"): float("nan"), ("C", "D"): 1e12}
    twelve = {"travel": random_travel(names, 3), "order": names[::-1], "packages": [(s, at(k * 90), at(k * 200 + 300), k) for k, s in enumerate(names)]}
    return {
        "twelve": twelve,
        "plain": {"travel": four_stops(), "order": list("ABCD"), "packages": [("C", at(0), at(150), 20), ("C", at(0), None, 5)]},
        "gap": {"travel": gap, "order": list("ABCD")},
        "foreign": {"travel": foreign, "order": list("ABCD")},
        "odd": {"travel": odd, "order": list("ABCD")},
        "one": {"travel": {}, "order": ["A"]},
        "undated": {"travel": four_stops(), "order": list("ABCD"), "departure": "soon"},
        "faulty": {"travel": four_stops(), "order": list("ABCD"), "packages": [("B", "noon", at(5), 1)]},
    }


def with_blocks(spark, silver, path, block_edges=travel_blocks.BLOCK_EDGES):
    travel_blocks.write_blocks(silver.travel, str(path), 6, block_edges)
    return replace(silver, blocks=travel_blocks.load_blocks(spark, str(path)))


@pytest.fixture(scope="module")
def silver(spark):
    found = network(spark, routes())
    slower = found.travel.where("from_stop_id = 'A'").withColumn("travel_seconds", F.col("travel_seconds") + 7)
    return replace(found, travel=found.travel.union(slower))  # repeated edges count with their smallest time


@pytest.mark.parametrize("block_edges", [travel_blocks.BLOCK_EDGES, 20, 1])
def test_blocks_give_what_edges_give(spark, silver, tmp_path, block_edges):
    stored = with_blocks(spark, silver, tmp_path, block_edges)
    assert stored.blocks.any_spread == (block_edges < 100)
    seq = sequences.actual_sequence(silver.sequences)
    plans = {
        "legs": lambda s: clock.join_leg_travel(sequences.route_legs(seq), s.times),
        "scores": lambda s: clock.score_sequences(seq, s),
        "timeline": lambda s: clock.route_timeline(seq, s).select("route_id", "pos", "arrival_us", "violations_so_far"),
        "reverse": lambda s: clock.reverse_prefix(seq, s.times, s.packages).select("route_id", "pos", "reverse_us"),
    }
    if block_edges == travel_blocks.BLOCK_EDGES:
        plans["packed"] = lambda s: packing.pack_routes(s).select("route_id", "stop_ids", "matrix_us", "service_us", "windows")
        plans["rejects"] = packing.packing_rejects
        plans["gold"] = gold.route_comparison
        plans["digests"] = lambda s: gold.matrix_digests(s).where("route_id <> 'odd'")
    for name, plan in plans.items():
        by_edges, by_blocks = (sorted(map(str, plan(s).collect())) for s in (silver, stored))
        assert by_edges == by_blocks and by_edges, name


def test_routes_in_several_blocks_are_solved_alike(spark, tmp_path):
    found = network(spark, {"R": routes()["twelve"], "four": routes()["plain"]})
    stored = with_blocks(spark, found, tmp_path, 100)
    assert [r["route_id"] for r in stored.blocks.spread.collect()] == ["R"]
    assert packing.RouteCut(stored).any_long
    assert sorted(gold.route_comparison(stored).collect()) == sorted(gold.route_comparison(found).collect())


def test_another_session_reads_the_buckets(spark, silver, tmp_path):
    silver_store.write_silver(silver, str(tmp_path))
    spark.sql(f"DROP TABLE {travel_blocks._table(f'{tmp_path}/travel_blocks')}")
    again = silver_store.load_silver(spark, str(tmp_path))
    assert again.blocks.blocks.count() == len(routes()) - 1  # one route has no edge
    seq = sequences.actual_sequence(again.sequences)
    assert sorted(clock.evaluate_routes(seq, again).collect()) == sorted(clock.evaluate_routes(seq, silver).collect())
    only = again.semi(spark.createDataFrame([("plain",)], "route_id string"))
    assert only.blocks.blocks.count() == 1
    assert travel_blocks.load_blocks(spark, str(tmp_path / "nowhere")) is None


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def above(plan: str, mark: str) -> list[str]:
    """The operators over the scan that ``mark`` names, nearest first."""
    lines = [(len(re.match(r"[\s:+\-*|]*", x).group()), x) for x in plan.split("\n")]
    k = next(i for i, (_, x) in enumerate(lines) if mark in x)
    depth, out = lines[k][0], []
    for indent, x in reversed(lines[:k]):
        if indent < depth:
            depth = indent
            out.append(re.sub(r"^[\s:+\-*|]*(\(\d+\) )?", "", x))
    return out


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_edge_is_shuffled(spark, silver, tmp_path, shuffled_joins):
    stored = with_blocks(spark, silver, tmp_path)
    seq = sequences.actual_sequence(stored.sequences)
    packed = above(final_plan(packing.pack_routes(stored)), "waykit_blocks")
    assert any("Join" in x for x in packed) and not any("Exchange" in x for x in packed)
    for df in (clock.evaluate_routes(seq, stored), clock.route_timeline(seq, stored)):
        over = above(final_plan(df), "waykit_blocks")
        join = next(i for i, x in enumerate(over) if "Join" in x)
        assert not any("Exchange" in x for x in over[:join])


def test_blocks_are_read_few_routes_at_once(spark, tmp_path):
    """All rows of a row group are decoded together, so well encoded matrices of many routes must not share one."""
    n, m = 1200, 60
    stops = spark.range(n * m).select(
        F.format_string("R%04d", F.floor(F.col("id") / m)).alias("route_id"), F.format_string("S%02d", F.col("id") % m).alias("stop_id"),
        (F.col("id") * 7919 % 997).cast("double").alias("lat"), (F.col("id") * 104729 % 991).cast("double").alias("lng"),
    )
    travel_blocks.write_matrices(stops, fixtures.matrices, str(tmp_path), 1)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "blocks").glob("*.parquet")]
    groups = [f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert sum(groups) == n and max(groups) * m * m < 2_000_000
    times = travel_blocks.load_blocks(spark, str(tmp_path)).blocks.select(F.explode(F.flatten("times")).alias("us"))
    want = fixtures.matrices(stops, 2).select(F.explode(F.flatten("times")).alias("us"))
    assert times.agg(F.count("us"), F.sum("us")).first() == want.agg(F.count("us"), F.sum("us")).first()


def test_plans_stay_small(spark, silver, tmp_path, shuffled_joins):
    stored = with_blocks(spark, silver, tmp_path)
    seq = sequences.actual_sequence(stored.sequences)
    for df, most in ((clock.evaluate_routes(seq, stored), 12), (clock.route_timeline(seq, stored), 13)):
        initial = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange (?:hash|range|Single|Round)", initial)) <= 16
        assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range|Single|Round)", final_plan(df))) <= most


@pytest.mark.parametrize("kind", ["tied", "dense", "repeated"])
def test_ranks_of_a_long_route_are_exact_and_evenly_dealt(spark, monkeypatch, kind):
    n, segment = 40_000, 2_000
    order = {"tied": F.lit(5), "dense": F.col("id") % 997, "repeated": F.lit(1)}[kind].cast("bigint")
    stop = F.lit("same") if kind == "repeated" else F.format_string("S%06d", (F.col("id") * 7919) % n)
    long = spark.range(n).select(F.lit("R").alias("route_id"), stop.alias("stop_id"), order.alias("actual_sequence_position"))
    short = spark.createDataFrame([("short", "b", 2), ("short", "a", 2), ("short", "c", -1)], schemas.FACT_ACTUAL_SEQUENCES)
    tables, keep = [], sequences.written
    monkeypatch.setattr(sequences, "written", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    rows = sequences.with_positions(long.union(short), "actual_sequence_position", "actual", segment).collect()
    assert [r["stop_id"] for r in sorted(rows, key=lambda r: r["pos"]) if r["route_id"] == "short"] == ["c", "a", "b"]
    got = [r for r in rows if r["route_id"] == "R"]
    assert sorted(r["pos"] for r in got) == list(range(n))
    key = {(r["stop_id"]): r["actual_sequence_position"] for r in long.collect()}
    ranked = [(key[r["stop_id"]], r["stop_id"]) for r in sorted(got, key=lambda r: r["pos"])]
    assert ranked == sorted(ranked)
    sizes = sorted(Counter(r["_seg"] for r in tables[0].select("_seg").collect()).values())
    assert len(sizes) > 10 and sizes[-1] < 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("block_edges", [travel_blocks.BLOCK_EDGES, 1])
def test_the_nearest_stop_comes_from_blocks_as_from_edges(spark, silver, tmp_path, block_edges):
    stored = with_blocks(spark, silver, tmp_path, block_edges)
    heads = silver.stops.groupBy("route_id").agg(F.min("stop_id").alias("stop_id"))
    heads = heads.union(spark.createDataFrame([("plain", "nowhere"), ("unknown", "A"), ("plain", "A")], heads.schema))
    visited = heads.union(spark.createDataFrame([("twelve", f"S{k:02d}") for k in range(6)], heads.schema))
    rows = lambda travel: sorted(map(tuple, nearest.nearest_step(heads, visited, travel).collect()))
    assert rows(stored.times) == rows(silver.travel)
    assert len(rows(stored.times)) == 7  # all but the route of one stop


def test_legs_across_borders_of_segments(spark):
    stops = [f"S{k:02d}" for k in range(11)]
    found = network(spark, {"R": {"travel": {}, "order": stops[::-1]}, "Q": {"travel": {}, "order": stops[:3]}})
    seq = sequences.actual_sequence(found.sequences)
    for legs in (sequences.route_legs, sequences.back_legs):
        whole = sorted(map(str, legs(seq).collect()))
        assert len(whole) == 14
        for segment in (1, 3, 11):
            assert sorted(map(str, legs(seq, segment).select(*legs(seq).columns).collect())) == whole
