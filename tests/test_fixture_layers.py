"""What the queries' input costs: only the tables and files asked for, and no edge of a matrix outside its route's row."""

from __future__ import annotations

import json
import os
from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from waykit import fixtures
from waykit.functions import clock_math as cm
from waykit.llm.common import stored
from waykit.operators.sequences import actual_sequence, measured
from waykit.plans import documents
from waykit.registry import QUERIES
from waykit.session import kept_by_route
from waykit.sources import keyed_json, tables, travel_blocks


@pytest.fixture
def sf_dir(spark, tmp_path):
    orders = [(k, date(2018, 7, 1 + k % 20), "1-URGENT" if k % 9 == 0 else "5-LOW" if k % 4 else "3-MEDIUM") for k in range(150)]
    orders += [orders[3]]
    lines = [(k, n, k * 7 % 20 + 1, k % 5 + 1, "F" if n else "O", 3.0, "R", 0.05) for k in range(150) for n in range(k % 3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate date, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, l_linestatus string,"
        " l_quantity double, l_returnflag string, l_discount double",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def layers(sf_dir: str) -> set[str]:
    return {layer for _, folder, layer in fixtures._written if folder == sf_dir}


def test_a_reader_lands_its_own_file_only(spark, sf_dir):
    assert QUERIES["dim_routes"](spark, sf_dir).count() == 13
    assert layers(sf_dir) == {"bronze/route_data.json", "silver-routes", "silver-stops"}
    assert QUERIES["read_travel_json"](spark, sf_dir).count() == 13
    assert "silver-travel" not in layers(sf_dir) and "bronze/package_data.json" not in layers(sf_dir)
    root = fixtures.bronze_root(spark, sf_dir)
    assert sorted(os.listdir(root)) == sorted(keyed_json.RAW_FILES[:4])


def test_documents_of_matrices_are_those_of_edges(spark, sf_dir):
    s = fixtures.silver(spark, sf_dir)
    text = lambda docs: sorted(
        (r.route_id, r.f, r.t) for r in docs.select(
            "route_id", F.explode("doc").alias("f", "targets")
        ).select("route_id", "f", F.to_json("targets").alias("t")).collect()
    )
    assert text(fixtures._travel_documents(s)) == text(documents.route_travel_docs(s))


@pytest.mark.parametrize("block_edges", [travel_blocks.BLOCK_EDGES, 100])
def test_blocks_of_matrices_are_those_of_edges(spark, sf_dir, tmp_path, block_edges):
    stops, travel = (getattr(fixtures.derive(spark, sf_dir), n) for n in ("stops", "travel"))
    stops = stops.unionByName(stops.limit(1).withColumns({"route_id": F.lit(None), "stop_id": F.lit(None)}))
    travel_blocks.write_blocks(travel, f"{tmp_path}/a", 3, block_edges)
    travel_blocks.write_matrices(stops, fixtures.matrices, f"{tmp_path}/b", 3, block_edges)
    a, b = (travel_blocks.load_blocks(spark, f"{tmp_path}/{n}") for n in "ab")
    assert a.any_spread == b.any_spread == (block_edges == 100)
    assert sorted(a.spread.collect()) == sorted(b.spread.collect())
    assert sorted(a.blocks.collect()) == sorted(b.blocks.collect()) and a.blocks.count() >= 13
    edges = travel_blocks.matrix_edges(fixtures.matrices(stops.where("route_id IS NOT NULL"), 2))
    assert sorted(edges.collect()) == sorted(travel.collect())


def test_scores_need_no_edge_table(spark, sf_dir):
    assert QUERIES["evaluate_routes"](spark, sf_dir).count() > 0
    assert "travel-blocks" in layers(sf_dir) and "silver-travel" not in layers(sf_dir)


def test_packages_are_dealt_once(spark, sf_dir):
    s = fixtures.silver(spark, sf_dir)
    plan = documents.route_package_docs(s)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_line_items_are_dealt_by_ranges_of_their_key(spark, tmp_path):
    spark.createDataFrame([(7, date(2018, 7, 1), "5-LOW")], "o_orderkey bigint, o_orderdate date, o_orderpriority string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    lines = [(None if k == 0 else 7, k % 3, k // 2, 1, "F", 3.0, "R", 0.05) for k in range(400)]
    spark.createDataFrame(
        lines + lines[:30],
        "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, l_linestatus string,"
        " l_quantity double, l_returnflag string, l_discount double",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    packages = fixtures.derive(spark, str(tmp_path)).packages
    plan = packages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1
    assert "Sort" not in plan.partition("Exchange rangepartitioning")[2]  # what stands below the exchange
    sums = [r["planned_service_time_seconds"] for r in packages.collect()]
    assert len(sums) == 400 and sum(sums) == 430 * 3.0 and sums.count(6.0) == 30
    conf, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(conf, "false")
    try:
        tasks = fixtures.derive(spark, str(tmp_path)).packages.where("stop_id = 'S7'").groupBy(F.spark_partition_id()).count()
        assert sorted(r["count"] > 50 for r in tasks.collect()) == [True] * 4  # one order's lines, in every task
    finally:
        spark.conf.set(conf, before)


def test_matrices_are_worked_out_as_arrays(spark):
    rows = [("a", "s1", 3.0, 4.0), ("a", "s2", -10.0, 7.5), ("a", "s2", 1.0, 1.0), ("a", "s3", None, 2.0), ("b", "t1", 5.0, 6.0)]
    rows += [("c", f"u{k:03}", k * 7919 % 997.0, k * 104729 % 991.0) for k in range(40)]
    stops = spark.createDataFrame(rows, "route_id string, stop_id string, lat double, lng double")
    found = fixtures.matrices(stops, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    edges = sorted(fixtures.travel_matrix(stops).collect(), key=str)
    assert len(edges) == 16 + 1 + 1600
    assert sorted(travel_blocks.matrix_edges(found).collect(), key=str) == edges
    micros = F.transform("seconds", lambda row: F.transform(row, cm.seconds_to_micros))
    assert found.where(~F.col("times").eqNullSafe(micros)).isEmpty()


def test_pieces_of_matrices_are_bounded(monkeypatch):
    monkeypatch.setattr(fixtures, "CELLS", 10)
    lists = [[f"s{k}" for k in range(n)] for n in (3, 0, 1, 2, 5, 1)]
    batch = (pa.array(lists, pa.list_(pa.string())), *[pa.array([[1.0 * len(x)] * len(x) for x in lists], pa.list_(pa.float64()))] * 2)
    pieces = list(fixtures._matrix_rows(iter([batch]), travel_blocks.micros))
    assert [len(p) for p in pieces] == [3, 1, 1, 1]
    assert [[len(row) for row in m] for p in pieces for m in p.to_pylist()] == [[len(x)] * len(x) for x in lists]


def test_micros_of_odd_values():
    assert travel_blocks.micros(np.array([0.5e-6, 1.5e-6, np.nan, np.inf, -2e10, 1e10])).to_pylist() == [0, 2, None, None, None, 10**16]


def test_routes_stay_in_place_from_sequence_to_score(spark, sf_dir, monkeypatch):
    s = fixtures.silver(spark, sf_dir)
    key, limit = "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key), spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        with kept_by_route(spark):
            kept = fixtures.relational_gold(s)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            rows = sorted(kept.collect())
        moved = fixtures.relational_gold(s)
        assert plan.count("REPARTITION_BY_NUM") == 5  # three sequences, services, windows
        assert plan.count("Exchange") < moved._jdf.queryExecution().executedPlan().toString().count("Exchange")
        assert rows == sorted(moved.collect()) and len(rows) > 5
    finally:
        spark.conf.set(limit, before[1])
    assert spark.conf.get(key) == before[0]
    monkeypatch.setattr(fixtures, "relational_gold", lambda _: spark.range(1).where(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        fixtures.gold(spark, sf_dir)
    assert spark.conf.get(key) == before[0]


def test_length_of_sequences_is_asked_without_sorting(spark, monkeypatch):
    rows = [("a", k, f"s{k}") for k in range(5)] + [("b", k, f"s{k}") for k in range(3)]
    seq = actual_sequence(spark.createDataFrame(rows, "route_id string, actual_sequence_position bigint, stop_id string"))
    plans = []
    monkeypatch.setattr(
        DataFrame, "isEmpty", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or not df.take(1)
    )
    assert [measured(seq, n, None)[1] for n in (4, 5)] == [True, False]
    assert plans and not any("Window" in p for p in plans)


@pytest.mark.parametrize(
    "name", ["read_package_json", "read_route_json", "read_travel_json", "read_travel_fragments", "dim_packages", "fact_stops"]
)
def test_records_are_parsed_once(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert found.count() > 0


def test_windows_are_hashed_where_they_are_small(spark, sf_dir):
    s = fixtures.silver(spark, sf_dir)
    limits = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(key) for key in limits]
    spark.conf.set(limits[0], "0b")
    spark.conf.set(limits[1], "-1")
    try:
        with kept_by_route(spark):
            kept = fixtures.relational_gold(s)
            rows = sorted(kept.collect())
        assert "ShuffledHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
        assert spark.conf.get(limits[0]) == "0b"
        sorted_only = fixtures.relational_gold(s)
        assert rows == sorted(sorted_only.collect()) and len(rows) > 5
        assert "ShuffledHashJoin" not in sorted_only._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in zip(limits, before, strict=True):
            spark.conf.set(key, value)


def test_the_travel_file_is_written_as_text(spark, sf_dir, monkeypatch):
    """The lines of the landing file read back as the documents of matrices, and no map is made into JSON for them."""
    s = fixtures.silver(spark, sf_dir)
    monkeypatch.setattr(keyed_json, "write_keyed_json", lambda *_: pytest.fail("a matrix went through a map"))
    found = keyed_json.read_travel_json(spark, fixtures.bronze_file(spark, sf_dir, keyed_json.RAW_FILES[3]))
    text = lambda docs: sorted(
        tuple(r) for r in docs.select("route_id", F.explode("doc").alias("f", "t")).select("route_id", "f", F.to_json("t")).collect()
    )
    assert text(found) == text(documents.route_travel_docs(s)) and not found.where("malformed").count()


def test_a_travel_line_needs_every_stop_once():
    place = np.array([1.0, np.nan])
    line = fixtures._travel_line('R"', ["a\\", "é"], place, np.array([2.0, 3.0]))
    assert json.loads(line) == {'R"': {"a\\": {"a\\": 0.0, "é": None}, "é": {"a\\": None, "é": 0.0}}}
    assert json.loads(fixtures._travel_line("R", [], np.empty(0), np.empty(0))) == {"R": {}}
    for route, stops in ((None, ["a", "b"]), ("R", ["a", None]), ("R", ["a", "a"])):
        with pytest.raises(ValueError, match="every stop's once"):
            fixtures._travel_line(route, stops, place, place)


def test_a_write_removes_its_shuffle_files(spark, tmp_path):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: tracker.shuffleStatuses().size()
    before = held()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert tables.written(rows, "freed").agg(F.sum("n")).first()[0] == 1000
    tables.write_overwrite(rows, str(tmp_path / "rows"))
    stored(rows, "freed")
    keyed_json.write_lines(rows.select(F.col("n").cast("string")), str(tmp_path / "lines"))
    freed = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    assert freed == "false" and held() <= before + 1  # the sum's own shuffle; garbage may be collected meanwhile
