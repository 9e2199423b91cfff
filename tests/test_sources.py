from __future__ import annotations

import json

import pytest

from networks import four_stops, network
from waykit import fixtures, schemas
from waykit.operators import silver
from waykit.plans import documents, gold
from waykit.sources import keyed_json, silver_store, tables
from waykit.streaming.incremental import incremental_evaluate


def route_doc(stops):
    return {
        "station_code": "D1",
        "date_YYYY_MM_DD": "2018-07-27",
        "departure_time_utc": "09:00:00",
        "executor_capacity_cm3": 3313071,
        "route_score": "High",
        "stops": {s: {"lat": 1.5, "lng": -2.5, "type": "Station" if s == "A" else "Dropoff", "zone_id": z} for s, z in stops.items()},
    }


def package(opens, closes):
    return {
        "scan_status": "DELIVERED",
        "time_window": {"start_time_utc": opens, "end_time_utc": closes},
        "planned_service_time_seconds": 12.5,
        "dimensions": {"depth_cm": 1.0, "height_cm": 2.0, "width_cm": 3.0},
    }


@pytest.mark.parametrize("indent", [None, 1])
def test_one_object_per_file_with_dynamic_keys(spark, tmp_path, indent):
    nan = float("nan")
    raw = {
        "route_data.json": {
            "RouteID_1": route_doc({"A": None, "B": "Z-1"}),
            "RouteID_2-x": route_doc({"A": nan}),
        },
        "package_data.json": {
            "RouteID_1": {
                "B": {"P1": package("2018-07-27 09:00:00", "2018-07-27 10:00:00"), "P2": package(nan, nan)},
                "A": {"P3": package(None, None)},
            }
        },
        "actual_sequences.json": {"RouteID_1": {"actual": {"A": 0, "B": 1}}, "RouteID_2-x": {"actual": {"A": 0}}},
        "travel_times.json": {"RouteID_1": {"A": {"A": 0, "B": 7.5}, "B": {"A": 8, "B": 0.0}}},
    }
    for name, content in raw.items():
        (tmp_path / name).write_text(json.dumps(content, indent=indent))
    docs = keyed_json.read_bronze(spark, str(tmp_path))
    assert {n: d.where("malformed").count() for n, d in docs.items()} == dict.fromkeys(docs, 0)
    routes = {tuple(r) for r in silver.dim_routes(docs["routes"]).collect()}
    assert routes == {
        (rid, "D1", "2018-07-27", "09:00:00", 3313071.0, "High") for rid in ("RouteID_1", "RouteID_2-x")
    }
    stops = {(r.route_id, r.stop_id, r.stop_type, r.zone_id) for r in silver.fact_stops(docs["routes"]).collect()}
    assert stops == {
        ("RouteID_1", "A", "Station", None), ("RouteID_1", "B", "Dropoff", "Z-1"), ("RouteID_2-x", "A", "Station", None),
    }
    packages = {(r.stop_id, r.package_id, r.time_window_start, r.time_window_end) for r in silver.dim_packages(docs["packages"]).collect()}
    assert packages == {
        ("B", "P1", "2018-07-27 09:00:00", "2018-07-27 10:00:00"), ("B", "P2", None, None), ("A", "P3", None, None),
    }
    order = {tuple(r) for r in silver.fact_actual_sequences(docs["sequences"]).collect()}
    assert order == {("RouteID_1", "A", 0), ("RouteID_1", "B", 1), ("RouteID_2-x", "A", 0)}
    travel = {tuple(r) for r in silver.fact_travel_times(docs["travel"]).collect()}
    assert travel == {
        ("RouteID_1", "A", "A", 0.0), ("RouteID_1", "A", "B", 7.5), ("RouteID_1", "B", "A", 8.0), ("RouteID_1", "B", "B", 0.0),
    }


def test_a_large_file_is_cut_into_splits_without_loss(spark, tmp_path):
    matrix = {f"S{k}": {f"S{m}": k * m / 10 for m in range(12)} for k in range(12)}
    path = tmp_path / "travel_times.json"
    path.write_text(json.dumps({f"RouteID_{r}": matrix for r in range(400)}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        docs = keyed_json.read_travel_json(spark, str(path))
        assert docs.rdd.getNumPartitions() > 4
        assert docs.where("NOT malformed").select("route_id").distinct().count() == docs.count() == 400
        assert silver.fact_travel_times(docs).count() == 400 * 144
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("indent", [None, 1])
def test_travel_records_are_cut_inside_a_route(spark, tmp_path, indent):
    """Routes far larger than a split, one without departures and one broken departure stop."""
    stops = [f"S{i}" for i in range(60)]
    docs = {f"RouteID_{r}": {a: {b: i + r / 10 for i, b in enumerate(stops)} for a in stops[: 50 * r]} for r in range(3)}
    text = json.dumps(docs, indent=indent)
    at = text.index('"S7"', text.index("RouteID_2"))  # among the times from S0
    path = tmp_path / "travel_times.json"
    path.write_text(text[:at] + "oops" + text[at:])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        read = keyed_json.read_travel_fragments(spark, str(path))
        assert read.rdd.getNumPartitions() > 10
        rows = read.collect()
        edges = silver.fact_travel_times(read).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.route_id for r in rows if r.malformed] == ["RouteID_2"]
    got = {(r.route_id, a): dict(m) for r in rows if not r.malformed for a, m in r.doc.items()}
    want = {(r, a): m for r, d in docs.items() for a, m in d.items() if (r, a) != ("RouteID_2", "S0")}
    assert got == want and len(rows) == len(want) + 1
    assert len(edges) == sum(len(m) for m in want.values())


def test_malformed_documents_are_flagged(spark, tmp_path):
    path = tmp_path / "actual_sequences.json"
    path.write_text('{"RouteID_1": {"actual": {"A": 0}}, "RouteID_2": {"actual": {"A": ')
    rows = {r.route_id: r.malformed for r in keyed_json.read_sequence_json(spark, str(path)).collect()}
    assert rows == {"RouteID_1": False, "RouteID_2": True}


def test_documents_round_trip(spark, tmp_path):
    source = network(
        spark,
        {"RouteID_7": {"travel": four_stops(), "order": list("ABCD"), "packages": [("B", None, "2018-07-27 10:00:00", 3)]}},
    )
    keyed_json.write_keyed_json(documents.package_docs(source), str(tmp_path / "p"))
    keyed_json.write_keyed_json(documents.travel_docs(source), str(tmp_path / "t"))
    assert silver.dim_packages(keyed_json.read_package_json(spark, str(tmp_path / "p"))).collect() == source.packages.collect()
    again = silver.fact_travel_times(keyed_json.read_travel_json(spark, str(tmp_path / "t")))
    assert sorted(again.collect()) == sorted(source.travel.collect())


def test_scans_are_pruned_and_filters_pushed(spark, tmp_path):
    source = network(spark, {"R": {"travel": four_stops(), "order": list("ABCD")}})
    tables.write_overwrite(source.stops, str(tmp_path / "stops"))
    df = tables.read_table(spark, str(tmp_path / "stops"), ["route_id", "stop_id"]).where("route_id = 'R'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<route_id:string,stop_id:string>" in plan
    assert "EqualTo(route_id,R)" in plan


def test_append_is_resumable(spark, tmp_path):
    gold_rows = spark.createDataFrame([(f"R{k}", k, *[1.0, 0] * 3, 1) for k in range(10)], schemas.ROUTE_COMPARISON)
    path = str(tmp_path / "gold")
    tables.write_append_resumable(gold_rows.where("num_stops < 4"), path)
    tables.write_append_resumable(gold_rows, path)
    tables.write_append_resumable(gold_rows, path)
    assert sorted(spark.read.parquet(path).collect()) == sorted(gold_rows.collect())
    assert tables.empty_gold(spark).count() == 0


def test_incremental_load_equals_batch_and_never_repeats_a_route(spark, tmp_path):
    source = network(spark, {f"R{k}": {"travel": four_stops(), "order": list("ABCD")} for k in range(6)})
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    evaluated = []

    def evaluate(ids):
        evaluated.append(ids.count())
        return gold.route_comparison(source, ids)

    source.routes.where("route_id < 'R3'").repartition(2).write.parquet(landing)
    incremental_evaluate(spark, landing, target, state, evaluate).awaitTermination()
    source.routes.write.mode("append").parquet(landing)
    incremental_evaluate(spark, landing, target, state, evaluate).awaitTermination()
    incremental_evaluate(spark, landing, target, state, evaluate).awaitTermination()
    assert sum(evaluated) == 6
    assert sorted(spark.read.parquet(target).collect()) == sorted(gold.route_comparison(source).collect())


def test_route_width_is_bounded_by_construction(spark):
    """However many line items or repeated orders there are, a route has at most 200 stops."""
    stops = fixtures.silver(spark, "/root/testdata/sf0.01").stops
    assert stops.groupBy("route_id").count().selectExpr("max(count) m").first().m <= 200


def test_from_documents_to_gold(spark, tmp_path):
    """Landed JSON files to the comparison table, through the stored silver layer."""
    source = network(spark, {f"RouteID_{k}": {"travel": four_stops(), "order": list("ABCD")} for k in range(3)})
    for file, docs in zip(
        keyed_json.RAW_FILES,
        (documents.route_docs, documents.package_docs, documents.sequence_docs, documents.travel_docs),
    ):
        keyed_json.write_keyed_json(docs(source), f"{tmp_path}/{file}")
    flat = silver_store.silver_from_documents(keyed_json.read_bronze(spark, str(tmp_path)))
    silver_store.write_silver(flat, str(tmp_path / "silver"))
    stored = silver_store.load_silver(spark, str(tmp_path / "silver"))
    assert sorted(gold.route_comparison(stored).collect()) == sorted(gold.route_comparison(source).collect())


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    source = network(spark, {f"R{k}": {"travel": four_stops(), "order": list("ABCD")} for k in range(3)})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tables.write_bucketed(source.stops, "bucketed_stops", str(tmp_path / "stops"), 4)
        tables.write_bucketed(source.routes, "bucketed_routes", str(tmp_path / "routes"), 4)
        joined = spark.table("bucketed_stops").join(spark.table("bucketed_routes"), "route_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS bucketed_stops")
        spark.sql("DROP TABLE IF EXISTS bucketed_routes")


def test_every_key_is_flattened_or_rejected(spark, tmp_path):
    """A truncated file, a record of another shape and stray text lose nothing without a row."""
    source = network(spark, {f"RouteID_{k}": {"travel": four_stops(), "order": list("ABCD")} for k in range(3)})
    makers = (documents.route_docs, documents.route_package_docs, documents.sequence_docs, documents.route_travel_docs)
    for file, docs in zip(keyed_json.RAW_FILES, makers):
        rows = {r.route_id: json.loads(r.d) for r in sorted(docs(source).selectExpr("route_id", "to_json(doc) AS d").collect())}
        text = json.dumps(rows)
        if file == "travel_times.json":
            text = text[:-60]
        if file == "actual_sequences.json":
            text = text.replace('"RouteID_1": ', '"RouteID_1": [1, 2], "RouteID_9": ')
        if file == "route_data.json":
            text = '{"Other_5": {"station_code": 1}, ' + text[1:]
        (tmp_path / file).write_text(text)
    silver_store.write_documents(keyed_json.read_bronze(spark, str(tmp_path)), str(tmp_path / "silver"))
    stored = silver_store.load_silver(spark, str(tmp_path / "silver"))
    rejected = {(r.file, r.route_id) for r in spark.read.parquet(str(tmp_path / "silver/rejected_documents")).collect()}
    assert rejected == {("travel", "RouteID_2"), ("sequences", "RouteID_1"), ("routes", None)}
    ids = lambda df: {r.route_id for r in df.select("route_id").distinct().collect()}
    assert ids(stored.travel) == {"RouteID_0", "RouteID_1"} and ids(stored.routes) == {f"RouteID_{k}" for k in range(3)}
    assert ids(stored.sequences) == {"RouteID_0", "RouteID_2", "RouteID_9"}


def test_load_into_a_target_that_a_lost_write_left_empty(spark, tmp_path):
    source = network(spark, {f"R{k}": {"travel": four_stops(), "order": list("ABCD")} for k in range(3)})
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    (tmp_path / "target" / "_temporary" / "0").mkdir(parents=True)
    source.routes.write.parquet(landing)
    incremental_evaluate(spark, landing, target, state, lambda ids: gold.route_comparison(source, ids)).awaitTermination()
    got = spark.read.schema(schemas.ROUTE_COMPARISON).parquet(target).collect()
    assert sorted(got) == sorted(gold.route_comparison(source).collect())


def test_catalog_tables(spark):
    rows = spark.createDataFrame([("R1", 1), ("R2", 2)], "route_id string, n int")
    try:
        tables.write_overwrite(rows, "waykit_rows")
        assert sorted(tables.read_table(spark, "waykit_rows", ["route_id"]).collect()) == [("R1",), ("R2",)]
    finally:
        spark.sql("DROP TABLE IF EXISTS waykit_rows")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "a"

        def getCheckpointDir(self):
            return self.folder

    class Session:
        conf, sparkContext = Conf(), Context()

    from waykit.session import scratch_dir

    Context.folder = None
    with pytest.raises(ValueError):
        scratch_dir(Session, "x")
    Context.folder = "s3a://bucket/shared"
    assert scratch_dir(Session, "x").startswith("s3a://bucket/shared/x-")
