from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from waykit import schemas
from waykit.functions.clock_math import one_decimal, round_tenth
from waykit.functions.arrays import is_permutation, reverse_segment
from waykit.operators import guardrail, sampling, similar
from waykit.plans import kpi


def gold_rows(spark, *rows):
    """(id, stops, nn_v, algo_t, algo_v, actual_t)"""
    full = [(i, n, 100.0, nv, at, av, dt, 0, 2) for i, n, nv, at, av, dt in rows]
    return spark.createDataFrame(full, schemas.ROUTE_COMPARISON)


@pytest.mark.parametrize(
    "algo, nn, passed, status, label",
    [
        (1, 4, True, "GUARDRAIL_OK_BUT_UNRESOLVED", "NEEDS REVIEW"),
        (2, 2, True, "GUARDRAIL_OK_BUT_UNRESOLVED", "NEEDS REVIEW"),
        (3, 1, False, "GUARDRAIL_FAILED", "GUARDRAIL FAILED"),
        (0, 4, True, "SAFE", "SAFE"),
        (5, 1, False, "GUARDRAIL_FAILED", "GUARDRAIL FAILED"),
    ],
)
def test_guardrail(spark, algo, nn, passed, status, label):
    row = guardrail.validate_routes(gold_rows(spark, ("R", 5, nn, 1.0, algo, 1.0))).first()
    assert (row.guardrail_passed, row.status) == (passed, status)
    shown = spark.range(1).select(guardrail.review_label(F.lit(status)).alias("l")).first().l
    assert shown == label


def test_rounding_equals_numpy(spark):
    values = [k / 60 for k in range(-3000, 3000, 7)] + [0.05, 0.15, 2.25, 2.35]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.y for r in df.select(round_tenth(F.col("x")).alias("y")).collect()]
    assert got == [float(np.round(v, 1)) for v in values]


def test_text_rounding_equals_python(spark):
    values = [k / 20 for k in range(-400, 400)] + [k / 7 for k in range(300)] + [247 / 2000 * 100, 98.8, 100.0]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.y for r in df.select(one_decimal(F.col("x")).alias("y")).collect()]
    assert got == [f"{v:.1f}" for v in values]


def test_unknown_ids_get_an_error(spark):
    gold = gold_rows(spark, ("R", 5, 1, 60.0, 1, 120.0))
    requests = spark.createDataFrame([("R",), ("X",)], "route_id string")
    rows = {r.route_id: r for r in guardrail.investigation_report(requests, gold, similar.failure_routes(gold)).collect()}
    assert rows["R"].error is None and rows["R"].num_similar_cases_found == 1
    assert rows["R"].comparison.minutes_saved_by_algorithm == 1.0 and rows["R"].validation.guardrail_passed
    assert rows["X"].error == "No route found with id X" and rows["X"].summary is None


def test_similar_band_is_inclusive_and_keeps_the_route_itself(spark):
    gold = gold_rows(spark, *[(f"R{n}", n, 1, 1.0, 1, 1.0) for n in (80, 100, 101, 120)], ("safe", 60, 0, 1.0, 0, 1.0))
    failures = similar.failure_routes(gold)
    counts = {r.route_id: r.num_similar_cases_found for r in similar.similar_case_count(gold, failures).collect()}
    assert counts == {"R80": 2, "R100": 4, "R101": 3, "R120": 3, "safe": 1}
    listed = similar.similar_cases(gold, failures)
    assert {r.route_id for r in listed.where("for_num_stops = 80").collect()} == {"R80", "R100"}


def test_kpis(spark):
    gold = gold_rows(spark, ("a", 5, 3, 60.0, 0, 120.0), ("b", 5, 1, 60.0, 1, 60.0), ("c", 5, 0, 90.0, 0, 60.0), ("d", 5, 0, 30.0, 0, 60.0))
    row = kpi.kpi_summary(gold).first()
    assert (row.total_routes, row.avg_minutes_saved, row.pct_algo_faster, row.pct_zero_violations) == (4, 0.25, 50.0, 75.0)
    assert (row.nn_total, row.algo_total) == (4, 1)
    assert kpi.final_findings(gold).first().avg_time_diff_minutes == -0.25
    assert kpi.violation_reduction(gold).first().reduction_pct == 75.0
    assert kpi.kpi_verdict(gold).first()[1:] == ("warning", "75.0% of routes finished with zero violations.")
    assert {tuple(r) for r in kpi.violation_bars(gold).collect()} == {("Unconstrained", 4), ("Constrained", 1)}
    assert kpi.axis_max(gold).first().axis_max == 2.0


def test_no_reduction_is_shown_unless_there_are_fewer(spark):
    assert kpi.violation_reduction(gold_rows(spark, ("a", 5, 1, 1.0, 1, 1.0))).first().reduction_pct is None


def test_constant_and_empty_histograms(spark):
    flat = kpi.saved_histogram(gold_rows(spark, ("a", 5, 0, 1.0, 0, 61.0), ("b", 5, 0, 2.0, 0, 62.0))).orderBy("bin").collect()
    assert [r.routes for r in flat] == [2] + [0] * 24
    empty = gold_rows(spark, ("a", 5, 0, 1.0, 0, 1.0)).limit(0)
    assert sum(r.routes for r in kpi.saved_histogram(empty).collect()) == 0
    assert kpi.kpi_summary(empty.where("false")).first().total_routes == 0


def test_sample_is_the_same_for_every_partitioning(spark):
    ids = spark.range(500).select(F.concat(F.lit("RouteID_"), F.col("id")).alias("route_id"))
    twice = ids.union(ids)
    picks = [[r.route_id for r in sampling.sample_routes(twice.repartition(n), 50).collect()] for n in (1, 3, 11)]
    assert picks[0] == picks[1] == picks[2] and len(set(picks[0])) == 50


def test_arrays(spark):
    def one(expr):
        return spark.range(1).select(expr.alias("x")).first().x

    route = F.array(*[F.lit(s) for s in "ABCDE"])
    assert one(reverse_segment(route, F.lit(1), F.lit(3))) == list("ADCBE")
    assert one(reverse_segment(route, F.lit(2), F.lit(4))) == list("ABEDC")
    assert one(is_permutation(F.reverse(route), route))
    assert not one(is_permutation(F.array(*[F.lit(s) for s in "AABCD"]), route))
