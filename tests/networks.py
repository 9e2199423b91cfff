"""Small route networks for tests."""

from __future__ import annotations

import random

from waykit import schemas
from waykit.sources.silver_store import Silver

DATE, DEPARTURE = "2018-07-27", "09:00:00"


def four_stops() -> dict[tuple[str, str], float]:
    near = {("A", "B"), ("A", "C"), ("B", "D"), ("C", "D")}
    return {
        (a, b): 0.0 if a == b else 100.0 if (a, b) in near or (b, a) in near else 300.0
        for a in "ABCD"
        for b in "ABCD"
    }


def random_travel(stops: list[str], seed: int) -> dict[tuple[str, str], float]:
    rng = random.Random(seed)
    return {(a, b): 0.0 if a == b else float(rng.randint(50, 500)) for a in stops for b in stops}


def at(offset: int) -> str:
    """Clock text ``offset`` seconds after departure."""
    seconds = 9 * 3600 + offset
    return f"{DATE} {seconds // 3600:02d}:{seconds % 3600 // 60:02d}:{seconds % 60:02d}"


def network(spark, routes: dict[str, dict]) -> Silver:
    """Each route: travel, order (stop list), station (default first), packages [(stop, from, to, service)],
    departure."""
    dims, stops, packages, sequences, travel = [], [], [], [], []
    for rid, r in routes.items():
        order = r["order"]
        stations = r.get("stations", order[:1])
        dims.append((rid, "D1", DATE, r.get("departure", DEPARTURE), 1.0, "High"))
        for k, stop in enumerate(r.get("stops", sorted(order))):
            stops.append((rid, stop, float(k), float(k), "Station" if stop in stations else "Dropoff", None))
        for k, stop in enumerate(order):
            sequences.append((rid, stop, r.get("positions", list(range(len(order))))[k]))
        for k, (stop, opens, closes, service) in enumerate(r.get("packages", [])):
            packages.append((rid, stop, f"P{k}", "DELIVERED", opens, closes, float(service), 1.0, 1.0, 1.0))
        travel += [(rid, a, b, float(s)) for (a, b), s in r["travel"].items()]
    tables = ((dims, schemas.DIM_ROUTES), (stops, schemas.FACT_STOPS), (packages, schemas.DIM_PACKAGES),
              (sequences, schemas.FACT_ACTUAL_SEQUENCES), (travel, schemas.FACT_TRAVEL_TIMES))
    return Silver(*(spark.createDataFrame(rows, schema) for rows, schema in tables))
