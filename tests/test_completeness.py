"""Routes whose parts land apart."""

from __future__ import annotations

import random

from networks import at, four_stops, network
from waykit import schemas
from waykit.plans import documents, gold
from waykit.sources import tables
from waykit.streaming import completeness

MAKERS = {
    "routes": documents.route_docs,
    "packages": documents.route_package_docs,
    "sequences": documents.sequence_docs,
    "travel": documents.route_travel_docs,
}


def test_parts_in_any_order_and_twice_end_equal_to_the_batch(spark, tmp_path):
    names = [f"R{k}" for k in range(5)]
    packages = [("C", at(0), at(150), 20)]
    source = network(spark, {r: {"travel": four_stops(), "order": list("ABCD"), "packages": packages} for r in names})
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    records = [(r, part) for r in names for part in MAKERS]
    random.Random(3).shuffle(records)
    last = {r: max(k for k, (x, _) in enumerate(records) if x == r) for r in names}
    cuts, evaluated = (0, 7, 14, len(records)), []

    def evaluate(silver):
        rows = gold.route_comparison(silver)
        evaluated.append({r.route_id for r in rows.collect()})
        return rows

    def run():
        completeness.evaluate_complete(spark, landing, target, state, evaluate).awaitTermination()
        return {r.route_id for r in tables.read_slices(spark, target, schemas.ROUTE_COMPARISON).collect()}

    docs = {part: maker(source).cache() for part, maker in MAKERS.items()}
    for begin, end in zip(cuts, cuts[1:]):
        for part in MAKERS:
            now = [r for r, p in records[begin:end] if p == part]
            again = [r for r, p in records[:begin] if p == part][:1]  # and one that landed before
            if now + again:
                completeness.land(docs[part].where(docs[part].route_id.isin(now + again)), landing, part)
        assert run() == {r for r in names if last[r] < end}
    assert sorted(r for e in evaluated for r in e) == names  # each once
    stored = tables.read_slices(spark, target, schemas.ROUTE_COMPARISON)
    assert sorted(stored.collect()) == sorted(gold.route_comparison(source).collect())

    # A batch half committed by a lost driver is replaced as a whole when it is replayed.
    before = sorted(stored.collect())
    torn = stored.limit(1)
    tables.replace_slice(torn.union(torn), target, "stream", 99)
    held = tables.stored_slices(spark, target, schemas.ROUTE_COMPARISON)
    assert held.where("slice = 99").count() == 2
    tables.replace_slice(held.limit(0).select(*schemas.ROUTE_COMPARISON.names).union(torn), target, "stream", 99)
    assert tables.stored_slices(spark, target, schemas.ROUTE_COMPARISON).where("slice = 99").count() == 1 and before
