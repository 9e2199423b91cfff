"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waykit.llm.common import pick

RING_SLOTS = 1 << 14
VIRTUAL_NODES = 64


def ring_points(shards: int, virtual_nodes: int, slots: int) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node, clockwise. A shard's points do not depend on the others."""

    def place(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big") % slots

    return sorted((place(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def plan_ring(counts: dict[int, int], shards: int, virtual_nodes: int, slots: int, slack: float) -> dict[int, list]:
    """Per ring slot the pieces (upto, shard, shift) of its rows: rank < upto goes to ``shard`` at rank + shift.

    Every slot first offers its rows to the shard of the next virtual node clockwise; what a full shard
    cannot take is offered to the following one, in rounds of one step for all. The input is one count per
    ring slot, as many at any data size. With slack 0 capacities add up to the rows: all shards end full,
    so their counts are at most one apart.
    """
    total = sum(counts.values())
    points = ring_points(shards, virtual_nodes, slots)
    free = [max(total // shards + (s < total % shards), int((1 + slack) * total / shards)) for s in range(shards)]
    used = [0] * shards
    first, k = {}, 0
    for slot in sorted(counts):
        while k < len(points) and points[k][0] < slot:
            k += 1
        first[slot] = k
    pieces: dict[int, list] = {slot: [] for slot in counts}
    waiting = [(slot, 0, first[slot]) for slot in sorted(counts)]
    while waiting:
        onward = []
        for slot, start, k in waiting:
            shard = points[k % len(points)][1]
            takes = min(counts[slot] - start, free[shard])
            if takes:
                pieces[slot].append((start + takes, shard, used[shard] - start))
                free[shard] -= takes
                used[shard] += takes
            if start + takes < counts[slot]:
                onward.append((slot, start + takes, k + 1))
        waiting = onward
    return pieces


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
    slots: int = RING_SLOTS,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per row of ``docs``; ``slot`` is gapless from 0 in each shard.

    A row's place on the ring comes from doc_id and the text's checksum. No shard holds more than ``(1 +
    slack)`` times the mean; with slack 0 the counts are at most one apart. Another shard takes its own arcs
    and shifts only what overflowed. Texts are never moved: a row is three numbers, equal rows are combined
    before the shuffle and numbered apart afterwards, ranks are taken within a ring slot, and a slot's rank
    gives the place in its shard directly, so nothing is sorted per shard.

    Null text has no bytes and checksum 0; null doc_id is a key like any other. An empty table gives no
    rows. Other columns are ignored.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(docs, doc_id="bigint", text="string").select(
        "doc_id", (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    apart = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    point = F.pmod(F.xxhash64(F.lit("ring"), "doc_id", "text_crc32", "size"), F.lit(slots)).cast("int")
    placed = apart.withColumn("point", point)
    counts = {r["point"]: r["n"] for r in placed.groupBy("point").agg(F.sum("copies").alias("n")).collect()}
    pieces = plan_ring(counts, shards, virtual_nodes, slots, slack)
    plan = docs.sparkSession.createDataFrame(
        list(pieces.items()), "point int, pieces array<struct<upto:bigint,shard:int,shift:bigint>>"
    )
    order = Window.partitionBy("point").orderBy("doc_id", "size", "text_crc32")
    ranked = placed.withColumn("start", F.sum("copies").over(order) - F.col("copies"))
    # One row per ring slot, a number set by the parameters.
    copies = ranked.join(F.broadcast(plan), "point").withColumn(
        "rank", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("copies") - 1))
    )
    piece = F.get(F.filter("pieces", lambda p: p["upto"] > F.col("rank")), F.lit(0))
    return copies.withColumn("piece", piece).select(
        "doc_id", "size", "text_crc32", F.col("piece.shard").alias("shard"), (F.col("rank") + F.col("piece.shift")).alias("slot")
    )


def digest(docs: DataFrame) -> DataFrame:
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
