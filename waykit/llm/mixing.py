"""Mixing sources to target weights by capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waykit.llm.common import DOCUMENT, pick, stored, word_count
from waykit.sources.tables import broadcast_if_small

CELL_BITS = 12  # order keys have 60 bits; their first bits number the cells of a source
KEY = ("no_source", "src")


def order_key(seed: str) -> Column:
    """60 bits of a seeded hash of doc_id and text: the order in which a source is drawn."""
    name = F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")))
    )
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """Size, source key (null source told apart from '') and order key of each row."""
    return docs.select(
        "doc_id",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("src"),
        word_count(F.col("text")).alias("size"),
        order_key(seed).alias("h"),
    )


def water_fill(sizes: DataFrame, weights: tuple[int, ...], epochs: int, share: float) -> DataFrame:
    """(source key, source_size, target): targets by weight, none above ``epochs`` times its source.

    With sources in the order of cap / weight, a source is capped exactly when the level without it
    and those before it would lift it over its cap; what is left is shared among the rest by weight. The
    table has one row per source.
    """
    everything = Window.orderBy("no_source", "src")
    turn = (F.row_number().over(everything) - 1) % len(weights)
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (turn + 1).cast("int"))
    )
    capped = weighed.withColumn("cap", F.col("source_size") * epochs)
    total = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "src")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    full = capped.select(
        "*",
        (F.sum("source_size").over(total) * F.lit(share)).alias("all_words"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps_before"),
        (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights_left"),
    ).withColumn("full", (F.col("all_words") - F.col("caps_before")) * F.col("weight") > F.col("cap") * F.col("weights_left"))
    level = (F.col("all_words") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(total)) / F.sum(
        F.when(F.col("full"), 0).otherwise(F.col("weight"))
    ).over(total)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return full.select(*KEY, "source_size", target.cast("double").alias("target"))


def draws(rows: DataFrame, weights: tuple[int, ...], epochs: int, share: float) -> DataFrame:
    """(source key, source_size, target, whole, last): every row of a source is taken ``whole`` times, and
    once more where its order key is at most ``last``.

    The last key is found in two steps: words per cell of order keys place the remainder in one cell,
    and only that cell's keys (1 / 4,096 of the source) are summed one by one.
    """
    cells = rows.groupBy(*KEY, F.shiftright("h", 60 - CELL_BITS).alias("cell")).agg(F.sum("size").alias("words"))
    sizes = rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (
        water_fill(sizes, weights, epochs, share)
        .withColumn("whole", whole.cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    in_source = Window.partitionBy(*KEY)
    upto = in_source.orderBy("cell")
    cut = (
        cells.withColumn("start", F.sum("words").over(upto) - F.col("words"))
        .join(plan.select(*KEY, "rest"), list(KEY))
        .where((F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("words")))
    )
    inner = (
        rows.withColumn("cell", F.shiftright("h", 60 - CELL_BITS))
        .join(cut.drop("words"), [*KEY, "cell"])
        .groupBy(*KEY, "cell", "start", "rest", "h")
        .agg(F.sum("size").alias("words"))
        .withColumn("begin", F.col("start") + F.sum("words").over(in_source.orderBy("h")) - F.col("words"))
    )
    taken = F.when(2 * F.col("begin") + F.col("words") < 2 * F.col("rest"), F.col("h"))
    last = inner.groupBy(*KEY, "cell").agg(F.max(taken).alias("found")).select(
        *KEY, F.coalesce("found", F.shiftleft("cell", 60 - CELL_BITS) - 1).alias("last")
    )
    # A remainder that rounding puts at or past the end of its source takes all of it.
    end = F.when(F.col("rest") > 0, F.lit((1 << 60) - 1)).otherwise(F.lit(-1))
    return plan.join(last, list(KEY), "left").select(
        *KEY, "source_size", "target", "whole", F.coalesce("last", end).alias("last")
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, share: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """(doc_id, text, lang, source, n_chars, size, source_size, target, taken, copies) per row of ``docs``.

    Size is the number of words. Sources, by code point and null last, get ``weights`` in turn; together
    they share ``share`` of all words. ``copies`` is how often the mix takes the row, at most ``epochs``: whole
    repetitions of the source, plus one for the rows that the seeded order puts before the remainder's end.
    A source's words so differ from its target by at most half the row at the cut.

    Null and empty texts have size 0; a source without words has target 0. Rows equal in doc_id and text are
    taken alike. Other columns are ignored. One row per source is broadcast after a look at its size; a hot
    source is only ever summed.
    """
    base = pick(docs, **DOCUMENT)
    plan = stored(draws(stored(sized(base, seed), "mix-rows"), weights, epochs, share), "mix-plan")
    rows = base.select(
        "*",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("src"),
        word_count(F.col("text")).alias("size"),
        order_key(seed).alias("h"),
    )
    joined = rows.join(broadcast_if_small(plan), list(KEY))
    copies = F.col("whole") + F.when(F.col("h") <= F.col("last"), 1).otherwise(0)
    return joined.withColumn("copies", copies).select(
        *base.columns, "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself, with the columns of documents: each row as often as the mix takes it."""
    mixed = mix_sources(docs, **options).where("copies > 0")
    again = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return again.select(*DOCUMENT)


def digest(docs: DataFrame) -> DataFrame:
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM s),
b AS (SELECT *, sum(source_size) OVER () AS t,
    coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
    sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
f AS (SELECT *, (t - cb) * weight > cap * wl AS full_ FROM b),
g AS (SELECT source, source_size, CASE WHEN full_ THEN cap::DOUBLE ELSE
    (sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ())::DOUBLE
      / sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER () * weight END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM g),
q AS (SELECT *, target - whole * source_size AS rest FROM p),
k AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
c AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS begin_ FROM k)
SELECT d.doc_id, d.size::BIGINT AS size, q.source_size, q.target,
  (d.size * (q.whole + CASE WHEN 2 * c.begin_ + c.words < 2 * q.rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.h = d.h
"""
