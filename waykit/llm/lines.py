"""Line deduplication: lines that several documents hold stay only in the smallest of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit.llm.common import WHITESPACE, lower_ascii, pick, stored


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, print, pos, h1, h2) of every line whose key is long enough.

    ``h1, h2`` are 128 bits of the key, the line stripped and lower-cased (ASCII). ``print`` tells rows
    apart that share a doc_id.
    """
    exploded = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("print"), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    key = lower_ascii(F.btrim("line", F.lit(WHITESPACE)))
    return (
        exploded.select("doc_id", "print", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "print", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) per row of ``docs``: the text without its repeated lines.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its
    lines except those of the smallest doc_id that holds it (which keeps its own repeats). Documents per
    key are combined before the shuffle, so a line that a third of all documents hold is one row per task;
    only its positions are joined, and Spark splits that join where it is skewed. Positions then pick
    the lines that stay, in order; only here is text moved, once.

    Null or empty text is one empty line. Rows that share a doc_id are one document; each gives a row. A row
    without doc_id belongs to no document: it keeps all its lines and counts for no key. Other columns are ignored.
    """
    base = pick(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = line_keys(base, min_chars)
    by_key = keys.groupBy("h1", "h2")
    if min_docs == 2:  # two different documents are there when the ends differ; needs no set of ids
        shared = by_key.agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper < last")
    else:
        held = by_key.agg(F.min("doc_id").alias("keeper"), F.count_distinct("doc_id").alias("held"))
        shared = held.where(F.col("held") >= min_docs)
    # Written down, so that Spark sees both sides of the join as they are and splits what is skewed.
    shared = stored(shared.select("h1", "h2", "keeper"), "shared-lines")
    dropped = (
        keys.join(shared, ["h1", "h2"])
        .where("doc_id <> keeper")
        .groupBy("doc_id", "print")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    lines = F.split("text", "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    joined = base.withColumn("print", F.xxhash64("text")).join(dropped, ["doc_id", "print"], "left")
    cut = F.array_join(F.transform(stays, lambda p: F.get(F.col("lines"), p)), "\n")
    return joined.withColumn("lines", lines).select(
        "doc_id",
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(cut).alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
h AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, coalesce(k.doc_id <> h.keeper, false) AS gone FROM k LEFT JOIN h ON k.key = h.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
