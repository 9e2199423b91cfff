"""Quality rules whose cutoffs are chosen on labelled rows under a bound on false rejections."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waykit.llm.common import UPPER, WHITESPACE, pick, stored, words
from waykit.sources.tables import broadcast_if_small

SYMBOLS = "#*$%&|<>"
RULES = ("symbol_share", "dup_line_share", "repeat_share", "capital_share")
CUTOFFS = (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5)
ALPHA = 0.05  # false rejections allowed per stratum, shared equally by the rules
DELTA = 0.05  # chance that any of the chosen cutoffs breaks its bound


def measures(docs: DataFrame) -> DataFrame:
    """Base counts of each text; everything stays inside the row."""
    base = pick(docs, doc_id="bigint", text="string", lang="string")
    text = F.coalesce(F.col("text"), F.lit(""))
    read = base.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("stratum"),
        F.xxhash64(text).alias("p1"),
        F.xxhash64(F.lit(1), text).alias("p2"),
        words(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda l: F.btrim(l, F.lit(WHITESPACE)) != "").alias("lines"),
        F.length(F.translate(text, WHITESPACE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, UPPER, ""))).cast("bigint").alias("n_capitals"),
    )
    following = lambda i, k: F.get(F.col("words"), i + k)
    windows = F.slice(
        F.transform("words", lambda w, i: F.xxhash64(w, following(i, 1), following(i, 2))),
        F.lit(1),
        F.greatest(F.size("words") - 2, F.lit(0)),
    )
    hashed = read.withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn(
        "ordered",
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    at = lambda j: F.get(F.col("ordered"), j)["h"]
    twice = F.filter("ordered", lambda s, j: F.coalesce((s["h"] == at(j - 1)), F.lit(False)) | F.coalesce(s["h"] == at(j + 1), F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))))
    return ordered.select(
        "doc_id",
        "stratum",
        "p1",
        "p2",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("ordered").isNull(), 0).otherwise(F.size(covered)).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        "n_capitals",
    )


def shares(measured: DataFrame) -> DataFrame:
    chars = F.greatest("word_chars", F.lit(1))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select(
        "*",
        failed.alias("base_failed"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / F.greatest("n_words", F.lit(1))).alias("repeat_share"),
        (F.col("n_capitals") / chars).alias("capital_share"),
    )


def allowed_rejections(n, alpha: float, level):
    """Largest k whose exact binomial tail P(X <= k), X ~ B(n, alpha), is at most ``level``; -1 if none.

    With k rejections among n good rows the exact upper bound of the rejection rate, at confidence 1 - ``level``, is
    at most ``alpha`` just when k is not above this. Terms are carried as logarithms.
    """
    odds = math.log(alpha / (1 - alpha))
    start = F.struct(
        (n * math.log(1 - alpha)).alias("term"), F.lit(0.0).alias("tail"), F.lit(-1).cast("bigint").alias("k")
    )

    def step(s, i):
        tail = s["tail"] + F.exp(s["term"])
        return F.struct(
            (s["term"] + F.log((n - i) / (i + 1)) + odds).alias("term"),
            tail.alias("tail"),
            F.when(tail <= level, i).otherwise(s["k"]).alias("k"),
        )

    upto = F.sequence(F.lit(0).cast("bigint"), F.floor(n * alpha).cast("bigint"))
    return F.aggregate(upto, start, step)["k"]


def choose_cutoffs(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one cutoff per rule): the lowest that is proven, null where none is.

    Good rows (label 1) that pass the base rules are the holdout of their stratum; nothing is fitted on them but these
    choices. The tail bound needs independent trials, so a text counts once in its stratum, however many rows or documents
    repeat it (told apart by 128 bits). Every pair of stratum, rule and candidate is a test at ``delta`` divided by their number.
    """
    good = (
        pick(labels, doc_id="bigint", quality="int").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    )
    holdout = rows.where("NOT base_failed").join(good.select("doc_id"), "doc_id").dropDuplicates(["stratum", "p1", "p2"])
    counts = holdout.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(r) > c).alias(f"{r}_{k}") for r in RULES for k, c in enumerate(CUTOFFS)],
    )
    counts = counts.withColumn("strata", F.count("*").over(Window.partitionBy()))  # one row per stratum
    level = F.lit(delta) / (F.col("strata") * (len(RULES) * len(CUTOFFS)))
    tested = counts.withColumn("most", allowed_rejections(F.col("n"), alpha / len(RULES), level))
    # A higher cutoff never rejects more, so the lowest passing one is the first that passes.
    chosen = [
        F.coalesce(*[F.when(F.col(f"{r}_{k}") <= F.col("most"), F.lit(c)) for k, c in enumerate(CUTOFFS)]).alias(
            f"{r}_cutoff"
        )
        for r in RULES
    ]
    return tested.select("stratum", *chosen)


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row of ``docs``.

    With probability 1 - ``delta``, in every stratum (language; null and '' are one) the cutoffs reject at most
    ``alpha`` of the good rows that pass the base rules. A stratum with too few labels to prove a cutoff
    rejects nothing beyond the base rules; without labels none does.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike; label rows that
    repeat a doc_id count once, with the smaller label. Other columns are ignored. Windows within a
    text are compared by 64-bit hashes. The measures are stored once (a few numbers per row), cutoffs are one row per
    stratum and are broadcast after a look at their size.
    """
    rows = stored(shares(measures(docs)), "rule-measures")
    cutoffs = stored(choose_cutoffs(rows, labels, alpha, delta), "rule-cutoffs")
    judged = rows.join(broadcast_if_small(cutoffs), "stratum", "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(r) > F.col(f"{r}_cutoff"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return apply_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_CUTS = ", ".join(map(str, CUTOFFS))
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
a AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls FROM d),
p AS (SELECT doc_id, i, w[i] AS w1, w[i+1] AS w2, w[i+2] AS w3 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS c FROM p) WHERE c > 1),
n AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS j FROM r) GROUP BY doc_id),
m AS (SELECT a.doc_id, stratum, t, len(w) AS n_words, length(regexp_replace(t, '{_WS}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM a LEFT JOIN n USING (doc_id)),
s AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [n_symbols / greatest(word_chars, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1), n_capitals / greatest(word_chars, 1)] AS v FROM m),
g AS (SELECT DISTINCT stratum, t, v FROM s JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id) WHERE NOT base_failed),
c AS (SELECT stratum, rule, cut, count(*) AS n, count(*) FILTER (v[rule] > cut) AS k
  FROM g, (SELECT unnest([1, 2, 3, 4]) AS rule), (SELECT unnest([{_CUTS}]) AS cut) GROUP BY ALL),
l AS (SELECT *, {DELTA} / ({len(RULES) * len(CUTOFFS)} * (SELECT count(DISTINCT stratum) FROM c)) AS level FROM c),
b AS (SELECT *, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA / 4}) + (n - i) * ln(1 - {ALPHA / 4})))
    FROM (SELECT unnest(range(0, k + 1)) AS i)) AS tail FROM l WHERE k <= n * {ALPHA / 4}),
u AS (SELECT stratum, rule, min(cut) AS cut FROM b WHERE tail <= level GROUP BY ALL)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM u WHERE u.stratum = s.stratum AND v[u.rule] > u.cut) AS kept
FROM s
"""
