"""Licence scans by a positional index of rare template words."""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.llm.common import UPPER, pick

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between words, once A-Z are lower-cased
BREAK_CHARS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
RARE_SHARE = 4  # one in so many distinct words of a template is looked up, the rarest first


@dataclass(frozen=True)
class Template:
    """A passage that stands for a licence; ``keys`` are the phrases of it that must be there word for word."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The base phrases, and passages of public licences with their mandatory phrases.
TEMPLATES = (
    Template("gpl", "GNU General Public License", base=True),
    Template("apache", "Apache License", base=True),
    Template("cc-by", "CC BY", base=True),
    Template("mit", "MIT License", base=True),
    Template("gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl-3.0", "GNU General Public License, version 3"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("mpl-2.0", "Mozilla Public License, v. 2.0"),
    Template("mpl-2.0", "Mozilla Public License, Version 2.0"),
    Template("epl-2.0", "Eclipse Public License v2.0"),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("cc-by-nd", "CC BY-ND"),
    Template("cc-by-nc-sa", "CC BY-NC-SA"),
    Template("cc0", "CC0 1.0 Universal"),
    Template("bsd", "BSD 2-Clause License"),
    Template("bsd", "BSD 3-Clause License"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        ("Permission is hereby granted, free of charge", "sublicense, and/or sell copies"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("Redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        ("except in compliance with the License", "www.apache.org/licenses/LICENSE-2.0"),
    ),
    Template(
        "gpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation",
        ("under the terms of the GNU General Public License",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
        ("free and unencumbered software released into the public domain",),
    ),
    Template(
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("Creative Commons Attribution 4.0 International",),
    ),
)


def template_words(text: str) -> list[str]:
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(BREAKS, lowered) if w]


def required(template: Template) -> list[int]:
    """The word places of a template that its mandatory phrases cover; all of them where none is named."""
    body = template_words(template.text)
    if not template.keys:
        return list(range(len(body)))
    places: set[int] = set()
    for key in template.keys:
        phrase = template_words(key)
        starts = [i for i in range(len(body) - len(phrase) + 1) if body[i : i + len(phrase)] == phrase]
        if not starts or not phrase:
            raise ValueError(f"the template of {template.label} lacks its phrase {key!r}")
        places.update(range(starts[0], starts[0] + len(phrase)))
    return sorted(places)


def text_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + BREAK_CHARS, UPPER.lower() + " " * len(BREAK_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def word_weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Inverse document frequency, in thousandths, of every template word over all rows of ``docs``.

    With N rows, df of which hold the word: floor(1000 * ln((2N + 2) / (2df + 1))). A text is cut to the
    template words that it holds, each once, and these are counted per task before they are shuffled. The result has
    one entry per template word, however many documents there are.
    """
    vocabulary = sorted({w for t in templates for w in template_words(t.text)})
    held = F.array_intersect(text_words(F.col("text")), _constant(vocabulary, "array<string>"))
    # "" counts rows; the outer form keeps Spark from evaluating the list once more in a filter of empty ones.
    rows = pick(docs, text="string").select(F.explode_outer(F.array_append(held, F.lit(""))).alias("word"))
    counts = {r["word"]: r["documents"] for r in rows.groupBy("word").agg(F.count("*").alias("documents")).collect()}
    n = counts.get("", 0)
    return {w: math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(w, 0) + 1))) for w in vocabulary}


def rare_words(template: Template, weights: dict[str, int]) -> list[str]:
    """The highest-weighted of a template's distinct words: every fourth, at least one."""
    distinct = sorted(set(template_words(template.text)), key=lambda w: (-weights[w], w))
    return distinct[: -(-len(distinct) // RARE_SHARE)]


def positional_index(templates: tuple[Template, ...], weights: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """rare word -> [(template, place of the word in it)]."""
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        rare = set(rare_words(template, weights))
        for place, word in enumerate(template_words(template.text)):
            if word in rare:
                index.setdefault(word, []).append((t, place))
    return index


def _constant(value: object, kind: str) -> Column:
    """A nested constant; Spark folds it into the plan once, where literals by the thousand would be built one by one."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, weights: dict[str, int] | None = None
) -> DataFrame:
    """(doc_id, n_words, found) per row of ``docs``; ``found`` lists where templates stand in its text, in order.

    An entry is (label, base, start, score): ``start`` is the word where the template begins, negative where its
    beginning is missing; ``score`` the share of the template's weight whose words stand at their places.

    Only the rarest words of a template are looked up in a text. Each gives the places where its templates would
    begin; a beginning named by at least half of a template's rare places is verified: all words of its
    mandatory phrases must stand there. A phrase without further text is its own mandatory phrase and has one
    rare word, so each of its places is found. Everything stays inside the row: nothing is shuffled but the counts of
    template words, and the work is linear in a text's length, up to the sort of what its rare words name.

    Null and empty texts have no words and no entries. Repeated rows give a row each and count as often in the
    weights, rows without doc_id too; other columns are ignored. Without documents there are no rows.
    """
    weights = weights if weights is not None else word_weights(docs, templates)
    index = positional_index(templates, weights)
    bodies = [template_words(t.text) for t in templates]
    total = [max(sum(weights[w] for w in b), 1) for b in bodies]
    rare = [sum(len([1 for t, _ in places if t == i]) for places in index.values()) for i in range(len(templates))]
    must = [set(required(t)) for t in templates]

    postings = _constant(
        {word: [{"t": t, "o": o} for t, o in places] for word, places in index.items()},
        "map<string, array<struct<t int, o int>>>",
    )
    table = _constant(
        [
            {
                "label": t.label,
                "base": t.base,
                "body": [{"word": w, "weight": weights[w], "must": j in must[i]} for j, w in enumerate(bodies[i])],
                "total": total[i],
            }
            for i, t in enumerate(templates)
        ],
        "array<struct<label string, base boolean, body array<struct<word string, weight int, must boolean>>, total int>>",
    )
    votes = _constant([-(-r // 2) for r in rare], "array<int>")

    n = F.size("words")
    named = pick(docs, doc_id="bigint", text="string").select("doc_id", text_words(F.col("text")).alias("words"))
    word_at = lambda i: F.get(F.col("words"), i)
    hits = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: word_at(i).isin(*index)))
    named = named.withColumn("hits", F.coalesce(hits, F.array().cast("array<int>")))
    starts = F.flatten(
        F.transform(
            "hits",
            lambda i: F.transform(postings[word_at(i)], lambda p: F.struct(p["t"].alias("t"), (i - p["o"]).alias("start"))),
        )
    )
    voted = named.withColumn("starts", F.sort_array(starts))
    # In sorted order a beginning has enough votes where the entry so many places on is still the same.
    enough = F.filter("starts", lambda s, k: s.eqNullSafe(F.get(F.col("starts"), k + F.get(votes, s["t"]) - 1)))
    voted = voted.withColumn("begins", F.array_distinct(enough))

    def stands(s: Column) -> Column:
        """What is there of the template that would begin at s."""
        template = F.get(table, s["t"])
        there = lambda w, j: word_at(s["start"] + j).eqNullSafe(w["word"])
        missing = F.filter(template["body"], lambda w, j: w["must"] & ~there(w, j))
        gained = F.transform(template["body"], lambda w, j: F.when(there(w, j), w["weight"]).otherwise(0))
        share = F.aggregate(gained, F.lit(0), lambda a, x: a + x) / template["total"]
        return F.struct(
            s["start"].cast("bigint").alias("start"),
            template["label"].alias("label"),
            template["base"].alias("base"),
            F.when(F.size(missing) == 0, share).alias("score"),
        )

    checked = voted.withColumn("checked", F.transform("begins", stands))
    return checked.select(
        "doc_id",
        n.cast("bigint").alias("n_words"),
        F.sort_array(F.filter("checked", lambda f: f["score"].isNotNull())).alias("found"),
    )


def digest(docs: DataFrame) -> DataFrame:
    base = F.filter("found", lambda f: f["base"])
    names = lambda found: F.array_join(F.sort_array(F.array_distinct(found["label"])), ",")
    scanned = scan(docs).withColumn("base", base)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.col("base")["start"]).alias("first_word"),
        F.array_max(F.col("base")["start"]).alias("last_word"),
        names(F.col("base")).alias("base_labels"),
        names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.col("found")["score"]), F.lit(0.0)).alias("score"),
    )


def _values(rows: list[tuple]) -> str:
    quote = lambda v: "'" + v + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)


_BODY = _values(
    [(i, j, w, j in required(t)) for i, t in enumerate(TEMPLATES) for j, w in enumerate(template_words(t.text))]
)
_NAMES = _values([(i, t.label, t.base) for i, t in enumerate(TEMPLATES)])
ORACLE = rf"""
WITH body(t, o, word, must) AS (VALUES {_BODY}), names(t, label, base) AS (VALUES {_NAMES}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
f AS (SELECT word, floor(1000 * ln((2 * (SELECT count(*) FROM documents) + 2) / (2 * count(DISTINCT doc_id) + 1)))::BIGINT AS weight
  FROM (SELECT DISTINCT word FROM body) LEFT JOIN w USING (word) GROUP BY word),
b AS (SELECT body.*, weight FROM body JOIN f USING (word)),
r AS (SELECT t, word FROM (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY weight DESC, word) AS k, count(*) OVER (PARTITION BY t) AS n
  FROM (SELECT DISTINCT t, word, weight FROM b)) WHERE k <= (n + {RARE_SHARE} - 1) // {RARE_SHARE}),
x AS (SELECT t, word, o FROM b SEMI JOIN r USING (t, word)),
q AS (SELECT t, count(*) AS rare FROM x GROUP BY t),
v AS (SELECT doc_id, t, start FROM (SELECT doc_id, t, p - o AS start, count(*) AS votes FROM w JOIN x USING (word) GROUP BY ALL)
  JOIN q USING (t) WHERE 2 * votes >= rare),
c AS (SELECT v.doc_id, v.t, v.start, count(*) FILTER (must AND w.word IS DISTINCT FROM b.word) AS missing,
    coalesce(sum(weight) FILTER (w.word = b.word), 0) / greatest(sum(weight), 1) AS score
  FROM v JOIN b USING (t) LEFT JOIN w ON w.doc_id = v.doc_id AND w.p = v.start + b.o GROUP BY ALL),
g AS (SELECT doc_id, start, label, base, score FROM c JOIN names USING (t) WHERE missing = 0)
SELECT d.doc_id, len(words)::BIGINT AS n_words, count(*) FILTER (base)::BIGINT AS n_base, min(start) FILTER (base)::BIGINT AS first_word,
  max(start) FILTER (base)::BIGINT AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0)::DOUBLE AS score
FROM d LEFT JOIN g USING (doc_id) GROUP BY d.doc_id, words
"""
