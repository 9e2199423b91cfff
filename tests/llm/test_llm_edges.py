"""Every operator on nulls, empties, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import pandas as pd
import pytest
from edge_cases import documents, documents_frame, equal_to_sql, frame, repeats

from waykit.llm import arc, chat, decontam, jaccard, lines, mixing, quality, rules, sharding, suffixes

LABELS = "doc_id bigint, quality int, toxic int"


def labels(spark, rows=((4, 1, 0), (5, 1, 1), (6, None, None), (17, 0, 0), (20, 0, 0), (None, 1, 0), (4, 1, 0))):
    return spark.createDataFrame(list(rows), LABELS)


def benchmark(spark):
    text = documents()[3][1]
    items = [(1, " ".join(text.split(" ")[10:50])), (2, None), (3, ""), (None, "three"), (4, "not there at all in any of them")]
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS TEXT")


OPERATORS = {
    "quality": lambda s, d: quality.digest(d, labels(s)),
    "mixing": lambda s, d: mixing.digest(d),
    "jaccard": lambda s, d: jaccard.digest(d),
    "sharding": lambda s, d: sharding.digest(d),
    "rules": lambda s, d: rules.digest(d, labels(s)),
    "suffixes": lambda s, d: suffixes.digest(d),
    "lines": lambda s, d: lines.digest(d),
}
SQL = {"mixing": mixing.ORACLE, "jaccard": jaccard.ORACLE, "suffixes": suffixes.ORACLE, "lines": lines.ORACLE, "rules": rules.ORACLE}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows_give_a_row_each(spark, name):
    got = OPERATORS[name](spark, frame(spark, documents()))
    assert got.count() == len(documents()) and got.where("doc_id IS NULL").isEmpty()
    if name in SQL:
        equal_to_sql(got, SQL[name], documents=documents_frame(documents()), labels=labels(spark).toPandas())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_and_rows_without_id_each_give_a_row(spark, name):
    got = OPERATORS[name](spark, frame(spark, repeats())).toPandas()
    assert len(got) == len(repeats()) and got["doc_id"].isna().sum() == 3
    again = OPERATORS[name](spark, frame(spark, repeats()[::-1])).toPandas()
    order = list(got.columns)
    pd.testing.assert_frame_equal(
        got.sort_values(order, ignore_index=True), again[order].sort_values(order, ignore_index=True), check_dtype=False
    )


def test_operators_without_labels(spark):
    none = labels(spark, ())
    docs = frame(spark, documents())
    assert {r["score"] for r in quality.digest(docs, none).collect()} == {0.5}
    judged = rules.digest(docs, none).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in judged)


def test_leaks_on_edge_rows(spark):
    found = decontam.digest(frame(spark, documents()), benchmark(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(4, 1), (5, 1), (6, 1), (7, 1), (8, None), (9, None), (10, None)}
    assert decontam.digest(frame(spark, []), benchmark(spark)).count() == 0
    assert decontam.digest(frame(spark, documents()), benchmark(spark).limit(0)).count() == 0
    assert decontam.digest(frame(spark, repeats()), benchmark(spark)).where("item_id IS NULL").count() == 1


def test_pipeline_stages_on_edge_rows(spark):
    for rows in (documents(), repeats(), []):
        docs = frame(spark, rows)
        for stage in (lambda d: quality.keep_good(d, labels(spark)), jaccard.one_of_each, lambda d: decontam.clean(d, benchmark(spark)), mixing.repeated):
            out = stage(docs)
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert {tuple(r) for r in out.collect()} <= set(rows)


def test_pages_edge_rows(spark):
    rows = [(1, "http://a/b c\n", None), (2, None, ""), (3, "dns:x", "<p>é\r\n\r\nWARC/1.0\r\n\r\n</p>"), (None, "u", "same"), (7, "u", "same"),
            (5, "u", "same"), (7, "u", "same"), (9, "http://x", "x" * 6_000_000), (10, "http://x", "y\n\n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS URL", "2 AS digest", "3 AS head")
    got = arc.digest(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got if r["page_id"] != 7}
    assert by[1]["payload_bytes"] == by[2]["payload_bytes"] == 0 and by[2]["refers_to"] == 1 and by[1]["record_type"] == "response"
    assert by[5]["record_type"] == "response" and by[None]["refers_to"] == 5
    assert [r["refers_to"] for r in got if r["page_id"] == 7] == [5, 5] and by[9]["payload_bytes"] == 6_000_000
    unique = [r for r in rows if r[0] not in (None, 7)]
    plain = spark.createDataFrame(unique, "page_id bigint, url string, html string")
    pdf = pd.DataFrame(unique, columns=["page_id", "url", "html"]).astype({"url": "string", "html": "string"})
    equal_to_sql(arc.digest(plain), arc.ORACLE, pages=pdf)
    assert arc.digest(pages.limit(0)).count() == 0


def test_pages_with_the_largest_and_smallest_numbers(spark):
    ids = (2**63 - 1, 2**63 - 2, 10**18, -(2**63), 1 - 2**63, -(10**18), 0)
    rows = [(i, "http://h", ("same", "also")[k % 2]) for k, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = arc.digest(pages).collect()  # pandas would round numbers beside nulls
    assert {r["page_id"]: r["refers_to"] for r in got} == {
        i: None if i <= 1 - 2**63 else {"same": 1 - 2**63, "also": -(2**63)}[h] for i, _, h in rows
    }
    assert len(got) == len(rows)
    assert [arc.whole_number(t) for t in (str(2**63), str(-(2**63) - 1), "1" * 20, "", "-", None)] == [None] * 6


def test_conversations_edge_rows(spark):
    rows = [(1, 0, "system", "be <|im_start|> ~1 brief"), (1, 1, "user", None), (1, 2, "assistant", ""), (2, 0, "assistant", "x" * 5000),
            (2, 1, None, "who\n"), (2, 1, "assistant", "a b " * 600), (3, 5, "system", "only"), (4, 1, "user", "<~1|"), (4, 0, "assistant", "é 漢"),
            *[(5, i, "assistant" if i % 2 else "user", f"turn {i} " + "w " * (i % 37)) for i in range(120)],
            *[(6, i, ("system", "user", "assistant")[min(i, 1 + i % 2)], "s " * 200) for i in range(9)]]
    kinds = "conv_id bigint, turn bigint, role string, text string"
    talk = spark.createDataFrame(rows, kinds).selectExpr("*", "1 AS ROLE", "2 AS block", "3 AS tokens")
    pdf = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"role": "string", "text": "string"})
    equal_to_sql(chat.digest(talk), chat.ORACLE, conversations=pdf)
    assert chat.digest(talk.limit(0)).count() == 1
    twice = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "hi"), (None, 1, "user", "hi")], kinds)
    assert {(r["conv_id"], r["n_turns"]) for r in chat.digest(twice).collect()} == {(None, 3), (-1, 2)}
