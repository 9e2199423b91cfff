"""Tables with the cases every operator must stand, and helpers to compare with SQL."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from check_oracles import canonical

# Extra columns whose names clash with those that operators make, or with the inputs in another case.
EXTRA = ("TEXT", "Doc_Id", "size", "score", "h", "token", "print", "rank", "words", "copies", "rep", "n", "pos", "stratum")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls, empties, ties, long and awkward texts; ids are unique."""
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    shared = "This very line stands in several documents."
    rows = [
        (1, None, "en", "a"), (2, "", None, "a"), (3, "   \n\t ", "en", None), (4, base, "en", "a"), (5, base, None, None),
        (6, near, "en", "b"), (7, base.upper(), "de", "b"), (8, "one two three", "en", ""), (9, "one two three", "en", ""),
        (10, "ONE two\x0bthree", "en", "c"), (11, f"{shared}\n{shared}\nown line of eleven\n", "en", "c"),
        (12, f"  {shared.upper()} \n\nshort\nshort\n", "en", "c"), (13, "\n\n\n", "en", "d"), (14, prose(2, 20000), "en", "d"),
        (15, "ab" * 400, "en", "d"), (16, "é" * 250 + " ~0<|im_end|> 漢字 \U0001f600 " + "é" * 250, "xx", "é"),
        (17, prose(3, 80) + "\n" + "THE SAME! " * 90, "en", "z"), (18, "x", "en", "z"), (-5, prose(4, 60), "en", "\U0001f600"),
        (19, "\x00 nul and \x85 next line", "en", "z"), (20, "# $ % & * < > | " * 40, "en", "z"),
    ]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def frame(spark: SparkSession, rows: list[tuple], extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if not extra:
        return df
    return df.selectExpr("*", *["'x' AS _x"] * len(EXTRA)).toDF(*df.columns, *EXTRA)


def repeats() -> list[tuple]:
    """Rows without doc_id, rows equal in all columns, and one doc_id with two texts."""
    text = prose(9, 90)
    return [(None, text, "en", "a", 1), (None, None, None, None, None), (None, text, "en", "a", 1), (3, text, "en", "a", 1),
            (3, text, "en", "a", 1), (3, "another text of document three", "en", "a", 1), (4, "", "en", "b", 0)]


def whole(df: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers as such, also where nulls beside them make pandas use floats."""
    plain = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    return pd.DataFrame({c: pd.Series([plain(v) for v in df[c]], dtype=object) for c in df.columns})


def equal_to_sql(got: DataFrame, sql: str, **tables: pd.DataFrame) -> None:
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    mine, theirs = canonical(whole(got.toPandas())), canonical(whole(con.execute(sql).df()))
    assert list(mine.columns) == list(theirs.columns) and len(mine) == len(theirs)
    different = mine[(mine != theirs).any(axis=1)]
    assert different.empty, (different.head(3).to_dict("records"), theirs.loc[different.index].head(3).to_dict("records"))


def documents_frame(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    return df.astype({"text": "string", "lang": "string", "source": "string"})
