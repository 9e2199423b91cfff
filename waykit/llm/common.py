"""Small helpers that all operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waykit.session import scratch_dir, shuffles_freed

WHITESPACE = " \t\n\x0b\x0c\r"  # the class [\x20\x09-\x0D]
DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns alone, cast, whatever else ``df`` carries.

    Columns are found by position, so extra columns whose names clash (also in another case) do no
    harm; the exact name wins. A missing column is null.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])

    def found(name: str, kind: str) -> Column:
        same = [i for i, n in enumerate(names) if n == name]
        alike = same or [i for i, n in enumerate(names) if n.lower() == name.lower()]
        return (F.col(f"_c{alike[0]}") if alike else F.lit(None)).cast(kind).alias(name)

    return plain.select(*[found(n, k) for n, k in types.items()])


def stored(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read again: lineage ends there.

    A task holds one row group in memory while it writes; ``row_group`` is its size in bytes, if not the usual one.
    """
    path = scratch_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.options(**({"parquet.block.size": row_group} if row_group else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The maximal runs of ``[^\\x20\\x09-\\x0D]``; null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITESPACE, " " * len(WHITESPACE))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
