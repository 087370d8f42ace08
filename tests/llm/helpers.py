"""Small tables for the operators' tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Nulls, empty and blank texts, repeated rows, one id with two texts, a null id, a very long text.
ODD_DOCUMENTS = [
    (1, "One line here\nAnother line there\n"),
    (1, "One line here\nAnother line there\n"),
    (1, "a different text of the same id"),
    (2, None),
    (3, ""),
    (4, " \t \n  "),
    (None, "a text without an id"),
    (5, "word " * 40_000 + "\n" + "x" * 100_000),
    (6, "Überall ist’s \x00 schön — 日本語テキスト \U0001f600"),
]


def documents(spark: SparkSession, rows, clash: bool = True) -> DataFrame:
    """Rows of (doc_id, text), with columns named like the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clash:
        for name in ("version", "pos", "n_lines", "n_dropped", "keep", "kept_text", "w0", "node", "spans", "items", "score", "label", "found", "next", "n_chars"):
            df = df.selectExpr("*", f"7 AS {name}")
    return df


def odd(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD_DOCUMENTS)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
