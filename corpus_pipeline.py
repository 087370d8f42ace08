"""Documents through five stages to token ids: quality, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept. Stages but
the last return the columns of the documents, with ``n_chars`` following the text where it changes.
Nulls and empty texts are handled as the operators' docstrings say; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.llm import decontaminate, line_dedup, quality, simhash
from matchmill.llm.queries import table, vocabulary
from matchmill.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' columns, ``n_chars`` counted again if they have it."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select([F.col(f"`{c}`") for c in columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels, scores at least 0.3."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a line that ten or more documents have only the first stays; documents left without a line go."""
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1, keep_first=True)
    marks = docs.withColumnRenamed("n_lines", "__n_lines").withColumnRenamed("n_dropped", "__n_dropped").withColumnRenamed("kept_text", "__kept_text")
    kept = line_dedup.apply_bitmaps(marks, bitmaps)
    kept = kept.where((F.col("n_dropped") == 0) | (F.col("n_dropped") < F.col("n_lines"))).drop("n_lines", "n_dropped")
    kept = kept.drop("text").withColumnRenamed("kept_text", "text")
    for name in ("n_lines", "n_dropped", "kept_text"):
        kept = kept.withColumnRenamed(f"__{name}", name)
    return _with_text(kept, docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return simhash.one_of_each(docs, size=5, index=simhash.SIMILAR_1024)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    return _with_text(decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token_ids and n_tokens; ``text`` is what the ids decode to."""
    words = vocabulary(spark)
    # Written between: else each task keeps two Python workers, which stay with all they hold for the stages after.
    encoded = cut_lineage(docs.withColumn("token_ids", words.encode(F.col("text"))).drop("text"), "encoded")
    decoded = encoded.withColumn("text", words.decode(F.col("token_ids")).cast("string"))
    columns = [*docs.columns, *["token_ids"] * ("token_ids" not in docs.columns)]
    return decoded.select([F.col(f"`{c}`") for c in columns]).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", encoding_stage),
]

#: Boosted trees are beyond SQL; the tests hold the result against a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
