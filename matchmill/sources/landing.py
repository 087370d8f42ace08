"""Landed files: JSON with an explicit schema, parquet hand-offs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchmill import schemas


def read_json(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON lines, or one document per file; no inference pass."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """One raw JSON document per line, as column ``payload``; bad lines are kept."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def read_id_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.ID_PAGE)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.ACCOUNT)


def read_league_entries(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.LEAGUE_ENTRIES)


def read_champions(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.CHAMPIONS, multi_line)


def read_items(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.ITEMS, multi_line)
