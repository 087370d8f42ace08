"""Checks on tables and arguments."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.functions.scalars import valid_text
from matchmill.session import freed_shuffles

# Fixed value: what a schema, table or column name may look like.
IDENTIFIER = re.compile(r"^[a-zA-Z0-9_]+$")


class SkipJob(Exception):
    """Nothing to do; the job ends as skipped, not failed."""


class EmptyWork(SkipJob):
    """The work list itself is empty: there is nothing left to pick."""


class NoRows(ValueError):
    """An insert got zero rows."""


def identifier(name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"invalid name {name!r}: letters, digits and _ only")
    return name


def skip_if_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise SkipJob(f"no rows in {what}")
    return df


def require_column(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        raise SkipJob(f"column {column} is missing")
    return df


def require_valid_text(df: DataFrame, column: str) -> DataFrame:
    """Fail the query on a NULL or empty value, in the same pass that reads it."""
    checked = F.when(valid_text(F.col(column)), F.col(column)).otherwise(
        F.raise_error(F.lit(f"invalid {column}")).cast("string")
    )
    return df.withColumn(column, checked)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count; counted map-side first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def _key_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """A hash of each row's key, equal where keys are; none for keys that may be equal in other bits (0.0 and -0.0)."""
    plain = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    if any(not isinstance(df.schema[k].dataType, plain) for k in keys):
        return None
    return df.select(F.xxhash64(*keys).alias("key_hash"))


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no key repeats. Hashes are counted first: keys are shuffled only if hashes repeat."""
    hashes = _key_hash(df, keys)
    with freed_shuffles(df.sparkSession):
        if hashes is not None and duplicate_keys(hashes, ["key_hash"]).limit(1).isEmpty():
            return True
        return duplicate_keys(df, keys).limit(1).isEmpty()


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    if not is_unique(df, keys):
        raise ValueError(f"{what}: key {list(keys)} is not unique")
    return df


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a step and how many it removed."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    rows_after: Column = count(after, "rows_after").scalar()
    return count(before, "rows_before").select(
        "rows_before",
        rows_after.alias("rows_after"),
        (F.col("rows_before") - rows_after).alias("rows_removed"),
    )
