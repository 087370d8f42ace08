"""Engine workloads: derived columns, wide aggregates, windows, a sampled self join, caching."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1000
WINDOW_BUCKETS = 100


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept while several actions use it, and released after."""
    df = df.cache()
    try:
        yield df
    finally:
        df.unpersist()


def memory_columns(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Random, root, text and hash columns over a numeric key."""
    text = F.concat(F.lit("row_"), F.col(key).cast("string"))
    return df.withColumns(
        {
            "data1": F.rand(seed),
            "data2": F.rand(seed + 1) * 1000,
            "data3": F.rand(seed + 2) * F.col(key),
            "data4": F.sqrt(key),
            "text_col": text,
            "hash_col": F.hash(text),
        }
    )


def _formula(step: int, x: Column) -> tuple[str, Column]:
    # Scales and the five-column steps of the CPU workload.
    if step < 5:
        return "trig", F.sin(x / 1000.0) * F.cos(x / 1000.0) * F.tan(x / 10000.0)
    if step < 10:
        return "exp", F.exp(x / 1000000.0) + F.log(x + 1)
    if step < 15:
        return "power", F.pow(x, F.lit(0.5)) + F.sqrt(x + 1)
    return "complex", F.sqrt(F.sin(x / 1000.0)) + F.log(F.cos(x / 1000.0) + 2)


def math_columns(df: DataFrame, key: str, count: int) -> DataFrame:
    """``count`` math columns over a numeric key, added in one projection."""
    named = {}
    for step in range(count):
        kind, formula = _formula(step, F.col(key))
        named[f"{kind}_{step}"] = formula
    return df.withColumns(named)


def global_aggregate(df: DataFrame, total: str, mean: str, largest: str, smallest: str) -> DataFrame:
    return df.agg(
        F.sum(total).alias(f"sum_{total}"),
        F.avg(mean).alias(f"avg_{mean}"),
        F.max(largest).alias(f"max_{largest}"),
        F.min(smallest).alias(f"min_{smallest}"),
        F.count(F.lit(1)).alias("total_count"),
    )


def wide_aggregate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum, mean, extremes and deviation of the named columns, in one pass."""
    kinds = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev}
    return df.agg(*[f(c).alias(f"{kind}_{c}") for c in columns for kind, f in kinds.items()])


def self_join_sample(df: DataFrame, key: str, size: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` joined with its own ``size`` smallest distinct keys, which are few enough to broadcast.

    As the keys are distinct a row is found once, however often its key is repeated.
    """
    sample = df.select(F.col(key).alias("join_id")).distinct().orderBy("join_id").limit(size)
    return df.join(F.broadcast(sample), F.col(key) == F.col("join_id"), "inner")


def memory_workload(df: DataFrame, key: str) -> dict[str, int]:
    """Cache, count, aggregate and self-join one table; returns the row counts."""
    with cached(memory_columns(df.select(key), key)) as rows:
        count = rows.count()
        totals = global_aggregate(rows, "data1", "data2", "data3", "data4").first()
        joined = self_join_sample(rows, key).count()
    return {"count": count, "aggregated": totals["total_count"], "joined": joined}
