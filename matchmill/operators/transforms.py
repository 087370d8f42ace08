"""Table-to-table steps: keep, rename, dedupe, stamp, union."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.functions import dates
from matchmill.session import cut_lineage


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in list order; an absent name is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in the table: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names the table does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def dedupe_first(df: DataFrame, subset: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``, which should be total within a key.

    The ``= 1`` filter on row_number lets Spark cut every key to one row per map task
    before the shuffle, so a key holding any share of the rows sends one row per task.
    """
    window = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(window)).where("_first = 1").drop("_first")


#: So many repeated keys are a table that is broadcast; with more, rows are shuffled as they are.
FEW_KEYS = 1 << 20


def dedupe_few(df: DataFrame, subset: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``dedupe_first`` of rows that can be read twice, a written table's, whose keys seldom repeat.

    Hashes of the keys are counted first; only rows under a hash that repeats are shuffled.
    """
    hashed = F.xxhash64(*subset)
    counts = df.groupBy(hashed.alias("_key_hash")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(counts.where("_n > 1").select("_key_hash"), "repeated")
    n = repeated.count()
    if n == 0 or n > FEW_KEYS:
        return dedupe_first(df, subset, order) if n else df
    marked = df.withColumn("_key_hash", hashed)
    alone = marked.join(repeated, "_key_hash", "left_anti").drop("_key_hash")
    again = marked.join(repeated, "_key_hash", "left_semi").drop("_key_hash")
    return alone.unionByName(dedupe_first(again, subset, order))


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where rows of a key are alike or any will do: the smallest, so that reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    return dedupe_first(df, keys, rest) if rest else df.distinct()


def dedupe_keys(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Distinct keys, for tables whose whole row is the key; combined map-side."""
    return df.select(*subset).distinct()


# Names and formats of the columns that jobs add.
JOB_COLUMNS, JOB_FORMAT = ("tech_dag_id", "tech_execution_date"), "%Y-%m-%d %H:%M:%S"
PHOTO_COLUMNS, PHOTO_FORMAT = ("tech_date_photo", "tech_annee_photo", "tech_semaine_photo"), "%Y-%m-%d"


def tech_info(df: DataFrame, job_id: str, job_time: dt.datetime | str, names: Sequence[str] = JOB_COLUMNS) -> DataFrame:
    """Stamp each row with the job id and the job time as Paris wall-clock text."""
    stamp = F.date_format(dates.paris_time(job_time), dates.spark_pattern(JOB_FORMAT))
    return df.withColumns(dict(zip(names, (F.lit(job_id), stamp), strict=True)))


def tech_photo(
    df: DataFrame, job_time: dt.datetime | str, names: Sequence[str] = PHOTO_COLUMNS, date_format: str = PHOTO_FORMAT
) -> DataFrame:
    """Stamp each row with the snapshot day, its ISO year and its ISO week."""
    moment = dates.paris_time(job_time)
    day = F.date_format(moment, dates.spark_pattern(date_format))
    return df.withColumns(dict(zip(names, (day, dates.iso_year(moment), dates.iso_week(moment)), strict=True)))


def union_sources(sources: Iterable[DataFrame | None]) -> DataFrame:
    """All sources stacked by column name; absent columns are NULL, None sources are skipped."""
    present = [s for s in sources if s is not None]
    if not present:
        raise ValueError("no source to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)
