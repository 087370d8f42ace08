"""Row numbers and ranks in groups too large for one task.

A plain window sorts a whole group in one task. Here the table is range-sorted over all
tasks once and written with each row's position; numbers then come from positions and
small per-task summaries, however the rows fall on the groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.session import cut_lineage

# monotonically_increasing_id() puts the task in the upper bits, the row's position below.
_TASK_SHIFT = 33
_SCRATCH = ["_task", "_pos", "_first", "_n", "_first_key", "_last_key", "_offset", "_tie"]


def _tie_start(one: Column, two: Column, at: Column) -> Column:
    """The position of the first row of each row's run of equal keys, of a task's sorted rows: two hashes and a position."""

    # Defined in here, so that executors get it by value and need nothing of this package.
    def mark(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        before, start = None, 0
        for one, two, at in parts:
            one, two, at = one.to_numpy(), two.to_numpy(), at.to_numpy()
            if not len(at):
                yield pd.Series([], dtype="int64")
                continue
            new = np.ones(len(at), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            new[0] = before != (one[0], two[0])
            starts = np.maximum.accumulate(np.where(new, at, start))
            before, start = (one[-1], two[-1]), int(starts[-1])
            yield pd.Series(starts)

    return F.pandas_udf(mark, "long")(one, two, at)


def _range_sorted(df: DataFrame, groups: Sequence[str], order: Sequence[str], ties: bool = False) -> DataFrame:
    """``df`` range-partitioned and sorted, with ``_task`` and ``_pos``, cut from its lineage.

    The input row id splits a run of equal keys over several tasks. Positions are stored
    before they are used, so all later passes agree on them after a lost executor too.
    With ``ties`` also ``_tie``, the position where the row's run of equal keys begins in its task.
    """
    keys = [F.col(g).asc() for g in groups] + [_direction(o) for o in order]
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys, F.col("_row").asc()).sortWithinPartitions(*keys, "_row")
    placed = placed.drop("_row").withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns(
        {
            "_task": F.shiftright("_at", _TASK_SHIFT).cast("int"),
            "_pos": F.col("_at").bitwiseAND(F.lit((1 << _TASK_SHIFT) - 1)),
        }
    )
    if ties:
        # Hashes leave NULLs out, so these are named beside the values.
        same = [F.col(c) for c in (*groups, *_plain(order))]
        same += [c.isNull() for c in same]
        placed = placed.withColumn("_tie", _tie_start(F.xxhash64(F.lit(1), *same), F.xxhash64(F.lit(2), *same), "_pos"))
    return cut_lineage(placed.drop("_at"), "ranking")


def _direction(text: str):
    name, _, direction = text.partition(" ")
    return F.col(name).desc() if direction.strip().lower() == "desc" else F.col(name).asc()


def _plain(order: Sequence[str]) -> list[str]:
    return [o.partition(" ")[0] for o in order]


def numbered_in_groups(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    number: str = "row_number",
    rank: str | None = None,
) -> DataFrame:
    """``df`` with ``row_number`` (and ``rank``) over (PARTITION BY groups ORDER BY order).

    ``order`` holds names, each with an optional ``desc``; NULLs sort as Spark sorts them.
    ``df`` should be a table read, not a chain of shuffles: row ids split ties.
    """
    rows = _range_sorted(df, groups, order, ties=rank is not None)
    keys = F.struct(*_plain(order))
    parts = [*groups, "_task"]
    # One row per (group, task): at most groups + tasks rows in total.
    summary = rows.groupBy(*parts).agg(
        F.min("_pos").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by(keys, "_pos").alias("_first_key"),
        F.max_by(keys, "_pos").alias("_last_key"),
    )
    before = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    small = summary.withColumnsRenamed({p: f"_g_{p}" for p in parts})
    same_part = F.lit(True)
    for part in parts:
        same_part = same_part & F.col(part).eqNullSafe(F.col(f"_g_{part}"))
    value = (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("long")
    scratch = [*_SCRATCH, *[f"_g_{p}" for p in parts]]
    if rank is None:
        return rows.join(small, same_part, "left").withColumn(number, value).drop(*scratch)
    # A run of equal keys that began in an earlier task takes that task's starting number.
    starts = (
        rows.join(small, same_part, "left")
        .where(keys.eqNullSafe(F.col("_last_key")))
        .groupBy(*[F.col(g).alias(f"_h_{g}") for g in groups], F.col("_last_key").alias("_run"))
        .agg(F.min(value).alias("_run_start"))
    )
    same_run = F.col("_first_key").eqNullSafe(F.col("_run"))
    for group in groups:
        same_run = same_run & F.col(f"_g_{group}").eqNullSafe(F.col(f"_h_{group}"))
    # A table of known size: rows are not sorted or shuffled a second time where it is small.
    small = cut_lineage(small.join(starts, same_run, "left"), "numbers")
    in_task = F.col("_offset") + F.col("_tie") - F.col("_first") + 1
    carried = F.when(keys.eqNullSafe(F.col("_first_key")), F.col("_run_start"))
    ranked = rows.join(small, same_part, "left").withColumns(
        {number: value, rank: F.coalesce(carried, in_task).cast("long")}
    )
    return ranked.drop(*scratch, "_run", "_run_start", *[f"_h_{g}" for g in groups])
