"""Joins whose plans hold when one key carries a large share of the rows.

Inner, left and right joins are left to Catalyst: AQE broadcasts a side it has measured
to be small and splits hot partitions. It splits only joins of two plain shuffles, never
a full outer join, nor the right of a semi or anti join. So the right of those is reduced
to a written table of distinct keys, and a full join is composed of joins that split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.session import cut_lineage

#: A crowded bin of a range join is cut into pieces of so many rows: a task's pairs of two are its square.
PIECE = 1 << 13


def key_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``df`` (combined map-side), NULLs left out, as a written table.

    Read back it is a plain scan of known size: it is broadcast when small, and otherwise
    leaves the other side of the join free to be split on a hot key.
    """
    return cut_lineage(df.select(*keys).dropna().distinct(), "keys")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``."""
    return left.join(key_table(right, keys), list(keys), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; a NULL key is never found."""
    return left.join(key_table(right, keys), list(keys), "left_anti")


def lookup(df: DataFrame, *dimensions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join dimensions: stored tables of one row per key. Rows without a match stay."""
    for dimension in dimensions:
        df = df.join(dimension, list(on), "left")
    return df


def pack(df: DataFrame, name: str) -> DataFrame:
    """All columns of ``df`` as one struct column, so ``name.column`` still resolves."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def full_join(left: DataFrame, right: DataFrame, right_name: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Full outer equi-join of packed frames: a left join, and the right rows whose key the left has not.

    ``left`` holds struct columns (see ``pack``), ``right`` the single struct ``right_name``;
    each pair is a dotted left column and a column of the right struct. Both joins can be split on a
    hot key. Each side is read twice and neither is written, but for the distinct keys of the left.
    """
    left_names = left.columns
    keys = [f"_k{i}" for i in range(len(pairs))]
    keyed_left = left.select("*", *[F.col(a).alias(k) for k, (a, _) in zip(keys, pairs, strict=True)])
    keyed_right = right.select("*", *[F.col(f"{right_name}.{b}").alias(k) for k, (_, b) in zip(keys, pairs, strict=True)])
    right_only = anti_join(keyed_right, keyed_left, keys)
    for name in left_names:
        right_only = right_only.withColumn(name, F.lit(None).cast(left.schema[name].dataType))
    columns = [*left_names, right_name]
    return keyed_left.join(keyed_right, keys, "left").select(*columns).unionByName(right_only.select(*columns))


def compares_all(df: DataFrame) -> int:
    """How many joins of ``df`` compare all pairs of rows, by the plan that Spark has made for it."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct")


def range_join(left: DataFrame, right: DataFrame, value: Column, low: Column, high: Column, kind: str = "inner") -> DataFrame:
    """Rows of ``left`` and ``right`` with ``low <= value <= high`` (``low`` and ``high`` of ``right``), inner or left.

    Values and bounds are numbers or timestamps (cast dates to those). An interval is put into the one or two bins
    of the width that is the next power of two to its length; a value looks into its bin of each
    width that some interval has. So the join has keys, an interval makes two rows at most however long
    it is, and a value as many as there are widths: a few, and never more than the 128 that are told apart.
    The pairs of a bin grow with the square of its rows, though its bytes do not: both sides of a crowded bin
    are cut into pieces of ``PIECE`` rows, and each pair of pieces is a key, so that no task has many more pairs
    than others. The pairs themselves are as many as the result has, but for a factor of two to four.
    """
    if kind not in ("inner", "left"):
        raise ValueError("a range join is inner or left")
    start, stop = _number(low), _number(high)
    width = F.greatest(F.ceil(F.log2(F.greatest(stop - start, F.lit(2.0**-63)))), F.lit(-63)).cast("int")
    bins = F.array_distinct(F.array(_bin(start, F.col("_width")), _bin(stop, F.col("_width"))))
    ranged = right.where(start <= stop).withColumn("_width", F.least(width, F.lit(64)))
    # One row for each width, of which there are 128 at most.
    widths = sorted(r[0] for r in ranged.select("_width").distinct().collect())
    placed = ranged.withColumn("_bin", F.explode(bins)).withColumnRenamed("_width", "_of_width").withColumnRenamed("_bin", "_of_bin")
    within = (value >= low) & (value <= high)
    scratch = ["_width", "_bin", "_left_piece", "_right_piece"]
    wanted = F.array(*[F.lit(w) for w in widths]).cast("array<int>")

    def looking(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_width", F.explode(wanted)).withColumn("_bin", _bin(_number(value), F.col("_width")))

    # Rows are numbered once and written, so that numbers stay: they tell a row's piece, and which rows have found nothing.
    numbered = cut_lineage(left.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_left")), "range-left")
    unpacked = numbered.select("_row", "_left.*")
    placed = placed.withColumnsRenamed({"_of_width": "_width", "_of_bin": "_bin"})
    placed = cut_lineage(placed.withColumn("_right_row", F.monotonically_increasing_id()), "range-right")
    sizes, tasks = _pieces(looking(unpacked), placed)
    placed = _cut(placed, sizes, "right", tasks).drop("_right_row")
    cut = _cut(looking(unpacked), sizes, "left", tasks)
    found = cut.join(placed, scratch, "inner").where(within).drop(*scratch)
    if kind == "inner":
        return found.drop("_row")
    # Who has found something needs no pairs: the first that is met tells.
    same = reduce(lambda a, b: a & b, [cut[c] == placed[c] for c in scratch])
    alone = anti_join(unpacked, cut.join(placed, same & within, "left_semi").select("_row"), ["_row"])
    return found.unionByName(alone, allowMissingColumns=True).drop("_row")


def _pieces(looking: DataFrame, placed: DataFrame) -> tuple[DataFrame, int]:
    """In how many pieces the sides of each crowded bin are cut, a written table, and over how many tasks the pairs are dealt.

    A crowded bin has more than ``PIECE`` rows, so the table is short.
    """
    bins = ["_width", "_bin"]
    n_left = looking.groupBy(*bins).agg(F.count(F.lit(1)).alias("_n_left"))
    n_right = placed.groupBy(*bins).agg(F.count(F.lit(1)).alias("_n_right"))
    pieces = [F.ceil(F.col(f"_n_{side}") / PIECE).cast("int").alias(f"_{side}_pieces") for side in ("left", "right")]
    sizes = cut_lineage(n_left.join(n_right, bins).select(*bins, "_n_left", "_n_right", *pieces), "bins")
    pairs = sizes.agg(F.sum(F.col("_n_left").cast("double") * F.col("_n_right"))).first()[0] or 0.0
    crowded = sizes.where("_left_pieces > 1 OR _right_pieces > 1").select(*bins, "_left_pieces", "_right_pieces")
    fewest = int(looking.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Pieces meet tasks by their hash: at four of the largest pairs a task, tasks are alike.
    return cut_lineage(crowded, "crowded"), min(max(fewest, int(pairs / (4 * PIECE**2))), 1 << 16)


def _cut(rows: DataFrame, crowded: DataFrame, side: str, tasks: int) -> DataFrame:
    """Each row in one piece of its own side of its bin, and once for each piece of the other, dealt over ``tasks``."""
    other = "right" if side == "left" else "left"
    number = "_row" if side == "left" else "_right_row"
    cut = rows.join(crowded, ["_width", "_bin"], "left")
    own = F.pmod(F.xxhash64(number), F.coalesce(f"_{side}_pieces", F.lit(1))).cast("int")
    everywhere = F.sequence(F.lit(0), F.coalesce(f"_{other}_pieces", F.lit(1)) - 1)
    cut = cut.withColumn(f"_{side}_piece", own).withColumn(f"_{other}_piece", F.explode(everywhere))
    return cut.drop("_left_pieces", "_right_pieces").repartition(tasks, "_width", "_bin", "_left_piece", "_right_piece")


def _number(column: Column) -> Column:
    """Numbers as doubles, timestamps as their seconds."""
    return column.cast("double")


def _bin(value: Column, width: Column) -> Column:
    """The number of the bin as a double, which holds it whatever its size."""
    scaled = value / F.pow(F.lit(2.0), width)
    return scaled - F.pmod(scaled, F.lit(1.0))
