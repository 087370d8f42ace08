"""MERGE and UPDATE as DataFrame plans.

A merge is two branches: target rows with the matched ones updated, and source rows no
target row matched. Keys match with plain equality, so a NULL key never matches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill.functions.scalars import sql_function
from matchmill.operators.guards import identifier, is_unique
from matchmill.operators.joins import key_table, semi_join
from matchmill.operators.transforms import one_per_key
from matchmill.session import cut_lineage, freed_shuffles

CREATED, MODIFIED = "tech_date_creation", "tech_date_modification"


def assigned(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` as the type it is stored in; a fraction stored as a whole number is rounded."""
    if isinstance(target, T.IntegralType) and isinstance(source, T.FractionalType):
        column = F.rint(column)
    return column if source == target else column.cast(target)


def _one_row_per_key(source: DataFrame, keys: Sequence[str], columns: Sequence[str], written: bool = False) -> DataFrame:
    """The source with one row per key and its row count; keys under ``_k_``, values under ``_s_``.

    It is a written table: a join with a plain one can be split on a hot target key, one
    with an aggregate cannot. A written source whose keys do not repeat is taken as it is.
    """
    if written and is_unique(source.dropna(subset=list(keys)), keys):
        out = [*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(1).cast("bigint").alias("_n")]
        return source.dropna(subset=list(keys)).select(*out, *[F.col(c).alias(f"_s_{c}") for c in columns])
    values = [F.first(c).alias(f"_s_{c}") for c in columns]
    grouped = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *values)
    return cut_lineage(grouped.withColumnsRenamed({k: f"_k_{k}" for k in keys}), "merge-source")


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])


def _all_matched(target: DataFrame, found: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``found`` has the keys of all target rows, so that no old value is needed; keys are read only if there are enough."""
    if found.count() < target.count():
        return False
    with freed_shuffles(target.sparkSession):
        return target.select(*keys).join(found.select(*[f"_k_{k}" for k in keys]), _same_key(keys), "left_anti").isEmpty()


def matched_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    match_columns: Sequence[str],
    now: Column,
    written: bool = False,
) -> DataFrame:
    """All target rows, the matched ones with ``match_columns`` taken from the source, which may be a ``written`` table.

    A source NULL overwrites. A target row matched by two source rows fails the query.
    ``_matched`` tells the rows apart. Where a written source has all of the target's keys, the values that it replaces
    are neither read nor shuffled.
    """
    matched = F.when(
        F.col("_n") > 1, F.raise_error(F.lit(f"merge: two source rows for one target row on {list(keys)}"))
    ).otherwise(F.col("_n").isNotNull())
    found = _one_row_per_key(source, keys, match_columns, written)
    replaced = written and _all_matched(target, found, keys)
    joined = (target.drop(*[c for c in match_columns if c not in keys]) if replaced else target).join(found, _same_key(keys), "left")
    joined = joined.withColumn("_matched", matched.cast("boolean"))
    out = []
    for field in target.schema:
        name, column = field.name, F.col(f"`{field.name}`")
        if name in match_columns:
            value = assigned(F.col(f"_s_{name}"), source.schema[name].dataType, field.dataType)
            column = value if replaced else F.when(F.col("_matched"), value).otherwise(column)
        elif name == MODIFIED:
            column = F.when(F.col("_matched"), now.cast(field.dataType)).otherwise(column)
        out.append(column.alias(name))
    return joined.select(*out, "_matched")


def unmatched_source(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key no target row has; every duplicate of such a row is kept.

    Only the key columns of the target are read, and of these only what the source has is
    made distinct and written: what is kept does not grow with the target. Both key tables
    are plain scans, so AQE broadcasts the small and splits the hot. Whole source rows are
    shuffled only if some keys are known and some are not.
    """
    present = key_table(semi_join(target.select(*keys), source, keys), keys)
    if present.isEmpty():
        return source
    new = source.join(present, list(keys), "left_anti")
    return source.limit(0) if new.select(*keys).isEmpty() else new


def inserted_rows(
    target: DataFrame,
    rows: DataFrame,
    non_match_columns: Mapping[str, str],
    now: Column,
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """``rows`` in the target's schema: mapped columns, both tech dates, defaults, else NULL."""
    defaults = defaults or {}
    out = []
    for field in target.schema:
        if field.name in non_match_columns:
            name = non_match_columns[field.name]
            column = assigned(F.col(f"`{name}`"), rows.schema[name].dataType, field.dataType)
        elif field.name in (CREATED, MODIFIED):
            column = now
        elif field.name in defaults:
            column = F.expr(defaults[field.name])
        else:
            column = F.lit(None)
        out.append(column.cast(field.dataType).alias(field.name))
    return rows.select(*out)


def check_branches(
    match_columns: Sequence[str], non_match_columns: Mapping[str, str], has_matched: bool, has_not_matched: bool
) -> list[str]:
    """The operations a merge performs; none, or one without columns, is an error."""
    if not has_matched and not has_not_matched:
        raise ValueError("a merge needs has_matched, has_not_matched or both")
    if has_matched and not match_columns:
        raise ValueError("has_matched needs match_columns")
    if has_not_matched and not non_match_columns:
        raise ValueError("has_not_matched needs non_match_columns")
    return ["UPDATE"] * has_matched + ["INSERT"] * has_not_matched


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    match_columns: Sequence[str] | Mapping[str, str] = (),
    non_match_columns: Mapping[str, str] | None = None,
    has_matched: bool = False,
    has_not_matched: bool = False,
    now: Column | None = None,
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """The target after the merge, as one plan.

    Of a ``match_columns`` mapping only the names count: each target column takes the
    source column of the same name. ``non_match_columns`` maps target to source names.
    """
    names, mapping = list(match_columns), dict(non_match_columns or {})
    check_branches(names, mapping, has_matched, has_not_matched)
    now = F.current_timestamp() if now is None else now
    result = matched_rows(target, source, keys, names, now).drop("_matched") if has_matched else target
    if has_not_matched:
        new = unmatched_source(target, source, keys)
        result = result.unionByName(inserted_rows(target, new, mapping, now, defaults))
    return result


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows to append when existing keys are to be left alone.

    Of several new rows with one key a single one is kept, as the key is unique in the target.
    """
    return unmatched_source(target, one_per_key(rows, keys), keys)


def _set_value(value: Any) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        native = sql_function(value)
        if native is not None:
            return native
    return F.lit(value)


def update_where(df: DataFrame, set_values: Mapping[str, Any], where: Mapping[str, Any]) -> DataFrame:
    """All rows of ``df`` with ``set_values`` applied where every condition holds.

    A value may be a bare SQL function name such as CURRENT_TIMESTAMP. A condition on a
    one-column DataFrame compares with its first row: order and limit it before.
    ``_updated`` marks the changed rows.
    """
    if not set_values:
        raise ValueError("an update needs set_values")
    if not where:
        raise ValueError("an update needs where conditions")
    hit = F.lit(True)
    for column, value in where.items():
        value = value.limit(1).scalar() if isinstance(value, DataFrame) else F.lit(value)
        hit = hit & (F.col(identifier(column)) == value)
    return _apply(df.withColumn("_updated", F.coalesce(hit, F.lit(False))), set_values)


def update_where_in(
    df: DataFrame, set_values: Mapping[str, Any], key: str, members: DataFrame
) -> DataFrame:
    """As ``update_where``, for rows whose key is among ``members``."""
    if not set_values:
        raise ValueError("an update needs set_values")
    found = key_table(members, [key]).withColumnRenamed(key, "_member")
    joined = df.join(found, F.col(key) == F.col("_member"), "left")
    return _apply(joined.withColumn("_updated", F.col("_member").isNotNull()).drop("_member"), set_values)


def _apply(df: DataFrame, set_values: Mapping[str, Any]) -> DataFrame:
    unknown = [c for c in set_values if c not in df.columns]
    if unknown:
        raise KeyError(f"columns not in the table: {unknown}")
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if field.name in set_values:
            new = _set_value(set_values[field.name]).cast(field.dataType)
            column = F.when(F.col("_updated"), new).otherwise(column)
        out.append(column.alias(field.name))
    return df.select(*out)
