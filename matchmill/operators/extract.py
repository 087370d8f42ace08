"""The table extract: select, joins, where, order and limit over DataFrames."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.operators import joins as J

MAIN = "t_main"

_DIRECTION = re.compile(r"\s+(asc|desc)$", re.IGNORECASE)
_EQUAL_COLUMNS = re.compile(r"\s*([\w.]+)\s*={1,2}\s*([\w.]+)\s*")
_AND = re.compile(r"\band\b", re.IGNORECASE)
_NULLS = re.compile(r"\s+nulls\s+(first|last)$", re.IGNORECASE)


@dataclass(frozen=True)
class Between:
    """A join condition: a column of the tables before lies between two columns of the joined one, bounds included."""

    value: str
    low: str
    high: str


@dataclass(frozen=True)
class Join:
    """One joined table. ``on`` is a SQL condition, (left column, right column) pairs, or ``Between``.

    A FULL join takes pairs, or a text of equal columns joined by AND, which says the same.
    """

    table: DataFrame
    on: str | Sequence[tuple[str, str]] | Between
    alias: str
    type: str = "INNER"


def sort_key(text: str) -> Column:
    """``expr [ASC|DESC] [NULLS FIRST|LAST]`` with NULLs as the largest value by default."""
    text = text.strip()
    nulls = _NULLS.search(text)
    text = _NULLS.sub("", text)
    direction = _DIRECTION.search(text)
    expr = F.expr(_DIRECTION.sub("", text))
    descending = direction is not None and direction.group(1).lower() == "desc"
    nulls_first = descending if nulls is None else nulls.group(1).lower() == "first"
    if descending:
        return expr.desc_nulls_first() if nulls_first else expr.desc_nulls_last()
    return expr.asc_nulls_first() if nulls_first else expr.asc_nulls_last()


def condition(column: str, value: Any) -> Column:
    """``is …`` text is a SQL test on the column; any other value is equality, so None finds nothing."""
    if isinstance(value, str) and value.lower().startswith("is "):
        return F.expr(f"{column} {value}")
    return F.col(column) == F.lit(value)


def _join(df: DataFrame, names: list[str], packed: bool, join: Join) -> tuple[DataFrame, bool]:
    kind = join.type.upper()
    # The join types an extract accepts.
    spark_kinds = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "FULL": "full_outer"}
    if kind not in spark_kinds:
        raise ValueError(f"join type {join.type!r} is not one of {sorted(spark_kinds)}")
    if isinstance(join.on, Between):
        if not packed:
            df, packed = df.select(*[F.expr(f"struct({n}.*)").alias(n) for n in names]), True
        right, on = J.pack(join.table, join.alias), join.on
        value, low, high = F.col(_dotted(on.value)), F.col(f"{join.alias}.{on.low}"), F.col(f"{join.alias}.{on.high}")
        return J.range_join(df, right, value, low, high, spark_kinds[kind]), True
    pairs = None if isinstance(join.on, str) else list(join.on)
    if kind == "FULL" and not pairs:
        pairs = _equal_columns(join.on, join.alias)
    if kind == "FULL":
        if not packed:
            df = df.select(*[F.expr(f"struct({n}.*)").alias(n) for n in names])
        dotted = [(_dotted(a), b) for a, b in pairs]
        return J.full_join(df, J.pack(join.table, join.alias), join.alias, dotted), True
    if pairs:
        on = " AND ".join(f"{_dotted(a)} = {join.alias}.{b}" for a, b in pairs)
    else:
        on = join.on
    right = J.pack(join.table, join.alias) if packed else join.table.alias(join.alias)
    joined = df.join(right, F.expr(on), spark_kinds[kind])
    # What the text says is not enough: an equality with a constant, or of one table's columns, is no key.
    if J.compares_all(joined) > J.compares_all(df) + J.compares_all(join.table):
        raise ValueError(f"a join needs an equality of columns of both tables, or Between; this compares all pairs of rows: {on!r}")
    return joined, packed


def _dotted(column: str) -> str:
    return column if "." in column else f"{MAIN}.{column}"


def _equal_columns(on: str, alias: str) -> list[tuple[str, str]]:
    """The pairs that a text of equal columns names; a column of ``alias`` is on one side of each."""
    pairs = []
    for part in _AND.split(on):
        found = _EQUAL_COLUMNS.fullmatch(part)
        sides = sorted(found.groups(), key=lambda c: c.startswith(f"{alias}.")) if found else ["", ""]
        if not sides[1].startswith(f"{alias}.") or sides[0].startswith(f"{alias}."):
            raise ValueError(f"a FULL join takes equal columns of both tables, joined by AND: {on!r}")
        pairs.append((sides[0], sides[1].partition(".")[2]))
    return pairs


def extract(
    table: DataFrame,
    select: Sequence[str] | None = None,
    joins: Sequence[Join] = (),
    where: Mapping[str, Any] | None = None,
    order: str | Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``SELECT … FROM table AS t_main [JOIN …] [WHERE …] [ORDER BY …] [LIMIT …]``.

    NULLs sort as the largest value. A limit of 0 or None means no limit. With joins the
    select list is mandatory, as ``*`` would repeat column names.
    """
    if joins and not select:
        raise ValueError("an extract with joins needs a select list")
    df = table.alias(MAIN)
    names, packed = [MAIN], False
    for join in joins:
        df, packed = _join(df, names, packed, join)
        names.append(join.alias)
    for column, value in (where or {}).items():
        df = df.where(condition(column, value))
    if order:
        parts = [order] if isinstance(order, str) else list(order)
        df = df.orderBy(*[sort_key(p) for p in parts])
    if limit:
        df = df.limit(limit)
    return df.selectExpr(*select) if select else df.select(f"{MAIN}.*")
