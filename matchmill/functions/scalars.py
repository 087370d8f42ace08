"""Scalar expressions shared by the plans; all stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_id(*parts: Column) -> Column:
    """md5 of the parts joined by ``_``; NULL when any part is NULL."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("_"), part)
    return F.md5(joined)


def at_least(value: Column, floor: float | int) -> Column:
    """``value`` floored, for use as a divisor; a NULL value becomes the floor."""
    return F.greatest(value, F.lit(floor))


def kda(kills: Column, deaths: Column, assists: Column) -> Column:
    """Kill-death-assist ratio to two decimals, ties to even."""
    return F.bround((kills + assists) / at_least(deaths, 1), 2)


def stored_as_int(value: Column) -> Column:
    """Double to INTEGER by rounding (a plain cast would truncate)."""
    return F.rint(value).cast("int")


def joined_text(items: Column, separator: str = ",") -> Column:
    """Array of strings to one string; empty and NULL arrays give ''."""
    return F.array_join(F.coalesce(items, F.array().cast("array<string>")), separator)


def default_to(value: Column, default: str | int) -> Column:
    """``value`` or the default when the key was absent."""
    return F.coalesce(value, F.lit(default))


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def from_epoch_ms(value: Column) -> Column:
    """Epoch milliseconds to a zone-less UTC timestamp, whatever the session's zone."""
    seconds = (value.cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)


def to_epoch_ms(value: Column) -> Column:
    """A zone-less timestamp, read as UTC, to epoch milliseconds."""
    value = value.cast("timestamp_ntz")
    minutes = (F.unix_date(value.cast("date")).cast("bigint") * 24 + F.hour(value)) * 60 + F.minute(value)
    return minutes * 60000 + F.floor(F.extract(F.lit("SECOND"), value) * 1000).cast("bigint")


def valid_text(value: Column) -> Column:
    """True for a non-empty string."""
    return value.isNotNull() & (value != "")


def sql_function(name: str) -> Column | None:
    """The column for a bare SQL function name accepted in an update, else None."""
    # The function names an update passes through unquoted.
    functions = {
        "CURRENT_TIMESTAMP": lambda: F.current_timestamp(),
        "CURRENT_DATE": lambda: F.current_date(),
        "CURRENT_TIME": lambda: F.date_format(F.current_timestamp(), "HH:mm:ss"),
        "NOW()": lambda: F.current_timestamp(),
        "NULL": lambda: F.lit(None),
    }
    make = functions.get(name.upper())
    return make() if make else None
