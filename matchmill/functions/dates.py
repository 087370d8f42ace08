"""Job-date expressions: Paris wall clock, ISO weeks, Sunday calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

JOB_ZONE = "Europe/Paris"


def spark_pattern(strftime: str) -> str:
    """A strftime pattern as a Spark date pattern."""
    codes = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "j": "DDD"}
    out, i = [], 0
    while i < len(strftime):
        char = strftime[i]
        if char == "%":
            code = strftime[i + 1 : i + 2]
            if code == "%":
                out.append("%")
            elif code in codes:
                out.append(codes[code])
            else:
                raise ValueError(f"date format code %{code} is not supported")
            i += 2
            continue
        out.append(f"'{char}'" if char.isalpha() else char)
        i += 1
    return "".join(out)


def utc_timestamp(moment: dt.datetime | str) -> Column:
    """A job timestamp as a UTC timestamp literal; aware datetimes are converted."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.to_timestamp_ntz(F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))


def paris_time(moment: dt.datetime | str) -> Column:
    """The job timestamp on the Paris wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(JOB_ZONE), utc_timestamp(moment))


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def sundays(spark: SparkSession, years: list[int], today: dt.date) -> DataFrame:
    """All Sundays of the given years up to ``today``, oldest first, as ``day date``."""
    if not years:
        raise ValueError("at least one year is needed")
    first = dt.date(min(years), 1, 1)
    first += dt.timedelta(days=(6 - first.weekday()) % 7)
    if first > today:
        return spark.createDataFrame([], "day date")
    days = spark.range(1).select(
        F.explode(F.expr(f"sequence(DATE'{first}', DATE'{today}', INTERVAL 7 DAYS)")).alias("day")
    )
    return days.where(F.year("day").isin(years) & (F.dayofweek("day") == 1)).orderBy("day")
