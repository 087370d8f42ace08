"""Shared pieces of the registered queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A Spark query over the tables of a folder, and the SQL giving the same rows."""

    run: QueryFunction
    sql: str | None = None


def _off_tie(digits: int) -> str:
    """A shift of a fraction of the last digit.

    Means of whole numbers often end exactly between two rounded values, where the order of
    summation would decide; the shift moves such values off the middle.
    """
    return f"{0.13 * 10**-digits:.{digits + 2}f}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    shift = F.lit(float(_off_tie(digits)))
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`") + shift, digits) if f.dataType == T.DoubleType() else F.col(f"`{f.name}`"))
            .alias(f.name)
            for f in df.schema
        ]
    )


def rounded_sql(expression: str, digits: int = 6) -> str:
    """The SQL of ``rounded`` for one expression."""
    return f"round(({expression}) + CAST({_off_tie(digits)} AS DOUBLE), {digits})"


FX_MATCH = """fx_match AS (
  SELECT concat('EUW1_', CAST(o_orderkey AS VARCHAR)) AS match_id, o_orderdate AS game_creation,
         60 + (o_orderkey * 37) % 2400 AS game_duration,
         CASE WHEN o_orderkey % 5 = 0 THEN 'ARAM' ELSE 'CLASSIC' END AS game_mode,
         o_orderstatus = 'P' AS game_in_progress, o_orderstatus = 'F' AS is_processed,
         o_orderdate AS tech_date_creation
  FROM orders)"""

FX_PLAYER = """fx_player AS (
  SELECT concat('P', CAST(s_suppkey AS VARCHAR)) AS puuid, s_name AS game_name,
         concat('TAG', CAST(s_nationkey AS VARCHAR)) AS tag_line,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL
              ELSE TIMESTAMP '2024-01-01 00:00:00' + (s_suppkey % 3650) * INTERVAL '1' DAY END AS date_processed
  FROM supplier WHERE s_acctbal >= 0)"""

FX_RAW_STATS = """fx_raw_stats AS (
  SELECT md5(concat('EUW1_', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR))) AS id,
         concat('EUW1_', CAST(l_orderkey AS VARCHAR)) AS match_id,
         concat('P', CAST(l_suppkey AS VARCHAR)) AS puuid,
         l_partkey % 170 AS champion_id, concat('champ_', CAST(l_partkey % 170 AS VARCHAR)) AS champion_name,
         CAST(l_quantity AS BIGINT) % 21 AS kills, (l_linenumber * 3 + l_partkey) % 13 AS deaths,
         (l_partkey + l_suppkey) % 25 AS assists,
         CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE 0 END AS double_kills,
         CASE WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END AS triple_kills,
         CASE WHEN l_partkey % 59 = 0 THEN 1 ELSE 0 END AS quadra_kills,
         CASE WHEN l_partkey % 97 = 0 THEN 1 ELSE 0 END AS penta_kills,
         1000 + l_partkey % 5000 + 500 + (l_suppkey * 13) % 3000 + l_linenumber * 50 AS total_damage_dealt_to_champions,
         1000 + l_partkey % 5000 AS physical_damage_dealt_to_champions,
         500 + (l_suppkey * 13) % 3000 AS magic_damage_dealt_to_champions,
         CAST(l_linenumber AS BIGINT) * 50 AS true_damage_dealt_to_champions,
         2000 + l_orderkey % 9000 + 300 + l_partkey % 700 + l_linenumber * 10 AS total_damage_taken,
         2000 + l_orderkey % 9000 AS physical_damage_taken, 300 + l_partkey % 700 AS magic_damage_taken,
         CAST(l_linenumber AS BIGINT) * 10 AS true_damage_taken,
         (l_suppkey * 31) % 4000 AS total_heal, l_orderkey % 60 AS total_minions_killed,
         5000 + l_partkey % 9000 AS gold_earned,
         l_partkey, l_suppkey, l_extendedprice, l_linenumber
  FROM lineitem)"""

FX_STATS = """fx_stats AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn
                 FROM fx_raw_stats) t WHERE rn = 1)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body


def _means() -> dict[str, str]:
    """SQL of the row values behind each mean; ``m`` is the length of the game in minutes."""
    # The formulas of the data model, as they are defined there.
    multi = "double_kills * 2 + triple_kills * 4 + quadra_kills * 8 + penta_kills * 16"
    return {
        "avg_damage_per_minute": "total_damage_dealt_to_champions / m",
        "avg_physical_damage_per_minute": "physical_damage_dealt_to_champions / m",
        "avg_magic_damage_per_minute": "magic_damage_dealt_to_champions / m",
        "avg_true_damage_per_minute": "true_damage_dealt_to_champions / m",
        **{
            f"avg_{kind}_damage_dealt_pct": f"{kind}_damage_dealt_to_champions * 100.0 / greatest(total_damage_dealt_to_champions, 1)"
            for kind in ("physical", "magic", "true")
        },
        "avg_kills_per_minute": "kills / m",
        "avg_deaths_per_minute": "deaths / m",
        "avg_assists_per_minute": "assists / m",
        "avg_multi_kill_score": multi,
        "penta_rate": "CASE WHEN penta_kills > 0 THEN 1 ELSE 0 END * 100.0",
        "avg_damage_taken_per_death": "total_damage_taken / greatest(deaths, 1)",
        "avg_physical_damage_taken_per_minute": "physical_damage_taken / m",
        "avg_magic_damage_taken_per_minute": "magic_damage_taken / m",
        "avg_true_damage_taken_per_minute": "true_damage_taken / m",
        **{
            f"avg_{kind}_damage_taken_pct": f"{kind}_damage_taken * 100.0 / greatest(total_damage_taken, 1)"
            for kind in ("physical", "magic", "true")
        },
        "avg_heal_per_minute": "total_heal / m",
        "avg_cs_per_minute": "total_minions_killed / m",
        "avg_gold_per_minute": "gold_earned / m",
        "avg_gold_per_cs": "gold_earned / greatest(total_minions_killed, 1)",
        "avg_kda": "(kills + assists) / greatest(deaths, 1)",
        "tanking_index": "total_damage_taken / m * 0.35 + total_heal / m * 0.25 + 1.0 / greatest(deaths / m, 0.1) * 0.3 - deaths / m * 50",
        "damage_index": f"total_damage_dealt_to_champions / m * 0.6 + kills / m * 80 + ({multi}) * 4 - deaths / m * 50",
        "support_index": "assists / m * 180 + total_heal / m * 0.15 - deaths / m * 80",
    }


MEANS = _means()


def kpi_sql(keys: list[str], digits: int | None = 6) -> str:
    """The metrics of relation ``s`` per group, as SQL."""
    def mean(expression: str) -> str:
        average = f"avg(CAST({expression} AS DOUBLE))"
        return rounded_sql(average, digits) if digits is not None else average

    metrics = [f"{mean(e)} AS {name}" for name, e in MEANS.items()]
    metrics += [
        "count(*) AS total_games",
        "CAST(max(kills) AS BIGINT) AS best_kills",
        "CAST(max(total_damage_dealt_to_champions) AS BIGINT) AS best_damage",
        "CAST(min(deaths) AS BIGINT) AS best_deaths",
    ]
    rows = "SELECT *, CAST(game_duration AS DOUBLE) / 60 AS m FROM s WHERE game_duration > 120"
    return f"SELECT {', '.join(keys)}, {', '.join(metrics)}\nFROM ({rows}) played"


PLAYER_INPUT = """s AS (
  SELECT fx_stats.*, p.game_name, m.game_duration
  FROM fx_stats JOIN fx_player p ON fx_stats.puuid = p.puuid JOIN fx_match m ON fx_stats.match_id = m.match_id)"""

CHAMPION_INPUT = """s AS (
  SELECT fx_stats.*, m.game_duration FROM fx_stats JOIN fx_match m ON fx_stats.match_id = m.match_id)"""

STATS_VIEWS = [FX_MATCH, FX_PLAYER, FX_RAW_STATS, FX_STATS]

KEYS = {
    "player": ["game_name"],
    "champion": ["champion_name", "champion_id"],
    "player_champion": ["game_name", "champion_name", "champion_id"],
}


def mart_sql(mart: str, digits: int | None = 6) -> str:
    """A whole mart as SQL text starting with WITH."""
    source = CHAMPION_INPUT if mart == "champion" else PLAYER_INPUT
    keys = KEYS[mart]
    return with_views(f"{kpi_sql(keys, digits)} GROUP BY {', '.join(keys)}", *STATS_VIEWS, source)
