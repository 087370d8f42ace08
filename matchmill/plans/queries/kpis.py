"""KPI groupings and the dashboard panels on them."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmill.plans import dashboards as D
from matchmill.plans import kpi as K
from matchmill.plans import star_views as V
from matchmill.plans.queries import common as C
from matchmill.plans.queries.common import Query, rounded

CHOSEN = {"champion_name": "champ_7", "game_name": "Supplier#000000003"}
TODAY = dt.date(2024, 1, 10)


def champion_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.champion_stats(V.stats(spark, sf_dir), V.matches(spark, sf_dir))


def player_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.player_stats(V.stats(spark, sf_dir), V.players(spark, sf_dir), V.matches(spark, sf_dir))


def of_players(spark: SparkSession, sf_dir: str, metrics: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``metrics`` of the players' statistics; whose share is large is told by the lines as they landed."""
    crowd = K.crowded(V.raw_stats(spark, sf_dir), V.players(spark, sf_dir))
    return K.by_player(player_input(spark, sf_dir), metrics, crowd)


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    keys = K.group_keys(per_player="player" in name, per_champion="champion" in name)
    if name == "champion":
        return K.kpi(champion_input(spark, sf_dir), keys)
    return of_players(spark, sf_dir, lambda rows: K.kpi(rows, keys))


def _kpi(name: str) -> Query:
    return Query(lambda spark, sf_dir: rounded(mart(spark, sf_dir, name)), C.mart_sql(name))


def _grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    groupings = [C.KEYS["player"], C.KEYS["player_champion"]]

    def sets(rows: DataFrame) -> DataFrame:
        return K.kpi_grouping_sets(K.kpi_states(rows, C.KEYS["player_champion"]), groupings)

    return rounded(of_players(spark, sf_dir, sets))


QUERIES: dict[str, Query] = {
    "kpi_per_champion": _kpi("champion"),
    "kpi_per_player": _kpi("player"),
    "kpi_per_player_champion": _kpi("player_champion"),
    "kpi_grouping_sets": Query(
        _grouping_sets,
        C.with_views(
            C.kpi_sql(C.KEYS["player_champion"])
            + " GROUP BY GROUPING SETS ((game_name), (game_name, champion_name, champion_id))",
            *C.STATS_VIEWS,
            C.PLAYER_INPUT,
        ),
    ),
}


# What each panel shows, written down apart from the definitions that the queries use. Labels, keys, sizes.
_SHOWN = {
    "indices": 'damage_index AS "Carry", tanking_index AS "Tanking", support_index AS "Support"',
    "kda": 'avg_kda AS "KDA"',
    "damage": 'avg_physical_damage_per_minute AS "Dégâts physiques", avg_magic_damage_per_minute AS "Dégâts magiques",'
    ' avg_true_damage_per_minute AS "Dégâts brute"',
    "taken": 'avg_physical_damage_taken_per_minute AS "Dégâts physiques", avg_magic_damage_taken_per_minute AS "Dégâts magiques",'
    ' avg_true_damage_taken_per_minute AS "Dégâts brute"',
    "events": 'avg_kills_per_minute AS "Kill par minute", avg_deaths_per_minute AS "Deaths par minute",'
    ' avg_assists_per_minute AS "Assists par minute"',
    "games": "total_games",
    "multi": 'avg_multi_kill_score AS "Score"',
    "farm": 'avg_cs_per_minute AS "Creeps par minute", avg_gold_per_minute AS "Gold par minute"',
    "penta": 'penta_rate AS "Score"',
    "all indices": "tanking_index, damage_index, support_index, champion_name",
}
_OF_CHAMPION = ["indices", "kda", "damage", "taken", "events", "games", "multi", "farm", "penta"]
_OF_PLAYER = {"d12": "damage", "d13": "taken", "d14": "events", "d15": "kda", "d17": "indices", "d18": "farm", "d19": "multi", "d20": "games", "d21": "penta"}
_BEST = {
    "d23": ("avg_kda, champion_name", "avg_kda", 20),
    "d24": (_SHOWN["all indices"], "damage_index", 5),
    "d25": ("avg_damage_per_minute, champion_name", "avg_damage_per_minute", 5),
    "d26": ("avg_physical_damage_per_minute, champion_name", "avg_physical_damage_per_minute", 10),
    "d27": (_SHOWN["all indices"], "tanking_index", 5),
    "d28": (_SHOWN["all indices"], "support_index", 5),
    "d29": ("avg_magic_damage_per_minute, champion_name", "avg_magic_damage_per_minute", 10),
    "d30": ("avg_multi_kill_score, champion_name", "avg_multi_kill_score", 5),
}
_PANEL_SQL = {f"d{i:02}": ("champion", _SHOWN[what], "champion_name = 'champ_7'", "") for i, what in enumerate(_OF_CHAMPION, 1)}
_PANEL_SQL |= {name: ("player", _SHOWN[what], "game_name = 'Supplier#000000003'", "") for name, what in _OF_PLAYER.items()}
_PANEL_SQL |= {
    "d11": ("player_champion", 'champion_name AS "Nom du champion", total_games AS "Nombre de game"', "game_name = 'Supplier#000000003'",
            "total_games DESC NULLS FIRST, champion_name, champion_id LIMIT 10"),
    "d16": ("player_champion", f'champion_name AS "Nom du champion", {_SHOWN["damage"]}', "game_name = 'Supplier#000000003'",
            "avg_damage_per_minute DESC NULLS FIRST, champion_name, champion_id LIMIT 10"),
}
_PANEL_SQL |= {
    name: ("champion", shown, "true", f"{by} DESC NULLS FIRST, champion_name, champion_id LIMIT {top}") for name, (shown, by, top) in _BEST.items()
}


def panel_sql(name: str) -> str:
    of, shown, where, top = _PANEL_SQL[name]
    picked = f"SELECT * FROM ({C.mart_sql(of, None)}) mart WHERE {where}" + (f" ORDER BY {top}" if top else "")
    metrics = "|".join(sorted(C.MEANS, key=len, reverse=True))
    columns = re.sub(
        rf"\b({metrics})\b( AS)?",
        lambda m: C.rounded_sql(m[1]) + (" AS" if m[2] else f" AS {m[1]}"),
        shown,
    )
    return f"SELECT {columns} FROM ({picked})"


def _panel(name: str) -> Query:
    spec = D.PANELS[name]
    value = CHOSEN.get(spec.key)
    return Query(lambda spark, sf_dir: rounded(D.panel(mart(spark, sf_dir, spec.mart), spec, value)), panel_sql(name))


def _selector(name: str, column: str) -> Query:
    return Query(
        lambda spark, sf_dir: D.selector(mart(spark, sf_dir, name), column),
        f"SELECT DISTINCT {column} FROM ({C.mart_sql(name)}) mart",
    )


QUERIES |= {name: _panel(name) for name in D.PANELS}
QUERIES |= {name: _selector(*where) for name, where in D.SELECTORS.items()}


def _known_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a player, named once it was processed."""
    return V.table(spark, sf_dir, "supplier").selectExpr(
        "concat('P', s_suppkey) AS puuid", "CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS game_name"
    )


_KNOWN_PLAYERS = """known AS (SELECT concat('P', CAST(s_suppkey AS VARCHAR)) AS puuid,
  CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS game_name FROM supplier)"""

_STATE = "CASE WHEN {} THEN 'processed' ELSE 'not processed' END"


def _pie(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = D.PANELS["d03"]
    shown = D.panel(mart(spark, sf_dir, spec.mart), spec, CHOSEN["champion_name"])
    return rounded(D.shares(shown, shown.columns))


QUERIES |= {
    "d31": Query(
        lambda spark, sf_dir: D.players_to_process(V.players(spark, sf_dir), TODAY),
        C.with_views(
            f"SELECT game_name, tag_line, date_processed, CASE WHEN date_processed = DATE '{TODAY}' THEN 1 ELSE 0 END"
            " AS processed_today FROM fx_player",
            C.FX_PLAYER,
        ),
    ),
    "d31_whole_day": Query(
        lambda spark, sf_dir: D.players_to_process(
            V.players(spark, sf_dir).withColumn("date_processed", F.expr("date_processed + INTERVAL 3 HOURS")),
            TODAY,
            whole_day=True,
        ),
        C.with_views(
            "SELECT game_name, tag_line, date_processed + INTERVAL '3' HOUR AS date_processed,"
            f" CASE WHEN CAST(date_processed + INTERVAL '3' HOUR AS DATE) = DATE '{TODAY}' THEN 1 ELSE 0 END"
            " AS processed_today FROM fx_player",
            C.FX_PLAYER,
        ),
    ),
    "d32": Query(
        lambda spark, sf_dir: D.matches_by_state(V.matches(spark, sf_dir)),
        C.with_views(
            f'SELECT {_STATE.format("is_processed")} AS is_processed, count(match_id) AS "count" FROM fx_match GROUP BY 1',
            C.FX_MATCH,
        ),
    ),
    "d33": Query(
        lambda spark, sf_dir: D.players_by_state(_known_players(spark, sf_dir)),
        C.with_views(
            f'SELECT {_STATE.format("game_name IS NOT NULL")} AS is_processed, count(puuid) AS "count" FROM known GROUP BY 1',
            _KNOWN_PLAYERS,
        ),
    ),
    "d34": Query(
        lambda spark, sf_dir: D.count_of(V.stats(spark, sf_dir), "id"),
        C.with_views('SELECT count(id) AS "count" FROM fx_stats', C.FX_RAW_STATS, C.FX_STATS),
    ),
    "d35": Query(
        lambda spark, sf_dir: D.count_of(V.matches(spark, sf_dir), "match_id", F.expr("is_processed IS TRUE")),
        C.with_views('SELECT count(match_id) AS "count" FROM fx_match WHERE is_processed IS TRUE', C.FX_MATCH),
    ),
    "d36": Query(
        lambda spark, sf_dir: D.count_of(V.matches(spark, sf_dir), "match_id", F.expr("is_processed IS FALSE")),
        C.with_views('SELECT count(match_id) AS "count" FROM fx_match WHERE is_processed IS FALSE', C.FX_MATCH),
    ),
    "d37": Query(
        lambda spark, sf_dir: D.count_of(_known_players(spark, sf_dir), "puuid", F.col("game_name").isNotNull()),
        C.with_views('SELECT count(puuid) AS "count" FROM known WHERE game_name IS NOT NULL', _KNOWN_PLAYERS),
    ),
    "d38": Query(
        lambda spark, sf_dir: D.count_of(_known_players(spark, sf_dir), "puuid", F.col("game_name").isNull()),
        C.with_views('SELECT count(puuid) AS "count" FROM known WHERE game_name IS NULL', _KNOWN_PLAYERS),
    ),
    "pie_shares": Query(
        _pie,
        "SELECT "
        + ", ".join(
            C.rounded_sql(
                f"{c} * 100.0 / (avg_physical_damage_per_minute + avg_magic_damage_per_minute + avg_true_damage_per_minute)"
            )
            + f' AS "{label}"'
            for c, label in D.PANELS["d03"].labels.items()
        )
        + f" FROM ({C.mart_sql('champion', None)}) mart WHERE champion_name = 'champ_7'",
    ),
}
