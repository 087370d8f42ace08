"""The dashboard queries over marts and fact tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHAMPION, PLAYER, PLAYER_CHAMPION = "champion", "player", "player_champion"

# The labels panels show.
_INDICES = {"damage_index": "Carry", "tanking_index": "Tanking", "support_index": "Support"}
_KDA = {"avg_kda": "KDA"}
_DAMAGE = {
    "avg_physical_damage_per_minute": "Dégâts physiques",
    "avg_magic_damage_per_minute": "Dégâts magiques",
    "avg_true_damage_per_minute": "Dégâts brute",
}
_TAKEN = {
    "avg_physical_damage_taken_per_minute": "Dégâts physiques",
    "avg_magic_damage_taken_per_minute": "Dégâts magiques",
    "avg_true_damage_taken_per_minute": "Dégâts brute",
}
_EVENTS = {
    "avg_kills_per_minute": "Kill par minute",
    "avg_deaths_per_minute": "Deaths par minute",
    "avg_assists_per_minute": "Assists par minute",
}
_GAMES = {"total_games": "total_games"}
_FARM = {"avg_cs_per_minute": "Creeps par minute", "avg_gold_per_minute": "Gold par minute"}
_MULTI = {"avg_multi_kill_score": "Score"}
_PENTA = {"penta_rate": "Score"}
_ALL_INDICES = {c: c for c in ("tanking_index", "damage_index", "support_index", "champion_name")}


def _named(metric: str) -> dict[str, str]:
    return {metric: metric, "champion_name": "champion_name"}


@dataclass(frozen=True)
class Panel:
    """Columns (with labels) of one mart, for one key value or as a top-k by one metric."""

    mart: str
    labels: Mapping[str, str]
    key: str | None = None
    top_by: str | None = None
    top: int | None = None


PANELS = {
    # one champion
    "d01": Panel(CHAMPION, _INDICES, "champion_name"),
    "d02": Panel(CHAMPION, _KDA, "champion_name"),
    "d03": Panel(CHAMPION, _DAMAGE, "champion_name"),
    "d04": Panel(CHAMPION, _TAKEN, "champion_name"),
    "d05": Panel(CHAMPION, _EVENTS, "champion_name"),
    "d06": Panel(CHAMPION, _GAMES, "champion_name"),
    "d07": Panel(CHAMPION, _MULTI, "champion_name"),
    "d08": Panel(CHAMPION, _FARM, "champion_name"),
    "d09": Panel(CHAMPION, _PENTA, "champion_name"),
    # one player
    "d11": Panel(
        PLAYER_CHAMPION,
        {"champion_name": "Nom du champion", "total_games": "Nombre de game"},
        "game_name",
        "total_games",
        10,
    ),
    "d12": Panel(PLAYER, _DAMAGE, "game_name"),
    "d13": Panel(PLAYER, _TAKEN, "game_name"),
    "d14": Panel(PLAYER, _EVENTS, "game_name"),
    "d15": Panel(PLAYER, _KDA, "game_name"),
    "d16": Panel(
        PLAYER_CHAMPION, {"champion_name": "Nom du champion", **_DAMAGE}, "game_name", "avg_damage_per_minute", 10
    ),
    "d17": Panel(PLAYER, _INDICES, "game_name"),
    "d18": Panel(PLAYER, _FARM, "game_name"),
    "d19": Panel(PLAYER, _MULTI, "game_name"),
    "d20": Panel(PLAYER, _GAMES, "game_name"),
    "d21": Panel(PLAYER, _PENTA, "game_name"),
    # best champions
    "d23": Panel(CHAMPION, _named("avg_kda"), top_by="avg_kda", top=20),
    "d24": Panel(CHAMPION, _ALL_INDICES, top_by="damage_index", top=5),
    "d25": Panel(CHAMPION, _named("avg_damage_per_minute"), top_by="avg_damage_per_minute", top=5),
    "d26": Panel(CHAMPION, _named("avg_physical_damage_per_minute"), top_by="avg_physical_damage_per_minute", top=10),
    "d27": Panel(CHAMPION, _ALL_INDICES, top_by="tanking_index", top=5),
    "d28": Panel(CHAMPION, _ALL_INDICES, top_by="support_index", top=5),
    "d29": Panel(CHAMPION, _named("avg_magic_damage_per_minute"), top_by="avg_magic_damage_per_minute", top=10),
    "d30": Panel(CHAMPION, _named("avg_multi_kill_score"), top_by="avg_multi_kill_score", top=5),
}

# Selector lists: distinct key values of a mart.
SELECTORS = {"d10": (CHAMPION, "champion_name"), "d22": (PLAYER, "game_name")}


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest, NULLs counting as largest; kept per task, so nothing is sorted whole."""
    return df.orderBy(F.col(metric).desc_nulls_first(), *ties).limit(k)


def panel(mart: DataFrame, spec: Panel, value: str | None = None) -> DataFrame:
    """The rows a panel shows. ``value`` is the champion or player chosen in the selector."""
    if spec.key:
        mart = mart.where(F.col(spec.key) == F.lit(value))
    if spec.top_by:
        mart = top_k(mart, spec.top_by, spec.top, ["champion_name", "champion_id"])
    return mart.select(*[F.col(c).alias(label) for c, label in spec.labels.items()])


def selector(mart: DataFrame, column: str) -> DataFrame:
    return mart.select(column).distinct()


def shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column as a percentage of their sum, as pie panels show them."""
    total = sum((F.col(f"`{c}`") for c in columns[1:]), F.col(f"`{columns[0]}`"))
    return df.select(*[(F.col(f"`{c}`") * 100.0 / F.nullif(total, F.lit(0.0))).alias(c) for c in columns])


def players_to_process(players: DataFrame, today: dt.date, whole_day: bool = False) -> DataFrame:
    """The work list, flagged when processed today.

    The flag compares the timestamp with the date, so it holds at midnight only;
    ``whole_day`` compares days instead.
    """
    processed: Column = F.col("date_processed")
    if whole_day:
        processed = F.to_date(processed)
    flag = F.when(processed == F.lit(today), 1).otherwise(0)
    return players.select("game_name", "tag_line", "date_processed", flag.alias("processed_today"))


def _bucketed(df: DataFrame, processed: Column, column: str) -> DataFrame:
    bucket = F.when(processed, "processed").otherwise("not processed").alias("is_processed")
    return df.groupBy(bucket).agg(F.count(column).alias("count"))


def matches_by_state(matches: DataFrame) -> DataFrame:
    return _bucketed(matches, F.col("is_processed"), "match_id")


def players_by_state(players: DataFrame) -> DataFrame:
    return _bucketed(players, F.col("game_name").isNotNull(), "puuid")


def count_of(df: DataFrame, column: str, only: Column | None = None) -> DataFrame:
    """Non-null values of a column, optionally of the rows where ``only`` is true."""
    if only is not None:
        df = df.where(only)
    return df.agg(F.count(column).alias("count"))
