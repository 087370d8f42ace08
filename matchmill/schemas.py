"""Table and payload schemas. Columns, defaults and keys are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

RAW, FACT, MART, REF = "raw_datas", "fact_datas", "mart_datas", "referentiel"
LAYERS = (RAW, FACT, MART, REF)

_TECH = {"tech_date_creation": "TIMESTAMP_NTZ", "tech_date_modification": "TIMESTAMP_NTZ"}
_TECH_DEFAULTS = {
    "tech_date_creation": "CAST(current_timestamp() AS TIMESTAMP_NTZ)",
    "tech_date_modification": "CAST(current_timestamp() AS TIMESTAMP_NTZ)",
}

PLAYERS_PER_MATCH = 10


@dataclass(frozen=True)
class Table:
    """A fixed-schema table. ``bucket_key`` spreads it over partitions an update can rewrite alone."""

    name: str
    columns: dict[str, str]
    primary_key: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    bucket_key: str | None = None


MATCH_COLUMNS = [
    *[f"puuid_{i}" for i in range(1, PLAYERS_PER_MATCH + 1)],
    "game_creation",
    "game_duration",
    "game_mode",
    "game_version",
    "game_in_progress",
    "is_processed",
]

# Participant columns of the statistics table and the payload fields they come from.
STAT_FIELDS = {
    "puuid": "puuid",
    "champion_id": "championId",
    "champion_name": "championName",
    "kills": "kills",
    "deaths": "deaths",
    "assists": "assists",
    "double_kills": "doubleKills",
    "triple_kills": "tripleKills",
    "quadra_kills": "quadraKills",
    "penta_kills": "pentaKills",
    "largest_killing_spree": "largestKillingSpree",
    "total_damage_dealt": "totalDamageDealt",
    "total_damage_dealt_to_champions": "totalDamageDealtToChampions",
    "physical_damage_dealt_to_champions": "physicalDamageDealtToChampions",
    "magic_damage_dealt_to_champions": "magicDamageDealtToChampions",
    "true_damage_dealt_to_champions": "trueDamageDealtToChampions",
    "largest_critical_strike": "largestCriticalStrike",
    "total_damage_taken": "totalDamageTaken",
    "physical_damage_taken": "physicalDamageTaken",
    "magic_damage_taken": "magicDamageTaken",
    "true_damage_taken": "trueDamageTaken",
    "total_heal": "totalHeal",
    "total_heals_on_teammates": "totalHealsOnTeammates",
    "total_minions_killed": "totalMinionsKilled",
    "neutral_minions_killed": "neutralMinionsKilled",
    "gold_earned": "goldEarned",
    "champ_level": "champLevel",
    "champ_experience": "champExperience",
}
ITEM_FIELDS = {f"item{i}": f"item{i}" for i in range(7)}

_TEXT_STATS = ("puuid", "champion_name")

# Columns a statistics merge inserts: all but the items, which stay in the raw table.
STAT_COLUMNS = ["id", "match_id", *STAT_FIELDS]
STAT_COLUMNS.insert(STAT_COLUMNS.index("assists") + 1, "kda")


def _stat_type(column: str) -> str:
    return "STRING" if column in _TEXT_STATS or column in ("id", "match_id") else "INT"


# KPI metrics in mart order; counts and extremes are whole numbers.
KPI_METRICS = [
    "avg_damage_per_minute",
    "avg_physical_damage_per_minute",
    "avg_magic_damage_per_minute",
    "avg_true_damage_per_minute",
    "avg_physical_damage_dealt_pct",
    "avg_magic_damage_dealt_pct",
    "avg_true_damage_dealt_pct",
    "avg_kills_per_minute",
    "avg_deaths_per_minute",
    "avg_assists_per_minute",
    "avg_multi_kill_score",
    "penta_rate",
    "avg_damage_taken_per_death",
    "avg_physical_damage_taken_per_minute",
    "avg_magic_damage_taken_per_minute",
    "avg_true_damage_taken_per_minute",
    "avg_physical_damage_taken_pct",
    "avg_magic_damage_taken_pct",
    "avg_true_damage_taken_pct",
    "avg_heal_per_minute",
    "avg_cs_per_minute",
    "avg_gold_per_minute",
    "avg_gold_per_cs",
    "avg_kda",
    "total_games",
    "best_kills",
    "best_damage",
    "best_deaths",
    "tanking_index",
    "damage_index",
    "support_index",
]
KPI_WHOLE = ("total_games", "best_kills", "best_damage", "best_deaths")
KPI_KEY_TYPES = {"game_name": "STRING", "champion_name": "STRING", "champion_id": "BIGINT"}


def _mart(name: str, keys: tuple[str, ...]) -> Table:
    metrics = {m: "BIGINT" if m in KPI_WHOLE else "DOUBLE" for m in KPI_METRICS}
    columns = {**metrics, **{k: KPI_KEY_TYPES[k] for k in keys}, **_TECH}
    return Table(f"{MART}.{name}", columns, defaults=dict(_TECH_DEFAULTS))


# Text lengths of the fact tables.
MATCH_ID, PUUID = "VARCHAR(50)", "VARCHAR(250)"
_STAT_TEXTS = {"id": "VARCHAR(250)", "match_id": MATCH_ID, "puuid": PUUID, "champion_name": "VARCHAR(100)"}

FACT_MATCH = Table(
    f"{FACT}.fact_match",
    {
        "match_id": MATCH_ID,
        **{f"puuid_{i}": PUUID for i in range(1, PLAYERS_PER_MATCH + 1)},
        "game_creation": "TIMESTAMP_NTZ",
        "game_duration": "BIGINT",
        "game_mode": "VARCHAR(50)",
        "game_version": "VARCHAR(20)",
        "game_in_progress": "BOOLEAN",
        "is_processed": "BOOLEAN",
        **_TECH,
    },
    ("match_id",),
    {"game_in_progress": "false", "is_processed": "false", **_TECH_DEFAULTS},
    bucket_key="match_id",
)

FACT_PLAYERS_TO_PROCESS = Table(
    f"{FACT}.fact_puuid_to_process",
    {"puuid": PUUID, "game_name": "VARCHAR(100)", "tag_line": "VARCHAR(50)", "date_processed": "TIMESTAMP_NTZ", **_TECH},
    ("puuid",),
    dict(_TECH_DEFAULTS),
)

FACT_PLAYERS = Table(
    f"{FACT}.fact_puuid",
    {
        "puuid": PUUID,
        "game_name": "VARCHAR(100)",
        "tag_line": "VARCHAR(50)",
        "queue_type": "VARCHAR(30)",
        "tier": "VARCHAR(10)",
        "rank": "VARCHAR(4)",
        "date_processed": "TIMESTAMP_NTZ",
        **_TECH,
    },
    ("puuid",),
    dict(_TECH_DEFAULTS),
    bucket_key="puuid",
)

FACT_STATS = Table(
    f"{FACT}.fact_stats",
    {**{c: _STAT_TEXTS.get(c, _stat_type(c)) for c in STAT_COLUMNS}, **_TECH, **{c: "INT" for c in ITEM_FIELDS}},
    ("id",),
    dict(_TECH_DEFAULTS),
    bucket_key="match_id",
)

MART_PLAYER = _mart("kpi_stats_per_player", ("game_name",))
MART_PLAYER_CHAMPION = _mart("kpi_stats_per_player_champion", ("game_name", "champion_name", "champion_id"))
MART_CHAMPION = _mart("kpi_stats_per_champion", ("champion_name", "champion_id"))

FIXED_TABLES = (
    FACT_MATCH,
    FACT_PLAYERS_TO_PROCESS,
    FACT_PLAYERS,
    FACT_STATS,
    MART_PLAYER,
    MART_PLAYER_CHAMPION,
    MART_CHAMPION,
)

# ---- landed payloads ----

CORRUPT = "_corrupt_record"


def _participant_type() -> str:
    fields = {**STAT_FIELDS, **ITEM_FIELDS}
    return ", ".join(f"{p}: {_stat_type(c)}" for c, p in fields.items())


MATCH_PAYLOAD = (
    "metadata struct<matchId: string, participants: array<string>>, "
    "info struct<gameCreation: bigint, gameDuration: bigint, gameMode: string, gameVersion: string, "
    f"gameEndTimestamp: bigint, participants: array<struct<{_participant_type()}>>>, {CORRUPT} string"
)
ID_PAGE = "puuid string, queue int, start bigint, match_ids array<string>"
ACCOUNT = "puuid string, gameName string, tagLine string"
LEAGUE_ENTRIES = "puuid string, entries array<struct<queueType: string, tier: string, rank: string>>"
CHAMPIONS = (
    "data map<string, struct<name: string, id: string, key: string, title: string, blurb: string, "
    "tags: array<string>>>"
)
ITEMS = (
    "data map<string, struct<name: string, description: string, plaintext: string, "
    "gold: struct<total: bigint>, image: struct<full: string, sprite: string>>>"
)


def struct_of(ddl: str) -> T.StructType:
    """A DDL schema as a StructType."""
    return T.StructType.fromDDL(ddl)
