"""The performance KPIs of players and champions.

Every metric is a count, an extreme or a mean of one row expression, so all of them
combine map-side: a group costs one buffer per task however many rows it has. A buffer is
four times as wide as a row, though. Where groups have a few rows a task, as players have, the
rows are shuffled by player instead (``by_player``), but for players with so many that they combine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill import schemas
from matchmill.functions.scalars import at_least

MIN_DURATION = 120
PLAYER = ["game_name"]
CHAMPION = ["champion_name", "champion_id"]


def _minutes() -> Column:
    return F.col("game_duration") / 60


def _per_minute(column: str) -> Column:
    return F.col(column) / _minutes()


def _share(part: str, total: str) -> Column:
    return F.col(part) * F.lit(100.0) / at_least(F.col(total), 1)


def _multi_kills() -> Column:
    # The weight of each multi-kill.
    weights = {"double_kills": 2, "triple_kills": 4, "quadra_kills": 8, "penta_kills": 16}
    score = F.lit(0)
    for column, weight in weights.items():
        score = score + F.col(column) * weight
    return score


def mean_expressions() -> dict[str, Column]:
    """Row expressions whose mean over a group is the metric."""
    dealt, taken = "damage_dealt_to_champions", "damage_taken"
    deaths = F.col("deaths")
    out = {"avg_damage_per_minute": _per_minute(f"total_{dealt}")}
    for kind in ("physical", "magic", "true"):
        out[f"avg_{kind}_damage_per_minute"] = _per_minute(f"{kind}_{dealt}")
        out[f"avg_{kind}_damage_dealt_pct"] = _share(f"{kind}_{dealt}", f"total_{dealt}")
        out[f"avg_{kind}_damage_taken_per_minute"] = _per_minute(f"{kind}_{taken}")
        out[f"avg_{kind}_damage_taken_pct"] = _share(f"{kind}_{taken}", f"total_{taken}")
    for event in ("kills", "deaths", "assists"):
        out[f"avg_{event}_per_minute"] = _per_minute(event)
    out |= {
        "avg_multi_kill_score": _multi_kills(),
        "penta_rate": F.when(F.col("penta_kills") > 0, 100.0).otherwise(0.0),
        "avg_damage_taken_per_death": F.col("total_damage_taken") / at_least(deaths, 1),
        "avg_heal_per_minute": _per_minute("total_heal"),
        "avg_cs_per_minute": _per_minute("total_minions_killed"),
        "avg_gold_per_minute": _per_minute("gold_earned"),
        "avg_gold_per_cs": F.col("gold_earned") / at_least(F.col("total_minions_killed"), 1),
        "avg_kda": (F.col("kills") + F.col("assists")) / at_least(deaths, 1),
        # The weights of the three indices.
        "tanking_index": _per_minute("total_damage_taken") * 0.35
        + _per_minute("total_heal") * 0.25
        + F.lit(1.0) / at_least(_per_minute("deaths"), 0.1) * 0.3
        - _per_minute("deaths") * 50,
        "damage_index": _per_minute(f"total_{dealt}") * 0.6
        + _per_minute("kills") * 80
        + _multi_kills() * 4
        - _per_minute("deaths") * 50,
        "support_index": _per_minute("assists") * 180 + _per_minute("total_heal") * 0.15 - _per_minute("deaths") * 80,
    }
    return out


def whole_metrics() -> dict[str, Column]:
    """Counts and extremes."""
    return {
        "total_games": F.count(F.lit(1)),
        "best_kills": F.max("kills").cast("bigint"),
        "best_damage": F.max("total_damage_dealt_to_champions").cast("bigint"),
        "best_deaths": F.min("deaths").cast("bigint"),
    }


def group_keys(per_player: bool = False, per_champion: bool = False) -> list[str]:
    if not per_player and not per_champion:
        raise ValueError("KPIs need a grouping: per player, per champion or both")
    return PLAYER * per_player + CHAMPION * per_champion


def eligible(stats: DataFrame) -> DataFrame:
    """Games long enough to count; unknown durations are left out."""
    return stats.where(F.col("game_duration") > MIN_DURATION)


def kpi(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All metrics of ``stats`` (statistics with game_duration) per group of ``keys``."""
    if not keys:
        raise ValueError("KPIs need at least one group key")
    metrics = {name: F.avg(e.cast("double")) for name, e in mean_expressions().items()} | whole_metrics()
    return eligible(stats).groupBy(*keys).agg(*[metrics[m].alias(m) for m in schemas.KPI_METRICS])


#: Players are told apart by so many numbers; rows of a number that has more of them than this combine map-side.
PLACES, CROWD = 4096, 1 << 20


def _place(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(PLACES)).cast("int")


def crowded(rows: DataFrame, players: DataFrame | None = None) -> list[int]:
    """The places of players with a large share of ``rows``, of which only the puuid is read: at most ``PLACES`` numbers.

    With ``players`` they are told apart by name, else by puuid.
    """
    counts = rows.groupBy("puuid").agg(F.count(F.lit(1)).alias("n_rows"))
    if players is not None:
        counts = counts.join(players.select("puuid", *PLAYER), "puuid")
    counts = counts.groupBy(_place(["puuid"] if players is None else PLAYER).alias("place"))
    found = {r[0]: r[1] for r in counts.agg(F.sum("n_rows")).collect()}
    most = max(CROWD, 4 * sum(found.values()) // PLACES)
    return sorted(p for p, n in found.items() if n > most)


def by_player(
    stats: DataFrame,
    metrics: Callable[[DataFrame], DataFrame],
    crowd: Sequence[int],
    key: Sequence[str] = PLAYER,
    place: Sequence[str] = (),
) -> DataFrame:
    """``metrics`` of ``stats``, grouped by the player (``key``) and maybe more, with the rows of a player together.

    Of the places in ``crowd`` rows are combined map-side, so that no task has all of a player with a large share.
    Rows are shuffled by the player or, if given, by the columns ``place``, which follow from the player and are among the groups' keys.
    """
    in_crowd = _place(key).isin(list(crowd))
    alone = metrics((stats.where(~in_crowd) if crowd else stats).repartition(*(place or key)))
    return alone.unionByName(metrics(stats.where(in_crowd))) if crowd else alone


#: The columns of the statistics that the metrics are made of.
MEASURES = [
    "kills", "deaths", "assists", "double_kills", "triple_kills", "quadra_kills", "penta_kills",
    *[f"{kind}_damage_{way}" for kind in ("total", "physical", "magic", "true") for way in ("dealt_to_champions", "taken")],
    "total_heal", "total_minions_killed", "gold_earned",
]


def kpi_states(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums, counts and extremes per group: what coarser groupings of the same rows need."""
    parts = []
    for name, expression in mean_expressions().items():
        value = expression.cast("double")
        parts += [F.sum(value).alias(f"sum_{name}"), F.count(value).alias(f"n_{name}")]
    parts += [column.alias(name) for name, column in whole_metrics().items()]
    return eligible(stats).groupBy(*keys).agg(*parts)


def kpi_from_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The metrics of a grouping no finer than the one of ``states``."""
    merged = {m: F.sum(f"sum_{m}") / F.nullif(F.sum(f"n_{m}"), F.lit(0)) for m in mean_expressions()}
    merged |= {
        "total_games": F.sum("total_games"),
        "best_kills": F.max("best_kills"),
        "best_damage": F.max("best_damage"),
        "best_deaths": F.min("best_deaths"),
    }
    return states.groupBy(*keys).agg(*[merged[m].alias(m) for m in schemas.KPI_METRICS])


def kpi_of_states(states: DataFrame) -> DataFrame:
    """The metrics of the grouping of ``states`` itself, one row per group: nothing is shuffled."""
    metrics = {m: F.col(f"sum_{m}") / F.nullif(F.col(f"n_{m}"), F.lit(0)) for m in mean_expressions()}
    keys = [c for c in (*PLAYER, *CHAMPION) if c in states.columns]
    return states.select(*keys, *[metrics.get(m, F.col(m)).alias(m) for m in schemas.KPI_METRICS])


def kpi_grouping_sets(states: DataFrame, groupings: Sequence[Sequence[str]]) -> DataFrame:
    """Several groupings stacked, keys a grouping does not use being NULL.

    The statistics are joined and scanned once, into ``states`` of the finest grouping;
    the coarser ones are folded from those few rows.
    """
    finest = list(dict.fromkeys(k for g in groupings for k in g))
    out = None
    for grouping in groupings:
        part = kpi_from_states(states, grouping)
        for key in finest:
            if key not in grouping:
                part = part.withColumn(key, F.lit(None).cast(states.schema[key].dataType))
        part = part.select(*finest, *schemas.KPI_METRICS)
        out = part if out is None else out.unionByName(part)
    return out


def champion_stats(stats: DataFrame, matches: DataFrame) -> DataFrame:
    """Statistics with their match's duration; only that column of the matches is read."""
    return stats.join(matches.select("match_id", "game_duration"), "match_id")


def player_stats(stats: DataFrame, players: DataFrame, matches: DataFrame) -> DataFrame:
    """As ``champion_stats``, for the listed players, with their name.

    The player list is joined first: it drops rows before the large join. No hint is
    given; Catalyst or AQE broadcasts the list when it is measured to be small.
    """
    return champion_stats(stats.join(players.select("puuid", "game_name"), "puuid"), matches)
