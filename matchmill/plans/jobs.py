"""End-to-end jobs: landed payloads to reference, fact and mart tables.

The job id and job time are parameters, so a run can be repeated with the same result.
Raw tables are written before the merges that read them: a merge's source is then plain
files, counted, and cut from the plan that made it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill import schemas
from matchmill.functions import dates
from matchmill.operators import guards, nested, transforms
from matchmill.plans import kpi as K
from matchmill.session import cut_lineage, discard
from matchmill.sources.warehouse import Warehouse

RAW, REF = schemas.RAW, schemas.REF
QUARANTINE = f"{RAW}.raw_match_rejected"
#: When matches were asked for; how a match without a usable document makes way for others.
ATTEMPTS = f"{RAW}.raw_match_attempts"


@dataclass(frozen=True)
class Run:
    """Where a job writes, and the id and time it stamps.

    With ``tidy`` a mart job removes the versions that it replaces: for a warehouse of which nobody reads earlier ones.
    """

    warehouse: Warehouse
    job_id: str
    time: dt.datetime
    tidy: bool = False

    def tidied(self, *tables: str) -> None:
        """Remove what earlier versions of the tables have left, if that is wanted."""
        for table in tables if self.tidy else ():
            self.warehouse.remove_replaced(table)


def _same(names: Sequence[str]) -> dict[str, str]:
    return {n: n for n in names}


def _raw(run: Run, df: DataFrame, table: str) -> DataFrame:
    """Replace a raw table, stamped; returns it as written."""
    run.warehouse.insert(df, table, "replace", run.job_id, run.time)
    return run.warehouse.read(table)


# ---- reference data ----


def reference_champions(run: Run, landed: DataFrame) -> dict[str, Any]:
    return run.warehouse.insert(nested.champions(landed), f"{REF}.ref_champions", "replace", run.job_id, run.time)


def reference_items(run: Run, landed: DataFrame) -> dict[str, Any]:
    return run.warehouse.insert(nested.items(landed), f"{REF}.ref_items", "replace", run.job_id, run.time)


# ---- work lists ----


def _not_yet(column: str, run_time: dt.datetime | None) -> Column:
    """What was not picked by this run yet, so that a drain in batches comes to its end."""
    if run_time is None:
        return F.lit(True)
    return F.col(column).isNull() | (F.col(column) < dates.utc_timestamp(run_time))


#: Up to so many rows are picked by one task, out of the first of each other task's; a longer list is sorted over all tasks.
TOP = 1 << 20


def _first(work: DataFrame, keys: Sequence[Column], limit: int | None) -> DataFrame:
    """The first ``limit`` rows in the order of ``keys``; no task holds a long list."""
    if not limit or limit <= TOP:
        return work.orderBy(*keys).limit(limit) if limit else work
    # The number tells the task in its upper bits, and tasks follow each other in the order: one number parts the list.
    placed = cut_lineage(work.orderBy(*keys).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    last, left = None, limit
    tasks = placed.groupBy(F.shiftright("_at", 33).alias("task")).agg(F.count(F.lit(1)).alias("n_rows"))
    for task, n_rows in sorted(tuple(r) for r in tasks.collect()):  # a row for each task
        if n_rows >= left:
            last = (task << 33) + left
            break
        left -= n_rows
    return (placed if last is None else placed.where(F.col("_at") < last)).drop("_at")


def players_to_enrich(warehouse: Warehouse, limit: int | None = None, run_time: dt.datetime | None = None) -> DataFrame:
    """Players without a name: those never looked up, then those looked up longest ago."""
    named = warehouse.read(schemas.FACT_PLAYERS.name)
    work = named.where("game_name IS NULL AND tag_line IS NULL").where(_not_yet("date_processed", run_time))
    return _first(work, [F.asc_nulls_first("date_processed"), F.asc("puuid")], limit).select("puuid")


def players_to_follow(warehouse: Warehouse, limit: int | None = None, run_time: dt.datetime | None = None) -> DataFrame:
    """Players whose matches are listed next; never-processed ones come last."""
    work = warehouse.read(schemas.FACT_PLAYERS_TO_PROCESS.name).where(_not_yet("date_processed", run_time))
    return _first(work, [F.asc_nulls_last("date_processed"), F.asc("puuid")], limit).select("puuid")


def matches_to_fetch(warehouse: Warehouse, limit: int | None = None, run_time: dt.datetime | None = None) -> DataFrame:
    """Matches not processed yet: those never asked for, oldest first, then those asked for longest ago."""
    work = warehouse.read(schemas.FACT_MATCH.name).where("NOT is_processed").select("match_id", "tech_date_creation")
    if warehouse.exists(ATTEMPTS):
        asked = warehouse.read(ATTEMPTS).groupBy("match_id").agg(F.max("attempted").alias("attempted"))
        work = work.join(cut_lineage(asked, "attempts"), "match_id", "left").where(_not_yet("attempted", run_time))
    else:
        work = work.withColumn("attempted", F.lit(None).cast("timestamp_ntz"))
    order = [F.asc_nulls_first("attempted"), F.asc("tech_date_creation"), F.asc("match_id")]
    return _first(work, order, limit).select("match_id")


def _picked(work: DataFrame, what: str) -> DataFrame:
    """The work list as a written table: what the job does later must not change it."""
    picked = cut_lineage(work, "picked")
    if picked.isEmpty():
        raise guards.EmptyWork(f"no rows in {what}")
    return picked


# ---- fact tables ----


def enrich_players(run: Run, accounts: DataFrame, entries: DataFrame, limit: int | None = None) -> dict[str, Any]:
    """Names and ranks of players that have none; all that were picked are marked as looked up."""
    picked = _picked(players_to_enrich(run.warehouse, limit, run.time), "players to enrich")
    found = nested.player_info(picked, accounts, entries)
    found = found.withColumn("date_processed", dates.utc_timestamp(run.time))
    return run.warehouse.merge(
        _raw(run, found, f"{RAW}.raw_puuid_info"),
        schemas.FACT_PLAYERS.name,
        ["puuid"],
        match_columns=["game_name", "tag_line", "queue_type", "tier", "rank", "date_processed"],
        has_matched=True,
        now=run.time,
    )


def enrich_matches(
    run: Run, pages: DataFrame, queue: int = nested.ARAM_QUEUE, limit: int | None = None, cap: int | None = None
) -> dict[str, Any]:
    """New match ids of the followed players; those players are marked done, whatever was found.

    ``cap`` keeps each player's first positions only; without it every landed id counts.
    """
    warehouse = run.warehouse
    picked = players_to_follow(warehouse, limit, run.time)
    followed = _picked(guards.require_valid_text(picked, "puuid"), "players to follow")
    wanted = pages.join(followed, "puuid", "left_semi")
    ids = transforms.dedupe_keys(nested.match_ids(wanted, queue, cap), ["match_id"])
    merged = None
    try:
        merged = warehouse.merge(
            _raw(run, ids, f"{RAW}.raw_match_datas_ids"),
            schemas.FACT_MATCH.name,
            ["match_id"],
            non_match_columns={"match_id": "match_id"},
            has_not_matched=True,
            now=run.time,
        )
    except guards.NoRows:
        pass  # the players are marked all the same, or they would be picked again and again
    warehouse.update_in(
        schemas.FACT_PLAYERS_TO_PROCESS.name,
        {"date_processed": dates.utc_timestamp(run.time)},
        "puuid",
        followed,
    )
    if merged is None:
        raise guards.SkipJob("no match ids of the followed players")
    return merged


def _quarantine(run: Run, rejected: DataFrame) -> None:
    """Keep rejected documents, each once however often its batch is applied; a digest stands for the text."""
    digested = rejected.withColumn("digest", F.sha2("payload", 256))
    stamped = transforms.tech_info(transforms.one_per_key(digested, ["digest"]), run.job_id, run.time)
    if run.warehouse.exists(QUARANTINE):
        run.warehouse.insert_ignore(stamped, QUARANTINE, ["digest"])
    else:
        run.warehouse.insert(stamped, QUARANTINE)


def parse_payloads(landed: DataFrame) -> DataFrame:
    """Match documents (``payload``) parsed once, into a written table of the parsed columns; a job in batches starts with it."""
    guards.require_column(landed, "payload")
    return cut_lineage(nested.marked(nested.parse_matches(landed)), "parsed")


def apply_match_payloads(
    run: Run, landed: DataFrame, picked: DataFrame | None = None, parsed: DataFrame | None = None
) -> dict[str, dict[str, Any]]:
    """Statistics, players and matches out of match documents (``payload``), of the ``picked`` matches only if given.

    The documents are parsed once, into a written table of the parsed columns (``parsed``, if that is done already), and
    everything else reads the columns it needs from that. The match table is merged last: a match turns
    processed only when its rows are in. Documents that cannot be read or name no match, or that
    name too many players, go to a table of their own.
    """
    own = parsed is None
    parsed = parse_payloads(landed) if own else parsed
    rejected = nested.quarantined(parsed)
    if not rejected.isEmpty():
        _quarantine(run, rejected)
    if picked is None:
        return _apply_parsed(run, parsed)
    # What is picked is looked up once: all tables are made of it, some in several passes.
    wanted = cut_lineage(parsed.join(picked, parsed["metadata.matchId"] == picked["match_id"], "left_semi"), "wanted")
    try:
        return _apply_parsed(run, wanted)
    finally:
        discard(wanted, *([parsed] if own else []))


def _apply_parsed(run: Run, parsed: DataFrame) -> dict[str, dict[str, Any]]:
    warehouse = run.warehouse
    tables = nested.match_tables(parsed)
    people = nested.named_output(tables, "stats_participants")
    order = [c for c in people.columns if c not in ("id", "match_id", "puuid")]
    try:
        stats = _raw(run, transforms.dedupe_few(people, ["id"], order), f"{RAW}.raw_stats")
    except guards.NoRows as nothing:
        raise guards.SkipJob("no readable match documents") from nothing
    ids = transforms.dedupe_keys(nested.named_output(tables, "puuid_participants"), ["puuid"])
    players = _raw(run, ids, f"{RAW}.raw_puuid")
    header = nested.named_output(tables, "match_data")
    first = [F.col(c) for c in header.columns if c != "match_id"]
    matches = _raw(run, transforms.dedupe_few(header, ["match_id"], first), f"{RAW}.raw_match")
    return {
        "stats": warehouse.merge(
            stats,
            schemas.FACT_STATS.name,
            ["match_id"],
            non_match_columns=_same(schemas.STAT_COLUMNS),
            has_not_matched=True,
            now=run.time,
        ),
        "players": warehouse.merge(
            players,
            schemas.FACT_PLAYERS.name,
            ["puuid"],
            non_match_columns={"puuid": "puuid"},
            has_not_matched=True,
            now=run.time,
        ),
        "matches": warehouse.merge(
            matches,
            schemas.FACT_MATCH.name,
            ["match_id"],
            match_columns=schemas.MATCH_COLUMNS,
            has_matched=True,
            now=run.time,
        ),
    }


def enrich_stats(
    run: Run, landed: DataFrame, limit: int | None = None, parsed: DataFrame | None = None
) -> dict[str, dict[str, Any]]:
    """The next unprocessed matches, out of their landed documents (see ``landing.read_payload_lines``).

    All that were picked are noted as asked for, also when nothing useful was found, so that a
    match without a usable document does not keep others from being picked next. A job lost
    before that picks the same again. ``parsed`` has the same documents from ``parse_payloads``, for batches over one landing.
    """
    picked = _picked(matches_to_fetch(run.warehouse, limit, run.time), "matches to fetch")
    done, skipped = {}, None
    try:
        done = apply_match_payloads(run, landed, picked, parsed)
    except guards.SkipJob as nothing:
        skipped = nothing
    run.warehouse.insert(picked.select("match_id", dates.utc_timestamp(run.time).alias("attempted")), ATTEMPTS)
    if skipped:
        raise skipped
    return done


def drain(job: Callable[[], Any]) -> int:
    """Run a job with a batch size until its work list is empty; batches with nothing useful count too.

    Returns the number of batches. The work list has to shrink with each, as those of one
    run time do.
    """
    batches = 0
    while True:
        try:
            job()
        except guards.EmptyWork:
            return batches
        except guards.SkipJob:
            pass
        batches += 1


# ---- marts ----


def _mart(run: Run, metrics: DataFrame, name: str, keys: Sequence[str], columns: Sequence[str]) -> dict[str, Any]:
    """Merge fresh metrics into a mart: known keys are updated, new ones inserted."""
    raw, mart = f"{RAW}.raw_kpi_per_{name}", f"{schemas.MART}.kpi_stats_per_{name}"
    run.warehouse.insert(metrics, raw, "replace")
    run.tidied(raw)
    merged = run.warehouse.merge(
        run.warehouse.read(raw),
        mart,
        keys,
        match_columns=schemas.KPI_METRICS,
        non_match_columns=_same([*schemas.KPI_METRICS, *columns]),
        has_matched=True,
        has_not_matched=True,
        now=run.time,
    )
    run.tidied(mart)
    return merged


def _facts(run: Run) -> tuple[DataFrame, DataFrame, DataFrame]:
    read = run.warehouse.read
    return read(schemas.FACT_STATS.name), read(schemas.FACT_PLAYERS_TO_PROCESS.name), read(schemas.FACT_MATCH.name)


def _of_players(run: Run, metrics: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``metrics`` of the statistics of the listed players."""
    stats, players, matches = _facts(run)
    return K.by_player(K.player_stats(stats, players, matches), metrics, K.crowded(stats, players))


def player_states(run: Run) -> DataFrame:
    """The facts joined once, as a written table of one row per player and champion that both player marts are made of."""
    return cut_lineage(_of_players(run, lambda rows: K.kpi_states(rows, K.PLAYER + K.CHAMPION)), "states")


def kpi_per_player(run: Run, states: DataFrame | None = None) -> dict[str, Any]:
    if states is None:
        metrics = _of_players(run, lambda rows: K.kpi(rows, K.PLAYER))
    else:
        metrics = K.kpi_from_states(states, K.PLAYER)
    return _mart(run, metrics, "player", ["game_name"], K.PLAYER)


def _player_champion_mart(run: Run, metrics: DataFrame) -> dict[str, Any]:
    return _mart(run, metrics, "player_champion", ["game_name", "champion_id"], K.PLAYER + K.CHAMPION)


def kpi_per_player_champion(run: Run, states: DataFrame | None = None, alone: DataFrame | None = None) -> dict[str, Any]:
    """``alone`` has states that are the only ones of their player's name and champion: these are not shuffled."""
    keys = K.PLAYER + K.CHAMPION
    if states is None:
        metrics = _of_players(run, lambda rows: K.kpi(rows, keys))
    else:
        metrics = K.kpi_from_states(states, keys)
    if alone is not None:
        metrics = K.kpi_of_states(alone).select(*metrics.columns).unionByName(metrics)
    return _player_champion_mart(run, metrics)


def kpi_players(run: Run) -> dict[str, dict[str, Any]]:
    """Both player marts from one pass over the facts."""
    states = player_states(run)
    return {"player": kpi_per_player(run, states), "player_champion": _player_champion_mart(run, K.kpi_of_states(states))}


def kpi_per_champion(run: Run) -> dict[str, Any]:
    stats, _, matches = _facts(run)
    metrics = K.kpi(K.champion_stats(stats, matches), K.CHAMPION)
    return _mart(run, metrics, "champion", ["champion_id"], K.CHAMPION)
