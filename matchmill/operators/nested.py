"""Landed JSON payloads to flat tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmill import schemas
from matchmill.functions import scalars as S
from matchmill.operators.joins import key_table
from matchmill.operators.transforms import one_per_key
from matchmill.session import cut_lineage

# The ranked queue looked up per player, and the id-page limits.
RANKED_QUEUE = "RANKED_SOLO_5x5"
ARAM_QUEUE = 450
PAGE_SIZE = 100
IDS_PER_PLAYER = 1000


def parse_matches(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """The payload column parsed once; unreadable documents keep their text in ``_corrupt_record``.

    The document goes through a generator: a later filter on its fields cannot be pushed
    below one, which would parse every document again for the filter.
    """
    schema = schemas.struct_of(schemas.MATCH_PAYLOAD)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    return landed.select(F.inline(F.array(F.from_json(payload, schema, options))))


def is_readable() -> Column:
    """True for a parsed document that names its match and has no more players than the match table has columns for."""
    players = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in ("metadata.participants", "info.participants")])
    return F.col(schemas.CORRUPT).isNull() & F.col("metadata.matchId").isNotNull() & (players <= schemas.PLAYERS_PER_MATCH)


#: Whether a document is readable, told as it is parsed: who asks later need not read its participants for it.
READABLE = "_readable"


def marked(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn(READABLE, is_readable())


def _readable(parsed: DataFrame) -> Column:
    return F.col(READABLE) if READABLE in parsed.columns else is_readable()


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(_readable(parsed))


def quarantined(parsed: DataFrame) -> DataFrame:
    """The documents that are not readable, as text."""
    return parsed.where(~_readable(parsed)).select(
        F.coalesce(F.col(schemas.CORRUPT), F.to_json(F.struct("metadata", "info"))).alias("payload")
    )


def match_header(parsed: DataFrame) -> DataFrame:
    """One row per match: players by position (NULL when absent), timing, mode, state."""
    players = [
        F.get("metadata.participants", F.lit(i)).alias(f"puuid_{i + 1}") for i in range(schemas.PLAYERS_PER_MATCH)
    ]
    return parsed.select(
        F.col("metadata.matchId").alias("match_id"),
        *players,
        S.from_epoch_ms(F.col("info.gameCreation")).alias("game_creation"),
        F.col("info.gameDuration").alias("game_duration"),
        F.col("info.gameMode").alias("game_mode"),
        F.col("info.gameVersion").alias("game_version"),
        F.col("info.gameEndTimestamp").isNull().alias("game_in_progress"),
        F.lit(True).alias("is_processed"),
    )


def participants(parsed: DataFrame, items: bool = True) -> DataFrame:
    """One row per participant of each match, with its id and ratio derived."""
    rows = parsed.select(F.col("metadata.matchId").alias("match_id"), F.explode("info.participants").alias("p"))
    fields = {**schemas.STAT_FIELDS, **(schemas.ITEM_FIELDS if items else {})}
    columns = {name: F.col(f"p.{source}") for name, source in fields.items()}
    columns["id"] = S.row_id(F.col("match_id"), columns["puuid"])
    columns["match_id"] = F.col("match_id")
    columns["kda"] = S.kda(columns["kills"], columns["deaths"], columns["assists"])
    order = [*schemas.STAT_COLUMNS, *(schemas.ITEM_FIELDS if items else {})]
    return rows.select(*[columns[c].alias(c) for c in order])


def participant_ids(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.explode("metadata.participants").alias("puuid"))


def match_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """The three tables one parse feeds; write ``parsed`` once when more than one is used."""
    good = readable(parsed)
    return {
        "match_data": match_header(good),
        "stats_participants": participants(good),
        "puuid_participants": participant_ids(good),
    }


def named_output(outputs: dict[str, DataFrame], key: str) -> DataFrame:
    if not isinstance(outputs, dict):
        raise TypeError("a named output needs a dict of tables")
    if key not in outputs:
        raise KeyError(f"no output {key!r}; there are {sorted(outputs)}")
    return outputs[key]


def match_ids(pages: DataFrame, queue: int = ARAM_QUEUE, cap: int | None = None) -> DataFrame:
    """Match ids of one queue from landed id pages; with ``cap``, those of each player's first positions only.

    A page holds at most a hundred ids and says where it starts, so no player's whole
    list is ever one row.
    """
    ids = pages.where(F.col("queue") == queue).select(
        "puuid", F.coalesce("start", F.lit(0)).alias("start"), F.posexplode("match_ids").alias("pos", "match_id")
    )
    ids = ids.withColumn("position", (F.col("start") + F.col("pos")).cast("long"))
    if cap is not None:
        ids = ids.where(F.col("position") < cap)
    return ids.select("puuid", "position", "match_id")


def first_league_entry(entries: DataFrame, queue_type: str = RANKED_QUEUE) -> DataFrame:
    """The first entry of the wanted queue per player, NULLs when there is none."""
    entry: Column = F.get(F.filter("entries", lambda e: e["queueType"].isin(queue_type)), F.lit(0))
    return entries.select(
        "puuid", entry["queueType"].alias("queue_type"), entry["tier"].alias("tier"), entry["rank"].alias("rank")
    )


def player_info(players: DataFrame, accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """Account and league columns looked up per player; players without them stay.

    The landed tables are cut to the wanted players, a written table of keys, before anything of
    them is made unique: that join can be split on an account landed often.
    """
    wanted = key_table(players, ["puuid"])

    def of_wanted(landed: DataFrame) -> DataFrame:
        return one_per_key(landed.join(wanted, "puuid", "left_semi"), ["puuid"])

    names = of_wanted(accounts).select(
        "puuid", F.col("gameName").alias("game_name"), F.col("tagLine").alias("tag_line")
    )
    return wanted.join(names, "puuid", "left").join(first_league_entry(of_wanted(entries)), "puuid", "left")


def champions(landed: DataFrame) -> DataFrame:
    """The keyed champion map as rows; absent text fields become ''."""
    rows = landed.select(F.explode("data").alias("key_", "v"))
    fields = {"name": "name", "id": "id", "key": "key", "title": "title", "description": "blurb"}
    return rows.select(
        *[S.default_to(F.col(f"v.{source}"), "").alias(name) for name, source in fields.items()],
        S.joined_text(F.col("v.tags")).alias("tags"),
    )


def items(landed: DataFrame) -> DataFrame:
    """The keyed item map as rows; the map key is the id."""
    rows = landed.select(F.explode("data").alias("id", "v"))
    return rows.select(
        "id",
        S.default_to(F.col("v.name"), "").alias("name"),
        S.default_to(F.col("v.description"), "").alias("description"),
        S.default_to(F.col("v.plaintext"), "").alias("plaintext"),
        S.default_to(F.col("v.gold.total"), 0).alias("cost"),
        S.default_to(F.col("v.image.full"), "").alias("image_full"),
        S.default_to(F.col("v.image.sprite"), "").alias("image_sprite"),
    )


def latest_version(versions: Column) -> Column:
    """The first entry of a version list, newest first; NULL for an empty list."""
    return F.get(versions, F.lit(0))


def _leaves(schema: T.StructType, path: str = "", name: str = "") -> list[Column]:
    out = []
    for field in schema.fields:
        here, label = f"{path}`{field.name}`", f"{name}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here + ".", label + ".")
        else:
            out.append(F.col(here).alias(label))
    return out


def normalise(df: DataFrame) -> DataFrame:
    """Nested objects as flat ``a.b`` columns; lists and maps are kept."""
    return df.select(*_leaves(df.schema))


_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def _declared(told: str) -> str:
    """The type that ``schema_of_variant_agg`` tells, as a declaration; what is only ever null is a text."""
    parts = _QUOTED.split(told)
    parts[::2] = [p.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING") for p in parts[::2]]
    return "".join(parts)


def _texts_and_leaves(column: Column, kind: T.DataType, name: str = "") -> list[Column]:
    """The leaves below objects; what has no single type, and an object without keys, as JSON text."""
    if isinstance(kind, T.StructType) and kind.fields:
        return [c for f in kind.fields for c in _texts_and_leaves(column.getField(f.name), f.dataType, f"{name}.{f.name}" if name else f.name)]
    told = kind.simpleString()
    return [(F.to_json(column) if "variant" in told or told == "struct<>" else column).alias(name)]


def flatten_json(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents of any shape as flat ``a.b`` columns, for whatever keys arrive in any of them.

    The texts are parsed once, into a written VARIANT column; the union of their shapes is one aggregate
    over it. Lists are kept as arrays. Where documents disagree on a value's type, or it is an object in
    some and none in others, the column holds JSON text. Keys that a document has not are NULL; so is
    everything of a text that is no JSON, or no object. Other columns are kept. The columns are as many
    as there are different paths: documents keyed by ids are better read as maps (see ``items``).
    """
    rest = [c for c in df.columns if c != payload]
    parsed = cut_lineage(df.withColumn(payload, F.try_parse_json(payload)), "variants")
    told = parsed.agg(F.schema_of_variant_agg(payload)).first()[0]
    if not told or not told.startswith("OBJECT<"):
        # No object at all, or some documents are none: what is one tells.
        parsed = parsed.withColumn(payload, F.when(F.schema_of_variant(payload).startswith("OBJECT<"), F.col(payload)))
        told = parsed.agg(F.schema_of_variant_agg(payload)).first()[0]
        if not told or not told.startswith("OBJECT<"):
            return parsed.select(*rest)
    kind = T.StructType.fromDDL(f"told {_declared(told)}")["told"].dataType
    read = parsed.withColumn(payload, F.try_variant_get(payload, "$", _declared(told)))
    return read.select(*[F.col(f"`{c}`") for c in rest], *_texts_and_leaves(F.col(f"`{payload}`"), kind))
