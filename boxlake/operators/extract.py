"""Projections of landed payloads.

Each ``extract_*`` turns landed JSON into one small row per landed document, with the
rows of a game held in an array and with a ``reject_reason`` where the game cannot be
used. Documents are parsed once and never shuffled: only the extracted rows are.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import games as G
from boxlake.functions import parsing as P
from boxlake.operators.merge import pick_row
from boxlake.schemas import LINEUP_MEASURES, PLAYER_STATS, TEAM_RATINGS, TEAM_STATS

# Field names of the landed documents.
SUMMARY_ROOT = "boxScoreSummary"
TRADITIONAL_ROOTS = ("boxScoreTraditional", "boxScoreTraditionalV3", "boxScoreTraditionalv3")
ADVANCED_ROOTS = ("boxScoreAdvanced", "boxScoreAdvancedV3", "boxScoreAdvancedv3")
SIDES = ("homeTeam", "awayTeam")
GAME_FIELDS = ("homeTeamId", "awayTeamId", "gameTimeUTC", "gameEt", "gameStatusText")
ARENA_FIELDS = {"arena_name": "arenaName", "arena_city": "arenaCity", "arena_state": "arenaState"}
BOX_TEAM_ID = ("teamId", "teamID", "id")
SUMMARY_TEAM_ID = ("teamId", "id")
ABBREVIATION = ("teamTricode", "abbreviation")
CITY = ("teamCity", "city")
TEAM_NAME = ("teamName", "name", "nickname")
TEAM_FIELDS = (*SUMMARY_TEAM_ID, *ABBREVIATION, *CITY, *TEAM_NAME)
TEAM_STAT_FIELDS = {
    "pts": ("points", "pts"),
    "fgm": ("fieldGoalsMade", "fgm"),
    "fga": ("fieldGoalsAttempted", "fga"),
    "fg3m": ("threePointersMade", "fg3m"),
    "fg3a": ("threePointersAttempted", "fg3a"),
    "ftm": ("freeThrowsMade", "ftm"),
    "fta": ("freeThrowsAttempted", "fta"),
    "oreb": ("reboundsOffensive", "oreb"),
    "dreb": ("reboundsDefensive", "dreb"),
    "reb": ("reboundsTotal", "reb"),
    "ast": ("assists", "ast"),
    "stl": ("steals", "stl"),
    "blk": ("blocks", "blk"),
    "tov": ("turnovers", "tov"),
    "pf": ("foulsPersonal", "pf"),
}
TEAM_RATING_FIELDS = {
    "off_rating": ("offensiveRating", "offRating"),
    "def_rating": ("defensiveRating", "defRating"),
    "net_rating": ("netRating",),
    "pace": ("pace",),
    "ts_pct": ("trueShootingPercentage", "tsPct"),
}
# Spellings that mean the same as a number and as a text.
PLAIN_NUMBERS = {"bigint": r"^-?[0-9]{1,18}$", "double": r"^-?[0-9]{1,15}(\.[0-9]{1,15})?$"}
PLAYER_STAT_FIELDS = {
    **{name: TEAM_STAT_FIELDS[name][0] for name in PLAYER_STATS if name != "plus_minus"},
    "plus_minus": "plusMinusPoints",
}
PLAYER_TEXT_FIELDS = {
    "first_name": "firstName", "last_name": "familyName", "position": "position", "minutes": "minutes",
}
PLAYER_COLUMNS = ("personId", "teamId")
LINEUP_COLUMNS = ("GROUP_ID",)
LINEUP_TEXT_FIELDS = ("group_set", "group_id", "group_name")

# Reject reasons and their texts.
REASONS = {
    "not_landed": "no landed document for the game",
    "malformed_payload": "landed document is not a JSON object",
    "no_summary": "no summary object in the document",
    "missing_team_ids": "home or away team id missing or unreadable",
    "missing_game_time": "neither a UTC nor a local game time",
    "unreadable_time": "game date or time cannot be read",
    "out_of_range": "a number does not fit its column or a text is too long",
    "no_player_table": "no player table, or an empty one",
    "missing_player_columns": "player table lacks a required column",
    "no_player_rows": "no player row has both ids",
    "missing_lineup_columns": "lineup table lacks a required column",
    "null_key": "a key column is null",
    "unknown_reference": "a row refers to an unknown game, team or player",
}

LANDED_ORDER = ["landed_at", "_digest"]


def reject_message(reason: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return F.coalesce(F.try_element_at(texts, reason), reason)


def _first_reason(*cases: tuple[str, Column]) -> Column:
    return F.coalesce(*[F.when(condition, F.lit(reason)) for reason, condition in cases], F.lit(None).cast("string"))


def _documents(landed: DataFrame, *keep: str) -> DataFrame:
    return landed.select(
        *keep, "landed_at", F.xxhash64("payload").alias("_digest"),
        P.parse_document(F.col("payload")).alias("doc"),
    )


def latest(extracted: DataFrame, key: tuple[str, ...] = ("game_id",)) -> DataFrame:
    """The newest landed copy of each game."""
    return pick_row(extracted, list(key), LANDED_ORDER).drop(*LANDED_ORDER)


def _too_long(name: str, length: int) -> Column:
    return F.coalesce(F.char_length(name) > length, F.lit(False))


# --- games and team dimension --------------------------------------------------------


def _side_fields(side: str) -> list[Column]:
    """Raw dimension fields of one side; all NULL when the side is no object."""
    team = F.col(side)
    return [
        P.to_long(P.any_of(team, SUMMARY_TEAM_ID)).alias(f"{side}_id"),
        P.to_text(P.any_of(team, ABBREVIATION)).alias(f"{side}_abbreviation"),
        P.any_of(team, CITY).alias(f"{side}_city"),
        P.any_of(team, TEAM_NAME).alias(f"{side}_name"),
        team.getField(TEAM_NAME[0]).alias(f"{side}_own_name"),
    ]


def _team_dim(side: str, fallback_id: Column) -> Column:
    """Dimension row of one side; an id that is missing or zero falls back to the game's."""
    city, name, own_name = (F.col(f"{side}_{c}") for c in ("city", "name", "own_name"))
    full = F.when(P.truthy(own_name), P.to_text(own_name)).when(
        P.truthy(city) & P.truthy(name), F.concat(P.to_text(city), F.lit(" "), P.to_text(name))
    )
    return F.struct(
        F.coalesce(F.nullif(F.col(f"{side}_id"), F.lit(0)), fallback_id).alias("team_id"),
        F.col(f"{side}_abbreviation").alias("abbreviation"),
        P.to_text(name).alias("team_name"),
        P.to_text(city).alias("city"),
        full.alias("full_name"),
    )


def extract_games(landed: DataFrame) -> DataFrame:
    """Landed summaries to game columns, a two-entry ``teams`` array and a reject reason."""
    doc = F.col("doc")
    found = _documents(landed, "game_id").select(
        "game_id", *LANDED_ORDER,
        P.is_object(doc).alias("is_doc"),
        P.is_filled_object(doc, f"$.{SUMMARY_ROOT}").alias("has_root"),
        P.get_struct(doc, f"$.{SUMMARY_ROOT}", GAME_FIELDS).alias("game"),
        P.get_struct(doc, f"$.{SUMMARY_ROOT}.arena", ARENA_FIELDS.values()).alias("arena"),
        *[P.get_struct(doc, f"$.{SUMMARY_ROOT}.{side}", TEAM_FIELDS).alias(side) for side in SIDES],
    )
    fields = found.select(
        "game_id", *LANDED_ORDER, "is_doc", "has_root",
        P.to_long(F.col("game.homeTeamId")).alias("home_team_id"),
        P.to_long(F.col("game.awayTeamId")).alias("away_team_id"),
        F.col("game.gameTimeUTC").alias("utc"),
        P.first_truthy(F.col("game.gameTimeUTC"), F.col("game.gameEt")).alias("time"),
        P.get(F.col("game.gameStatusText"), "$", "string").alias("game_status"),
        *[P.get(F.col(f"arena.{f}"), "$", "string").alias(c) for c, f in ARENA_FIELDS.items()],
        *[field for side in SIDES for field in _side_fields(side)],
    )
    home, away = F.col("home_team_id"), F.col("away_team_id")
    texts = fields.select(
        "game_id", *LANDED_ORDER, "is_doc", "has_root", "home_team_id", "away_team_id",
        "game_status", *ARENA_FIELDS,
        P.to_text(F.col("time")).alias("time_text"),
        P.to_text(F.col("utc")).alias("utc_text"),
        F.array(*[_team_dim(side, fallback) for side, fallback in zip(SIDES, (home, away))]).alias("teams"),
    )
    rows = texts.select(
        "*",
        G.iso_date(F.col("time_text")).alias("game_date"),
        G.iso_timestamp(F.col("utc_text")).alias("game_datetime_utc"),
    )
    team_ids = [F.get("teams", F.lit(i)).getField("team_id") for i in (0, 1)]
    reason = _first_reason(
        ("malformed_payload", ~F.coalesce(F.col("is_doc"), F.lit(False))),
        ("no_summary", ~F.col("has_root")),
        ("missing_team_ids", home.isNull() | away.isNull()),
        ("missing_game_time", F.col("time_text").isNull()),
        ("unreadable_time",
         F.col("game_date").isNull() | (F.col("utc_text").isNotNull() & F.col("game_datetime_utc").isNull())),
        ("out_of_range", P.outside_int32(home, away, *team_ids) | _too_long("game_id", 10)),
    )
    return rows.withColumn("reject_reason", reason).drop("is_doc", "has_root", "time_text", "utc_text")


def game_rows(games: DataFrame) -> DataFrame:
    return games.select(
        "game_id", "season", "game_date", "game_datetime_utc",
        F.col("home_team_id").try_cast("int").alias("home_team_id"),
        F.col("away_team_id").try_cast("int").alias("away_team_id"),
        "game_status", "arena_name", "arena_city", "arena_state",
    )


def team_dim_rows(games: DataFrame, *keep: str) -> DataFrame:
    """Two dimension rows per game, home before away (``pos``)."""
    return games.select(*keep, "game_id", F.posexplode("teams").alias("pos", "t")).select(
        *keep, "game_id", "pos", F.col("t.team_id").try_cast("int").alias("team_id"),
        "t.abbreviation", "t.team_name", "t.city", "t.full_name",
    )


# --- team box scores -----------------------------------------------------------------


def document_root(doc: Column, names: tuple[str, ...], fields: tuple[str, ...]) -> Column:
    """``fields`` of the first object found under one of the names, else of the document itself."""
    return F.coalesce(*[P.get_struct(doc, f"$.{n}", fields) for n in names], P.get_struct(doc, "$", fields))


class Measures:
    """Typed columns of the statistics object of one kind of box document."""

    def __init__(self, dtype: str, fields: dict[str, tuple[str, ...]], texts: tuple[str, ...], zero_as_missing: bool):
        self.dtype, self.fields, self.texts, self.zero_as_missing = dtype, fields, texts, zero_as_missing
        self.parser = {"bigint": P.to_long, "double": P.to_double}[dtype]
        self.names = (*texts, *(n for names in fields.values() for n in names))

    def typed(self, value: Column, path: str) -> Column:
        """The plain numbers of a statistics object, read at once as texts; NULL where a field is none.

        Only what is sure to be a number is cast: casts that fail are costly.
        """
        names = list(dict.fromkeys(n for names in self.fields.values() for n in names))

        def number(text: Column) -> Column:
            return F.when(text.rlike(PLAIN_NUMBERS[self.dtype]), text.try_cast(self.dtype))

        texts = P.get(value, path, "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">")
        return P.once(texts, lambda t: F.struct(*[number(t.getField(n)).alias(n) for n in names]))

    def columns(self, stats: Column, typed: Column) -> list[Column]:
        return [*[P.to_text(stats.getField(t)).alias(t) for t in self.texts],
                *[self._column(stats, typed, names).alias(c) for c, names in self.fields.items()]]

    def _column(self, stats: Column, typed: Column, names: tuple[str, ...]) -> Column:
        """The number under the first of one or two spellings.

        Plain numbers and absent fields are settled by the typed object; what is left (zeros,
        nulls, texts that are no number, oversized values) goes the long way.
        """
        first, last = names[0], names[-1]
        number, other = typed.getField(first), typed.getField(last)
        absent = stats.getField(first).isNull()
        counts = number != 0 if self.zero_as_missing and first != last else number.isNotNull()
        return (
            F.when(counts, number)
            .when(absent & stats.getField(last).isNull(), F.lit(None))
            .when(absent & other.isNotNull(), other)
            .otherwise(P.once(P.any_of(stats, names, self.zero_as_missing), self.parser))
        )


def traditional_measures(zero_as_missing: bool = True) -> Measures:
    return Measures("bigint", TEAM_STAT_FIELDS, ("minutes",), zero_as_missing)


def advanced_measures(zero_as_missing: bool = True) -> Measures:
    return Measures("double", TEAM_RATING_FIELDS, (), zero_as_missing)


def extract_team_entries(landed: DataFrame, roots: tuple[str, ...], measures: Measures) -> DataFrame:
    """Landed box documents to the ``entries`` array of (team_id, measures), and ``readable``.

    Home and away objects come first; the plain team list counts only when neither
    is usable (an id that can be read, and statistics that are an object). A document that
    is no JSON object is not readable and has no entries.

    The measures of all sides are one function over an array, evaluated as it stands: as
    generated code they fill methods that are too large to be compiled, which takes longer.
    """
    def entry(team: Column, path: str) -> Column:
        # By path: some names of the id differ by case only, which fields of a struct cannot.
        team_id = P.first_truthy(*[P.get(team, f"{path}.{n}") for n in BOX_TEAM_ID])
        return F.struct(
            P.once(team_id, P.to_long).alias("team_id"),
            P.get_struct(team, f"{path}.statistics", measures.names).alias("stats"),
            measures.typed(team, f"{path}.statistics").alias("typed"),
        )

    def usable(entries: Column) -> Column:
        return F.filter(entries, lambda e: e.getField("team_id").isNotNull() & e.getField("stats").isNotNull())

    found = _documents(landed, "game_id").select(
        "game_id", *LANDED_ORDER, document_root(F.col("doc"), roots, (*SIDES, "teams")).alias("root"),
    )
    teams = found.select(
        "game_id", *LANDED_ORDER, F.col("root").isNotNull().alias("readable"),
        usable(F.array(*[entry(F.col(f"root.{side}"), "$") for side in SIDES])).alias("sides"),
        P.elements(F.col("root.teams")).alias("listed"),
    )
    from_list = usable(F.transform("listed", lambda team: entry(team, "$")))
    used = F.when(F.size("sides") > 0, F.col("sides")).otherwise(F.coalesce(from_list, F.col("sides")))
    entries = F.transform(
        used, lambda e: F.struct(e.getField("team_id").alias("team_id"), *measures.columns(e.getField("stats"), e.getField("typed")))
    )
    return teams.select("game_id", *LANDED_ORDER, "readable", F.when(F.col("readable"), entries).alias("entries"))


def _entry_of(entries: str, team: str) -> Column:
    """Entry of a team; the later one when an id appears twice."""
    return F.try_element_at(F.filter(entries, lambda e: e.getField("team_id") == F.col(team)), F.lit(-1))


def assemble_teambox(todo: DataFrame, traditional: DataFrame, advanced: DataFrame) -> DataFrame:
    """One row per work-list game with its home and away ``rows`` and a reject reason.

    A side without an entry keeps null measures and is written all the same. The entries of a
    game are found by a generator: a condition on the rows, which names every measure, would
    otherwise be pushed below and find the entries anew for each of them.
    """
    trad = traditional.select("game_id", F.col("entries").alias("trad"), F.col("readable").alias("_t"))
    adv = advanced.select("game_id", F.col("entries").alias("adv"), F.col("readable").alias("_a"))
    joined = todo.join(trad, "game_id", "left").join(adv, "game_id", "left")
    found = F.struct(*[
        _entry_of(source, f"{side}_team_id").alias(f"_{side}_{source}")
        for side in ("home", "away")
        for source in ("trad", "adv")
    ])
    picked = joined.select(
        *todo.columns,
        F.inline(F.array(found)),
        _first_reason(
            ("not_landed", F.col("_t").isNull() | F.col("_a").isNull()),
            ("malformed_payload", ~F.col("_t") | ~F.col("_a")),
        ).alias("_reason"),
    )

    def side(name: str, other: str) -> Column:
        return F.struct(
            F.col(f"{name}_team_id").alias("team_id"),
            F.lit(name == "home").alias("is_home"),
            F.col(f"{other}_team_id").alias("opponent_team_id"),
            *[F.col(f"_{name}_trad.{c}").alias(c) for c in ("minutes", *TEAM_STATS)],
            *[F.col(f"_{name}_adv.{c}").alias(c) for c in TEAM_RATINGS],
        )

    stats = [F.col(f"_{name}_trad.{s}") for name in ("home", "away") for s in TEAM_STATS]
    return picked.select(
        *todo.columns,
        F.array(side("home", "away"), side("away", "home")).alias("rows"),
        F.coalesce(F.col("_reason"), F.when(P.outside_int32(*stats), F.lit("out_of_range"))).alias("reject_reason"),
    )


def teambox_rows(games: DataFrame, *keep: str) -> DataFrame:
    """Two box rows per game, home before away (``pos``)."""
    return games.select(*keep, "game_id", "season", F.posexplode("rows").alias("pos", "r")).select(
        *keep, "game_id", "season", "pos", "r.team_id", "r.is_home", "r.opponent_team_id", "r.minutes",
        *[F.col(f"r.{s}").try_cast("int").alias(s) for s in TEAM_STATS],
        *[f"r.{r}" for r in TEAM_RATINGS],
    )


# --- player dimension and box scores -------------------------------------------------


def first_table(doc: Column, names) -> Column:
    """Rows of the first table of a tabular document, NULL when there is none."""
    return P.get(doc, "$.tables[0]", f"array<{P.struct_type(names)}>")


def _has_columns(table: str, names: tuple[str, ...]) -> Column:
    """A column exists when any row carries it, be it with a JSON null."""

    def has(name: str) -> Column:
        return F.exists(table, lambda row: row.getField(name).isNotNull())

    return reduce(and_, map(has, names))


def _player(row: Column, pos: Column) -> Column:
    field = row.getField
    return F.struct(
        pos.alias("pos"),
        P.to_long(field("personId")).alias("player_id"),
        P.to_long(field("teamId")).alias("team_id"),
        *[P.to_text(field(f)).alias(c) for c, f in PLAYER_TEXT_FIELDS.items()],
        *[P.to_long(field(f)).alias(c) for c, f in PLAYER_STAT_FIELDS.items()],
    )


def extract_players(landed: DataFrame) -> DataFrame:
    """Landed player tables to a ``players`` array and a reject reason."""
    docs = _documents(landed, "game_id").select(
        "game_id", *LANDED_ORDER,
        P.is_object(F.col("doc")).alias("is_doc"),
        first_table(
            F.col("doc"), (*PLAYER_COLUMNS, *PLAYER_TEXT_FIELDS.values(), *PLAYER_STAT_FIELDS.values())
        ).alias("table"),
    )
    named = F.filter(
        F.transform("table", _player),
        lambda p: p.getField("player_id").isNotNull() & p.getField("team_id").isNotNull(),
    )
    rows = docs.select(
        "game_id", *LANDED_ORDER, "is_doc",
        F.coalesce(F.size("table"), F.lit(0)).alias("table_rows"),
        _has_columns("table", PLAYER_COLUMNS).alias("has_columns"),
        named.alias("players"),
    )
    too_big = F.exists(
        "players",
        lambda p: P.outside_int32(*[p.getField(c) for c in ("player_id", "team_id", *PLAYER_STATS)]),
    )
    reason = _first_reason(
        ("malformed_payload", ~F.coalesce(F.col("is_doc"), F.lit(False))),
        ("no_player_table", F.col("table_rows") <= 0),
        ("missing_player_columns", ~F.col("has_columns")),
        ("no_player_rows", F.size("players") == 0),
        ("out_of_range", too_big),
    )
    return rows.select("game_id", *LANDED_ORDER, "players", reason.alias("reject_reason"))


def assemble_playerbox(todo: DataFrame, players: DataFrame) -> DataFrame:
    """One row per work-list game with its players and a reject reason."""
    found = players.withColumn("_landed", F.lit(True))
    reason = F.when(F.col("_landed").isNull(), F.lit("not_landed")).otherwise(F.col("reject_reason"))
    return todo.join(found, "game_id", "left").withColumn("reject_reason", reason).drop("_landed")


def playerbox_rows(games: DataFrame, *keep: str) -> DataFrame:
    """One row per listed player, in payload order (``pos``)."""
    home, away, team = F.col("home_team_id"), F.col("away_team_id"), F.col("p.team_id")
    flat = games.select(
        *keep, "game_id", "season", "home_team_id", "away_team_id", F.explode("players").alias("p")
    )
    return flat.select(
        *keep, "game_id", "season", "p.pos",
        F.col("p.player_id").try_cast("int").alias("player_id"),
        team.try_cast("int").alias("team_id"),
        G.is_home(team, home, away).alias("is_home"),
        G.opponent(team, home, away).alias("opponent_team_id"),
        F.lit(None).cast("boolean").alias("starter_flag"),
        "p.minutes",
        *[F.col(f"p.{s}").try_cast("int").alias(s) for s in PLAYER_STATS],
        "p.first_name", "p.last_name", "p.position",
        G.full_name(F.col("p.first_name"), F.col("p.last_name")).alias("full_name"),
    )


def player_dim_seeds(rows: DataFrame) -> DataFrame:
    """First listed row of every player of a game."""
    return pick_row(rows, ["game_id", "player_id"], ["pos"], last=False)


# --- lineups -------------------------------------------------------------------------


def extract_lineups(landed: DataFrame) -> DataFrame:
    """Landed lineup tables (season, team_id, group_quantity) to ``groups`` and a reject reason."""
    keys = ("season", "team_id", "group_quantity")
    columns = {**{n: "string" for n in LINEUP_TEXT_FIELDS}, **dict(LINEUP_MEASURES)}
    parsers = {"string": P.to_text, "int": P.to_long, "double": P.to_double}
    whole = [n for n, t in LINEUP_MEASURES if t == "int"]
    docs = _documents(landed, *keys).select(
        *keys, *LANDED_ORDER,
        P.is_object(F.col("doc")).alias("is_doc"),
        first_table(F.col("doc"), [n.upper() for n in columns]).alias("table"),
    )

    def group(row: Column, pos: Column) -> Column:
        return F.struct(
            pos.alias("pos"),
            *[parsers[t](row.getField(n.upper())).alias(n) for n, t in columns.items()],
        )

    def defect(g: Column) -> Column:
        return F.when(g.getField("group_id").isNull(), "null_key").when(
            P.outside_int32(*[g.getField(n) for n in whole]), "out_of_range"
        )

    rows = docs.select(
        *keys, *LANDED_ORDER, "is_doc",
        (F.size("table") > 0).alias("has_rows"),
        _has_columns("table", LINEUP_COLUMNS).alias("has_columns"),
        F.coalesce(F.transform("table", group), F.array()).alias("groups"),
    )
    reason = F.coalesce(
        _first_reason(
            ("malformed_payload", ~F.coalesce(F.col("is_doc"), F.lit(False))),
            ("missing_lineup_columns", F.col("has_rows") & ~F.col("has_columns")),
            ("out_of_range", _too_long("season", 7)),
        ),
        F.get(F.array_compact(F.transform("groups", defect)), F.lit(0)),
    )
    return rows.select(*keys, *LANDED_ORDER, "groups", reason.alias("reject_reason"))


def lineup_rows(lineups: DataFrame, *keep: str) -> DataFrame:
    """Rows of the usable tables; those with a reject reason yield none.

    Masking the array and dropping its empty result afterwards keeps the optimizer from
    pushing a condition on the extracted columns below their extraction, which would
    evaluate it twice.
    """
    usable = F.when(F.col("reject_reason").isNull(), F.col("groups"))
    flat = lineups.select(*keep, "season", "team_id", "group_quantity", F.explode_outer(usable).alias("g"))
    return flat.filter(F.col("g").isNotNull()).select(
        *keep, "season", "team_id", "group_quantity", "g.pos", "g.group_set", "g.group_id", "g.group_name",
        *[F.col(f"g.{n}").try_cast(t).alias(n) for n, t in LINEUP_MEASURES],
    )
