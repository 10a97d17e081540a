"""Table registry of the star schema.

One ``TableSpec`` per table holds everything the operators need to know about it:
Spark schema, key, constraints, references and the merge policy of its writer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

INSERT_IGNORE = "insert_ignore"
OVERWRITE = "overwrite"
COALESCE = "coalesce"

INT32_MIN, INT32_MAX = -(2**31), 2**31 - 1


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


def _ints(*names: str) -> dict:
    return {name: IntegerType() for name in names}


def _doubles(*names: str) -> dict:
    return {name: DoubleType() for name in names}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    cascade: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: tuple[str, ...]
    policy: str
    listed: tuple[str, ...]
    not_null: tuple[str, ...]
    lengths: tuple[tuple[str, int], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    partition_by: tuple[str, ...] = ()
    inserted_at: str | None = None
    updated_at: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stamps(self) -> list[str]:
        return [c for c in (self.inserted_at, self.updated_at) if c]


# Column names of the tables, in table order.
TEAM_STATS = (
    "pts", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
    "ast", "stl", "blk", "tov", "pf",
)
TEAM_RATINGS = ("off_rating", "def_rating", "net_rating", "pace", "ts_pct")
PLAYER_STATS = (
    "pts", "reb", "ast", "stl", "blk", "tov", "pf",
    "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "plus_minus",
)
LINEUP_TEXTS = ("group_set", "group_name")
LINEUP_KEY = ("season", "team_id", "group_quantity", "group_id")
LINEUP_MEASURES = (
    ("gp", "int"), ("w", "int"), ("l", "int"), ("w_pct", "double"), ("min", "double"),
    ("fgm", "int"), ("fga", "int"), ("fg_pct", "double"),
    ("fg3m", "int"), ("fg3a", "int"), ("fg3_pct", "double"),
    ("ftm", "int"), ("fta", "int"), ("ft_pct", "double"),
    ("oreb", "int"), ("dreb", "int"), ("reb", "int"), ("ast", "int"), ("tov", "int"),
    ("stl", "int"), ("blk", "int"), ("blka", "int"), ("pf", "int"), ("pfd", "int"),
    ("pts", "int"), ("plus_minus", "int"),
)

SPINE = TableSpec(
    name="spine",
    schema=_struct(game_id=StringType(), season=StringType(), first_seen_at=TimestampType()),
    key=("game_id",),
    policy=INSERT_IGNORE,
    listed=("season",),
    not_null=("game_id", "season"),
    lengths=(("game_id", 10), ("season", 7)),
    partition_by=("season",),
    inserted_at="first_seen_at",
)

FACT_GAMES = TableSpec(
    name="fact_games",
    schema=_struct(
        game_id=StringType(), season=StringType(), game_date=DateType(),
        game_datetime_utc=TimestampType(),
        **_ints("home_team_id", "away_team_id", "home_points", "away_points"),
        game_status=StringType(), arena_name=StringType(), arena_city=StringType(),
        arena_state=StringType(), last_updated_at=TimestampType(),
    ),
    key=("game_id",),
    policy=OVERWRITE,
    listed=(
        "season", "game_date", "game_datetime_utc", "home_team_id", "away_team_id",
        "game_status", "arena_name", "arena_city", "arena_state",
    ),
    not_null=("game_id", "season", "game_date", "home_team_id", "away_team_id"),
    lengths=(("game_id", 10), ("season", 7)),
    partition_by=("season",),
    updated_at="last_updated_at",
)

DIM_TEAMS = TableSpec(
    name="dim_teams",
    schema=_struct(
        team_id=IntegerType(), abbreviation=StringType(), team_name=StringType(),
        city=StringType(), full_name=StringType(), conference=StringType(),
        division=StringType(), is_active=BooleanType(), last_updated_at=TimestampType(),
    ),
    key=("team_id",),
    policy=COALESCE,
    listed=("abbreviation", "team_name", "city", "full_name"),
    not_null=("team_id",),
    updated_at="last_updated_at",
)

DIM_PLAYERS = TableSpec(
    name="dim_players",
    schema=_struct(
        player_id=IntegerType(), full_name=StringType(), first_name=StringType(),
        last_name=StringType(), position=StringType(), height=StringType(),
        weight=StringType(), birthdate=DateType(), country=StringType(),
        is_active=BooleanType(), last_updated_at=TimestampType(),
    ),
    key=("player_id",),
    policy=COALESCE,
    listed=("full_name", "first_name", "last_name", "position"),
    not_null=("player_id",),
    updated_at="last_updated_at",
)

TEAMBOX = TableSpec(
    name="teambox_pergame",
    schema=_struct(
        game_id=StringType(), team_id=IntegerType(), season=StringType(),
        is_home=BooleanType(), opponent_team_id=IntegerType(), minutes=StringType(),
        **_ints(*TEAM_STATS), **_doubles(*TEAM_RATINGS), last_updated_at=TimestampType(),
    ),
    key=("game_id", "team_id"),
    policy=OVERWRITE,
    listed=("season", "is_home", "opponent_team_id", "minutes", *TEAM_STATS, *TEAM_RATINGS),
    not_null=("game_id", "team_id", "season"),
    lengths=(("game_id", 10), ("season", 7)),
    foreign_keys=(
        ForeignKey("game_id", "fact_games", cascade=True),
        ForeignKey("team_id", "dim_teams"),
    ),
    partition_by=("season",),
    updated_at="last_updated_at",
)

PLAYERBOX = TableSpec(
    name="playerbox_pergame",
    schema=_struct(
        game_id=StringType(), player_id=IntegerType(), team_id=IntegerType(),
        season=StringType(), is_home=BooleanType(), opponent_team_id=IntegerType(),
        starter_flag=BooleanType(), minutes=StringType(), **_ints(*PLAYER_STATS),
        last_updated_at=TimestampType(),
    ),
    key=("game_id", "player_id"),
    policy=OVERWRITE,
    listed=(
        "team_id", "season", "is_home", "opponent_team_id", "starter_flag", "minutes",
        *PLAYER_STATS,
    ),
    not_null=("game_id", "player_id", "team_id", "season"),
    lengths=(("game_id", 10), ("season", 7)),
    foreign_keys=(
        ForeignKey("game_id", "fact_games", cascade=True),
        ForeignKey("player_id", "dim_players"),
        ForeignKey("team_id", "dim_teams"),
    ),
    partition_by=("season",),
    updated_at="last_updated_at",
)

LINEUPS = TableSpec(
    name="lineupbox_season",
    schema=_struct(
        season=StringType(), team_id=IntegerType(), group_quantity=IntegerType(),
        group_set=StringType(), group_id=StringType(), group_name=StringType(),
        **{n: IntegerType() if t == "int" else DoubleType() for n, t in LINEUP_MEASURES},
        last_updated_at=TimestampType(),
    ),
    key=LINEUP_KEY,
    policy=OVERWRITE,
    listed=(*LINEUP_TEXTS, *(n for n, _ in LINEUP_MEASURES)),
    not_null=LINEUP_KEY,
    lengths=(("season", 7),),
    foreign_keys=(ForeignKey("team_id", "dim_teams"),),
    partition_by=("season",),
    updated_at="last_updated_at",
)

ETL_ERRORS = TableSpec(
    name="etl_errors",
    schema=_struct(
        id=LongType(), process_name=StringType(), game_id=StringType(),
        error_type=StringType(), error_message=StringType(), stack_trace=StringType(),
        retry_count=IntegerType(), is_resolved=BooleanType(), created_at=TimestampType(),
        last_retry_at=TimestampType(), resolved_at=TimestampType(),
    ),
    key=("id",),
    policy=OVERWRITE,
    listed=("is_resolved", "resolved_at"),
    not_null=("process_name", "error_type", "error_message", "created_at"),
    lengths=(("game_id", 10),),
    # Open errors are a part of their own: closed ones are not read or written again.
    partition_by=("is_resolved",),
)

# Sums behind the reports, kept beside the facts and merged with the rows of each load.
TEAM_DAYS = TableSpec(
    name="team_days",
    schema=_struct(
        season=StringType(), team_id=IntegerType(), game_date=DateType(),
        **{n: LongType() for n in ("games", "wins", "losses", "pts_sum", "off_rating_n", "def_rating_n", "net_rating_n")},
        **{n: DoubleType() for n in ("off_rating_sum", "def_rating_sum", "net_rating_sum")},
    ),
    key=("season", "team_id", "game_date"),
    policy=OVERWRITE,
    listed=("games", "wins", "losses", "pts_sum", "off_rating_n", "def_rating_n", "net_rating_n", "off_rating_sum", "def_rating_sum", "net_rating_sum"),
    not_null=("season", "team_id"),
    partition_by=("season",),
)

PLAYER_MEANS = ("pts", "reb", "ast", "stl", "blk", "tov")
PLAYER_SHARES = ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta")
_PLAYER_SUMS = ("games", *(f"{s}_sum" for s in (*PLAYER_MEANS, *PLAYER_SHARES)), *(f"{s}_n" for s in PLAYER_MEANS))

PLAYER_TOTALS = TableSpec(
    name="player_totals",
    schema=_struct(season=StringType(), player_id=IntegerType(), **{n: LongType() for n in _PLAYER_SUMS}),
    key=("season", "player_id"),
    policy=OVERWRITE,
    listed=_PLAYER_SUMS,
    not_null=("season", "player_id"),
    partition_by=("season",),
)

TABLES = {
    spec.name: spec
    for spec in (
        SPINE, FACT_GAMES, DIM_TEAMS, DIM_PLAYERS, TEAMBOX, PLAYERBOX, LINEUPS, ETL_ERRORS,
        TEAM_DAYS, PLAYER_TOTALS,
    )
}
