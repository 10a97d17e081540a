"""Box-score shaped frames derived from the driver's order tables.

An order stands for a game, its lines for player entries, the error events for the
error table. Expressions that are valid in Spark SQL and in DuckDB alike are kept as
text, so that a query and its twin start from the same rows.

Conditions such as ``game_key % 7 <> 0`` describe what a table already holds; they make
the difference between a target and its batch; together these hold every source row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_TEAM = 1610612737
TEAMS = 30
PLAYERS = 450


def season_sql(day: str) -> str:
    return (
        f"case when month({day}) < 10"
        f" then concat(cast(year({day}) - 1 as string), '-', lpad(cast(year({day}) % 100 as string), 2, '0'))"
        f" else concat(cast(year({day}) as string), '-', lpad(cast((year({day}) + 1) % 100 as string), 2, '0')) end"
    )


GAME_ID = "lpad(cast(o_orderkey as string), 10, '0')"

# One game per order.
GAMES = {
    "game_key": "o_orderkey",
    "game_id": GAME_ID,
    "season": season_sql("o_orderdate"),
    "game_date": "cast(o_orderdate as date)",
    "home_team_id": f"cast({FIRST_TEAM} + o_custkey % {TEAMS} as int)",
    # Never the home team: one of the other teams, counted on from it.
    "away_team_id": f"cast({FIRST_TEAM} + (o_custkey % {TEAMS} + 1 + (o_custkey * 7 + o_orderkey) % {TEAMS - 1}) % {TEAMS} as int)",
    "game_status": "o_orderstatus",
    "cust": "o_custkey",
}

# Games with defects of every kind.
DIRTY_GAMES = {
    "game_key": "o_orderkey",
    "game_id": f"case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0"
    f" then cast(o_orderkey as string) else {GAME_ID} end",
    "season": f"case when o_orderkey % 107 = 0 then concat(cast(year(o_orderdate) as string), '-',"
    f" cast(year(o_orderdate) + 1 as string)) when o_orderkey % 109 = 0 then null"
    f" else {season_sql('o_orderdate')} end",
    "game_date": "case when o_orderkey % 113 = 0 then null else cast(o_orderdate as date) end",
    "home_team_id": f"case when o_orderkey % 127 = 0 then 0"
    f" else cast({FIRST_TEAM} + o_custkey % {TEAMS} as int) end",
    "away_team_id": f"case when o_orderkey % 131 = 0 then null"
    f" else cast({FIRST_TEAM} + (o_custkey * 7 + o_orderkey) % {TEAMS} as int) end",
}

# Statistics of one side of a game, summed over its order lines.
SIDE_STATS = {
    "pts": "cast(min(case when l_partkey % 97 = 0 then -1 else cast(l_quantity as bigint) end) as int)",
    "fgm": "cast(sum((cast(l_quantity as bigint) * l_linenumber) % 29) as int)",
    "fga": "cast(sum(cast(l_quantity as bigint)) as int)",
    "fg3m": "cast(sum(cast(round(100 * l_discount) as bigint)) as int)",
    "fg3a": "cast(sum(cast(round(100 * l_tax) as bigint) + l_linenumber % 4) as int)",
    "ftm": "cast(sum(l_linenumber) as int)",
    "fta": "cast(sum(l_linenumber + l_partkey % 4 - 1) as int)",
    "oreb": "cast(sum(l_partkey % 11) as int)",
    "dreb": "cast(sum(l_partkey % 13) as int)",
    "reb": "cast(sum(l_partkey % 11 + l_partkey % 13 + case when l_partkey % 17 = 0 then 9 else 0 end) as int)",
    "ast": "cast(sum(l_suppkey % 5) as int)",
    "stl": "cast(sum(l_suppkey % 3) as int)",
    "blk": "cast(sum(l_linenumber % 2) as int)",
    "tov": "cast(count(*) as int)",
    "pf": "cast(max(l_linenumber) as int)",
}

# One player entry per order line (joined to its game).
PLAYER_ENTRIES = {
    "player_id": f"cast(1 + l_partkey % {PLAYERS} as int)",
    "team_id": "case when l_suppkey % 25 = 0 then 1 when l_suppkey % 2 = 0 then home_team_id else away_team_id end",
    "minutes": "concat(cast(cast(l_quantity as int) as string), ':', lpad(cast(l_linenumber as string), 2, '0'))",
    "pts": "cast(case when l_partkey % 97 = 0 then -1 else cast(l_quantity as bigint) end as int)",
    "reb": "cast(case when l_partkey % 89 = 0 then -2 else l_partkey % 13 end as int)",
    "ast": "cast(l_partkey % 11 as int)",
    "stl": "cast(l_linenumber % 3 as int)",
    "blk": "cast(l_suppkey % 4 as int)",
    "tov": "cast(l_linenumber as int)",
    "pf": "cast(l_partkey % 6 as int)",
    "fgm": "cast((cast(l_quantity as bigint) * l_linenumber) % 29 as int)",
    "fga": "cast(l_quantity as int)",
    "fg3m": "cast(round(100 * l_discount) as int)",
    "fg3a": "cast(round(100 * l_tax) as int) + l_linenumber % 4",
    "ftm": "cast(l_linenumber as int)",
    "fta": "cast(l_linenumber + l_partkey % 4 - 1 as int)",
    "plus_minus": "cast(l_partkey % 21 - 10 as int)",
}

# Total order of the player entries of a game.
ENTRY_ORDER = {
    "s1": "l_linenumber",
    "s2": "l_partkey",
    "s3": "l_suppkey",
    "s4": "cast(l_quantity as bigint)",
    "s5": "cast(round(100 * l_extendedprice) as bigint)",
    "s6": "cast(round(100 * l_discount) as bigint)",
    "s7": "cast(round(100 * l_tax) as bigint)",
    "s8": "l_returnflag",
    "s9": "l_linestatus",
    "s10": "l_shipdate",
}
ENTRY_SEQUENCE = ["game_date", "game_id", *ENTRY_ORDER]


# What the quality rules of box rows look for and clean rows never have.
DIRTY_TEAMBOX = {
    "game_id": "case when game_key % 101 = 0 then null when game_key % 103 = 0 then '' else game_id end",
    "team_id": "cast(case when game_key % 107 = 0 then 0 when game_key % 109 = 0 then null else team_id end as int)",
}
DIRTY_PLAYERBOX = {
    **DIRTY_TEAMBOX,
    "player_id": "cast(case when s2 % 113 = 0 then 0 when s2 % 127 = 0 then null else player_id end as int)",
    "ast": "cast(case when s2 % 83 = 0 then -3 else ast end as int)",
    "stl": "cast(case when s2 % 79 = 0 then -1 else stl end as int)",
    "blk": "cast(case when s3 % 73 = 0 then -4 else blk end as int)",
    "pf": "cast(case when s2 % 71 = 0 then -1 else pf end as int)",
}


def columns_sql(expressions: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in expressions.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*columns_sql(GAMES))


def document_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games that documents are derived from, dealt out: a document costs more than its row.

    The number is given, since adaptive execution would join these small partitions again.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return orders.repartition(parts, "o_orderkey").selectExpr(*columns_sql(GAMES))


def loaded_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the games that stands for an already filled fact table."""
    return games(spark, sf_dir).filter("game_key % 7 <> 0")


def dirty_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*columns_sql(DIRTY_GAMES))


def finder_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed finder rows: one per team and game, some of another competition."""
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team"), F.lit("W").alias("f"), F.lit("L").alias("o")),
        F.struct(F.col("away_team_id").alias("team"), F.lit("L").alias("f"), F.lit("W").alias("o")),
    )
    wl = F.when(F.col("game_status") == "F", F.col("s.f")).when(F.col("game_status") == "O", F.col("s.o"))
    return document_games(spark, sf_dir).withColumn("s", F.explode(sides)).select(
        F.when(F.col("game_key") % 17 == 0, "10").otherwise("00").alias("league"),
        F.when(F.col("game_key") % 19 == 0, "Playoffs").otherwise("Regular Season").alias("season_type"),
        F.to_json(F.struct(
            F.col("game_id").alias("GAME_ID"), F.col("s.team").alias("TEAM_ID"), wl.alias("WL"),
        )).alias("payload"),
        "season",
    )


def side_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per game and side (0 = home), without game columns."""
    lines = table(spark, sf_dir, "lineitem")
    totals = [F.expr(e).alias(n) for n, e in SIDE_STATS.items()]
    return lines.groupBy(F.col("l_orderkey").alias("game_key"), F.expr("l_suppkey % 2").alias("side")).agg(*totals)


def teambox(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = F.col("side") == 0
    return side_totals(spark, sf_dir).join(games(spark, sf_dir), "game_key").select(
        "game_key", "side", "game_id", "season", "game_date",
        F.when(home, F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"),
        home.alias("is_home"),
        F.when(home, F.col("away_team_id")).otherwise(F.col("home_team_id")).alias("opponent_team_id"),
        F.lit("240").alias("minutes"),
        *SIDE_STATS,
        (F.col("pts") + 100).cast("double").alias("off_rating"),
        (F.col("fga") + 90).cast("double").alias("def_rating"),
        (F.col("pts") - F.col("fga") + 10).cast("double").alias("net_rating"),
        (F.col("tov") * 10).cast("double").alias("pace"),
        F.lit(0.5).alias("ts_pct"),
    )


def playerbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "game_key")
    return lines.join(games(spark, sf_dir), "game_key").selectExpr(
        "game_key", "game_id", "season", "game_date", "home_team_id", "away_team_id",
        *columns_sql(PLAYER_ENTRIES), *columns_sql(ENTRY_ORDER),
    )


def _with_defects(rows: DataFrame, defects: dict[str, str]) -> DataFrame:
    return rows.withColumns({name: F.expr(e) for name, e in defects.items()})


def dirty_teambox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_defects(teambox(spark, sf_dir), DIRTY_TEAMBOX)


def dirty_playerbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_defects(playerbox(spark, sf_dir), DIRTY_PLAYERBOX)


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error table from the error events."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, sf_dir, "events").filter("event_type = 'error'").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("load_"), (F.col("user_id") % 4).cast("string")).alias("process_name"),
        F.when(F.col("user_id") % 10 != 0, F.lpad((F.col("event_id") - F.col("event_id") % 3).cast("string"), 10, "0")).alias("game_id"),
        F.element_at(F.array(F.lit("ReadTimeout"), F.lit("ConnectionError"), F.lit("ValueError")), k % 3 + 1).alias("error_type"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("error_message"),
        F.lit(None).cast("string").alias("stack_trace"),
        F.lit(0).alias("retry_count"),
        (k % 5 == 0).alias("is_resolved"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_retry_at"),
        F.when(k % 5 == 0, F.col("ts").cast("timestamp")).alias("resolved_at"),
    )


# Numbers that fit no column, of every size and spelling.
OVERSIZED = ("2147483648", "9223372036854775808", "1e30", '"99999999999999999999"')


def _oversized():
    """One of them for a few of the games whose documents are sound otherwise."""
    value = F.get(F.array(*map(F.lit, OVERSIZED)), (F.col("cust") % len(OVERSIZED)).cast("int"))
    return F.when((F.col("game_key") % 8 == 0) & (F.col("game_key") % 23 == 0), value)


# --- landed documents ----------------------------------------------------------------


def _object(*fields: tuple[str, object]):
    """JSON object text from (name, JSON text column or literal); NULL columns are left out."""
    parts = [
        F.concat(F.lit(f'"{name}":'), value if not isinstance(value, str) else F.lit(value))
        for name, value in fields
    ]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))


def _quoted(column):
    return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))


def _plain(column):
    return column.cast("string")


def summary_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game summaries; ``game_key % 8`` picks the kind of drift or defect."""
    key, cust = F.col("game_key"), F.col("cust")
    v, w = key % 8, key % 5
    day = F.col("game_date").cast("string")
    clock = F.concat(
        F.lit("T"), F.lpad((cust % 24).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((key % 60).cast("string"), 2, "0"), F.lit(":00Z"),
    )
    iso = _quoted(F.concat(day, clock))

    def team(team_id):
        number = (team_id - FIRST_TEAM).cast("string")
        return _object(
            ("teamId", F.when(w == 1, F.lit("0")).when(w != 2, _plain(team_id))),
            ("id", F.when(w == 2, _quoted(team_id + 100))),
            ("teamTricode", F.when(w == 3, F.lit('""')).otherwise(_quoted(F.concat(F.lit("T"), number)))),
            ("abbreviation", F.when(w == 3, _quoted(F.concat(F.lit("A"), number)))),
            ("teamCity", F.when(w != 4, _quoted(F.concat(F.lit("City"), number)))),
            ("teamName", F.when(w < 3, _quoted(F.concat(F.lit("Name"), number)))),
            ("nickname", F.when(w >= 3, _quoted(F.concat(F.lit("Nick"), number)))),
        )

    root = _object(
        ("homeTeamId", F.when(_oversized().isNotNull(), _oversized()).when(v == 2, _quoted(F.col("home_team_id"))).otherwise(_plain(F.col("home_team_id")))),
        ("awayTeamId", F.when(v != 3, _plain(F.col("away_team_id")))),
        ("gameTimeUTC", F.when(v == 5, F.lit('"soon"')).when((v != 2) & (v != 4), iso)),
        ("gameEt", F.when(v == 2, iso)),
        ("gameStatusText", _quoted(F.col("game_status"))),
        ("arena", F.when(v == 6, F.lit('"closed"')).otherwise(_object(
            ("arenaName", _quoted(F.concat(F.lit("Arena "), (cust % 50).cast("string")))),
            ("arenaCity", F.when(cust % 3 != 0, _quoted(F.concat(F.lit("City"), (cust % 50).cast("string"))))),
            ("arenaState", F.lit("null")),
        ))),
        ("homeTeam", F.when(v == 6, F.lit("[]")).otherwise(team(F.col("home_team_id")))),
        ("awayTeam", team(F.col("away_team_id"))),
    )
    document = F.when(v == 1, F.lit('{"other":1}')).when(v == 7, F.lit("<html>busy</html>")).otherwise(
        _object(("boxScoreSummary", root))
    )
    return document_games(spark, sf_dir).select("game_id", _landed_at(), document.alias("payload"), "season")


def _landed_at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp").alias("landed_at")


def _team_box_document(names: tuple[str, str, str], stats):
    """Document around two team objects; ``game_key % 8`` picks its shape."""
    v = F.col("game_key") % 8
    home, away = (
        _object(("teamId", _plain(F.col(c))), ("statistics", stats(side)))
        for side, c in enumerate(("home_team_id", "away_team_id"))
    )
    both = _object(("homeTeam", home), ("awayTeam", away))
    alias = _object(
        ("homeTeam", _object(("teamId", F.lit("0")), ("teamID", _quoted(F.col("home_team_id"))), ("statistics", stats(0)))),
        ("awayTeam", _object(("teamId", F.lit('"x"')), ("statistics", stats(1)))),
    )
    listed = F.concat(
        F.lit('{"homeTeam":5,"teams":['), away, F.lit(',7,{"id":3},'), home, F.lit(","),
        _object(("teamId", _plain(F.col("home_team_id"))), ("statistics", stats(2))), F.lit("]}"),
    )
    return (
        F.when(v == 0, _object((names[0], both)))
        .when(v == 1, _object((names[1], both)))
        .when(v == 2, _object((names[0], "3"), (names[2], both)))
        .when(v == 3, both)
        .when(v == 4, _object((names[0], listed)))
        .when(v == 5, _object((names[0], _object(("homeTeam", home), ("awayTeam", "[]")))))
        .when(v == 6, _object((names[0], alias)))
        .otherwise(F.lit("[1,2]"))
    )


def traditional_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traditional box documents; one game in eleven is not landed."""
    key, cust = F.col("game_key"), F.col("cust")

    def stats(side: int):
        points = (cust + side) % 7
        made = (key + side) % 5
        return _object(
            ("minutes", F.when(key % 3 == 0, F.lit("240")).when(key % 3 == 1, F.lit('"240:00"'))),
            ("points", F.coalesce(_oversized(), _plain(points))),
            ("pts", F.when(key % 2 == 0, _quoted(points + 50))),
            ("fieldGoalsMade", _quoted(made)),
            ("fga", _plain(made + 10)),
            ("assists", F.concat(_plain(made), F.lit(".9"))),
            ("steals", F.when(key % 6 == 0, F.lit("[]")).when(key % 6 == 1, F.lit("false")).otherwise(F.lit('""'))),
            ("stl", F.when(key % 4 == 0, F.lit('"many"')).otherwise(_plain(made + 1))),
            ("turnovers", F.lit("null")),
        )

    document = _team_box_document(
        ("boxScoreTraditional", "boxScoreTraditionalV3", "boxScoreTraditionalv3"), stats
    )
    rows = document_games(spark, sf_dir).filter("game_key % 11 <> 0")
    return rows.select("game_id", _landed_at(), document.alias("payload"), "season")


def advanced_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("game_key"), F.col("cust")

    def stats(side: int):
        value = (cust + side) % 4
        return _object(
            ("offensiveRating", F.concat(_plain(value), F.lit(".0"))),
            ("offRating", F.when(key % 2 == 0, F.concat(_plain(value + 100), F.lit(".5")))),
            ("netRating", _plain(value)),
            ("pace", F.when(key % 3 == 0, _quoted(value)).otherwise(F.concat(F.lit("9"), _plain(value), F.lit(".25")))),
            ("tsPct", F.lit("0.625")),
        )

    document = _team_box_document(("boxScoreAdvanced", "boxScoreAdvancedV3", "boxScoreAdvancedv3"), stats)
    return document_games(spark, sf_dir).select("game_id", _landed_at(), document.alias("payload"), "season")


def players_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player tables of 3 to 6 entries; ``game_key % 8`` picks the defect."""
    key, cust = F.col("game_key"), F.col("cust")
    v = key % 8

    def entry(i):
        player = (cust * 3 + i * i) % PLAYERS + 1
        team = F.when(i % 5 == 4, F.lit(1)).when(i % 2 == 0, F.col("home_team_id")).otherwise(F.col("away_team_id"))
        return _object(
            ("personId", F.when((v == 4) & (i == 1), F.lit("null")).when(v == 6, F.lit('"?"')).otherwise(_plain(player))),
            ("teamId", F.when(v != 5, _plain(team))),
            ("firstName", F.when((player + i) % 3 != 0, _quoted(F.concat(F.lit("First"), _plain(player))))),
            ("familyName", F.when(player % 4 != 0, _quoted(F.concat(F.lit("Last"), _plain(player + i))))),
            ("position", F.when(i % 2 == 0, F.lit('"G"')).otherwise(F.lit('""'))),
            ("minutes", _quoted(F.concat(_plain(i + 10), F.lit(":30")))),
            ("points", F.coalesce(F.when(i == 0, _oversized()), _plain((cust + i) % 3))),
            ("reboundsTotal", _quoted(i)),
            ("assists", F.lit("null")),
            ("plusMinusPoints", F.concat(_plain(i - 3), F.lit(".0"))),
        )

    table_rows = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), 2 + key % 4), entry), ",")
    document = (
        F.when(v == 1, F.lit('{"tables":[]}'))
        .when(v == 2, F.lit('{"tables":[[],[{"personId":1}]]}'))
        .when(v == 7, F.lit("{broken"))
        .otherwise(F.concat(F.lit('{"tables":[['), table_rows, F.lit('],[{"other":1}]]}')))
    )
    rows = document_games(spark, sf_dir).filter("game_key % 13 <> 0")
    return rows.select("game_id", _landed_at(), document.alias("payload"), "season")


def lineups_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineup tables: one document per game key, keyed by season, team and group size."""
    key, cust = F.col("game_key"), F.col("cust")

    def group(i):
        return _object(
            ("GROUP_SET", F.lit('"Lineups"')),
            ("GROUP_ID", F.when(key % 9 != 0, _quoted(F.concat(F.lit("-"), _plain((cust + i) % 40), F.lit("-"))))),
            ("GROUP_NAME", _quoted(F.concat(F.lit("Group "), _plain((cust + i) % 40)))),
            ("GP", F.coalesce(_oversized(), _plain(1 + (cust + i) % 82))),
            ("W", _plain((cust + i) % 41)),
            ("MIN", F.concat(_plain(key % 48), F.lit(".5"))),
            ("PTS", _plain(key % 120)),
            ("PLUS_MINUS", _plain(i - 1)),
        )

    rows = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), group), ",")
    document = F.concat(F.lit('{"tables":[['), rows, F.lit("]]}"))
    return document_games(spark, sf_dir).select(
        F.col("home_team_id").alias("team_id"),
        (2 + key % 4).cast("int").alias("group_quantity"),
        F.timestamp_seconds(key).alias("landed_at"),
        document.alias("payload"),
        "season",
    )


# --- texts for the parsers -----------------------------------------------------------

# JSON snippets by position; ``%`` is replaced by the customer number.
NUMBER_SNIPPETS = (
    "%", '"%"', "%.7", '"%.7"', '"none"', '""', "null", "[%]", '{"n":%}', "true",
    '"  %  "', "-%.7", "1e3", '"-%"',
)
BOOL_SNIPPETS = (
    "true", "false", '"true"', '"TRUE"', '"t"', '"yes"', '"y"', '"1"', '"false"', '"FALSE"', '"f"',
    '"no"', '"n"', '"0"', "1", "42", "-1", "1.0", "0", "0.0", '"perhaps"', "null", '""', "[true]",
    '"  true  "', '"  false  "',
)
TEXT_SNIPPETS = ('"ball"', '"Two Words %"', "%", "%.5", "null", '""', '"   "', '"  ball  "', "true", "false")
OPERAND_SNIPPETS = ("%", "0", "0.0", '"0"', '""', "false", "[]", "{}", "null", '"word"')


def snippet_values(spark: SparkSession, sf_dir: str, snippets: tuple[str, ...]) -> DataFrame:
    """(o_orderkey, pos, payload ``{"v": …}``), the snippet picked by order key."""
    pos = (F.col("o_orderkey") % len(snippets)).cast("int")
    text = F.replace(F.get(F.array(*map(F.lit, snippets)), pos), F.lit("%"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", pos.alias("pos"), F.concat(F.lit('{"v":'), text, F.lit("}")).alias("payload")
    )


def operand_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with three operands of every falsy and truthy kind; ``c`` may be absent."""
    n = len(OPERAND_SNIPPETS)
    choices = F.array(*map(F.lit, OPERAND_SNIPPETS))

    def snippet(index):
        return F.replace(F.get(choices, index.cast("int")), F.lit("%"), F.col("o_custkey").cast("string"))

    key = F.col("o_orderkey")
    document = _object(
        ("a", snippet(key % n)),
        ("b", snippet(F.floor(key / n) % n)),
        ("c", F.when(key % 3 != 0, snippet(F.floor(key / (n * n)) % n))),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", document.alias("payload"))
