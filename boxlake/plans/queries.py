"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import parsing as P
from boxlake.functions.games import full_name
from boxlake.functions.seasons import ANY_YEARS, LEAGUE_YEARS, is_season_text, season_of_date
from boxlake.operators import errors as E
from boxlake.operators import extract as X
from boxlake.operators import integrity as I
from boxlake.operators import merge as M
from boxlake.operators import quality as Q
from boxlake.operators import reports as R
from boxlake.operators import worklist as W
from boxlake.plans import marts, standings
from boxlake.schemas import DIM_PLAYERS, DIM_TEAMS, FACT_GAMES, LINEUPS, PLAYER_TOTALS, PLAYERBOX, SPINE, TABLES, TEAM_DAYS, TEAMBOX, TEAM_RATINGS, TEAM_STATS
from boxlake.sources import adapted as A
from boxlake.sources import landing, ledger
from boxlake.sources.files import Working
from boxlake.sources.warehouse import Append, Warehouse

# One time for everything that would be "now".
RUN_TS = "2024-01-31 00:00:00"
FIRST_N = 50
RETRY_N = 100


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _date_text(name: str = "game_date"):
    return F.col(name).cast("string").alias(name)


def _select_as(spec, rows: DataFrame) -> DataFrame:
    """Give adapted rows the full column list of a table."""
    have = set(rows.columns)
    return rows.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema
    ])


# --- spine ---------------------------------------------------------------------------


def _completed(spark: SparkSession, d: str) -> DataFrame:
    return landing.completed_games(landing.finder_rows(A.finder_landed(spark, d)))


def spine_extract(spark, d):
    return _completed(spark, d)


def _old_spine(spark, d):
    old = A.loaded_games(spark, d).select("game_id", F.lit("1900-01").alias("season"))
    return _select_as(SPINE, old)


def spine_insert_ignore(spark, d):
    merged = M.merge(_old_spine(spark, d), _completed(spark, d), SPINE, ["season"], _run_ts())
    return merged.select("game_id", "season", M.ACTION)


def spine_counts(spark, d):
    return M.insert_counts(_old_spine(spark, d), _completed(spark, d), SPINE, by=["season"])


def spine_from_ids(spark, d):
    ids = A.games(spark, d).select(F.array("game_id", F.concat(F.lit("x"), "game_id")).alias("game_ids"), "season")
    return landing.games_from_ids(ids)


# --- work lists ----------------------------------------------------------------------


def missing_games(spark, d):
    return W.missing_games(_completed(spark, d), A.loaded_games(spark, d))


def missing_teambox(spark, d):
    todo = W.missing_boxes(A.games(spark, d), A.teambox(spark, d).filter("game_key % 5 <> 0"))
    return todo.withColumn("game_date", F.col("game_date").cast("string"))


def missing_playerbox(spark, d):
    todo = W.missing_boxes(A.games(spark, d), A.playerbox(spark, d))
    return todo.withColumn("game_date", F.col("game_date").cast("string"))


def worklist_first_n(spark, d):
    todo = W.missing_boxes(A.games(spark, d), A.teambox(spark, d).filter("game_key % 5 <> 0"))
    # Counted by block and read again: the anti join is run once.
    todo = Working(spark).keep(todo, "todo")
    return W.first_n_per_season(todo, W.GAME_ORDER, FIRST_N).select("game_id", "season", _date_text())


def worklist_one_season(spark, d):
    todo = W.missing_games(_completed(spark, d), A.loaded_games(spark, d), seasons=["1997-98"])
    return W.first_n(todo, W.SPINE_ORDER, FIRST_N)


# --- parsers -------------------------------------------------------------------------


def _parsed(spark, d, snippets, parser):
    rows = A.snippet_values(spark, d, snippets)
    value = P.get(P.parse_document(F.col("payload")), "$.v")
    return rows.select("o_orderkey", parser(value).alias("parsed"))


def parse_int(spark, d):
    return _parsed(spark, d, A.NUMBER_SNIPPETS, P.to_long)


def parse_float(spark, d):
    return _parsed(spark, d, A.NUMBER_SNIPPETS, P.to_double)


def parse_bool(spark, d):
    return _parsed(spark, d, A.BOOL_SNIPPETS, P.to_bool)


def parse_string(spark, d):
    return _parsed(spark, d, A.TEXT_SNIPPETS, P.to_clean_text)


def nested_get(spark, d):
    doc = P.parse_document(F.col("payload"))
    return A.summary_landed(spark, d).select(
        "game_id",
        P.get_or(doc, "$.boxScoreSummary.arena.arenaName", F.lit("none")).alias("arena_name"),
        P.get_or(doc, "$.boxScoreSummary.arena.arenaState", F.lit("none")).alias("arena_state"),
    )


def truthy_coalesce(spark, d):
    doc = F.col("doc")
    rows = A.operand_values(spark, d).select("o_orderkey", P.parse_document(F.col("payload")).alias("doc"))
    a, b, c = (P.get(doc, f"$.{n}") for n in "abc")
    return rows.select(
        "o_orderkey",
        P.to_long(P.first_truthy(a, b, c)).alias("first_of_three"),
        P.to_long(P.first_truthy(a, b)).alias("first_of_two"),
        P.to_long(P.first_present(a, b)).alias("present_of_two"),
    )


# --- games stage ---------------------------------------------------------------------


def _extracted_games(spark, d):
    extracted = X.latest(X.extract_games(A.summary_landed(spark, d)))
    return A.games(spark, d).select("game_id", "season").join(extracted, "game_id", "left")


def game_structure(spark, d):
    rows = X.game_rows(_extracted_games(spark, d).filter("reject_reason is null"))
    return rows.select(
        "game_id", "season", _date_text(), F.unix_timestamp("game_datetime_utc").alias("game_epoch"),
        "home_team_id", "away_team_id", "game_status", "arena_name", "arena_city", "arena_state",
    )


def game_rejects(spark, d):
    return _extracted_games(spark, d).filter("reject_reason is not null").select("game_id", "season", "reject_reason")


def team_dim_rows(spark, d):
    return X.team_dim_rows(_extracted_games(spark, d).filter("reject_reason is null"))


def upsert_dim_teams(spark, d):
    """Landed team rows into a dimension that already holds every other team."""
    known = A.games(spark, d).filter("home_team_id % 2 = 0").select(F.col("home_team_id").alias("team_id")).distinct()
    target = _select_as(DIM_TEAMS, known.select(
        "team_id", F.lit("OLD").alias("abbreviation"), F.lit("Old City").alias("city"), F.lit("East").alias("conference"),
    ))
    merged = M.merge(target, team_dim_rows(spark, d), DIM_TEAMS, ["game_id", "pos"], _run_ts())
    return merged.select("team_id", "abbreviation", "team_name", "city", "full_name", "conference", M.ACTION)


def upsert_fact_games(spark, d):
    """Two versions of some games into a fact table that holds most of them."""
    target = _select_as(FACT_GAMES, A.loaded_games(spark, d).select(
        "game_id", "season", "game_date", "home_team_id", "away_team_id", "game_status",
        F.lit("Old Arena").alias("arena_name"), F.lit(99).alias("home_points"),
    ))
    news = A.games(spark, d).filter("game_key % 3 = 0 or game_key % 7 = 0").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "game_id", "season", "game_date", F.lit(None).cast("timestamp").alias("game_datetime_utc"),
        (F.col("home_team_id") + F.col("version")).alias("home_team_id"), "away_team_id",
        F.concat("game_status", F.col("version").cast("string")).alias("game_status"),
        F.when(F.col("version") == 1, "New Arena").alias("arena_name"),
        F.lit("City").alias("arena_city"), F.lit(None).cast("string").alias("arena_state"), "version",
    )
    merged = M.merge(target, news, FACT_GAMES, ["version"], _run_ts())
    return merged.select(
        "game_id", "season", _date_text(), "home_team_id", "away_team_id", "home_points", "game_status",
        "arena_name", "arena_city", M.ACTION,
    )


# --- box stages ----------------------------------------------------------------------


def side_unpivot(spark, d):
    entries = X.extract_team_entries(A.traditional_landed(spark, d), X.TRADITIONAL_ROOTS, X.traditional_measures())
    flat = X.latest(entries).select("game_id", F.posexplode("entries").alias("pos", "e")).select(
        "game_id", "pos", "e.team_id", "e.fgm"
    )
    return M.pick_row(flat, ["game_id", "team_id"], ["pos"]).select("game_id", "team_id", "fgm")


def _assembled_teambox(spark, d, zero_as_missing=True):
    trad = X.extract_team_entries(
        A.traditional_landed(spark, d), X.TRADITIONAL_ROOTS, X.traditional_measures(zero_as_missing)
    )
    adv = X.extract_team_entries(
        A.advanced_landed(spark, d), X.ADVANCED_ROOTS, X.advanced_measures(zero_as_missing)
    )
    todo = A.games(spark, d).select("game_id", "season", "game_date", "home_team_id", "away_team_id")
    return X.assemble_teambox(todo, X.latest(trad), X.latest(adv))


_TEAMBOX_SHOWN = (
    "minutes", "pts", "fgm", "fga", "ast", "stl", "tov", "off_rating", "net_rating", "pace", "ts_pct",
)


def teambox_rows(spark, d):
    rows = X.teambox_rows(_assembled_teambox(spark, d).filter("reject_reason is null"))
    return rows.select("game_id", "season", "pos", "team_id", "is_home", "opponent_team_id", *_TEAMBOX_SHOWN)


def teambox_rejects(spark, d):
    return _assembled_teambox(spark, d).filter("reject_reason is not null").select("game_id", "reject_reason")


def teambox_zeros_kept(spark, d):
    rows = X.teambox_rows(_assembled_teambox(spark, d, zero_as_missing=False).filter("reject_reason is null"))
    return rows.select("game_id", "pos", "team_id", "pts", "off_rating")


def upsert_teambox(spark, d):
    """Team rows written twice (the second write wins) into a partly filled table."""
    box = A.teambox(spark, d)
    target = _select_as(TEAMBOX, box.filter("game_key % 4 <> 0").withColumn("pts", F.lit(1)))
    news = box.filter("game_key % 2 = 0").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    news = news.withColumn("pts", F.col("pts") + F.col("version")).withColumn(
        "minutes", F.when(F.col("version") == 1, F.col("minutes"))
    )
    merged = M.merge(target, news, TEAMBOX, ["game_date", "game_id", "version", "side"], _run_ts())
    return merged.select(*TEAMBOX.key, "season", "is_home", "opponent_team_id", "minutes", *TEAM_STATS, *TEAM_RATINGS, M.ACTION)


def _assembled_players(spark, d):
    todo = A.games(spark, d).select("game_id", "season", "game_date", "home_team_id", "away_team_id")
    return X.assemble_playerbox(todo, X.latest(X.extract_players(A.players_landed(spark, d))))


def playerbox_rows(spark, d):
    rows = X.playerbox_rows(_assembled_players(spark, d).filter("reject_reason is null"))
    return rows.select(
        "game_id", "season", "pos", "player_id", "team_id", "is_home", "opponent_team_id", "starter_flag",
        "minutes", "pts", "reb", "ast", "plus_minus", "full_name",
    )


def playerbox_rejects(spark, d):
    return _assembled_players(spark, d).filter("reject_reason is not null").select("game_id", "reject_reason")


def player_dim_seed(spark, d):
    """First row of every player of a game, over the order lines."""
    seeds = M.pick_row(A.playerbox(spark, d), ["game_id", "player_id"], list(A.ENTRY_ORDER), last=False)
    return seeds.select("game_id", "player_id", "team_id", "minutes", "pts")


def _player_names(spark, d):
    player, team = F.col("player_id").cast("string"), F.col("team_id")
    first = F.when(F.col("s2") % 3 != 0, F.concat(F.lit("First"), player, F.lit("-"), team.cast("string")))
    last = F.when(F.col("s3") % 4 != 0, F.concat(F.lit("Last"), player))
    position = F.when(F.col("s1") % 2 == 0, F.lit("")).when(F.col("s1") % 3 == 0, F.col("minutes"))
    return A.playerbox(spark, d).select(
        "player_id", "game_date", "game_id", *A.ENTRY_ORDER,
        first.alias("first_name"), last.alias("last_name"), full_name(first, last).alias("full_name"),
        position.alias("position"),
    )


def upsert_dim_players(spark, d):
    """First row per game, then the last value per column over the games."""
    seeds = M.pick_row(_player_names(spark, d), ["game_id", "player_id"], list(A.ENTRY_ORDER), last=False)
    known = A.playerbox(spark, d).filter("player_id % 3 = 0").select("player_id").distinct()
    target = _select_as(DIM_PLAYERS, known.select(
        "player_id", F.lit("Old Name").alias("full_name"), F.lit("C").alias("position"), F.lit("6-6").alias("height"),
    ))
    merged = M.merge(target, seeds, DIM_PLAYERS, ["game_date", "game_id"], _run_ts())
    return merged.select("player_id", "full_name", "first_name", "last_name", "position", "height", M.ACTION)


def upsert_playerbox(spark, d):
    """All player entries, some players twice in a game: the last entry wins."""
    box = A.playerbox(spark, d)
    target = _select_as(PLAYERBOX, M.pick_row(
        box.filter("game_key % 3 = 0 or game_key % 5 = 0"), ["game_id", "player_id"], list(A.ENTRY_ORDER), last=False
    ).withColumn("starter_flag", F.lit(True)))
    news = box.filter("game_key % 5 <> 0").select(
        "*", F.lit(None).cast("boolean").alias("is_home"), F.lit(None).cast("int").alias("opponent_team_id"),
        F.lit(None).cast("boolean").alias("starter_flag"),
    )
    merged = M.merge(target, news, PLAYERBOX, A.ENTRY_SEQUENCE, _run_ts())
    return merged.select(*PLAYERBOX.key, "team_id", "season", "starter_flag", "minutes", "pts", "reb", "fgm", "plus_minus", M.ACTION)


def stamps(spark, d):
    """When rows were first and last written, after two runs at fixed times."""
    first, second = (F.lit(t).cast("timestamp") for t in ("2024-01-30 06:00:00", RUN_TS))
    early, late = (A.games(spark, d).filter(c) for c in ("game_key % 5 <> 0", "game_key % 3 = 0"))
    facts = spark.createDataFrame([], FACT_GAMES.schema)
    for rows, at in ((early, first), (late, second)):
        facts = M.merge(facts, _select_as(FACT_GAMES, rows), FACT_GAMES, ["game_id"], at).drop(M.ACTION)
    spine = spark.createDataFrame([], SPINE.schema)
    for rows, at in ((early, first), (late, second)):
        spine = spine.unionByName(M.insert_ignore(spine, _select_as(SPINE, rows), SPINE, ["season"], at))

    def shown(rows, name, column):
        return rows.select(F.lit(name).alias("table_name"), "game_id", F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias("stamp"))

    return shown(facts, "fact_games", "last_updated_at").unionByName(shown(spine, "spine", "first_seen_at"))


def truncate_tables(spark, d):
    """Rows of each table before and after all tables are emptied."""
    warehouse = Warehouse(spark, f"{Working(spark).root}/warehouse")
    warehouse.create_tables()
    rows = {"spine": A.games(spark, d), "fact_games": A.games(spark, d), TEAMBOX.name: A.teambox(spark, d)}
    warehouse.commit({name: Append(_select_as(TABLES[name], frame)) for name, frame in rows.items()})

    def counted(name):
        return warehouse.read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")

    def all_tables():
        return reduce(DataFrame.unionByName, map(counted, rows))

    # Folders stay on disk, so the first counts can still be read after the tables are empty.
    before = all_tables().withColumnRenamed("n", "before")
    warehouse.truncate()
    return before.join(all_tables().withColumnRenamed("n", "after"), "table_name")


# --- seasons -------------------------------------------------------------------------


def season_of_dates(spark, d):
    return A.table(spark, d, "orders").select(
        "o_orderkey", season_of_date(F.col("o_orderdate")).alias("season"),
        season_of_date(F.col("o_orderdate"), override="2024-25").alias("overridden"),
    )


def _season_texts(spark, d):
    year = (F.col("o_orderkey") % 9000).cast("int")
    four = F.lpad(year.cast("string"), 4, "0")
    yy = F.lpad(F.pmod(year + 1, F.lit(100)).cast("string"), 2, "0")
    kind = F.col("o_orderkey") % 7
    text = (
        F.when(kind == 0, F.concat(four, F.lit("-"), (year + 1).cast("string")))
        .when(kind == 1, F.concat(F.substring(four, 3, 2), F.lit("-"), yy))
        .when(kind == 2, F.concat(four, F.lit("-"), F.substring(four, 3, 2)))
        .when(kind == 3, F.lit(""))
        .when(kind == 5, F.concat(four, F.lit("-x"), F.substring(yy, 1, 1)))
        .when(kind != 6, F.concat(four, F.lit("-"), yy))
    )
    return A.table(spark, d, "orders").select("o_orderkey", text.alias("season"))


def season_format_a(spark, d):
    return _season_texts(spark, d).withColumn("valid", is_season_text(F.col("season"), ANY_YEARS))


def season_format_b(spark, d):
    return _season_texts(spark, d).withColumn("valid", is_season_text(F.col("season"), LEAGUE_YEARS))


# --- quality -------------------------------------------------------------------------


def validate_games(spark, d):
    return Q.violations(A.dirty_games(spark, d), Q.game_rules(), ["game_key"])


def validate_teambox(spark, d):
    return Q.violations(A.dirty_teambox(spark, d), Q.teambox_rules(), ["game_key", "side"])


def validate_playerbox(spark, d):
    return Q.violations(A.dirty_playerbox(spark, d), Q.playerbox_rules(), ["game_key", "player_id"])


def violation_summary(spark, d):
    found = [
        Q.violations(rows, rules, []).withColumn("entity", F.lit(entity))
        for entity, rows, rules in (
            ("game", A.dirty_games(spark, d), Q.game_rules()),
            ("teambox", A.dirty_teambox(spark, d), Q.teambox_rules()),
            ("playerbox", A.dirty_playerbox(spark, d), Q.playerbox_rules()),
        )
    ]
    return Q.violation_summary(found[0].unionByName(found[1]).unionByName(found[2]), ["entity"])


def quality_passing(spark, d):
    return Q.passing(A.teambox(spark, d), Q.teambox_rules()).select("game_id", "side", "pts")


# --- integrity -----------------------------------------------------------------------


def _parents(spark, d):
    games = A.loaded_games(spark, d)
    return {
        "fact_games": games.select("game_id"),
        "dim_teams": games.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).distinct(),
        "dim_players": A.table(spark, d, "part").filter("p_partkey % 450 <> 7").selectExpr(
            "cast(1 + p_partkey % 450 as int) as player_id"
        ).distinct(),
    }


def fk_orphans(spark, d):
    return I.orphan_games(A.playerbox(spark, d), PLAYERBOX, _parents(spark, d))


def cascade_delete(spark, d):
    return I.cascade(A.teambox(spark, d), A.loaded_games(spark, d)).select("game_id", "side", "pts")


def constraint_violations(spark, d):
    return I.constraint_violations(_select_as(PLAYERBOX, A.playerbox(spark, d)), PLAYERBOX)


def game_constraint_violations(spark, d):
    return I.constraint_violations(_select_as(FACT_GAMES, A.dirty_games(spark, d)), FACT_GAMES)


def atomic_games(spark, d):
    box = A.playerbox(spark, d)
    bad = I.orphan_games(box, PLAYERBOX, _parents(spark, d))
    return I.without_games(box, bad).groupBy("game_id").agg(F.count("*").alias("rows"))


# --- error table ---------------------------------------------------------------------


def errors_append(spark, d):
    rejects = _extracted_games(spark, d).filter("reject_reason is not null").select(
        F.lit("games").alias("process_name"), "game_id", F.col("reject_reason").alias("error_type"),
        X.reject_message(F.col("reject_reason")).alias("error_message"),
    )
    return E.error_rows(rejects, _run_ts()).select(
        "process_name", "game_id", "error_type", "error_message", "stack_trace", "retry_count", "is_resolved"
    )


def errors_resolve(spark, d):
    done = A.games(spark, d).filter("game_key % 3 = 0").select(F.lit("load_1").alias("process_name"), "game_id")
    return E.resolve(A.errors(spark, d), done, _run_ts()).select("id", "process_name", "game_id", "is_resolved", "changed")


def errors_failed_ids(spark, d):
    return E.failed_game_ids(A.errors(spark, d), "load_2", RETRY_N).select("game_id")


def errors_failed_ids_all(spark, d):
    return E.open_game_ids(A.errors(spark, d), "load_2")


def _recent(spark, d):
    return E.recent(A.errors(spark, d), _run_ts())


def errors_totals(spark, d):
    return E.totals(_recent(spark, d))


def errors_by_process(spark, d):
    return E.count_by(_recent(spark, d), "process_name")


def errors_by_type(spark, d):
    return E.count_by(_recent(spark, d), "error_type")


def errors_summary(spark, d):
    """The one-row summary; its maps are printed in name order."""
    row = E.summary(A.errors(spark, d), _run_ts())

    def printed(name):
        entries = F.transform(
            F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
        )
        return F.array_join(entries, ",").alias(name)

    return row.select("total_errors", "unresolved", printed("by_process"), printed("by_type"))


def errors_recent_open(spark, d):
    rows = E.recent_open(A.errors(spark, d))
    return rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


# --- reports and retries -------------------------------------------------------------


def stage_report(spark, d):
    ok = F.col("reject_reason").isNull()
    stages = {
        "games": _extracted_games(spark, d),
        "teambox": _assembled_teambox(spark, d),
        "playerbox": _assembled_players(spark, d),
    }
    parts = [df.select(F.lit(n).alias("stage"), "season", "reject_reason") for n, df in stages.items()]
    return R.stage_report(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["stage", "season"], ok)


def backfill_summary(spark, d):
    """Seasons that can be listed, from landed files.

    One season lacks the required columns, one has payloads that cannot be read, and in the
    files of one every third line is cut off.
    """
    payload = F.when(F.col("season") == "1996-97", F.lit('{"TEAM_ID":1}'))
    payload = payload.when((F.col("season") == "1995-96") & (F.crc32(F.col("payload").cast("binary")) % 2 == 0), F.lit("<html>busy</html>"))
    landed = A.finder_landed(spark, d).withColumn("payload", payload.otherwise(F.col("payload")))
    line = F.to_json(F.struct("league", "season_type", "payload"))
    cut = (F.col("season") == "1994-95") & (F.crc32(F.col("payload").cast("binary")) % 3 == 0)
    root = Working(spark).root
    landed.select("season", F.when(cut, F.left(line, F.length(line) - 4)).otherwise(line).alias("value")).write.partitionBy(
        "season"
    ).text(f"{root}/finder")
    return R.backfill_summary(landing.finder_status(landing.finder_rows(landing.landed(spark, root, "finder", broken=True))))


def retry_worklist(spark, d):
    todo = W.missing_boxes(A.games(spark, d), A.teambox(spark, d).filter("game_key % 5 <> 0"))
    failed = E.open_game_ids(A.errors(spark, d), "load_2")
    return W.only_failed(todo, failed).select("game_id", "season")


def retry_newest(spark, d):
    """The games without a team box among the newest failures, with their retries so far."""
    todo = W.missing_boxes(A.games(spark, d), A.teambox(spark, d).filter("game_key % 5 <> 0"))
    tried = E.attempts(A.errors(spark, d).withColumn("retry_count", (F.col("id") % 4).cast("int")))
    found = W.with_attempts(todo, E.newest_failures(E.due(tried, _run_ts()), "load_2", RETRY_N))
    return found.select("game_id", "season", "attempts")


def failure_ledger(spark, d):
    """Ledger lines written and read back, with tabs inside some messages."""
    failures = A.errors(spark, d).filter("game_id is not null").select(
        "game_id", "error_type",
        F.when(F.col("id") % 3 == 0, F.concat("error_message", F.lit("\tretry\tlater"))).otherwise(F.col("error_message")).alias("message"),
    )
    path = f"{Working(spark).root}/ledger"
    ledger.append(failures.withColumn("process", F.lit("games")), path)
    found = ledger.read(spark, path).drop("process")
    return found.withColumn("message", F.replace("message", F.lit("\t"), F.lit("|")))


def lineup_failure_ledger(spark, d):
    failures = A.errors(spark, d).filter("game_id is not null").select(
        "game_id", (F.col("id") % 30).cast("string").alias("team_id"), "error_type", F.col("error_message").alias("message")
    )
    path = f"{Working(spark).root}/ledger"
    ledger.append(failures.withColumn("process", F.lit("lineups")), path, ledger.LINEUP_FIELDS)
    return ledger.read(spark, path, ledger.LINEUP_FIELDS).drop("process")


# --- lineups -------------------------------------------------------------------------

_LINEUP_DOC = ("season", "team_id", "group_quantity")


def lineup_rejects(spark, d):
    found = X.extract_lineups(A.lineups_landed(spark, d))
    return found.filter("reject_reason is not null").groupBy("season", "reject_reason").agg(F.count("*").alias("documents"))


def lineup_upsert(spark, d):
    """Landed lineup tables, in landing order, into a table holding one group size."""
    rows = X.lineup_rows(X.extract_lineups(A.lineups_landed(spark, d)), "landed_at")
    target = _select_as(LINEUPS, A.games(spark, d).filter("game_key % 4 = 1").select(
        "season", F.col("home_team_id").alias("team_id"), F.lit(3).alias("group_quantity"),
        F.lit("-0-").alias("group_id"), F.lit(-1).alias("gp"),
    ).distinct())
    merged = M.merge(target, rows, LINEUPS, ["landed_at", "pos"], _run_ts())
    return merged.select(*LINEUPS.key, "group_name", "gp", "w", "min", "pts", "plus_minus", M.ACTION)


# --- marts ---------------------------------------------------------------------------


def team_record(spark, d):
    return marts.team_record(A.teambox(spark, d))


def win_trend(spark, d):
    box, games = A.teambox(spark, d).drop("game_date"), A.games(spark, d)
    return marts.win_trend(box, games).withColumn("game_date", F.col("game_date").cast("string"))


def player_averages(spark, d):
    return marts.player_averages(A.playerbox(spark, d))


def game_box(spark, d):
    teams = A.games(spark, d).select("home_team_id").distinct().select(
        F.col("home_team_id").alias("team_id"), F.concat(F.lit("Team "), F.col("home_team_id").cast("string")).alias("full_name")
    )
    # A player's name is that of the first part that stands for them.
    players = A.table(spark, d, "part").groupBy((1 + F.col("p_partkey") % A.PLAYERS).cast("int").alias("player_id")).agg(
        F.min_by("p_name", "p_partkey").alias("full_name")
    )
    box = A.playerbox(spark, d).drop("game_date").withColumn("is_home", F.col("team_id") == F.col("home_team_id"))
    view = marts.game_box(box, A.games(spark, d), teams, players)
    return view.withColumn("game_date", F.col("game_date").cast("string"))


def season_change(spark, d):
    return marts.season_change(A.teambox(spark, d))


def _in_loads(rows, spec, sums, loads=3):
    """Sums of rows that arrive in several loads of whole games."""
    kept = None
    for k in range(loads):
        news = sums(rows.filter(F.col("game_key") % loads == k))
        kept = news if kept is None else standings.added(kept, news, spec)
    return kept


def team_record_kept(spark, d):
    return standings.team_record(_in_loads(A.teambox(spark, d), TEAM_DAYS, standings.team_days))


def season_change_kept(spark, d):
    return standings.season_change(_in_loads(A.teambox(spark, d), TEAM_DAYS, standings.team_days))


def player_averages_kept(spark, d):
    return standings.player_averages(_in_loads(A.playerbox(spark, d), PLAYER_TOTALS, standings.player_totals))


def win_trend_kept(spark, d):
    """The report after a second load, whose games stand among and behind those of the first."""
    box, games = A.teambox(spark, d), A.games(spark, d)
    late = (F.col("game_key") % 5 == 0) & (F.col("game_date") >= F.lit("1996-03-01").cast("date"))
    kept = marts.win_trend(box.filter(~late).drop("game_date"), games)
    changed = box.filter(late).select("season", "team_id", F.col("game_date").alias("first_day"))
    rows = standings.extended_win_trend(kept, box.drop("game_date"), games, standings.team_days(box), changed)
    return rows.withColumn("game_date", F.col("game_date").cast("string"))


def empty_team_boxes(spark, d):
    games = _assembled_teambox(spark, d).filter("reject_reason is null")
    return marts.empty_team_boxes(X.teambox_rows(games))


def daily_run_idempotent(spark, d):
    """Two runs of the daily job over landed documents; the second finds nothing to add."""
    from boxlake.plans.daily import replay

    return replay(spark, d)


QUERIES = {
    f.__name__: f
    for f in (
        spine_extract, spine_insert_ignore, spine_counts, spine_from_ids,
        missing_games, missing_teambox, missing_playerbox, worklist_first_n, worklist_one_season,
        parse_int, parse_float, parse_bool, parse_string, nested_get, truthy_coalesce,
        game_structure, game_rejects, team_dim_rows, upsert_dim_teams, upsert_fact_games,
        side_unpivot, teambox_rows, teambox_rejects, teambox_zeros_kept, upsert_teambox,
        playerbox_rows, playerbox_rejects, player_dim_seed, upsert_dim_players, upsert_playerbox, stamps, truncate_tables,
        season_of_dates, season_format_a, season_format_b,
        validate_games, validate_teambox, validate_playerbox, violation_summary, quality_passing,
        fk_orphans, cascade_delete, constraint_violations, game_constraint_violations, atomic_games,
        errors_append, errors_resolve, errors_failed_ids, errors_failed_ids_all, errors_totals,
        errors_by_process, errors_by_type, errors_summary, errors_recent_open,
        stage_report, backfill_summary, retry_worklist, retry_newest, failure_ledger, lineup_failure_ledger,
        lineup_rejects, lineup_upsert,
        team_record, win_trend, player_averages, game_box, season_change, empty_team_boxes,
        team_record_kept, season_change_kept, player_averages_kept, win_trend_kept,
        daily_run_idempotent,
    )
}
