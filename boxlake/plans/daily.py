"""Incremental load of landed documents into the warehouse.

Four stages: spine, games with the team dimension, team boxes, players with the player
dimension. Each stage finds what is missing, extracts it from the landing area, sets
unusable games aside and publishes dimensions, facts and errors in one commit. Every
game is new to its fact table by construction, so facts are appended and the existing
facts are read for their keys only. All seasons of a run go through one job per stage.

What a run reports is counted by the jobs that write: games by season and outcome, and the
rows that were inserted. A backfill that meets a file it cannot read goes on with halves of
its seasons until those of that file are alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.seasons import LEAGUE_YEARS, is_season_text, season_of_date
from boxlake.operators import errors as E
from boxlake.operators import extract as X
from boxlake.operators import integrity as I
from boxlake.operators import merge as M
from boxlake.operators import worklist as W
from boxlake.operators import reports as R
from boxlake.schemas import DIM_PLAYERS, DIM_TEAMS, FACT_GAMES, LINEUPS, PLAYER_TOTALS, PLAYERBOX, SPINE, TEAM_DAYS, TEAMBOX
from boxlake.plans import standings as S
from boxlake.sources import adapted as A
from boxlake.sources import landing, ledger
from boxlake.sources.files import Working
from boxlake.sources.warehouse import Append, Replace, Warehouse

REPORT_SCHEMA = "stage string, season string, success long, failed long, attempted long, inserted long"
UNREADABLE = "unreadable_file"

@dataclass
class Load:
    """One run over the given seasons, which are taken in the given order."""

    spark: SparkSession
    warehouse: Warehouse
    landing_root: str
    seasons: list[str]
    run_ts: Column | datetime | None = None
    limit: int | None = None
    fmt: str = "json"
    zero_as_missing: bool = True
    retry: bool = False
    # A retry leaves out games whose wait after the last failure is not over.
    only_due: bool = False
    # Only documents landed at or after this time; parquet landings skip older data.
    landed_since: datetime | None = None
    keep_going: bool = False
    # Only these games (game_id, season), and only these files of each kind.
    only: DataFrame | None = None
    files: dict[str, list[str]] | None = None

    def __post_init__(self):
        # Beside the tables: a place that every executor reaches.
        self.working = Working(self.spark, f"{self.warehouse.root}/_working")
        self.counts: list[tuple] = []
        self.refused: list[str] = []
        self.listed: list[str] = []
        self.broken: set[str] = set()
        # One fixed time for everything the run writes.
        if self.run_ts is None:
            self.run_ts = datetime.now(timezone.utc)
        if not isinstance(self.run_ts, Column):
            self.run_ts = F.lit(self.run_ts)

    # --- shared steps ----------------------------------------------------------------

    def _landed(self, kind: str, todo: DataFrame | None = None) -> DataFrame:
        rows = landing.landed(
            self.spark, self.landing_root, kind, self.seasons, self.fmt, self.landed_since,
            files=None if self.files is None else self.files.get(kind, []), broken=kind == "finder",
        )
        if todo is None:
            return rows
        # Spark sends a short list to every executor and deals both sides out for a long one.
        return rows.join(todo.select("game_id"), "game_id", "left_semi")

    def _with_season_order(self, df: DataFrame) -> DataFrame:
        order = F.array_position(F.array(*map(F.lit, self.seasons)), F.col("season"))
        return df.withColumn("season_order", order)

    def _todo(self, todo: DataFrame, order: tuple[str, ...], process: str) -> DataFrame | None:
        """The work list as a written table, or None when everything is up to date.

        A retry takes the games that failed last, so its limit holds for all seasons together.
        """
        if self.only is not None:
            todo = todo.join(self.only.select("game_id").distinct(), "game_id", "left_semi")
        if self.retry:
            tried = E.attempts(self.warehouse.read("etl_errors", list(E.OPEN_PART)))
            tried = E.due(tried, self.run_ts) if self.only_due else tried
            first = W.with_attempts(todo, E.newest_failures(tried, process, self.limit))
        else:
            # With a limit the list is counted and read again: it is made once.
            todo = todo if self.limit is None else self.working.keep(todo, f"{process}_missing")
            first = W.first_n_per_season(todo, order, self.limit)
        kept = self.working.keep(self._with_season_order(first), f"{process}_todo")
        return None if kept.isEmpty() else kept

    def _book(self, process: str, games: DataFrame, bad: DataFrame | None, changes: dict, table: str) -> None:
        """Commit a stage together with its errors; both writing jobs count for the report."""
        retries = (F.col("attempts") + 1 if "attempts" in games.columns else F.lit(0)).alias("retries")
        outcome = games.select("season", "game_id", "reject_reason", retries)
        if bad is not None:
            marks = bad.withColumn("_bad", F.lit("unknown_reference"))
            outcome = outcome.join(marks, "game_id", "left").select(
                "season", "game_id", F.coalesce("reject_reason", "_bad").alias("reject_reason"), "retries"
            )
        seasons, seen = list(self.seasons), Observation()
        outcome = self.working.keep(
            outcome.observe(seen, *R.stage_counts(seasons, F.col("reject_reason").isNull())), f"{process}_outcome"
        )
        counts = R.read_counts(seasons, seen.get)
        rejects = outcome.filter("reject_reason is not null").select(
            F.lit(process).alias("process_name"), "game_id",
            F.col("reject_reason").alias("error_type"),
            X.reject_message(F.col("reject_reason")).alias("error_message"), "retries",
        )
        failed = any(pair[1] for pair in counts.values())
        news = E.error_rows(rejects, self.run_ts, F.col("retries"))
        if self.retry:
            done = outcome.filter("reject_reason is null").select(F.lit(process).alias("process_name"), "game_id")
            errors = self.warehouse.read("etl_errors", list(E.OPEN_PART))
            resolved = E.resolve(errors, done, self.run_ts).drop("changed")
            changes["etl_errors"] = Replace(resolved.unionByName(news), E.OPEN_PART)
        elif failed:
            changes["etl_errors"] = Append(news)
        self.warehouse.commit(changes, count={table: ("season", seasons)})
        inserted = self.warehouse.counts[table]
        self.counts += [(process, season, ok, bad, ok + bad, inserted[season]) for season, (ok, bad) in counts.items()]
        if failed:
            ledger.append(
                rejects.select(F.col("process_name").alias("process"), "game_id", "error_type",
                               F.col("error_message").alias("message")),
                f"{self.warehouse.root}/_failures",
            )

    def _look_for_broken(self, kinds: tuple[str, ...], games: DataFrame) -> None:
        """Where documents are missing, look for files that cannot be read; their seasons count as failed."""
        missing = games.filter("reject_reason = 'not_landed'").select("season").distinct().collect()
        for kind in kinds if missing else ():
            found = landing.broken_files(self.spark, self.landing_root, kind, [r.season for r in missing], self.fmt)
            self.book_broken(kind, [(r.season, r.file) for r in found.collect()])

    def book_broken(self, kind: str, found: list[tuple[str, str]]) -> None:
        """Error rows for (season, file or message) that could not be read."""
        self.broken |= {season for season, _ in found}
        if found:
            rows = [(kind, None, UNREADABLE, f"{season}: {what}"[:2000]) for season, what in found]
            rejects = self.spark.createDataFrame(rows, "process_name string, game_id string, error_type string, error_message string")
            self.warehouse.commit({"etl_errors": Append(E.error_rows(rejects, self.run_ts))})

    # --- stages ----------------------------------------------------------------------

    def load_spine(self) -> None:
        """New game ids; a season whose finder rows lack a column is refused as a whole."""
        if self.only is not None:
            return self._add_to_spine(self.only)
        rows = landing.finder_rows(self._landed("finder"))
        status = {r.season: r.ok for r in landing.finder_status(rows).collect()}
        self.refused = [s for s, ok in status.items() if not ok]
        self.listed = [s for s, ok in status.items() if ok]
        if self.refused and len(self.seasons) == 1 and not self.keep_going:
            raise ValueError(f"finder rows of {self.refused[0]} cannot be read or lack one of {landing.FINDER_COLUMNS}")
        self.seasons = [s for s in self.seasons if s not in self.refused]
        if not self.seasons:
            return
        self._add_to_spine(landing.completed_games(rows.filter(~F.col("season").isin(self.refused))))

    def _add_to_spine(self, found: DataFrame) -> None:
        found = self.working.keep(self._with_season_order(found.select("game_id", "season")), "spine_found")
        usable = found.filter(F.char_length("game_id") <= 10)
        fresh = M.insert_ignore(self.warehouse.read("spine"), usable, SPINE, ["season_order"], self.run_ts)
        games = found.withColumn("reject_reason", F.when(F.char_length("game_id") > 10, "out_of_range"))
        self._book("spine", games, None, {"spine": Append(fresh)}, "spine")

    def load_games(self) -> None:
        wh = self.warehouse
        todo = self._todo(
            W.missing_games(wh.read("spine", self.seasons), wh.read("fact_games", self.seasons), self.seasons), W.SPINE_ORDER, "games"
        )
        if todo is None:
            return
        found = X.latest(X.extract_games(self._landed("summary", todo))).withColumn("_landed", F.lit(True))
        reason = F.when(F.col("_landed").isNull(), "not_landed").otherwise(F.col("reject_reason"))
        games = self.working.keep(
            todo.join(found, "game_id", "left").withColumn("reject_reason", reason).drop("_landed"), "games"
        )
        good = games.filter("reject_reason is null")
        teams = X.team_dim_rows(good, "season_order")
        dims = M.merge(wh.read("dim_teams"), teams, DIM_TEAMS, ["season_order", "game_id", "pos"], self.run_ts)
        facts = M.as_inserts(X.game_rows(good), FACT_GAMES, ["game_id"], self.run_ts)
        self._book("games", games, None, {"dim_teams": Replace(dims.drop(M.ACTION)), "fact_games": Append(facts)}, "fact_games")
        self._look_for_broken(("summary",), games)

    def load_teambox(self) -> None:
        wh = self.warehouse
        todo = self._todo(
            W.missing_boxes(wh.read("fact_games", self.seasons), wh.read(TEAMBOX.name, self.seasons), self.seasons), W.GAME_ORDER, "teambox"
        )
        if todo is None:
            return
        kinds = (
            ("traditional", X.TRADITIONAL_ROOTS, X.traditional_measures(self.zero_as_missing)),
            ("advanced", X.ADVANCED_ROOTS, X.advanced_measures(self.zero_as_missing)),
        )
        entries = [X.latest(X.extract_team_entries(self._landed(k, todo), roots, m)) for k, roots, m in kinds]
        games = self.working.keep(X.assemble_teambox(todo, *entries), "teambox")
        rows = X.teambox_rows(games.filter("reject_reason is null"), "game_date")
        bad = self._bad_games(rows, TEAMBOX, "teambox")
        rows = I.without_games(rows, bad)
        facts = M.as_inserts(rows, TEAMBOX, ["pos"], self.run_ts)
        news = S.team_days(M.pick_row(rows, list(TEAMBOX.key), ["pos"]))
        self._book("teambox", games, bad, {TEAMBOX.name: Append(facts), TEAM_DAYS.name: self._added(TEAM_DAYS, news)}, TEAMBOX.name)
        self._look_for_broken(("traditional", "advanced"), games)

    def load_players(self) -> None:
        wh = self.warehouse
        todo = self._todo(
            W.missing_boxes(wh.read("fact_games", self.seasons), wh.read(PLAYERBOX.name, self.seasons), self.seasons), W.GAME_ORDER, "playerbox"
        )
        if todo is None:
            return
        found = X.latest(X.extract_players(self._landed("players", todo)))
        games = self.working.keep(X.assemble_playerbox(todo, found), "playerbox")
        rows = X.playerbox_rows(games.filter("reject_reason is null"), "season_order", "game_date")
        bad = self._bad_games(rows, PLAYERBOX, "playerbox")
        rows = I.without_games(rows, bad)
        dims = M.merge(
            wh.read("dim_players"), X.player_dim_seeds(rows), DIM_PLAYERS,
            ["season_order", "game_date", "game_id"], self.run_ts,
        )
        facts = M.as_inserts(rows, PLAYERBOX, ["pos"], self.run_ts)
        self._book("playerbox", games, bad, {
            "dim_players": Replace(dims.drop(M.ACTION)), PLAYERBOX.name: Append(facts),
            PLAYER_TOTALS.name: self._added(PLAYER_TOTALS, S.player_totals(M.pick_row(rows, list(PLAYERBOX.key), ["pos"]))),
        }, PLAYERBOX.name)
        self._look_for_broken(("players",), games)

    def _added(self, spec, news: DataFrame) -> Replace:
        """The sums behind the reports, with those of the new facts."""
        return Replace(S.added(self.warehouse.read(spec.name, self.seasons), news, spec), tuple(self.seasons))

    def _bad_games(self, rows: DataFrame, spec, process: str) -> DataFrame:
        """Games whose rows refer to an unknown team.

        The other references hold by construction: games come from the fact table and
        players enter their dimension in the same commit.
        """
        parents = {"dim_teams": self.warehouse.read("dim_teams")}
        return self.working.keep(I.orphan_games(rows, spec, parents).select("game_id").distinct(), f"{process}_bad")

    def load_lineups(self) -> None:
        """Season lineup tables; only the seasons of the run are read and rewritten."""
        wh = self.warehouse
        found = X.extract_lineups(self._landed("lineups"))
        groups = self.working.keep(found, "lineups")
        rows = X.lineup_rows(groups, "landed_at")
        orphans = I.orphan_values(rows, "team_id", wh.read("dim_teams"))
        rows = rows.join(orphans, "team_id", "left_anti")
        merged = M.merge(wh.read(LINEUPS.name, self.seasons), rows, LINEUPS, ["landed_at", "pos"], self.run_ts)
        rejects = groups.join(orphans.withColumn("_bad", F.lit("unknown_reference")), "team_id", "left").select(
            F.lit("lineups").alias("process_name"), F.lit(None).cast("string").alias("game_id"),
            F.coalesce("reject_reason", "_bad").alias("error_type"),
            F.concat_ws(" ", X.reject_message(F.coalesce("reject_reason", "_bad")), F.lit("for"),
                        "season", "team_id", "group_quantity").alias("error_message"),
        ).filter("error_type is not null")
        seasons = list(self.seasons)
        wh.commit({
            LINEUPS.name: Replace(merged, tuple(seasons)),
            "etl_errors": Append(E.error_rows(rejects, self.run_ts)),
        }, count={LINEUPS.name: (M.ACTION, list(M.ACTIONS))})
        reason = F.coalesce("reject_reason", F.when(F.col("_bad"), "unknown_reference"))
        outcome = groups.join(orphans.withColumn("_bad", F.lit(True)), "team_id", "left").withColumn("reject_reason", reason)
        seen, ok = Observation(), F.col("reject_reason").isNull()
        outcome = outcome.select("season", "team_id", "reject_reason").observe(seen, *R.stage_counts(seasons, ok))
        outcome = self.working.keep(outcome, "lineups_outcome")
        found = R.read_counts(seasons, seen.get)
        # Rows are counted by action for the run as a whole, so they stand with its first season.
        inserted = [wh.counts[LINEUPS.name]["inserted"], *[0] * len(found)]
        self.counts += [("lineups", s, good, bad, good + bad, n) for (s, (good, bad)), n in zip(found.items(), inserted)]
        failed = outcome.filter("reject_reason is not null").select(
            F.lit("lineups").alias("process"), F.lit(None).cast("string").alias("game_id"), "team_id",
            F.col("reject_reason").alias("error_type"), X.reject_message(F.col("reject_reason")).alias("message"),
        )
        ledger.append(failed, f"{wh.root}/_lineup_failures", ledger.LINEUP_FIELDS)

    # --- whole run -------------------------------------------------------------------

    def run(self) -> DataFrame:
        """All stages in order; returns the stage report."""
        return self._run(self.load_spine, self.load_games, self.load_teambox, self.load_players)

    def run_retry(self) -> DataFrame:
        """The stages behind the spine, over the games that failed before."""
        return self._run(self.load_games, self.load_teambox, self.load_players)

    def run_lineups(self) -> DataFrame:
        return self._run(self.load_lineups)

    def _run(self, *stages: Callable[[], None]) -> DataFrame:
        try:
            for stage in stages:
                if self.seasons:
                    stage()
            return self.report()
        finally:
            self.working.close()

    def report(self) -> DataFrame:
        """(stage, season, success, failed, attempted, inserted); ``inserted`` are rows of the stage's table."""
        return self.spark.createDataFrame(self.counts, REPORT_SCHEMA)


def current_season(spark: SparkSession, day: Column | None = None, override: str | None = None) -> str:
    day = F.current_date() if day is None else day
    return spark.range(1).select(season_of_date(day, override)).first()[0]


def daily_run(
    spark: SparkSession, warehouse: Warehouse, landing_root: str, season: str | None = None, **options
) -> DataFrame:
    """Load what is new in the current (or the given) season."""
    return Load(spark, warehouse, landing_root, [current_season(spark, override=season)], **options).run()


def retry_failed(
    spark: SparkSession, warehouse: Warehouse, landing_root: str, seasons: list[str], **options
) -> DataFrame:
    """Take the failed games of every stage up again and close the errors that went away."""
    return Load(spark, warehouse, landing_root, list(seasons), retry=True, **options).run_retry()


def backfill(
    spark: SparkSession, warehouse: Warehouse, landing_root: str, seasons: list[str], **options
) -> tuple[DataFrame, DataFrame]:
    """Load several seasons; returns the stage report and (season, ok).

    A malformed season text refuses the whole run. A season that cannot be listed is
    reported as failed while the others are loaded; so is one that has not landed, and one
    with a file that cannot be read, which is named in the error table.
    """
    texts = spark.createDataFrame([(s,) for s in seasons], "season string")
    invalid = [r.season for r in texts.filter(~is_season_text(F.col("season"), LEAGUE_YEARS)).collect()]
    if invalid:
        raise ValueError(f"seasons must look like 2023-24: {invalid}")
    counts: dict[tuple[str, str], tuple] = {}
    loaded: set[str] = set()
    waiting = [list(seasons)]
    while waiting:
        part = waiting.pop(0)
        load = Load(spark, warehouse, landing_root, part, keep_going=True, **options)
        try:
            load.run()
            loaded |= set(load.listed) - load.broken
        except (PySparkException, Py4JJavaError) as failure:
            if isinstance(failure, AnalysisException):
                raise
            if len(part) > 1:
                waiting[:0] = [part[: len(part) // 2], part[len(part) // 2 :]]
            else:
                load.book_broken("backfill", _broken_or(load, part[0], failure))
        for row in load.counts:
            first = counts.setdefault(row[:2], row)
            # A stage that is taken up again finds what it has loaded before.
            counts[row[:2]] = (*first[:5], first[5] + (row[5] if first is not row else 0))
    report = spark.createDataFrame(list(counts.values()), REPORT_SCHEMA)
    return report, texts.withColumn("ok", F.col("season").isin(list(loaded)))


def _broken_or(load: Load, season: str, failure: Exception) -> list[tuple[str, str]]:
    """The files of a season that cannot be read, else the message of its failure."""
    found = []
    for kind in landing.LANDED_SCHEMAS:
        try:
            rows = landing.broken_files(load.spark, load.landing_root, kind, [season], load.fmt).collect()
            found += [(r.season, r.file) for r in rows]
        except (PySparkException, Py4JJavaError):
            continue
    return found or [(season, str(failure))]


def land_adapted(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the game documents derived from the driver's tables as a landing area."""
    for kind, rows in (
        ("finder", A.finder_landed), ("summary", A.summary_landed), ("traditional", A.traditional_landed),
        ("advanced", A.advanced_landed), ("players", A.players_landed),
    ):
        rows(spark, sf_dir).write.partitionBy("season").parquet(f"{root}/{kind}")


# What a replay shows of each table.
SHOWN = {
    "spine": ("game_id", "season"),
    "fact_games": ("game_id", "season", "game_date", "home_team_id", "away_team_id", "game_status", "arena_name", "arena_city"),
    "dim_teams": ("team_id", "abbreviation", "team_name", "city", "full_name"),
    "dim_players": ("player_id", "full_name"),
    "teambox_pergame": ("game_id", "team_id", "season", "is_home", "opponent_team_id", "minutes", "pts", "fgm", "fga", "ast", "stl"),
    "playerbox_pergame": ("game_id", "player_id", "team_id", "season", "is_home", "minutes", "pts", "reb", "plus_minus"),
}


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every table after two loads of the same landing area, as texts.

    They are read from the tables when the result is: these stay in the working folder.
    """
    place = Working(spark)
    landing_root = f"{place.root}/landing"
    land_adapted(spark, sf_dir, landing_root)
    seasons = [r.season for r in A.games(spark, sf_dir).select("season").distinct().orderBy("season").collect()]
    warehouse = Warehouse(spark, f"{place.root}/warehouse")
    warehouse.create_tables()
    for _ in range(2):
        Load(spark, warehouse, landing_root, list(seasons), fmt="parquet").run()
    found = None
    for name, columns in SHOWN.items():
        text = F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), "|", "~")
        rows = warehouse.read(name).select(F.lit(name).alias("table_name"), text.alias("row_text"))
        found = rows if found is None else found.unionByName(rows)
    return found
