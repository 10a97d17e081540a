"""The incremental load over small landing areas."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from boxlake.operators import errors as E
from boxlake.plans import daily as D
from boxlake.plans import marts
from boxlake.plans import standings as S
from boxlake.plans import upkeep as U
from boxlake.schemas import TABLES
from boxlake.sources import ledger
from boxlake.sources.warehouse import Append, Replace, Warehouse
from boxlake.streaming import complete_games as C
from boxlake.streaming.landing_stream import load_new_files

SEASON = "2024-25"
NOW = dt.datetime(2024, 12, 1)


class Landing:
    """Writes landed documents as JSON lines."""

    def __init__(self, root: Path):
        self.root, self.files = root, 0

    def write(self, kind: str, lines: list[dict], season: str = SEASON) -> None:
        folder = self.root / kind / f"season={season}"
        folder.mkdir(parents=True, exist_ok=True)
        self.files += 1
        (folder / f"part-{self.files}.json").write_text("\n".join(json.dumps(x) for x in lines) + "\n")

    def finder(self, rows: list[dict], season: str = SEASON, league: str = "00", season_type: str = "Regular Season"):
        self.write("finder", [{"league": league, "season_type": season_type, "payload": r} for r in rows], season)

    def document(self, kind: str, game_id: str, payload, at: str = "2024-11-20T00:00:00Z", season: str = SEASON):
        self.write(kind, [{"game_id": game_id, "landed_at": at, "payload": payload}], season)

    def game(self, game_id: str, home: int, away: int, day: str = "2024-11-15", season: str = SEASON, stats=None, players=None):
        """A complete, well-formed game."""
        self.finder([{"GAME_ID": game_id, "WL": "W"}, {"GAME_ID": game_id, "WL": "L"}], season)
        self.document("summary", game_id, {"boxScoreSummary": {
            "homeTeamId": home, "awayTeamId": away, "gameTimeUTC": f"{day}T19:00:00Z", "gameStatusText": "Final",
            "homeTeam": {"teamId": home, "teamTricode": f"T{home}", "teamCity": "City", "teamName": f"Team{home}"},
            "awayTeam": {"teamId": away, "teamTricode": f"T{away}", "teamCity": "City", "teamName": f"Team{away}"},
        }}, season=season)
        stats = stats or {"points": 100, "minutes": 240}
        self.document("traditional", game_id, {"boxScoreTraditional": {
            "homeTeam": {"teamId": home, "statistics": stats}, "awayTeam": {"teamId": away, "statistics": stats},
        }}, season=season)
        self.document("advanced", game_id, {"boxScoreAdvanced": {
            "homeTeam": {"teamId": home, "statistics": {"netRating": 1.5}},
            "awayTeam": {"teamId": away, "statistics": {"netRating": -1.5}},
        }}, season=season)
        players = players or [(1, home), (2, away)]
        self.document("players", game_id, {"tables": [[
            {"personId": p, "teamId": t, "firstName": f"F{p}", "familyName": f"L{p}", "points": 0, "minutes": "35:24"}
            for p, t in players
        ]]}, season=season)


@pytest.fixture
def place(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.create_tables()
    return Landing(tmp_path / "landing"), warehouse


def _run(spark, place, **options):
    landing, warehouse = place
    report = D.daily_run(spark, warehouse, str(landing.root), SEASON, run_ts=NOW, **options)
    return {(r.stage, r.season): (r.success, r.failed, r.attempted) for r in report.collect()}


def _state(warehouse):
    return {
        n: sorted(map(tuple, warehouse.read(n).drop("last_updated_at", "first_seen_at").collect()), key=repr)
        for n in TABLES
    }


def test_two_runs(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    landing.game("0022400002", 11, 12, day="2024-11-16")
    landing.finder([{"GAME_ID": "0022400009", "WL": None}])
    landing.finder([{"GAME_ID": "0022400008", "WL": "W"}], season_type="Playoffs")
    report = _run(spark, place)
    assert report == {(s, SEASON): (2, 0, 2) for s in ("spine", "games", "teambox", "playerbox")}
    first = _state(warehouse)
    assert [r[0] for r in first["spine"]] == ["0022400001", "0022400002"]
    assert len(first["teambox_pergame"]) == 4 and len(first["playerbox_pergame"]) == 4
    assert {r[0] for r in first["dim_teams"]} == {10, 11, 12}
    assert warehouse.read("dim_teams").filter("team_id = 10").first().full_name == "Team10"
    game = warehouse.read("fact_games").filter("game_id = '0022400001'").first()
    assert (game.game_date, game.home_points, game.season) == (dt.date(2024, 11, 15), None, SEASON)
    player = warehouse.read("playerbox_pergame").filter("player_id = 1 and game_id = '0022400001'").first()
    assert (player.is_home, player.opponent_team_id, player.pts, player.starter_flag) == (True, 11, 0, None)

    again = D.daily_run(spark, warehouse, str(landing.root), SEASON, run_ts=NOW)
    assert [tuple(r) for r in again.collect()] == [("spine", SEASON, 2, 0, 2, 0)]
    assert _state(warehouse) == first


def test_inserted_rows_are_counted_by_the_writing_jobs(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11, players=[(1, 10), (2, 11), (3, 11)])
    landing.game("0022300001", 10, 11, day="2023-11-15", season="2023-24")
    report, _ = D.backfill(spark, warehouse, str(landing.root), ["2023-24", SEASON], run_ts=NOW)
    inserted = {(r.stage, r.season): r.inserted for r in report.collect()}
    assert inserted == {
        **{(stage, season): n for season in ("2023-24", SEASON) for stage, n in (("spine", 1), ("games", 1), ("teambox", 2))},
        ("playerbox", "2023-24"): 2, ("playerbox", SEASON): 3,
    }


def test_retries_count_up_newest_first(spark, place):
    """Closed rows stay in their part; each retry has one attempt more; a limit takes the last failures."""
    landing, warehouse = place
    for i in range(3):
        landing.finder([{"GAME_ID": f"002240000{i}", "WL": "W"}])
        _run(spark, place) if i == 0 else D.daily_run(spark, warehouse, str(landing.root), SEASON, run_ts=NOW + dt.timedelta(hours=i), limit=10)

    def retry(**options):
        return D.retry_failed(spark, warehouse, str(landing.root), [SEASON], **options).collect()

    later = NOW + dt.timedelta(days=1)
    assert [(r.success, r.failed) for r in retry(run_ts=later, limit=1)] == [(0, 1)]
    errors = warehouse.read("etl_errors")
    last = errors.orderBy(F.desc("created_at")).first()
    # The game that failed last; ids break ties.
    assert (last.game_id, last.retry_count, last.last_retry_at) == ("0022400000", 1, later)
    # Its wait is 200 seconds now, that of the others is over.
    soon = later + dt.timedelta(seconds=150)
    assert [(r.success, r.failed) for r in retry(run_ts=soon, only_due=True)] == [(0, 2)]
    landing.game("0022400000", 10, 11)
    assert ("games", 1, 2) in {(r.stage, r.success, r.failed) for r in retry(run_ts=soon + dt.timedelta(seconds=250), only_due=True)}
    closed = [f for f in warehouse._tables()["etl_errors"] if f.endswith("true")]
    landing.game("0022400001", 10, 11)
    retry(run_ts=soon + dt.timedelta(hours=1))
    assert set(closed) < {f for f in warehouse._tables()["etl_errors"] if f.endswith("true")}
    open_ones = warehouse.read("etl_errors", ["false"])
    assert {r.game_id for r in open_ones.select("game_id").distinct().collect()} == {"0022400002"}
    assert open_ones.agg(F.max("retry_count")).first()[0] == 3


@pytest.mark.parametrize("kind", ["finder", "summary", "advanced"])
def test_a_broken_line_fails_its_season_only(spark, place, kind):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    landing.game("0022300001", 10, 11, day="2023-11-15", season="2023-24")
    folder = landing.root / kind / "season=2023-24"
    file = next(folder.iterdir())
    file.write_text("\n".join(line[: len(line) // 2] for line in file.read_text().splitlines()) + "\n")
    _, statuses = D.backfill(spark, warehouse, str(landing.root), ["2023-24", SEASON], run_ts=NOW)
    assert {r.season: r.ok for r in statuses.collect()} == {"2023-24": False, SEASON: True}
    assert {r.season for r in warehouse.read("playerbox_pergame").select("season").distinct().collect()} >= {SEASON}
    assert warehouse.read("teambox_pergame", ["2023-24"]).count() == 0
    if kind != "finder":
        error = warehouse.read("etl_errors").filter("error_type = 'unreadable_file'").first()
        assert error.process_name == kind and error.error_message.endswith(file.name)


@pytest.mark.parametrize("kind", ["finder", "traditional"])
def test_a_truncated_parquet_file_fails_its_season_only(spark, place, tmp_path, kind):
    landing, warehouse = place
    seasons = ["2021-22", "2022-23", "2023-24", SEASON]
    for i, season in enumerate(seasons):
        landing.game(f"00{20 + i}00001", 10, 11, day=f"{2021 + i}-11-15", season=season)
    from boxlake.sources import landing as L

    root = tmp_path / "parquet"
    for name in ("finder", "summary", "traditional", "advanced", "players"):
        L.landed(spark, str(landing.root), name).write.partitionBy("season").parquet(str(root / name))
    file = next((root / kind / "season=2022-23").glob("part-*"))
    file.write_bytes(file.read_bytes()[:-20])
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    report, statuses = D.backfill(spark, warehouse, str(root), seasons, run_ts=NOW, fmt="parquet")
    assert {r.season: r.ok for r in statuses.collect()} == {s: s != "2022-23" for s in seasons}
    boxes = {r.season for r in warehouse.read("teambox_pergame").select("season").distinct().collect()}
    assert boxes == set(seasons) - {"2022-23"}
    error = warehouse.read("etl_errors").filter("error_type = 'unreadable_file'").first()
    assert error.error_message.endswith(file.name)
    counted = {(r.stage, r.season): (r.success, r.inserted) for r in report.collect()}
    assert all(counted[("teambox", s)] == (1, 2) for s in boxes)
    assert L.broken_files(spark, str(root), "summary", seasons, "parquet").count() == 0


def test_rejects_retry_and_resolution(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    landing.finder([{"GAME_ID": "0022400002", "WL": "W"}])
    landing.game("0022400003", 10, 11)
    landing.document("summary", "0022400003", "not an object", at="2024-11-21T00:00:00Z")
    report = _run(spark, place)
    assert report[("games", SEASON)] == (1, 2, 3)
    assert report[("teambox", SEASON)] == (1, 0, 1)
    found = {r.game_id: r.error_type for r in warehouse.read("etl_errors").collect()}
    assert found == {"0022400002": "not_landed", "0022400003": "malformed_payload"}
    lines = {(r.process, r.game_id, r.error_type) for r in ledger.read(spark, f"{warehouse.root}/_failures").collect()}
    assert lines == {("games", "0022400002", "not_landed"), ("games", "0022400003", "malformed_payload")}

    landing.game("0022400002", 10, 11)
    report = D.retry_failed(spark, warehouse, str(landing.root), [SEASON], run_ts=NOW)
    assert {(r.stage, r.success, r.failed) for r in report.collect()} == {("games", 1, 1)}
    errors = warehouse.read("etl_errors")
    assert {r.game_id for r in E.open_game_ids(errors, "games").collect()} == {"0022400003"}
    assert errors.filter("is_resolved").count() == 1 and errors.filter("retry_count = 1").count() == 1


def test_unknown_team_rejects_the_whole_game(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11, players=[(1, 10), (2, 99)])
    landing.game("0022400002", 10, 11, players=[(1, 10), (3, 11)])
    report = _run(spark, place)
    assert report[("playerbox", SEASON)] == (1, 1, 2)
    assert {r.game_id for r in warehouse.read("playerbox_pergame").collect()} == {"0022400002"}
    assert {r.player_id for r in warehouse.read("dim_players").collect()} == {1, 3}
    error = warehouse.read("etl_errors").first()
    assert (error.process_name, error.game_id, error.error_type) == ("playerbox", "0022400001", "unknown_reference")


def test_both_ways_of_restricting_documents(spark, place, tmp_path):
    landing, warehouse = place
    for i in range(4):
        landing.game(f"002240000{i}", 10 + i, 20 + i)
    wide = Warehouse(spark, str(tmp_path / "wide"))
    wide.create_tables()
    a = _run(spark, (landing, warehouse))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = _run(spark, (landing, wide))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b and _state(warehouse) == _state(wide)


def test_newest_document_and_repeated_player(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    landing.document("players", "0022400001", {"tables": [[
        {"personId": 7, "teamId": 10, "firstName": "Ann", "points": 3},
        {"personId": 7, "teamId": 11, "firstName": "Bob", "familyName": "Last", "points": 0},
        {"personId": None, "teamId": 10}, {"personId": "x", "teamId": 10},
    ]]}, at="2024-12-01T00:00:00Z")
    _run(spark, place)
    rows = warehouse.read("playerbox_pergame").collect()
    assert [(r.player_id, r.team_id, r.pts) for r in rows] == [(7, 11, 0)]
    assert [(r.player_id, r.full_name, r.last_name) for r in warehouse.read("dim_players").collect()] == [(7, "Ann", None)]


@pytest.mark.parametrize(("zero_as_missing", "points"), [(True, None), (False, 0)])
def test_zero_points(spark, place, zero_as_missing, points):
    landing, warehouse = place
    landing.game("0022400001", 10, 11, stats={"points": 0, "fgm": "0", "minutes": 240})
    _run(spark, place, zero_as_missing=zero_as_missing)
    assert {(r.pts, r.fgm, r.minutes) for r in warehouse.read("teambox_pergame").collect()} == {(points, 0, "240")}


def test_only_recent_documents(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    report = _run(spark, place, landed_since=dt.datetime(2024, 12, 1))
    assert report[("games", SEASON)] == (0, 1, 1)
    report = _run(spark, place, landed_since=dt.datetime(2024, 11, 1))
    assert report[("games", SEASON)] == (1, 0, 1)


def test_nothing_landed(spark, place):
    assert _run(spark, place) == {}


def test_limit_takes_the_first_games(spark, place):
    landing, warehouse = place
    for i, day in enumerate(("2024-11-03", "2024-11-01", "2024-11-02")):
        landing.game(f"002240000{i}", 10, 11, day=day)
    _run(spark, place, limit=2)
    assert {r.game_id for r in warehouse.read("fact_games").collect()} == {"0022400000", "0022400001"}
    _run(spark, place, limit=1)
    boxes = warehouse.read("teambox_pergame").select("game_id").distinct().collect()
    assert {r.game_id for r in boxes} == {"0022400000", "0022400001", "0022400002"}
    with pytest.raises(ValueError):
        _run(spark, place, limit=-1)


def test_dimension_keeps_what_later_games_leave_out(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    landing.finder([{"GAME_ID": "0022400002", "WL": "W"}])
    landing.document("summary", "0022400002", {"boxScoreSummary": {
        "homeTeamId": 10, "awayTeamId": 11, "gameEt": "2024-11-17T00:00:00", "homeTeam": {"teamCity": "Moved"}, "awayTeam": 5,
    }})
    _run(spark, place)
    team = warehouse.read("dim_teams").filter("team_id = 10").first()
    assert (team.city, team.team_name, team.abbreviation) == ("Moved", "Team10", "T10")


def test_backfill(spark, place):
    landing, warehouse = place
    landing.game("0022300001", 10, 11, day="2023-11-15", season="2023-24")
    landing.game("0022400001", 10, 11)
    landing.finder([{"TEAM_ID": 1, "WL": "W"}], season="2022-23")
    seasons = ["2022-23", "2023-24", SEASON]
    with pytest.raises(ValueError, match="2024-2025"):
        D.backfill(spark, warehouse, str(landing.root), [*seasons, "2024-2025"])
    report, statuses = D.backfill(spark, warehouse, str(landing.root), seasons, run_ts=NOW)
    assert {r.season: r.ok for r in statuses.collect()} == {"2022-23": False, "2023-24": True, SEASON: True}
    assert report.filter("stage = 'playerbox' and success = 1").count() == 2
    assert warehouse.read("fact_games", ["2023-24"]).count() == 1
    landing.game("0022100001", 10, 11, day="2021-11-15", season="2021-22")
    landing.finder(["<html>busy</html>"], season="2021-22")
    report, statuses = D.backfill(spark, warehouse, str(landing.root), ["2020-21", "2021-22", SEASON], run_ts=NOW)
    assert {r.season: r.ok for r in statuses.collect()} == {"2020-21": False, "2021-22": False, SEASON: True}
    assert warehouse.read("fact_games", ["2021-22"]).count() == 0
    report, statuses = D.backfill(spark, warehouse, str(landing.root), ["2022-23"], run_ts=NOW)
    assert report.count() == 0 and [r.ok for r in statuses.collect()] == [False]
    with pytest.raises(ValueError, match="GAME_ID"):
        D.daily_run(spark, warehouse, str(landing.root), "2022-23")


def test_lineups(spark, place):
    landing, warehouse = place
    landing.game("0022400001", 10, 11)
    _run(spark, place)

    def land(team, payload, at):
        landing.write("lineups", [{"team_id": team, "group_quantity": 2, "landed_at": at, "payload": payload}])

    land(10, {"tables": [[{"GROUP_ID": "-1-2-", "GP": 5, "MIN": 10.5}, {"GROUP_ID": "-1-3-", "GP": 1}]]}, "2024-11-01T00:00:00Z")
    land(10, {"tables": [[{"GROUP_ID": "-1-2-", "GP": 6}]]}, "2024-11-02T00:00:00Z")
    land(11, {"tables": [[{"GROUP_VALUE": "x", "GP": 1}]]}, "2024-11-01T00:00:00Z")
    land(99, {"tables": [[{"GROUP_ID": "-9-", "GP": 1}]]}, "2024-11-01T00:00:00Z")
    for _ in range(2):
        D.Load(spark, warehouse, str(landing.root), [SEASON], run_ts=NOW).run_lineups()
    rows = {(r.team_id, r.group_id, r.gp, r["min"]) for r in warehouse.read("lineupbox_season").collect()}
    assert rows == {(10, "-1-2-", 6, None), (10, "-1-3-", 1, None)}
    assert {r.error_type for r in warehouse.read("etl_errors").collect()} == {"missing_lineup_columns", "unknown_reference"}
    failed = ledger.read(spark, f"{warehouse.root}/_lineup_failures", ledger.LINEUP_FIELDS).collect()
    assert {(r.team_id, r.error_type) for r in failed} == {("11", "missing_lineup_columns"), ("99", "unknown_reference")}


def test_stream_drives_the_load(spark, place, tmp_path):
    landing, warehouse = place
    options = {"run_ts": NOW}

    def drain():
        query = load_new_files(spark, warehouse, str(landing.root), str(tmp_path / "checkpoint"), **options)
        query.awaitTermination()
        return warehouse.read("playerbox_pergame").select("game_id").distinct().count()

    landing.game("0022400001", 10, 11)
    assert drain() == 1
    landing.game("0022300001", 10, 11, season="2023-24")
    assert drain() == 2
    landing.write("lineups", [{"team_id": 10, "group_quantity": 2, "landed_at": "2024-11-01T00:00:00Z", "payload": {"tables": [[{"GROUP_ID": "-1-2-", "GP": 5}]]}}])
    assert drain() == 2
    assert warehouse.read("lineupbox_season").count() == 1
    U.compact(warehouse, ["playerbox_pergame"], [SEASON, "2023-24"])
    assert drain() == 2


def test_stream_of_complete_games(spark, place, tmp_path):
    """Late, repeated and missing documents; state ends with the watermark."""
    landing, warehouse = place
    for kind in C.KINDS:
        (landing.root / kind).mkdir(parents=True)
    seen = []

    def drain():
        query = C.load_complete_games(spark, warehouse, str(landing.root), str(tmp_path / "checkpoint"), run_ts=NOW)
        query.awaitTermination()
        if query.lastProgress:
            seen.append(sum(s.numRowsTotal for s in query.lastProgress.stateOperators))
        return {r.game_id for r in warehouse.read("playerbox_pergame").select("game_id").distinct().collect()}

    def parts(game_id, kinds, at, points=100):
        stats = {"points": points, "minutes": 240}
        payloads = {
            "summary": {"boxScoreSummary": {
                "homeTeamId": 10, "awayTeamId": 11, "gameTimeUTC": "2024-11-15T19:00:00Z",
                "homeTeam": {"teamId": 10, "teamName": "A"}, "awayTeam": {"teamId": 11, "teamName": "B"}}},
            "traditional": {"homeTeam": {"teamId": 10, "statistics": stats}, "awayTeam": {"teamId": 11, "statistics": stats}},
            "advanced": {"homeTeam": {"teamId": 10, "statistics": {"pace": 1.5}}, "awayTeam": {"teamId": 11, "statistics": {"pace": 2.5}}},
            "players": {"tables": [[{"personId": 1, "teamId": 10, "points": 3}]]},
        }
        for kind in kinds:
            landing.document(kind, game_id, payloads[kind], at=at)

    parts("0022400001", C.KINDS, "2024-11-20T00:00:00Z")
    parts("0022400002", C.KINDS[:2], "2024-11-20T01:00:00Z")
    assert drain() == {"0022400001"}
    # The rest of the second game, and a newer copy of one of its documents.
    parts("0022400002", ("traditional",), "2024-11-20T02:00:00Z", points=77)
    parts("0022400002", C.KINDS[2:], "2024-11-21T00:00:00Z")
    # Of a third game only half ever lands in time.
    parts("0022400003", C.KINDS[:2], "2024-11-21T00:00:00Z")
    assert drain() == {"0022400001", "0022400002"}
    assert {r.pts for r in warehouse.read("teambox_pergame").filter("game_id = '0022400002'").collect()} == {77}
    assert drain() == {"0022400001", "0022400002"}
    # Weeks later the watermark has passed all of these, and state is left for the new game only.
    parts("0022400004", C.KINDS, "2024-12-20T00:00:00Z")
    drain()
    parts("0022400003", C.KINDS[2:], "2024-11-21T00:00:00Z")
    assert drain() == {"0022400001", "0022400002", "0022400004"}
    assert seen[-1] <= 8 < max(seen) + 5
    # The daily run finds what the stream has left behind.
    landing.finder([{"GAME_ID": "0022400003", "WL": "W"}])
    _run(spark, place)
    assert warehouse.read("playerbox_pergame").select("game_id").distinct().count() == 4


def test_kept_sums_follow_every_load(spark, place):
    landing, warehouse = place

    def same():
        days, totals = warehouse.read("team_days"), warehouse.read("player_totals")
        box, players, games = (warehouse.read(n) for n in ("teambox_pergame", "playerbox_pergame", "fact_games"))
        for kept, full in (
            (S.team_record(days), marts.team_record(box)), (S.season_change(days), marts.season_change(box)),
            (S.player_averages(totals), marts.player_averages(players)),
        ):
            rows = sorted(map(tuple, kept.select(full.columns).collect()), key=repr)
            assert rows == sorted(map(tuple, full.collect()), key=repr)
        return games.count()

    for k, day in enumerate(("2024-11-10", "2024-11-12", "2024-11-11")):
        landing.game(f"002240000{2 * k}", 10, 11, day=day, stats={"points": 90 + k, "minutes": 240})
        landing.game(f"002240000{2 * k + 1}", 11, 12 + k, day=day)
        _run(spark, place)
        assert same() == 2 * k + 2
    U.delete_games(warehouse, spark.createDataFrame([("0022400002",)], "game_id string"), [SEASON])
    assert same() == 5


def test_tables_and_commits(spark, place):
    _, warehouse = place
    spine = spark.createDataFrame([("g1", "2023-24", None), ("g2", SEASON, None)], TABLES["spine"].schema)
    warehouse.commit({"spine": Append(spine)})
    warehouse.create_tables()
    assert warehouse.read("spine").count() == 2 and warehouse.read("spine", [SEASON]).count() == 1
    warehouse.commit({"spine": Replace(spine.filter("game_id = 'g2'").withColumn("game_id", F.lit("g3")), (SEASON,))})
    assert {r.game_id for r in warehouse.read("spine").collect()} == {"g1", "g3"}

    def broken(_):
        raise ValueError("boom")

    bad = spine.withColumn("game_id", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        warehouse.commit({"dim_teams": Replace(spark.createDataFrame([(1,)], "team_id int").select(
            *[F.col("team_id") if c == "team_id" else F.lit(None).cast(TABLES["dim_teams"].schema[c].dataType).alias(c)
              for c in TABLES["dim_teams"].columns])), "spine": Append(bad)})
    assert warehouse.read("dim_teams").count() == 0 and warehouse.read("spine").count() == 2
    warehouse.truncate()
    assert all(warehouse.read(n).count() == 0 for n in TABLES)


def test_error_reports(spark, place):
    rows = [
        (1, "p", "g1", "A", "m", None, 0, False, dt.datetime(2024, 1, 30), None, None),
        (2, "p", "g1", "B", "m", None, 0, False, dt.datetime(2024, 1, 29), None, None),
        (3, "q", None, "A", "m", None, 0, True, dt.datetime(2024, 1, 28), None, None),
        (4, "q", "g2", "A", "m", None, 0, False, dt.datetime(2024, 1, 1), None, None),
        (5, "p", "g3", "A", "m", None, 0, False, dt.datetime(2024, 1, 31), None, None),
    ]
    errors = spark.createDataFrame(rows, TABLES["etl_errors"].schema)
    as_of = F.lit(dt.datetime(2024, 1, 31))
    row = E.summary(errors, as_of).first()
    assert (row.total_errors, row.unresolved) == (4, 3)
    assert row.by_process == {"p": 3, "q": 1} and row.by_type == {"A": 3, "B": 1}
    empty = E.summary(errors.limit(0), as_of).first()
    assert (empty.total_errors, empty.unresolved, empty.by_process) == (0, 0, {})
    assert [r.game_id for r in E.failed_game_ids(errors, "p").collect()] == ["g3", "g1"]
    assert [r.game_id for r in E.failed_game_ids(errors, "p", 1).collect()] == ["g3"]
    assert len(E.failed_game_ids(errors, "p", 0).collect()) == 2
    done = spark.createDataFrame([("p", "g1"), ("p", "g1")], "process_name string, game_id string")
    resolved = E.resolve(errors, done, as_of)
    assert resolved.filter("changed").count() == 2 and resolved.count() == 5
    assert [r.error_type for r in E.recent_open(errors, 2).collect()] == ["A", "A"]


def test_ledger_round_trip(spark, tmp_path):
    rows = [("teambox", "g1", "ReadTimeout", "timed\tout"), ("playerbox", "g2", "SSLError", ""), ("teambox", "g3", "E", None)]
    failures = spark.createDataFrame(rows, "process string, game_id string, error_type string, message string")
    path = str(tmp_path / "ledger")
    ledger.append(failures, path)
    ledger.append(failures.limit(1), path)
    found = sorted((r.process, r.game_id, r.error_type, r.message) for r in ledger.read(spark, path).collect())
    assert found == sorted([(*r[:3], r[3] or "") for r in rows] + [rows[0]])
    lineup = tmp_path / "failed_lineups.txt"
    lineup.write_text("g1\t12\tValueError\tMissing\tcolumn\n")
    found = ledger.read_file(spark, str(lineup), ledger.LINEUP_FIELDS).first()
    assert tuple(found) == ("g1", "12", "ValueError", "Missing\tcolumn")


def test_upkeep(spark, place):
    _, warehouse = place
    assert U.add_game_ids(warehouse, [], SEASON) == (0, 0)
    assert U.add_game_ids(warehouse, ["g1", "g2", "g2"], "2023-24") == (3, 2)
    assert U.add_game_ids(warehouse, ["g2", "g3"], SEASON) == (2, 1)
    assert U.add_game_ids(warehouse, ["g2", "g3"], SEASON) == (2, 0)
    assert {(r.game_id, r.season) for r in warehouse.read("spine").collect()} == {
        ("g1", "2023-24"), ("g2", "2023-24"), ("g3", SEASON),
    }
    failures = spark.createDataFrame(
        [("p", "g1", "A", "m"), ("p", "g1", "B", "m"), ("q", "g1", "A", "m")],
        "process_name string, game_id string, error_type string, error_message string",
    )
    U.record_errors(warehouse, failures, run_ts=NOW)
    assert U.mark_resolved(warehouse, "p", "g1", run_ts=NOW) == 2
    assert U.mark_resolved(warehouse, "p", "g1", run_ts=NOW) == 0
    errors = warehouse.read("etl_errors")
    assert errors.count() == 3 and errors.filter("is_resolved and resolved_at is not null").count() == 2

    def rows(name, values):
        spec = TABLES[name]
        frame = spark.createDataFrame(values, "game_id string, season string, team_id int, player_id int")
        return frame.select(*[
            (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema
        ])

    values = [("g1", SEASON, 1, 1), ("g2", SEASON, 1, 1), ("g0", "2023-24", 1, 1)]
    warehouse.commit({n: Append(rows(n, values)) for n in ("fact_games", "teambox_pergame", "playerbox_pergame")})
    U.delete_games(warehouse, spark.createDataFrame([("g1",)], "game_id string"), [SEASON])
    for name in ("fact_games", "teambox_pergame", "playerbox_pergame"):
        assert {r.game_id for r in warehouse.read(name).collect()} == {"g0", "g2"}
