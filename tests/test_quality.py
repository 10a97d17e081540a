"""Rules of games, team boxes and player boxes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxlake.operators import integrity as I
from boxlake.operators import quality as Q
from boxlake.schemas import FACT_GAMES, PLAYERBOX, TEAMBOX

# Rows at the edge of every rule: as many made as tried, no points, rebounds five apart.
GAME = {"game_id": "A123456789", "season": "1999-00", "game_date": dt.date(2000, 2, 29), "home_team_id": 1, "away_team_id": 2}
TEAM = {
    "game_id": "A123456789", "team_id": 1, "pts": 0, "fgm": 7, "fga": 7, "fg3m": 3, "fg3a": 3, "ftm": 1, "fta": 1,
    "oreb": 4, "dreb": 9, "reb": 18,
}
PLAYER = {
    "game_id": "A123456789", "player_id": 77, "team_id": 1, "pts": 0, "reb": 0, "ast": 0, "stl": 0, "blk": 0, "tov": 6,
    "pf": 0, "fgm": 3, "fga": 6, "fg3m": 3, "fg3a": 6, "ftm": 2, "fta": 2,
}


def _fields(spark, spec, rules, row):
    frame = spark.createDataFrame([tuple(row.get(c) for c in spec.columns)], spec.schema)
    return [e["field"] for e in Q.with_errors(frame, rules).first()["errors"]]


@pytest.mark.parametrize(
    ("change", "fields"),
    [
        ({}, []),
        ({"game_id": None}, ["game_id"]),
        ({"game_id": ""}, ["game_id"]),
        ({"game_id": "A12345678"}, ["game_id"]),
        ({"away_team_id": GAME["home_team_id"]}, ["team_ids"]),
        ({"home_team_id": 0, "away_team_id": 0}, ["home_team_id", "away_team_id"]),
        ({"game_date": None}, ["game_date"]),
        ({"season": "1999-01"}, ["season"]),
        ({"season": None}, []),
        ({"season": ""}, []),
    ],
)
def test_games(spark, change, fields):
    assert _fields(spark, FACT_GAMES, Q.game_rules(), {**GAME, **change}) == fields


@pytest.mark.parametrize(
    ("change", "fields"),
    [
        ({}, []),
        ({"fga": 6}, ["field_goals"]),
        ({"fg3m": 4}, ["three_pointers"]),
        ({"fta": None}, ["free_throws"]),
        ({"pts": -1}, ["pts"]),
        ({"reb": 19}, ["rebounds"]),
        ({"reb": 7}, ["rebounds"]),
        ({"oreb": None, "dreb": None, "reb": 6}, ["rebounds"]),
        ({"reb": 0}, []),
        ({"reb": None}, []),
        ({"game_id": "", "team_id": 0}, ["game_id", "team_id"]),
    ],
)
def test_team_boxes(spark, change, fields):
    assert _fields(spark, TEAMBOX, Q.teambox_rules(), {**TEAM, **change}) == fields


def test_player_boxes(spark):
    rules = Q.playerbox_rules()
    assert _fields(spark, PLAYERBOX, rules, PLAYER) == []
    ids = {k: PLAYER[k] for k in ("game_id", "player_id", "team_id")}
    assert _fields(spark, PLAYERBOX, rules, {**ids, "fgm": 1, "fg3m": 2}) == [
        "field_goals", "three_pointers", "shooting",
    ]
    assert _fields(spark, PLAYERBOX, rules, {**PLAYER, "pts": -1, "ast": -1, "pf": -1, "tov": -1}) == ["pts", "ast", "pf"]
    assert _fields(spark, PLAYERBOX, rules, {"pts": 1}) == ["game_id", "player_id", "team_id"]
    assert _fields(spark, PLAYERBOX, rules, {**PLAYER, "fg3a": 7}) == ["shooting"]


def test_violation_text_and_passing(spark):
    frame = spark.createDataFrame(
        [tuple({**TEAM, "pts": p}.get(c) for c in TEAMBOX.columns) for p in (-1, 5)], TEAMBOX.schema
    )
    found = Q.violations(frame, Q.teambox_rules(), ["game_id"]).first()
    assert found.text == "pts: Points cannot be negative (value=-1, rule=range_check)"
    assert [r.pts for r in Q.passing(frame, Q.teambox_rules()).collect()] == [5]


def test_constraints(spark):
    rows = [("0022400123", 1, 2, "2024-25"), ("0022400123", 1, 3, "2024-25"), ("00224001234", 2, 2, None), (None, 3, 3, "2024-2025"), (None, 3, 3, "2024-25")]
    frame = spark.createDataFrame(rows, "game_id string, player_id int, team_id int, season string").select(
        *[F.col(f.name) if f.name in ("game_id", "player_id", "team_id", "season") else F.lit(None).cast(f.dataType).alias(f.name)
          for f in PLAYERBOX.schema]
    ).withColumn("pts", F.lit(2**40))
    found = {r["constraint"]: r.violations for r in I.constraint_violations(frame, PLAYERBOX).collect()}
    assert found == {
        "not_null:game_id": 2, "not_null:season": 1, "length:game_id": 1, "length:season": 1,
        "int32:pts": 5, "unique:game_id,player_id": 1,
    }


def test_references(spark):
    box = spark.createDataFrame([("g1", 1, 10), ("g1", 2, 10), ("g2", 1, 11), ("g3", 9, None)], "game_id string, player_id int, team_id int")
    parents = {
        "fact_games": spark.createDataFrame([("g1",), ("g2",)], "game_id string"),
        "dim_players": spark.createDataFrame([(1,), (2,)], "player_id int"),
        "dim_teams": spark.createDataFrame([(10,)], "team_id int"),
    }
    bad = I.orphan_games(box, PLAYERBOX, parents)
    assert {tuple(r) for r in bad.collect()} == {("g3", "game_id"), ("g3", "player_id"), ("g2", "team_id")}
    assert {r.game_id for r in I.without_games(box, bad).collect()} == {"g1"}
    assert I.cascade(box, parents["fact_games"]).count() == 3
