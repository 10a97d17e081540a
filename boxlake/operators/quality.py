"""Data-quality rules as Columns, evaluated in one pass over the rows.

The job reports; it drops nothing unless ``passing`` is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.seasons import is_season_text

# Rule names and message texts of a violation.
REQUIRED, LENGTH, UNIQUE = "required", "length_check", "uniqueness"
FORMAT, LOGIC, RANGE, CONSISTENT = "format_check", "logic_check", "range_check", "consistency_check"
REQUIRED_TEXTS = {
    "game_id": "Game ID is required",
    "team_id": "Team ID is required",
    "player_id": "Player ID is required",
    "home_team_id": "Home team ID is required",
    "away_team_id": "Away team ID is required",
    "game_date": "Game date is required",
}
GAME_ID_LENGTH_TEXT = "Game ID must be exactly 10 characters"
SAME_TEAMS_TEXT = "Home and away team IDs must be different"
SEASON_TEXT = "Season must be in format YYYY-YY (e.g., 2024-25)"
SHOT_TEXTS = {
    "field_goals": "Field goals made cannot exceed attempts",
    "three_pointers": "Three pointers made cannot exceed attempts",
    "free_throws": "Free throws made cannot exceed attempts",
}
THREES_MADE_TEXT = "Three pointers made cannot exceed total field goals made"
THREES_TRIED_TEXT = "Three pointers attempted cannot exceed total field goals attempted"
POINTS_TEXT = "Points cannot be negative"
NEGATIVE_TEXT = "{} cannot be negative"
REBOUNDS_TEXT = "Total rebounds significantly differs from oreb + dreb"
GAME_ID_LENGTH, REBOUND_SLACK = 10, 5
SHOTS = (("field_goals", "fgm", "fga"), ("three_pointers", "fg3m", "fg3a"), ("free_throws", "ftm", "fta"))
NEVER_NEGATIVE = ("pts", "reb", "ast", "stl", "blk", "pf")


@dataclass(frozen=True)
class Rule:
    field: str
    rule: str
    message: str
    broken: Column
    value: Column

    def violation(self) -> Column:
        return F.when(
            self.broken,
            F.struct(
                F.lit(self.field).alias("field"),
                self.value.cast("string").alias("value"),
                F.lit(self.rule).alias("rule"),
                F.lit(self.message).alias("message"),
            ),
        )


def _blank(name: str) -> Column:
    """Missing in the loose sense: null, empty text or zero."""
    as_text = F.col(name).cast("string")
    return as_text.isNull() | as_text.isin("", "0")


def _number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _pair(left: str, left_value: Column, right: str, right_value: Column) -> Column:
    return F.concat(
        F.lit(f"{left}="), left_value.cast("string"), F.lit(f", {right}="), right_value.cast("string")
    )


def _required(name: str) -> Rule:
    return Rule(name, REQUIRED, REQUIRED_TEXTS[name], _blank(name), F.col(name))


def _required_text(name: str) -> Rule:
    text = F.col(name)
    return Rule(name, REQUIRED, REQUIRED_TEXTS[name], text.isNull() | (text == ""), text)


def _shot(field: str, made: str, tried: str) -> Rule:
    return Rule(
        field, LOGIC, SHOT_TEXTS[field], _number(made) > _number(tried),
        _pair("made", _number(made), "attempted", _number(tried)),
    )


def _not_negative(name: str, message: str | None = None) -> Rule:
    return Rule(
        name, RANGE, message or NEGATIVE_TEXT.format(name.upper()),
        F.coalesce(F.col(name) < 0, F.lit(False)), F.col(name),
    )


def game_rules() -> list[Rule]:
    home, away = F.col("home_team_id"), F.col("away_team_id")
    game_id, season = F.col("game_id"), F.col("season")
    return [
        _required_text("game_id"),
        Rule("game_id", LENGTH, GAME_ID_LENGTH_TEXT,
             (game_id != "") & (F.char_length(game_id) != GAME_ID_LENGTH), game_id),
        _required("home_team_id"),
        _required("away_team_id"),
        Rule("team_ids", UNIQUE, SAME_TEAMS_TEXT,
             ~_blank("home_team_id") & ~_blank("away_team_id") & (home == away),
             _pair("home", home, "away", away)),
        _required("game_date"),
        Rule("season", FORMAT, SEASON_TEXT, (season != "") & ~is_season_text(season), season),
    ]


def teambox_rules() -> list[Rule]:
    total, offensive, defensive = _number("reb"), _number("oreb"), _number("dreb")
    return [
        _required_text("game_id"),
        _required("team_id"),
        *[_shot(*shot) for shot in SHOTS],
        _not_negative("pts", POINTS_TEXT),
        Rule("rebounds", CONSISTENT, REBOUNDS_TEXT,
             (total > 0) & (F.abs(total - offensive - defensive) > REBOUND_SLACK),
             F.concat(F.lit("total="), total.cast("string"), F.lit(", "),
                      _pair("oreb", offensive, "dreb", defensive))),
    ]


def playerbox_rules() -> list[Rule]:
    return [
        _required_text("game_id"),
        _required("player_id"),
        _required("team_id"),
        *[_shot(*shot) for shot in SHOTS],
        Rule("shooting", LOGIC, THREES_MADE_TEXT, _number("fg3m") > _number("fgm"),
             _pair("fg3m", _number("fg3m"), "fgm", _number("fgm"))),
        Rule("shooting", LOGIC, THREES_TRIED_TEXT, _number("fg3a") > _number("fga"),
             _pair("fg3a", _number("fg3a"), "fga", _number("fga"))),
        *[_not_negative(stat) for stat in NEVER_NEGATIVE],
    ]


def with_errors(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``errors``: the violations of each row in rule order."""
    return rows.withColumn("errors", F.array_compact(F.array(*[r.violation() for r in rules])))


def violations(rows: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """One row per violation with its printable text."""
    # All rule results are exploded and the empty ones dropped behind: this stays in
    # generated code, and each rule is evaluated once.
    return (
        rows.select(*keep, F.explode(F.array(*[r.violation() for r in rules])).alias("e"))
        .filter(F.col("e").isNotNull())
        .select(*keep, "e.field", "e.value", "e.rule", "e.message")
        .withColumn("text", violation_text())
    )


def violation_text() -> Column:
    value = F.coalesce(F.col("value"), F.lit("None"))
    return F.concat(
        F.col("field"), F.lit(": "), F.col("message"),
        F.lit(" (value="), value, F.lit(", rule="), F.col("rule"), F.lit(")"),
    )


def violation_summary(found: DataFrame, by: list[str]) -> DataFrame:
    return found.groupBy(*by, "field", "rule").agg(F.count("*").alias("violations"))


def passing(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    return with_errors(rows, rules).filter(F.size("errors") == 0).drop("errors")
