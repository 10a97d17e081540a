"""Single actions on a warehouse outside the regular load."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.operators import errors as E
from boxlake.operators import integrity as I
from boxlake.operators import merge as M
from boxlake.plans import standings as S
from boxlake.schemas import PLAYER_TOTALS, PLAYERBOX, SPINE, TABLES, TEAM_DAYS, TEAMBOX
from boxlake.sources.landing import games_from_ids
from boxlake.sources.warehouse import Append, Replace, Warehouse


def _now(run_ts: datetime | Column | None) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts or datetime.now(timezone.utc))


def add_game_ids(
    warehouse: Warehouse, game_ids: list[str], season: str, run_ts: datetime | None = None
) -> tuple[int, int]:
    """Insert ids given by the caller into the spine; returns (attempted, inserted)."""
    if not game_ids:
        return 0, 0
    given = warehouse.spark.createDataFrame([(list(map(str, game_ids)), season)], "game_ids array<string>, season string")
    batch, spine = games_from_ids(given), warehouse.read(SPINE.name)
    inserted = M.insert_counts(spine, batch, SPINE).first().inserted
    if inserted:
        fresh = M.insert_ignore(spine, batch, SPINE, ["season"], _now(run_ts))
        warehouse.commit({SPINE.name: Append(fresh)})
    return len(game_ids), inserted


def record_errors(
    warehouse: Warehouse, failures: DataFrame, retry_count: int = 0, run_ts: datetime | None = None
) -> None:
    """Append failures (process_name, game_id, error_type, error_message)."""
    warehouse.commit({"etl_errors": Append(E.error_rows(failures, _now(run_ts), retry_count))})


def mark_resolved(
    warehouse: Warehouse, process_name: str, game_id: str, run_ts: datetime | None = None
) -> int:
    """Close the open errors of a process and game; returns how many there were."""
    errors = warehouse.read("etl_errors", list(E.OPEN_PART))
    open_ones = errors.filter(
        (F.col("process_name") == process_name) & (F.col("game_id") == game_id) & ~F.col("is_resolved")
    ).count()
    if open_ones:
        done = warehouse.spark.createDataFrame([(process_name, game_id)], "process_name string, game_id string")
        warehouse.commit({"etl_errors": Replace(E.resolve(errors, done, _now(run_ts)).drop("changed"), E.OPEN_PART)})
    return open_ones


def compact(warehouse: Warehouse, names: list[str], seasons: list[str]) -> None:
    """Rewrite the seasons of some tables as one folder each: every load appends another."""
    for season in seasons:
        warehouse.commit({name: Replace(warehouse.read(name, [season]), (season,)) for name in names})


def delete_games(warehouse: Warehouse, games: DataFrame, seasons: list[str]) -> None:
    """Delete games of some seasons together with their box rows."""
    surviving = warehouse.read("fact_games", seasons).join(games.select("game_id").distinct(), "game_id", "left_anti")
    changes = {"fact_games": Replace(surviving, tuple(seasons))}
    for name, spec in TABLES.items():
        if any(fk.cascade and fk.table == "fact_games" for fk in spec.foreign_keys):
            boxes = I.cascade(warehouse.read(name, seasons), surviving)
            changes[name] = Replace(boxes, tuple(seasons))
    # Sums cannot be taken back row by row: those of the seasons are made anew.
    days = changes[TEAMBOX.name].rows.join(surviving.select("game_id", "game_date"), "game_id")
    changes[TEAM_DAYS.name] = Replace(S.team_days(days), tuple(seasons))
    changes[PLAYER_TOTALS.name] = Replace(S.player_totals(changes[PLAYERBOX.name].rows), tuple(seasons))
    warehouse.commit(changes)
