"""Incremental work lists: what is known upstream but not loaded yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPINE_ORDER = ("game_id",)
GAME_ORDER = ("game_date", "game_id")


def _in_seasons(df: DataFrame, seasons: list[str] | None) -> DataFrame:
    return df if seasons is None else df.filter(F.col("season").isin(list(seasons)))


def missing_games(spine: DataFrame, games: DataFrame, seasons: list[str] | None = None) -> DataFrame:
    """Spine games without a game fact."""
    todo = _in_seasons(spine, seasons).select("game_id", "season")
    return todo.join(games.select("game_id"), "game_id", "left_anti")


def missing_boxes(games: DataFrame, boxes: DataFrame, seasons: list[str] | None = None) -> DataFrame:
    """Games without any box row; one row is enough to count as loaded.

    The box keys are made distinct first: that sends one row per game and map partition
    through the shuffle the join needs anyway, however many rows a game has.
    """
    todo = _in_seasons(games, seasons).select(
        "game_id", "season", "game_date", "home_team_id", "away_team_id"
    )
    return todo.join(boxes.select("game_id").distinct(), "game_id", "left_anti")


def first_n(todo: DataFrame, order: tuple[str, ...], n: int | None) -> DataFrame:
    """The first ``n`` entries of a work list in its order; no limit means no sort."""
    if n is None:
        return todo
    if n < 0:
        raise ValueError("a work list limit cannot be negative")
    return todo.orderBy(*order).limit(n)


def first_n_per_season(todo: DataFrame, order: tuple[str, ...], n: int | None) -> DataFrame:
    """The first ``n`` entries of every season.

    Entries are counted by blocks that follow the order (days, or leading characters of the
    id). Blocks before the place where ``n`` is reached are taken whole, and only the block
    at that place is sorted: a season of very many games is never ordered in one task.
    """
    if n is None:
        return todo
    if n < 0:
        raise ValueError("a work list limit cannot be negative")
    block = F.col(order[0]) if len(order) > 1 else F.substring(order[0], 1, 8)
    todo = todo.withColumn("_block", block)
    before = Window.partitionBy("season").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = todo.groupBy("season", "_block").agg(F.count("*").alias("_size"))
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).filter(F.col("_before") < n)
    blocks = blocks.withColumnsRenamed({"season": "_season", "_block": "_at"})
    taken = todo.join(blocks, F.col("season").eqNullSafe(F.col("_season")) & F.col("_block").eqNullSafe(F.col("_at")))
    whole = taken.filter(F.col("_before") + F.col("_size") <= n)
    place = F.row_number().over(Window.partitionBy("season", "_block").orderBy(*order))
    cut = taken.filter(F.col("_before") + F.col("_size") > n).withColumn("_place", place)
    cut = cut.filter(F.col("_before") + F.col("_place") <= n).drop("_place")
    return whole.unionByName(cut).drop("_block", "_season", "_at", "_size", "_before")


def only_failed(todo: DataFrame, failed: DataFrame) -> DataFrame:
    """Retry list: the part of a work list that failed before."""
    return todo.join(failed.select("game_id"), "game_id", "left_semi")


def with_attempts(todo: DataFrame, failed: DataFrame) -> DataFrame:
    """Retry list with the number of retries that each game has behind it."""
    return todo.join(failed.select("game_id", "attempts"), "game_id")
