"""Reports on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _share(made: str, tried: str) -> Column:
    return F.sum(made) / F.nullif(F.sum(tried), F.lit(0))


def scored_games(box: DataFrame) -> DataFrame:
    """Team rows with the opponent's points; ``win`` is NULL when either score is.

    A game has one row per team, so the opponent's points are what the game's other row
    has: one window over a game instead of a join of the table with itself.
    """
    game = Window.partitionBy("game_id")
    others = F.count("pts").over(game) - F.col("pts").isNotNull().cast("int")
    rest = F.sum("pts").over(game) - F.coalesce("pts", F.lit(0))
    return box.withColumn("opponent_pts", F.when(others == 1, rest).cast("int")).withColumn(
        "win", (F.col("pts") > F.col("opponent_pts")).cast("int")
    )


def team_record(box: DataFrame) -> DataFrame:
    """Wins, losses and mean ratings per team and season."""
    return scored_games(box).groupBy("season", "team_id").agg(
        F.count("*").alias("games"),
        F.count_if(F.col("win") == 1).alias("wins"),
        F.count_if(F.col("pts") < F.col("opponent_pts")).alias("losses"),
        F.avg("off_rating").alias("avg_off_rating"),
        F.avg("def_rating").alias("avg_def_rating"),
        F.avg("net_rating").alias("avg_net_rating"),
    )


def win_trend(box: DataFrame, games: DataFrame) -> DataFrame:
    """Running wins and games of each team through a season.

    Days are summed first and running totals are taken over days, of which a team and
    season have few; the order inside one day is resolved day by day. A team with a
    very large share of the rows is thus spread over its days instead of being sorted
    in a single task.
    """
    played = scored_games(box.join(games.select("game_id", "game_date"), "game_id")).select(
        "season", "team_id", "game_date", "game_id", F.coalesce("win", F.lit(0)).alias("win")
    )
    team, day = ["season", "team_id"], ["season", "team_id", "game_date"]
    before = Window.partitionBy(*team).orderBy("game_date").rowsBetween(Window.unboundedPreceding, -1)
    days = played.groupBy(*day).agg(F.sum("win").alias("_wins"), F.count("*").alias("_games")).select(
        *day,
        F.coalesce(F.sum("_wins").over(before), F.lit(0)).alias("_wins_before"),
        F.coalesce(F.sum("_games").over(before), F.lit(0)).alias("_games_before"),
    )
    within = Window.partitionBy(*day).orderBy("game_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        played.withColumn("_wins_today", F.sum("win").over(within))
        .withColumn("_games_today", F.count("*").over(within))
        .join(days, day)
        .select(
            *day, "game_id", "win",
            (F.col("_wins_before") + F.col("_wins_today")).alias("running_wins"),
            (F.col("_games_before") + F.col("_games_today")).alias("running_games"),
        )
    )


def player_averages(box: DataFrame) -> DataFrame:
    """Per-game means and shooting shares per player and season."""
    return box.groupBy("season", "player_id").agg(
        F.count("*").alias("games"),
        *[F.avg(s).alias(f"avg_{s}") for s in ("pts", "reb", "ast", "stl", "blk", "tov")],
        _share("fgm", "fga").alias("fg_share"),
        _share("fg3m", "fg3a").alias("fg3_share"),
        _share("ftm", "fta").alias("ft_share"),
    )


def game_box(box: DataFrame, games: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Box score view with names.

    The join strategy of the dimensions is left to Spark, which broadcasts by measured
    size and splits skewed partitions otherwise.
    """
    return (
        box.join(games.select("game_id", "game_date"), "game_id")
        .join(teams.select("team_id", F.col("full_name").alias("team")), "team_id")
        .join(players.select("player_id", F.col("full_name").alias("player")), "player_id")
        .select(
            "game_id", "season", "game_date", "team_id", "team", "player_id", "player",
            "is_home", "minutes", "pts", "reb", "ast",
        )
    )


def season_change(box: DataFrame) -> DataFrame:
    """Change of a team's totals against its previous season."""
    totals = box.groupBy("team_id", "season").agg(F.sum("pts").alias("pts"), F.avg("net_rating").alias("net"))
    order = Window.partitionBy("team_id").orderBy("season")
    return totals.select(
        "team_id", "season", "pts",
        (F.col("pts") - F.lag("pts").over(order)).alias("pts_change"),
        (F.col("net") - F.lag("net").over(order)).alias("net_change"),
    )


def empty_team_boxes(box: DataFrame) -> DataFrame:
    """Team rows written without any statistic; no later run fills them again."""
    from boxlake.schemas import TEAM_RATINGS, TEAM_STATS

    return box.filter(F.coalesce(*[F.col(c).cast("double") for c in (*TEAM_STATS, *TEAM_RATINGS)]).isNull()).select(
        "game_id", "team_id", "season"
    )
