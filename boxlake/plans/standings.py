"""Reports that follow the loads instead of reading all facts again.

The sums behind them are tables of their own: a row for each team and day, and one for each
player and season. The rows that a load appends are summed in the same way and added; only
the seasons of the load are read and written, in the commit of the facts. Games are loaded as
a whole and once, so sums of disjoint loads add up to the sums of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.plans.marts import scored_games
from boxlake.schemas import PLAYER_MEANS, PLAYER_SHARES, PLAYER_TOTALS, TEAM_DAYS, TableSpec

RATINGS = ("off_rating", "def_rating", "net_rating")


def _shaped(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def team_days(box: DataFrame) -> DataFrame:
    """Sums of team rows (with ``game_date``) by team and day; all rows of a game are there or none."""
    rows = scored_games(box).groupBy(*TEAM_DAYS.key).agg(
        F.count("*").alias("games"),
        F.count_if(F.col("win") == 1).alias("wins"),
        F.count_if(F.col("pts") < F.col("opponent_pts")).alias("losses"),
        F.sum("pts").alias("pts_sum"),
        *[F.sum(r).alias(f"{r}_sum") for r in RATINGS],
        *[F.count(r).alias(f"{r}_n") for r in RATINGS],
    )
    return _shaped(rows, TEAM_DAYS)


def player_totals(box: DataFrame) -> DataFrame:
    rows = box.groupBy(*PLAYER_TOTALS.key).agg(
        F.count("*").alias("games"),
        *[F.sum(s).alias(f"{s}_sum") for s in (*PLAYER_MEANS, *PLAYER_SHARES)],
        *[F.count(s).alias(f"{s}_n") for s in PLAYER_MEANS],
    )
    return _shaped(rows, PLAYER_TOTALS)


def added(kept: DataFrame, news: DataFrame, spec: TableSpec) -> DataFrame:
    """The kept sums together with those of new rows; a sum of nothing stays NULL."""
    sums = [F.sum(c).alias(c) for c in spec.columns if c not in spec.key]
    return _shaped(kept.unionByName(news).groupBy(*spec.key).agg(*sums), spec)


def _mean(name: str) -> Column:
    return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def team_record(days: DataFrame) -> DataFrame:
    """``marts.team_record`` from the sums."""
    return days.groupBy("season", "team_id").agg(
        *[F.sum(c).alias(c) for c in ("games", "wins", "losses")], *[_mean(r).alias(f"avg_{r}") for r in RATINGS]
    )


def season_change(days: DataFrame) -> DataFrame:
    """``marts.season_change`` from the sums."""
    totals = days.groupBy("team_id", "season").agg(F.sum("pts_sum").alias("pts"), _mean("net_rating").alias("net"))
    order = Window.partitionBy("team_id").orderBy("season")
    return totals.select(
        "team_id", "season", "pts",
        (F.col("pts") - F.lag("pts").over(order)).alias("pts_change"),
        (F.col("net") - F.lag("net").over(order)).alias("net_change"),
    )


def player_averages(totals: DataFrame) -> DataFrame:
    """``marts.player_averages`` from the sums."""

    def share(made: str, tried: str) -> Column:
        return F.col(f"{made}_sum") / F.nullif(F.col(f"{tried}_sum"), F.lit(0))

    return totals.select(
        "season", "player_id", "games",
        *[(F.col(f"{s}_sum") / F.nullif(F.col(f"{s}_n"), F.lit(0))).alias(f"avg_{s}") for s in PLAYER_MEANS],
        share("fgm", "fga").alias("fg_share"), share("fg3m", "fg3a").alias("fg3_share"), share("ftm", "fta").alias("ft_share"),
    )


def win_trend_since(box: DataFrame, games: DataFrame, days: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of ``marts.win_trend`` from each team's first changed day on.

    ``changed`` has (season, team_id, first_day); ``days`` are the sums of all days. What stands
    before the first day is a sum over the kept days, so earlier games are not read: a filter on
    the day prunes them. Rows of earlier days of the report stay as they are.
    """
    team = ["season", "team_id"]
    first = changed.groupBy(*team).agg(F.min("first_day").alias("first_day"))
    before = days.join(first, team).filter("game_date < first_day").groupBy(*team).agg(
        F.sum("wins").alias("wins_before"), F.sum("games").alias("games_before")
    )
    # A game is scored by both of its rows, also where only one team is asked for.
    teams_games = box.join(games.select("game_id", "game_date"), "game_id").join(first, team, "left")
    wanted = teams_games.withColumn("wanted", F.coalesce(F.col("game_date") >= F.col("first_day"), F.lit(False)))
    scored = scored_games(wanted).filter("wanted").select(
        *team, "game_date", "game_id", F.coalesce("win", F.lit(0)).alias("win")
    )
    day = [*team, "game_date"]
    by_day = scored.groupBy(*day).agg(F.sum("win").alias("_wins"), F.count("*").alias("_games"))
    earlier = Window.partitionBy(*team).orderBy("game_date").rowsBetween(Window.unboundedPreceding, -1)
    by_day = by_day.select(
        *day, F.coalesce(F.sum("_wins").over(earlier), F.lit(0)).alias("_wins"),
        F.coalesce(F.sum("_games").over(earlier), F.lit(0)).alias("_games"),
    )
    within = Window.partitionBy(*day).orderBy("game_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = scored.withColumn("_own", F.sum("win").over(within)).withColumn("_place", F.count("*").over(within))
    zero = F.lit(0)
    return rows.join(by_day, day).join(before, team, "left").select(
        *day, "game_id", "win",
        (F.coalesce("wins_before", zero) + F.col("_wins") + F.col("_own")).alias("running_wins"),
        (F.coalesce("games_before", zero) + F.col("_games") + F.col("_place")).alias("running_games"),
    )


def extended_win_trend(kept: DataFrame, box: DataFrame, games: DataFrame, days: DataFrame, changed: DataFrame) -> DataFrame:
    """The report after a load: kept rows before the first changed day, and the days from it on."""
    first = changed.groupBy("season", "team_id").agg(F.min("first_day").alias("first_day"))
    still = kept.join(first, ["season", "team_id"], "left").filter("first_day is null or game_date < first_day").drop("first_day")
    return still.unionByName(win_trend_since(box, games, days, changed).select(*kept.columns))
