"""Run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage_report(outcomes: DataFrame, by: list[str], ok: Column) -> DataFrame:
    """Success, failed and attempted games per group."""
    return outcomes.groupBy(*by).agg(
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failed"),
        F.count("*").alias("attempted"),
    )


def stage_counts(seasons: list[str], ok: Column) -> list[Column]:
    """The same for frames that are being written: aggregates for ``observe``, named by ``read_counts``."""
    counts = []
    for i, season in enumerate(seasons):
        mine = F.col("season") == season
        counts += [F.count_if(mine & ok).alias(f"success{i}"), F.count_if(mine & ~ok).alias(f"failed{i}")]
    return counts


def read_counts(seasons: list[str], seen: dict) -> dict[str, tuple[int, int]]:
    """(success, failed) of each season that had any."""
    found = {season: (seen[f"success{i}"], seen[f"failed{i}"]) for i, season in enumerate(seasons)}
    return {season: pair for season, pair in found.items() if any(pair)}


def backfill_summary(statuses: DataFrame) -> DataFrame:
    """Seasons done and failed, from one (season, ok) row per season."""
    return (
        statuses.groupBy("ok")
        .agg(F.count("*").alias("seasons"), F.sort_array(F.collect_set("season")).alias("_names"))
        .select("ok", "seasons", F.array_join("_names", ", ").alias("season_list"))
    )
