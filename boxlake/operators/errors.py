"""The error table: append, resolve, retry list and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.schemas import ETL_ERRORS

# Limit of a retry list when none (or zero) is given, rows of the report
# of recent errors, and the default length of a summary window.
RETRY_LIMIT, RECENT_ROWS, SUMMARY_DAYS = 1000, 10, 7
# Seconds to wait before the first, second and every later retry.
RETRY_WAITS = (120, 200, 250)
#: Part of the table that holds open errors.
OPEN_PART = ("false",)


def error_rows(rejects: DataFrame, run_ts: Column, retry_count: int | Column = 0) -> DataFrame:
    """Rejects (process_name, game_id, error_type, error_message) as new error rows."""
    retries = retry_count if isinstance(retry_count, Column) else F.lit(retry_count)
    identity = F.xxhash64("process_name", "game_id", "error_type", "error_message", run_ts.cast("timestamp"))
    given = {
        "id": identity,
        "retry_count": retries,
        "last_retry_at": F.when(retries > 0, run_ts.cast("timestamp")),
        "is_resolved": F.lit(False),
        "created_at": run_ts,
        **{c: F.col(c) for c in ("process_name", "game_id", "error_type", "error_message")},
    }
    return rejects.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ETL_ERRORS.schema]
    )


def resolve(errors: DataFrame, done: DataFrame, run_ts: Column) -> DataFrame:
    """Close the open errors of every (process_name, game_id) in ``done``.

    ``changed`` marks the closed rows; their number is the result of the update.
    """
    marks = done.select("process_name", "game_id").distinct().withColumn("_done", F.lit(True))
    closing = F.col("_done").isNotNull() & ~F.col("is_resolved")
    return (
        errors.join(marks, ["process_name", "game_id"], "left")
        .withColumn("changed", F.coalesce(closing, F.lit(False)))
        .withColumn("resolved_at", F.when(F.col("changed"), run_ts.cast("timestamp")).otherwise(F.col("resolved_at")))
        .withColumn("is_resolved", F.col("is_resolved") | F.col("changed"))
        .select(*errors.columns, "changed")
    )


def _open(errors: DataFrame) -> DataFrame:
    return errors.filter(~F.col("is_resolved"))


def failed_game_ids(errors: DataFrame, process_name: str, limit: int | None = None) -> DataFrame:
    """Distinct open game ids of a process, the most recently failed first."""
    return (
        _open(errors)
        .filter((F.col("process_name") == process_name) & F.col("game_id").isNotNull())
        .groupBy("game_id")
        .agg(F.max("created_at").alias("last_failed_at"))
        .orderBy(F.desc("last_failed_at"), "game_id")
        .limit(limit or RETRY_LIMIT)
    )


def attempts(errors: DataFrame) -> DataFrame:
    """(process_name, game_id, attempts, last_failed_at) of what is open, for each game of a process."""
    return _open(errors).filter(F.col("game_id").isNotNull()).groupBy("process_name", "game_id").agg(
        F.max("retry_count").alias("attempts"), F.max("created_at").alias("last_failed_at")
    )


def due(tried: DataFrame, as_of: Column) -> DataFrame:
    """Those of ``attempts`` whose wait is over; it grows with the number of retries."""
    waits = F.array(*map(F.lit, RETRY_WAITS))
    wait = F.get(waits, F.least("attempts", F.lit(len(RETRY_WAITS) - 1)))
    return tried.filter(F.col("last_failed_at") + F.make_dt_interval(secs=wait) <= as_of.cast("timestamp"))


def newest_failures(tried: DataFrame, process_name: str, limit: int | None = None) -> DataFrame:
    """The games of a process that failed last; all of them without a limit."""
    found = tried.filter(F.col("process_name") == process_name).select("game_id", "attempts", "last_failed_at")
    return found if limit is None else found.orderBy(F.desc("last_failed_at"), "game_id").limit(limit)


def open_game_ids(errors: DataFrame, process_name: str) -> DataFrame:
    """The whole set behind ``failed_game_ids``, for joins."""
    return (
        _open(errors)
        .filter((F.col("process_name") == process_name) & F.col("game_id").isNotNull())
        .select("game_id")
        .distinct()
    )


def recent(errors: DataFrame, as_of: Column, days: int = SUMMARY_DAYS) -> DataFrame:
    return errors.filter(F.col("created_at") >= as_of.cast("timestamp") - F.make_dt_interval(F.lit(days)))


def totals(errors: DataFrame) -> DataFrame:
    return errors.agg(
        F.count("*").alias("total_errors"), F.count_if(~F.col("is_resolved")).alias("unresolved")
    )


def count_by(errors: DataFrame, column: str) -> DataFrame:
    return errors.groupBy(column).agg(F.count("*").alias("errors"))


def summary(errors: DataFrame, as_of: Column, days: int = SUMMARY_DAYS) -> DataFrame:
    """One row: totals plus the counts by process and by type as maps.

    The maps hold one entry per process or error type. One pass counts by process, by type
    and in all, so what is gathered into them is the list of distinct names, not the errors.
    """
    by = ("process_name", "error_type")
    sets = recent(errors, as_of, days).groupingSets([[by[0]], [by[1]], []], *by).agg(
        F.grouping_id(*by).alias("level"), F.count("*").alias("errors"), F.count_if(~F.col("is_resolved")).alias("open"),
    )

    def total(column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("level") == 3, F.col(column))), F.lit(0)).cast("long")

    def as_map(column: str, level: int) -> Column:
        return F.map_from_entries(F.collect_list(F.when(F.col("level") == level, F.struct(column, "errors"))))

    return sets.agg(
        total("errors").alias("total_errors"), total("open").alias("unresolved"),
        as_map(by[0], 1).alias("by_process"), as_map(by[1], 2).alias("by_type"),
    )


def recent_open(errors: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return (
        _open(errors)
        .select("id", "process_name", "game_id", "error_type", "error_message", "created_at")
        .orderBy(F.desc("created_at"), F.desc("id"))
        .limit(n)
        .drop("id")
    )
