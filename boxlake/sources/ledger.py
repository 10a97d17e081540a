"""Tab-separated failure ledger.

A line is ``game_id TAB error_type TAB message``; lineup lines carry ``team_id`` after
the game. The message is the rest of the line and may itself contain tabs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GAME_FIELDS = ("game_id", "error_type", "message")
LINEUP_FIELDS = ("game_id", "team_id", "error_type", "message")


def format_lines(failures: DataFrame, fields: tuple[str, ...] = GAME_FIELDS) -> DataFrame:
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return failures.select(F.concat_ws("\t", *texts).alias("value"))


def parse_lines(lines: DataFrame, fields: tuple[str, ...] = GAME_FIELDS, keep: tuple[str, ...] = ()) -> DataFrame:
    parts = F.split("value", "\t", len(fields))
    return lines.select(*keep, *[F.get(parts, F.lit(i)).alias(f) for i, f in enumerate(fields)])


def append(failures: DataFrame, path: str, fields: tuple[str, ...] = GAME_FIELDS) -> None:
    """Append failures with a ``process`` column, one folder per process."""
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    lines = failures.select("process", F.concat_ws("\t", *texts).alias("value"))
    lines.write.mode("append").partitionBy("process").text(path)


def read(spark: SparkSession, path: str, fields: tuple[str, ...] = GAME_FIELDS) -> DataFrame:
    lines = spark.read.schema("value string, process string").text(path)
    return parse_lines(lines, fields, keep=("process",))


def read_file(spark: SparkSession, path: str, fields: tuple[str, ...] = GAME_FIELDS) -> DataFrame:
    """A ledger kept as plain text files of one process."""
    return parse_lines(spark.read.text(path), fields)
