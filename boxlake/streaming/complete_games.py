"""The load driven by games whose documents have all landed.

The documents of a game arrive in any order. Each kind is a stream of its own, of which only
ids, times and file names are kept; the streams are joined by game, and a game comes out once
the last of its documents is there. A micro-batch then loads these games from the files that
hold their documents, instead of reading the landing area of their seasons again.

State is bounded by time: documents of one game may land ``DELAY`` apart, and what has waited
longer is dropped. A document that is later still, as one that only corrects a loaded game,
changes nothing here; a game left behind is found by the next daily run, which starts from
what is missing. Repeated documents come with their files, and the newest of them counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxlake.plans.daily import Load
from boxlake.sources.files import Working
from boxlake.sources.landing import LANDED_SCHEMAS
from boxlake.sources.warehouse import Warehouse

KINDS = ("summary", "traditional", "advanced", "players")
DELAY = "3 days"
MAX_FILES = 10_000


def documents(
    spark: SparkSession, landing_root: str, kind: str, fmt: str = "json", delay: str = DELAY, max_files: int = MAX_FILES
) -> DataFrame:
    """Stream of (game_id, season, <kind>_at, <kind>_file), without the documents themselves."""
    reader = spark.readStream.format(fmt).schema(LANDED_SCHEMAS[kind]).option("maxFilesPerTrigger", max_files)
    rows = reader.load(f"{landing_root}/{kind}").filter("game_id is not null and landed_at is not null")
    return rows.select(
        "game_id", "season", F.col("landed_at").alias(f"{kind}_at"), F.col("_metadata.file_path").alias(f"{kind}_file")
    ).withWatermark(f"{kind}_at", delay)


def complete_games(
    spark: SparkSession, landing_root: str, fmt: str = "json", delay: str = DELAY, kinds: tuple[str, ...] = KINDS,
    max_files: int = MAX_FILES,
) -> DataFrame:
    """(game_id, season, <first kind>_at, a file of each kind) of games with a document of every kind."""

    def joined(left: DataFrame, kind: str) -> DataFrame:
        right = documents(spark, landing_root, kind, fmt, delay, max_files)
        right = right.withColumnsRenamed({"game_id": "_game", "season": "_season"})
        first, own = F.col(f"{kinds[0]}_at"), F.col(f"{kind}_at")
        near = (own >= first - F.expr(f"INTERVAL {delay}")) & (own <= first + F.expr(f"INTERVAL {delay}"))
        same = (F.col("game_id") == F.col("_game")) & (F.col("season") == F.col("_season"))
        # A stream has one event time only: that of the first kind.
        return left.join(right, same & near).drop("_game", "_season", f"{kind}_at")

    return reduce(joined, kinds[1:], documents(spark, landing_root, kinds[0], fmt, delay, max_files))


def load_complete_games(
    spark: SparkSession, warehouse: Warehouse, landing_root: str, checkpoint: str, fmt: str = "json",
    delay: str = DELAY, max_files: int = MAX_FILES, **options,
) -> StreamingQuery:
    """Start a query that loads the games completed so far and then ends.

    A batch that is delivered twice finds its games loaded. The files of a batch are those of
    its games, so their number is bounded by what a trigger reads and the delay.
    """

    def load(batch: DataFrame, _: int) -> None:
        working = Working(batch.sparkSession, f"{warehouse.root}/_working")
        try:
            games = working.keep(batch, "complete")
            seasons = [r.season for r in games.select("season").distinct().orderBy("season").collect()]
            if not seasons:
                return
            files = {
                kind: [r.file for r in games.select(F.col(f"{kind}_file").alias("file")).distinct().collect()] for kind in KINDS
            }
            only = games.select("game_id", "season").dropDuplicates(["game_id", "season"])
            Load(batch.sparkSession, warehouse, landing_root, seasons, keep_going=True, only=only, files=files, fmt=fmt, **options).run()
        finally:
            working.close()

    return (
        complete_games(spark, landing_root, fmt, delay, max_files=max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
