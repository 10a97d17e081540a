"""The daily load driven by newly landed files.

The stream only watches for files: it reads their paths, never their content. Every
micro-batch runs the incremental load for the seasons that received files, and the lineup
load for those that received lineup tables. A batch that is delivered twice finds nothing
left to do, since the load starts from what is missing and lineups are upserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxlake.plans.daily import Load
from boxlake.sources.warehouse import Warehouse

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_SEASON_IN_PATH = r"/season=([^/]+)/"
_KIND_IN_PATH = r"/([^/]+)/season="
# A first start over a full landing area is cut into batches of so many files.
MAX_FILES = 10_000


def landed_files(spark: SparkSession, landing_root: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """Stream of (path, kind, season) over all files of the landing area."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(f"{landing_root}/*/*/*")
    return files.select(
        "path", F.regexp_extract("path", _KIND_IN_PATH, 1).alias("kind"), F.regexp_extract("path", _SEASON_IN_PATH, 1).alias("season")
    )


def load_new_files(
    spark: SparkSession, warehouse: Warehouse, landing_root: str, checkpoint: str, max_files: int | None = MAX_FILES, **options
) -> StreamingQuery:
    """Start a query that loads everything landed so far and then ends."""

    def load(batch: DataFrame, _: int) -> None:
        landed = batch.select(F.col("kind") == "lineups", "season").distinct().orderBy("season").collect()
        games = [season for lineups, season in landed if not lineups]
        lineups = [season for lineups, season in landed if lineups]
        if games:
            Load(batch.sparkSession, warehouse, landing_root, games, keep_going=True, **options).run()
        if lineups:
            Load(batch.sparkSession, warehouse, landing_root, lineups, **options).run_lineups()

    return (
        landed_files(spark, landing_root, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
