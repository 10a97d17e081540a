"""Readers for the landing area.

Layout: ``<root>/<kind>/season=<season>/*``, JSON lines or parquet, one line per landed
document. ``payload`` holds the document as JSON text (a nested object in a JSON line is
read as its text). Documents keep their JSON types, since their shape drifts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import parsing as P
from boxlake.sources.files import exists, file_system

# Request parameters of the season finder and its required columns.
LEAGUE = "00"
SEASON_TYPE = "Regular Season"
FINDER_COLUMNS = ("GAME_ID", "WL")

_PER_GAME = "game_id string, landed_at timestamp, payload string, season string"
LANDED_SCHEMAS = {
    "finder": "league string, season_type string, payload string, season string",
    "summary": _PER_GAME,
    "traditional": _PER_GAME,
    "advanced": _PER_GAME,
    "players": _PER_GAME,
    "lineups": "team_id int, group_quantity int, landed_at timestamp, payload string, season string",
}


# A line that is no JSON, and the mark at both ends of a parquet file.
_BROKEN, _MAGIC = "_broken", b"PAR1"


def landed(
    spark: SparkSession, root: str, kind: str, seasons: list[str] | None = None, fmt: str = "json",
    since: datetime | None = None, files: list[str] | None = None, broken: bool = False,
) -> DataFrame:
    """Landed documents of one kind; only the partitions of ``seasons`` (or only ``files``) are read.

    With ``broken``, lines that are no JSON stay, their file named in ``broken_file``; otherwise
    they are left out.
    """
    schema, path = LANDED_SCHEMAS[kind], f"{root}/{kind}"
    if not exists(spark, path) or files == []:
        return spark.createDataFrame([], schema + (", broken_file string" if broken else ""))
    reader = spark.read.format(fmt).option("basePath", path)
    if fmt == "json":
        reader = reader.schema(f"{schema}, {_BROKEN} string").option("columnNameOfCorruptRecord", _BROKEN)
        rows = reader.load(files or path)
        file = F.when(F.col(_BROKEN).isNotNull(), F.col("_metadata.file_path"))
    else:
        rows, file = reader.schema(schema).load(files or path), F.lit(None).cast("string")
    if seasons is not None:
        rows = rows.filter(F.col("season").isin(list(seasons)))
    if broken:
        rows = rows.withColumn("broken_file", file)
    elif fmt == "json":
        rows = rows.filter(F.col(_BROKEN).isNull())
    rows = rows.drop(_BROKEN)
    if since is not None and "landed_at" in rows.columns:
        recent = F.col("landed_at") >= F.lit(since)
        rows = rows.filter(recent | F.col("broken_file").isNotNull() if broken else recent)
    return rows


def broken_files(spark: SparkSession, root: str, kind: str, seasons: list[str], fmt: str = "json") -> DataFrame:
    """(season, file) of files that cannot be read as a whole.

    Lines that are no JSON are found by reading them. A parquet file is known by its footer: a
    scan without columns counts the rows of all files that have one, and of the listed files
    that gave no row, both ends are looked at.
    """
    empty = spark.createDataFrame([], "season string, file string")
    if not exists(spark, f"{root}/{kind}"):
        return empty
    if fmt == "json":
        rows = landed(spark, root, kind, seasons, fmt, broken=True)
        # The reader wants a column of the data beside the mark of a broken line.
        rows = rows.filter("broken_file is not null and coalesce(length(payload), 0) >= 0")
        return rows.select("season", F.col("broken_file").alias("file")).distinct()
    listing = spark.read.format("binaryFile").option("basePath", f"{root}/{kind}").option("pathGlobFilter", "[!_.]*").load(f"{root}/{kind}")
    listing = listing.filter(F.col("season").isin(list(seasons))).select("season", F.col("path").alias("file"), "length")
    rows = spark.read.schema(LANDED_SCHEMAS[kind]).option("ignoreCorruptFiles", "true").parquet(f"{root}/{kind}")
    counted = rows.filter(F.col("season").isin(list(seasons))).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    doubtful = listing.join(counted, "file", "left_anti")

    def whole(file: str, length: int) -> bool:
        fs, where = file_system(spark, file)
        if length < 12:
            return False
        stream = fs.open(where)
        try:
            ends = []
            for place in (0, length - len(_MAGIC)):
                stream.seek(place)
                ends.append(bytes(stream.read() & 255 for _ in _MAGIC))
            return ends == [_MAGIC, _MAGIC]
        finally:
            stream.close()

    found = [(r.season, r.file) for r in doubtful.toLocalIterator() if not whole(r.file, r.length)]
    return spark.createDataFrame(found, "season string, file string") if found else empty


def finder_rows(landed_finder: DataFrame, league: str = LEAGUE, season_type: str = SEASON_TYPE) -> DataFrame:
    """Finder rows of the wanted competition, with column presence kept for checking.

    A line that could not be read (``broken_file``, if there is such a column) may have been
    of any competition: it stays, as a row that cannot be read.
    """
    wanted = (F.col("league") == league) & (F.col("season_type") == season_type)
    if "broken_file" in landed_finder.columns:
        wanted = wanted | F.col("broken_file").isNotNull()
    docs = landed_finder.filter(wanted).select(
        "season", P.parse_document(F.col("payload")).alias("doc")
    ).withColumn("readable", F.col("doc").isNotNull())
    fields = {name: P.get(F.col("doc"), f"$.{name}") for name in FINDER_COLUMNS}
    return docs.select(
        "season", "readable",
        *[v.isNotNull().alias(f"has_{n.lower()}") for n, v in fields.items()],
        P.to_text(fields["GAME_ID"]).alias("game_id"),
        P.to_text(fields["WL"]).alias("wl"),
    )


def finder_status(rows: DataFrame) -> DataFrame:
    """(season, ok): a season is refused when a required column is in none of its rows.

    So is one with a payload that cannot be read: which games it named is not known.
    """
    present = [F.bool_or(f"has_{n.lower()}") for n in FINDER_COLUMNS]
    return rows.groupBy("season").agg(F.least(*present, F.bool_and("readable")).alias("ok"))


def completed_games(rows: DataFrame) -> DataFrame:
    """Distinct (game_id, season) of completed games; each game is listed once per team."""
    done = rows.filter(F.col("wl").isNotNull() & F.col("game_id").isNotNull())
    return done.select("game_id", "season").dropDuplicates(["game_id", "season"])


def games_from_ids(ids: DataFrame, column: str = "game_ids") -> DataFrame:
    """(game_id, season) rows from an array of ids per season."""
    return ids.select(F.explode(column).alias("game_id"), "season")
