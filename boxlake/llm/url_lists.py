"""URL filters: every capture against the list entries that were active when it was fetched.

Dated entries (``list, key, at, action``: ``add`` or ``remove``) become validity intervals:
an entry holds from its time to the next entry of its list and key. Captures are joined as
of their time with the intervals of every key their URL falls under: its host and parent
domains (``d:example.com``) and its folders (``p:www.example.com/a/``).

Verdicts depend on URL and time only, so equal captures are judged once; a host with a third
of all captures makes one side of a join large that can be split, while the intervals of a
key never overlap. Of entries of one list, key and time a removal wins. Entries with a null
list, key, time or another action are ignored, as are repeated ones. Captures whose URL or
time is null, empty or without a host are under no list. Repeated captures get equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import let

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?([^/:?#@]++)(?::[0-9]*+)?([^?#]*+)"


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and dots at its end; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r"\.++$", "")


def path_of(url: Column) -> Column:
    """The path without query and fragment."""
    return F.regexp_extract(url, _URL, 2)


def keys_of(url: Column, depth: int) -> Column:
    """Keys that a URL falls under; folders up to ``depth`` below the host."""

    def domains(labels: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))

    def folders(host: Column) -> Column:
        def below(parts: Column) -> Column:
            # The last part is a file's name, or nothing.
            last = F.least(F.size(parts) - 1, F.lit(depth + 1))
            return F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(F.lit("p:"), host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))

        parts = F.split(path_of(url), "/", -1)
        return F.when(F.size(parts) > 1, let(parts, below)).otherwise(F.array().cast("array<string>"))

    return let(host_of(url), lambda host: F.when(host != "", F.concat(let(F.split(host, r"\."), domains), folders(host))))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, since, until``: when each key is on a list; an open end is null."""
    known = entries.filter(F.col("action").isin("add", "remove")).select("list", "key", "at", "action").dropna()
    # "remove" is the larger of the two.
    states = known.groupBy("list", "key", "at").agg(F.max("action").alias("action"))
    order = W.partitionBy("list", "key").orderBy("at")
    states = states.withColumn("until", F.lead("at").over(order))
    return states.filter("action = 'add'").select("list", "key", F.col("at").alias("since"), "until")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url``, ``fetched``) with ``lists``, the sorted names they were on.

    A column ``lists`` of the captures is replaced, all others stay, whatever their names are.
    """
    active = intervals(entries)
    # No folder of a URL deeper than any on a list can be on one.
    slashes = F.length("key") - F.length(F.replace(F.col("key"), F.lit("/"))) - 1
    depth = active.filter(F.col("key").startswith("p:")).agg(F.max(slashes)).first()[0]
    distinct = captures.select(F.col("url").alias("_url"), F.col("fetched").alias("_fetched")).dropna().distinct()
    keyed = distinct.select("_url", "_fetched", F.explode(keys_of(F.col("_url"), depth or 0)).alias("_key"))
    met = keyed.join(active, (F.col("_key") == F.col("key")) & (F.col("since") <= F.col("_fetched")), "inner")
    met = met.filter(F.col("until").isNull() | (F.col("_fetched") < F.col("until")))
    lists = met.groupBy("_url", "_fetched").agg(F.sort_array(F.collect_set("list")).alias("lists"))
    captures = captures.drop("lists")
    rows = captures.select(F.struct("*").alias("_row"), F.col("url").alias("_u"), F.col("fetched").alias("_f"))
    joined = rows.join(lists, (F.col("_u") == F.col("_url")) & (F.col("_f") == F.col("_fetched")), "left")
    return joined.select("_row.*", F.coalesce("lists", F.array().cast("array<string>")).alias("lists"))
