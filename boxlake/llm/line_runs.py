"""Line dedup: a run of lines that stands earlier too is deleted, so that its first copy stays.

Line ids of all documents are one sequence. Prefix doubling names the ``2**k`` lines from
each line on by the names of their two halves; suffixes of equal name are one interval of
the suffix array with that common prefix, and an interval of one suffix is dropped, so
levels shrink to what repeats. A run counts if it has ``MIN_CHARS`` code points (line ends
not counted). Which lines lie in such a run with an earlier copy is read off two windows
per line: the shortest run of that size that starts with the line, and the one that ends
with it. Each is named by the two overlapping powers of two that cover it, and all but the
first of its interval is deleted. Together these windows make up exactly the maximal runs:
a line of a run either ends a window of the run or lies in the one from the run's start.

All of it is joins and partial aggregates on 128-bit names. The text itself moves once, to
meet the numbers of its deleted lines. A line that a third of all documents share costs one
value per map task in the aggregates, and its joins are ones that can be split.

Null texts count as empty: one line without characters. Identical rows count as one document
and all get its result; rows that only share an id are ordered by a hash of their text; rows
without an id come last. Lines are divided by ``\\n`` only. An emptied text stays as a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import Scratch, let, text_of

MIN_CHARS = 40
LAST = (1 << 63) - 1
AT = ["doc", "tk", "n"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _order() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_of()).alias("tk")]


def _name(*parts) -> list[Column]:
    return [F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")]


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows whose name ``(a, b)`` repeats, with ``first``: where it stands first."""
    first = rows.groupBy("a", "b").agg(F.min(F.struct(*AT)).alias("first"), F.count("*").alias("k")).filter("k > 1")
    return rows.join(first.drop("k"), ["a", "b"])


def _part(level: DataFrame, tag: str) -> DataFrame:
    """A level's names and sizes under other column names, to be met at ``doc, tk, p``."""
    return level.select("doc", "tk", F.col("n").alias("p"), F.col("a").alias(f"a{tag}"), F.col("b").alias(f"b{tag}"), F.col("chars").alias(f"c{tag}"))


def _levels(docs: DataFrame, scratch: Scratch, min_chars: int) -> list[DataFrame]:
    """Level ``k`` has the repeated names of ``2**k`` lines that windows of the size can need."""
    split = docs.select(*_order(), F.posexplode(lines_of(text_of())).alias("n", "line"))
    lines = split.select(*AT, *_name("line"), F.length("line").cast("long").alias("chars"))
    levels = [scratch.keep(_repeated(lines).drop("first").distinct(), "level-0")]
    while True:
        below = levels[-1]
        ahead = below.withColumn("p", F.col("n") + (1 << (len(levels) - 1)))
        pairs = ahead.join(_part(below, "2"), ["doc", "tk", "p"]).filter(F.least("chars", "c2") < min_chars)
        level = pairs.select(*AT, *_name("a", "b", "a2", "b2"), (F.col("chars") + F.col("c2")).alias("chars"))
        level = scratch.keep(_repeated(level).drop("first"), f"level-{len(levels)}")
        if level.isEmpty():
            return levels
        levels.append(level)


def _windows(levels: list[DataFrame], min_chars: int, step: int) -> DataFrame:
    """First and last line of the shortest run of the size from (``step`` 1) or to (-1) each line."""
    rows = levels[0].select(*AT, F.lit(0).alias("length"), F.lit(0).cast("long").alias("have"))
    # A line of the size is a window of its own.
    short = levels[0].filter(F.col("chars") < min_chars).select(*AT)
    rows = rows.join(short, AT) if len(levels) > 1 else rows.filter(F.lit(False))
    for k in range(len(levels) - 1, -1, -1):
        at = F.col("n") + F.col("length") if step > 0 else F.col("n") - F.col("length") - ((1 << k) - 1)
        rows = rows.withColumn("p", at).join(_part(levels[k], "2"), ["doc", "tk", "p"], "left")
        fits = F.coalesce(F.col("have") + F.col("c2") < min_chars, F.lit(False))
        rows = rows.select(
            *AT, F.when(fits, F.col("length") + (1 << k)).otherwise(F.col("length")).alias("length"),
            F.when(fits, F.col("have") + F.col("c2")).otherwise(F.col("have")).alias("have"),
        )
    at = F.col("n") + F.col("length") if step > 0 else F.col("n") - F.col("length")
    rows = rows.withColumn("p", at).join(_part(levels[0], "2"), ["doc", "tk", "p"]).filter(F.col("have") + F.col("c2") >= min_chars)
    rows = rows.select("doc", "tk", F.least("n", "p").cast("int").alias("n"), (F.col("length") + 1).alias("length"))
    return rows.unionByName(levels[0].filter(F.col("chars") >= min_chars).select(*AT, F.lit(1).alias("length")))


def repeated_runs(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc, tk, start, stop``: the maximal runs of lines (both ends included) that stand earlier."""
    levels = _levels(docs, scratch, min_chars)
    windows = _windows(levels, min_chars, 1).unionByName(_windows(levels, min_chars, -1)).distinct()
    power = F.floor(F.log2(F.col("length").cast("double") + 0.5)).cast("int")
    windows = windows.withColumn("k", power).withColumn("p", F.col("n"))
    names = None
    for k, level in enumerate(levels):
        level = level.withColumn("k", F.lit(k))
        names = level if names is None else names.unionByName(level)
    one = names.select("doc", "tk", "k", F.col("n").alias("p"), F.col("a").alias("a1"), F.col("b").alias("b1"))
    two = names.select("doc", "tk", "k", F.col("n").alias("q"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    named = windows.join(one, ["doc", "tk", "k", "p"])
    named = named.withColumn("q", (F.col("n") + F.col("length") - F.pow(F.lit(2), F.col("k"))).cast("int")).join(two, ["doc", "tk", "k", "q"])
    named = named.select(*AT, "length", *_name("length", "a1", "b1", "a2", "b2"))
    later = _repeated(named).filter(F.struct(*AT) != F.col("first"))
    spans = later.select("doc", "tk", F.col("n").alias("start"), (F.col("n") + F.col("length") - 1).alias("stop"))
    order = W.partitionBy("doc", "tk").orderBy("start", "stop")
    spans = spans.distinct().withColumn("reach", F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1)))
    spans = spans.withColumn("island", F.sum(F.when(F.col("start") <= F.col("reach") + 1, 0).otherwise(1)).over(order))
    return spans.groupBy("doc", "tk", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def deduplicated(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs``, the text without its deleted lines, and what was deleted.

    Added: ``_lines``, ``_deleted`` (line numbers from 0, in order) and ``_runs``; columns of
    these names are replaced.
    """
    docs = docs.drop("_lines", "_deleted", "_runs")
    runs = repeated_runs(docs, scratch, min_chars)
    gone = runs.groupBy("doc", "tk").agg(
        F.sort_array(F.flatten(F.collect_list(F.sequence("start", "stop")))).alias("_deleted"), F.count("*").alias("_runs")
    ).withColumnsRenamed({"doc": "__doc", "tk": "__tk"})
    doc, tk = _order()
    # The columns of docs travel as one, whatever their names are.
    joined = docs.select(F.struct("*").alias("__row"), doc.alias("__d"), tk.alias("__t"))
    joined = joined.join(gone, (F.col("__d") == F.col("__doc")) & (F.col("__t") == F.col("__tk")), "left")
    joined = joined.select("__row.*", "_deleted", "_runs")

    def kept(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_deleted"))
        return F.array_join(F.transform(numbers, lambda i: lines[i]), "\n")

    text = F.when(F.col("_deleted").isNull(), F.col("text")).otherwise(let(lines_of(text_of()), kept))
    return joined.withColumns({
        "_lines": F.size(lines_of(text_of())).cast("long"), "text": text, "_runs": F.coalesce("_runs", F.lit(0).cast("long")),
        "_deleted": F.coalesce("_deleted", F.array().cast("array<int>")),
    })
