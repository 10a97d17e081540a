"""Benchmark decontamination by templates: re-parameterised questions are found as well.

Names (capitalised words inside a sentence), numbers and units become typed placeholders
that remember their value. Every window of ``WIDTH`` template tokens of a document is joined
by hash with the windows of the benchmark items. Where windows of one item meet a document
at one offset, a value of an item's slot should stand for one value of the document's: the one
in most of these windows (of equally many the item's own, then the least). A window with
another value does not count, unless all its slots have the item's own values. An item has
leaked into a document if good windows cover ``MIN_COVER`` of its windows.

Names are told by capital letters, so a text in capitals or title case has hardly a window
left. A second search is therefore made without case and names, with numbers and units
as the only placeholders, and what either search finds has leaked.

Both sides' windows are made once per search: the items' windows and the hits are written
tables, since several of the following steps read them and templates cost most of the time.
Hits are written where they are found and dealt out from there, so the tasks that make
templates hold no pages of sorts and shuffles.

The benchmark's windows are broadcast in blocks of a bounded number of rows, one join for
each block, so documents are never shuffled for the search, whatever they share. ``clean``
broadcasts the ids of what leaked if they are at most a block, and else hashes them.

Null and empty texts, and texts or items of fewer than ``WIDTH`` tokens, have no windows and
no leaks. Repeated items are items of their own. Identical rows count as one document and
get equal results; rows that share an id are told apart by a hash of their text. An empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import Scratch, let, text_of

WIDTH = 8
MIN_COVER = 0.25
#: Rows of a broadcast block: about 200 bytes each.
BLOCK_ROWS = 200_000
#: Texts that a task of the search reads at once: 4,096 as by default are arrays of 16 MB and
#: more, for which a heap without so much room in one piece grows.
READ_ROWS = 256
UNITS = (
    "mm cm m km inch inches feet foot yard yards mile miles mg g kg ton tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros pound pounds percent degrees"
).split()
NAMES = r"([\p{L},;:] )(\p{Lu}\p{L}*+(?: \p{Lu}\p{L}*+)*+)"
NUMBERS = r"[0-9]++(?:[.,:/][0-9]++)*+"
TOKENS = r"⟨[^⟩]*+⟩|[\p{L}\p{M}]++"


def template_tokens(text: Column, names: bool = True) -> Column:
    """Words, and placeholders such as ``⟨n 12⟩``, ``⟨u km⟩`` or ``⟨p Ann Lee⟩``.

    Without ``names`` the text is folded to lower case (by way of capitals, for ``ß``).
    """
    text = F.regexp_replace(text, NAMES, "$1⟨p $2⟩") if names else F.lower(F.upper(text))
    text = F.regexp_replace(text, NUMBERS, "⟨n $0⟩")
    text = F.regexp_replace(text, r"(⟨n [^⟩]*+⟩) ?(" + "|".join(UNITS) + r")\b", "$1⟨u $2⟩")
    text = F.regexp_replace(text, r"([$€£])(⟨n )", "⟨u $1⟩$2")
    return F.regexp_extract_all(text, F.lit(TOKENS), 0)


def _windows(rows: DataFrame, keys: list[str], names: bool) -> DataFrame:
    """Each window's hash ``h``, place ``at`` (from 0) beside the tokens of its text."""

    def hashed(canon: Column) -> Column:
        starts = F.when(F.size(canon) >= WIDTH, F.sequence(F.lit(1), F.size(canon) - (WIDTH - 1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(canon, i, WIDTH)))

    def both(tokens: Column) -> Column:
        canon = F.transform(tokens, lambda t: F.xxhash64(F.when(t.startswith("⟨"), F.substring(t, 1, 2)).otherwise(F.lower(t))))
        return F.struct(tokens.alias("tokens"), let(canon, hashed).alias("hashes"))

    # The generator keeps the arrays from being computed anew by what reads them.
    rows = rows.select(*keys, F.inline(F.array(let(template_tokens(F.col("text"), names), both))))
    return rows.select(*keys, "tokens", F.posexplode("hashes").alias("at", "h"))


def _slots(tokens: str, at: Column) -> Column:
    return F.filter(F.slice(tokens, at + 1, WIDTH), lambda t: t.startswith("⟨"))


def _order() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text_of()).alias("tk")]


def leaks(docs: DataFrame, benchmark: DataFrame, names: bool = True) -> DataFrame:
    """``doc, tk, item_id, ik, cover, exact``: items that leaked into documents.

    ``exact``: does every slot have the item's own value, at one offset? ``doc, tk`` name a
    document, ``ik`` an item.
    Without ``names``, case is ignored and names are words.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"), F.xxhash64("item_id", text_of()).alias("ik"))
    wanted = _windows(items.dropDuplicates(["ik"]), ["item_id", "ik"], names)
    wanted = wanted.select("item_id", "ik", F.col("at").alias("item_at"), "h", _slots("tokens", F.col("at")).alias("item_slots"))
    scratch = Scratch(docs.sparkSession, read_rows=READ_ROWS)
    wanted = scratch.keep(wanted, "item_windows")
    size = wanted.groupBy("ik").agg(F.count("*").alias("windows"))
    blocks = -(-wanted.count() // BLOCK_ROWS)
    of = docs.select(*_order(), text_of().alias("text"))
    found = []
    for b in range(max(blocks, 1)):
        part = wanted.filter(F.pmod("h", F.lit(max(blocks, 1))) == b)
        hits = _windows(of, ["doc", "tk"], names).join(F.broadcast(part), "h")
        found.append(hits.select("doc", "tk", "item_id", "ik", "item_at", (F.col("at") - F.col("item_at")).alias("offset"), "item_slots", _slots("tokens", F.col("at")).alias("slots")))
    hits = scratch.keep(reduce(DataFrame.unionByName, found), "found")

    offset = ["doc", "tk", "item_id", "ik", "offset"]
    # Identical rows are one document; with a fixed offset a window of the item stands once.
    hits = hits.groupBy(*offset, "item_at").agg(F.first(F.array_distinct(F.arrays_zip("item_slots", "slots"))).alias("pairs"))
    hits = scratch.keep(hits, "hits")
    slots = hits.select(*offset, "item_at", F.inline("pairs"))
    often = slots.groupBy(*offset, "item_slots", "slots").agg(F.count("*").alias("k"))
    stands = F.min(F.struct((-F.col("k")).alias("k"), (F.col("slots") != F.col("item_slots")).alias("other"), "slots"))["slots"]
    stands = often.groupBy(*offset, "item_slots").agg(stands.alias("stands"))
    changed = slots.filter("slots <> item_slots").join(stands, [*offset, "item_slots"])
    bad = changed.filter(F.col("slots") != F.col("stands")).select(*offset, "item_at").distinct()
    inexact = changed.select(*offset, F.lit(False).alias("exact")).distinct()
    good = hits.drop("pairs").join(bad, [*offset, "item_at"], "left_anti").join(inexact, offset, "left")
    good = good.withColumn("exact", F.coalesce("exact", F.lit(True)))
    cover = good.groupBy("doc", "tk", "item_id", "ik").agg(F.count_distinct("item_at").alias("met"), F.max("exact").alias("exact"))
    cover = cover.join(size, "ik").withColumn("cover", F.col("met") / F.col("windows"))
    return cover.filter(F.col("cover") >= MIN_COVER).select("doc", "tk", "item_id", "ik", "cover", "exact")


def either(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc, tk, item_id, exact`` of what either search finds; the search with names tells ``exact`` first."""
    found = leaks(docs, benchmark).withColumn("named", F.col("exact")).unionByName(
        leaks(docs, benchmark, names=False).withColumn("named", F.lit(None).cast("boolean"))
    )
    return found.groupBy("doc", "tk", "item_id", "ik").agg(F.coalesce(F.max("named"), F.max("exact")).alias("exact"))


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc, tk`` and what leaked: ``n_items``, ``n_exact`` and ``items``, ids joined by commas."""
    return either(docs, benchmark).groupBy("doc", "tk").agg(
        F.count("*").alias("n_items"), F.count_if("exact").alias("n_exact"),
        F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"),
    )


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, n_exact, items`` of every document; clean ones have zeros and ''."""
    own = docs.select("doc_id", *_order())
    found = leaked(docs, benchmark).withColumnRenamed("doc", "_doc").withColumnRenamed("tk", "_tk")
    joined = own.join(found, own["doc"].eqNullSafe(found["_doc"]) & (own["tk"] == found["_tk"]), "left")
    return joined.select(
        "doc_id", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("n_exact", F.lit(0).cast("long")).alias("n_exact"), F.coalesce("items", F.lit("")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item leaked into, with names or without case, as they are."""
    found = either(docs, benchmark).select(F.col("doc").alias("__doc"), F.col("tk").alias("__tk")).distinct()
    found = Scratch(docs.sparkSession).keep(found, "leaked")
    # Whole documents are not sorted to meet these few ids, and only moved if the ids pass a block.
    found = F.broadcast(found) if found.count() <= BLOCK_ROWS else found.hint("shuffle_hash")
    doc, tk = _order()
    marked = docs.withColumn("__d", doc).withColumn("__t", tk)
    return marked.join(found, F.col("__d").eqNullSafe(F.col("__doc")) & (F.col("__t") == F.col("__tk")), "left_anti").drop("__d", "__t")
