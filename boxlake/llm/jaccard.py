"""N-gram Jaccard join: documents whose sets of five-word shingles are alike by 0.8 or more.

Texts of equal sets are one class. Classes meet where they share a shingle in the part of
their set that any pair of this likeness must share: the first fifth in one global order,
by hash, with shingles that ``HEAVY`` or more classes list last. Where classes meet, their
shingles, hashed into groups and counted, are points; an R-tree over these points bounds the
overlap of two sets by the sum of coordinate minima, and surviving pairs are verified on the
whole sets. Rounds of links to one representative join most of a group of near copies first,
so that only pairs of different components are left to the tree; a place where very many
meet is cut into blocks, and every pair of blocks is searched.

Each class lists its first shingles by hash, some more than a fifth. If at most so many of
these are heavy, its part in the order is among the others. A class with more heavy ones
("crowded") meets others by all of a longer list: with another crowded class it shares one
of the first fifth by hash alone, and what it must share with a class that is not crowded
cannot stand behind that list.

A null or empty text, or one without words, has an empty set and is linked with nothing;
fewer words than five are one shingle. Rows that share an id count as one document, rows
without an id get no component. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from boxlake.llm.common import Scratch, chunks, least_apart, mix, packed_counts, text_of, word_hashes, words_of
from boxlake.llm.graph import components

WORDS = 5
#: Texts that a Python worker gets at once; it holds several copies of them and their sets.
BATCH_BYTES = "4m"
#: Likeness as a fraction; links need ``TENTHS[1] * shared >= TENTHS[0] * together``.
PART, WHOLE = 4, 5
#: Groups of the tree's points, and of the finer counts that its pairs must pass too.
GROUPS = 64
FINE = 512
#: Bits of each of the finer counts that come along to the places where sets meet.
SHORT = 4
#: Places of a class, the first ones, that tell whether a pair has met before.
EARLY = 8
HEAVY = 64
LEAF = 32
BLOCK = 2_000
STAR_ROUNDS = 2
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, starts, ends, first = words_of(texts)
    words = word_hashes(data, starts, ends)
    full = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        full = full * _STEP + words[k : k + len(full)]
    full, out = mix(full), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(full[a : b - WORDS + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for w in words[a:b]:
                one = one * _STEP + w
            out.append(mix(np.array([one], np.uint64)))
        else:
            out.append(full[:0])
    return out


def _signed(hashes: np.ndarray) -> np.ndarray:
    """As signed numbers of the same order."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def _each_set(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    texts = [t.encode() for t in pdf["text"]]
    for a, b in chunks(texts):
        with np.errstate(over="ignore"):
            yield from zip(range(a, b), shingle_sets(texts[a:b]), strict=True)


def summaries(docs: DataFrame) -> DataFrame:
    """Set size and 128-bit identity of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for _, tokens in _each_set(pdf):
                s1, s2 = int(mix(tokens ^ _STEP).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(tokens + _STEP), initial=0))
                rows.append((len(tokens), s1 - (1 << 63), s2 - (1 << 63)))
            out = pd.DataFrame(rows, columns=["n", "s1", "s2"])
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    return docs.mapInPandas(run, "doc_id long, n long, s1 long, s2 long")


def _needed_part(n):
    """Number of shingles in one order of which any partner shares one."""
    return n - (PART * n + WHOLE - 1) // WHOLE + 1


def lists(docs: DataFrame) -> DataFrame:
    """Each row's size, group counts and its first shingles by hash, ``spare`` more than needed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, rows = pdf["doc_id"].values, []
            for i, tokens in _each_set(pdf):
                n = len(tokens)
                spare = min(n // 16 + 4, n - _needed_part(n)) if n else 0
                fine = np.bincount((tokens & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE)
                vec = np.minimum(fine.reshape(-1, GROUPS).sum(0), np.iinfo("u1").max).astype("u1")
                fine = np.minimum(fine, np.iinfo("u1").max).astype("u1")
                first = tokens[: _needed_part(n) + spare] if n else tokens
                rows.append((ids[i], n, spare, vec.tobytes(), fine.tobytes(), packed_counts(tokens, FINE, SHORT), _signed(first)))
            yield pd.DataFrame(rows, columns=["node", "n", "spare", "vec", "fine", "short", "tokens"])

    return docs.mapInPandas(run, "node long, n long, spare long, vec binary, fine binary, short binary, tokens array<long>")


def reach_of(n: int) -> int:
    """How far into a crowded set of ``n`` a shingle can stand that a listed partner must share.

    At most a fifth of the set is missing in the partner, whose list of at most 5/4 of the
    size ends where ``lists`` ends it.
    """
    partner = WHOLE * n // PART
    return n - (PART * n + WHOLE - 1) // WHOLE + _needed_part(partner) + partner // 16 + 4


def long_lists(docs: DataFrame) -> DataFrame:
    """The first shingles by hash that a crowded class meets others by."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["doc_id"].values
            rows = [(ids[i], _signed(tokens[: reach_of(len(tokens))])) for i, tokens in _each_set(pdf)]
            yield pd.DataFrame(rows, columns=["node", "tokens"])

    return docs.mapInPandas(run, "node long, tokens array<long>")


def whole_sets(docs: DataFrame) -> DataFrame:
    """The whole set of each row, as sorted hashes in a binary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, rows = pdf["doc_id"].values, []
            for i, tokens in _each_set(pdf):
                rows.append((ids[i], tokens.tobytes()))
                if len(rows) >= 1000:
                    yield pd.DataFrame(rows, columns=["node", "tokens"])
                    rows = []
            yield pd.DataFrame(rows, columns=["node", "tokens"])

    return docs.mapInPandas(run, "node long, tokens binary")


def overlaps(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Summed coordinate minima; a count at the end of its range may stand for any number."""
    least = np.minimum(left, right)
    return np.where(least == np.iinfo(least.dtype).max, 1 << 40, least.astype(np.int64)).sum(-1)


def needed(n, m):
    """Least overlap of two linked sets of these sizes."""
    return (PART * (n + m) + PART + WHOLE - 1) // (PART + WHOLE)


class CountTree:
    """R-tree over count vectors: each node has the upper corner and the sizes of its points."""

    def __init__(self, vecs: np.ndarray, sizes: np.ndarray):
        # Points of like size and like largest groups become neighbours in a leaf.
        self.order = np.lexsort((vecs.argmax(1), sizes))
        self.vecs, self.sizes = vecs[self.order], sizes[self.order]
        cut = np.arange(0, len(sizes), LEAF)
        self.levels = [(np.maximum.reduceat(self.vecs, cut), np.minimum.reduceat(self.sizes, cut), np.maximum.reduceat(self.sizes, cut))]
        while len(self.levels[-1][1]) > LEAF:
            top, low, high = self.levels[-1]
            cut = np.arange(0, len(low), LEAF)
            self.levels.append((np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def near(self, vec: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the points whose overlap with a set may suffice."""
        at = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            fits = (WHOLE * high[at] >= PART * size) & (PART * low[at] <= WHOLE * size)
            at = at[fits]
            at = at[overlaps(top[at], vec) >= needed(size, np.maximum(low[at], PART * size // WHOLE))]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < (len(self.levels[depth - 1][1]) if depth else len(self.sizes))]
        sizes = self.sizes[at]
        fits = (WHOLE * np.minimum(sizes, size) >= PART * np.maximum(sizes, size))
        at, sizes = at[fits], sizes[fits]
        return self.order[at[overlaps(self.vecs[at], vec) >= needed(size, sizes)]]


def _whole_places(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows sorted by place, no place apart, and the starts of the places; a place may continue in the next batch."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        place = pdf[["token", "low", "high"]].values
        cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(1)]))
        rest = pdf.iloc[cut[-1] :]
        if len(cut) > 1:
            yield pdf.iloc[: cut[-1]], cut[:-1]
    if rest is not None and len(rest):
        yield rest, np.zeros(1, np.int64)


def _by_place(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")


def _few_and_many(pdf: pd.DataFrame, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Rows of places of one block that a leaf or two hold, their places' numbers, and the ranges of the others."""
    across = (pdf["low"] != pdf["high"]).values
    lengths = np.diff(np.append(cut, len(pdf)))
    group = np.repeat(np.arange(len(cut)), lengths)
    few = np.flatnonzero(np.repeat(lengths <= 2 * LEAF, lengths) & ~across)
    many = (lengths > 2 * LEAF) | across[cut]
    return few, group[few], list(zip(cut[many].tolist(), (cut + lengths)[many].tolist(), strict=True))


def _in_places(group, sizes, labels, ranks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a place whose labels differ and whose sizes and ranks allow a link, one distance at a time."""
    for d in range(1, len(group)):
        at = np.flatnonzero(group[d:] == group[:-d])
        if not len(at):
            return
        x, y = at, at + d
        fits = (labels[x] != labels[y]) & (WHOLE * np.minimum(sizes[x], sizes[y]) >= PART * np.maximum(sizes[x], sizes[y]))
        x, y = x[fits], y[fits]
        fits = _room(sizes, ranks, x, y)
        yield x[fits], y[fits]


def _room(sizes: np.ndarray, ranks: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Is enough left from this place on, if it is the first in the order that both have?

    A negative rank stands for any: its class has met by another order.
    """
    left = np.minimum(sizes[x] - ranks[x], sizes[y] - ranks[y])
    return (np.minimum(ranks[x], ranks[y]) < 0) | (left >= needed(sizes[x], sizes[y]))


def _with_partner(rows: DataFrame) -> DataFrame:
    """Those of ``rows``, sorted by place, that sizes and ranks leave a partner; all of places with many rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cut in _whole_places(batches):
            few, group, many = _few_and_many(pdf, cut)
            sizes, labels, ranks = (pdf[c].values[few] for c in ("n", "label", "rank"))
            keep = np.zeros(len(pdf), bool)
            for x, y in _in_places(group, sizes, labels, ranks):
                keep[few[x]] = keep[few[y]] = True
            for a, b in many:
                keep[a:b] = True
            yield pdf[keep]

    return rows.mapInPandas(run, rows.schema)


def _survivors(rows: DataFrame) -> DataFrame:
    """Pairs of different labels that meet at a place and survive the bounds.

    ``rows`` are sorted by place within partitions. A pair that shares one of the first places
    of both classes is only told at the least of them.
    """

    def small(group, vecs, sizes, labels, ranks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of groups that a block of the tree would hold."""
        for x, y in _in_places(group, sizes, labels, ranks):
            fits = overlaps(vecs[x], vecs[y]) >= needed(sizes[x], sizes[y])
            yield x[fits], y[fits]

    def large(vecs, sizes, labels, own, across) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tree = CountTree(vecs, sizes)
        # Of two labels one is not the most frequent: the other points need no search of their own.
        names, times = np.unique(labels, return_counts=True)
        for i in np.flatnonzero(labels != names[times.argmax()]):
            hits = tree.near(vecs[i], sizes[i])
            # Of two blocks, pairs across only.
            hits = hits[(labels[hits] != labels[i]) & ((own[hits] != own[i]) | (not across))]
            yield np.full(len(hits), i), hits

    def search(pdf: pd.DataFrame, cut: np.ndarray) -> pd.DataFrame:
        vecs, short = (np.frombuffer(b"".join(pdf[c]), "u1").reshape(len(pdf), -1) for c in ("vec", "short"))
        early = np.concatenate(pdf["early"].to_list()).reshape(-1, EARLY)
        sizes, labels, nodes, own, places = (pdf[c].values for c in ("n", "label", "node", "own", "token"))
        ranks = pdf["rank"].values if "rank" in pdf else np.full(len(pdf), -1)
        few, group, many = _few_and_many(pdf, cut)
        tries = [(few, small(group, vecs[few], sizes[few], labels[few], ranks[few]))]
        for a, b in many:
            across = pdf["low"].iat[a] != pdf["high"].iat[a]
            tries.append((np.arange(a, b), large(vecs[a:b], sizes[a:b], labels[a:b], own[a:b], across)))
        found = [np.zeros((0, 2), np.int64)]
        for at, tried in tries:
            for x, y in tried:
                x, y = at[x], at[y]
                fits = _room(sizes, ranks, x, y)
                x, y = x[fits], y[fits]
                fits = (PART + WHOLE) * least_apart(short, x, y, SHORT) <= (WHOLE - PART) * (sizes[x] + sizes[y])
                x, y = x[fits], y[fits]
                both = (early[x][:, :, None] == early[y][:, None, :]).any(2)
                fits = ~both.any(1) | (np.where(both, early[x], np.iinfo(np.int64).max).min(1) == places[x])
                x, y = nodes[x[fits]], nodes[y[fits]]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cut in _whole_places(batches):
            yield search(pdf, cut)

    return rows.mapInPandas(run, "a long, b long").distinct()


@F.pandas_udf(BooleanType())
def _may_link(na: pd.Series, va: pd.Series, nb: pd.Series, vb: pd.Series) -> pd.Series:
    """The bound: do summed minima of group counts reach the overlap that is needed?"""
    left, right = (np.frombuffer(b"".join(v), "u1").reshape(-1, FINE) for v in (va, vb))
    return pd.Series(overlaps(left, right) >= needed(na.values, nb.values))


@F.pandas_udf(BooleanType())
def _alike(left: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(left, right, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        both = int((y[at] == x).sum()) if len(y) else 0
        out.append(WHOLE * both >= PART * (len(x) + len(y) - both))
    return pd.Series(out, dtype=bool)


def _bounded(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that sizes and group counts leave possible."""
    for end in ("a", "b"):
        pairs = pairs.join(listed.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("fine").alias(f"v{end}")), end)
    fits = pairs.filter(f"{WHOLE} * least(na, nb) >= {PART} * greatest(na, nb)")
    return fits.filter(_may_link("na", "va", "nb", "vb")).select("a", "b").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``pairs(a, b)`` whose whole sets are alike enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = scratch.keep(whole_sets(docs.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")), "whole")
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("tokens").alias(f"t{end}")), end)
    return pairs.filter(_alike("ta", "tb")).select("a", "b").distinct()


def _labelled(met: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return met.withColumn("label", F.col("node"))
    return met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def classes_and_links(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """One row per document with its class, and the component of every class that has links.

    The first table has ``doc_id, n, s1, s2, node`` (``node``: the least id of an equal
    set), the second ``node, label``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    summed = scratch.keep(summaries(docs), "sets")
    first = summed.filter("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    keys = summed.join(first, ["s1", "s2"], "left")

    listed = scratch.keep(lists(docs).join(first.select("node").distinct(), "node", "left_semi"), "lists")
    shown = listed.select("node", F.posexplode("tokens").alias("pos", "token"))
    busy = shown.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token", (F.col("k") >= HEAVY).alias("heavy"))
    busy = scratch.keep(busy, "busy")
    # Few, as each is listed so often: joined without moving the lists.
    heavy = scratch.keep(busy.filter("heavy").select("token"), "heavy")
    heavies = listed.select("node", "spare", F.explode("tokens").alias("token")).join(heavy, "token")
    heavies = heavies.groupBy("node").agg(F.count("*").alias("k"), F.max("spare").alias("spare"))
    heavies = scratch.keep(heavies.select("node", "k", (F.col("k") > F.col("spare")).alias("crowded")), "heavies")
    crowded = scratch.keep(heavies.filter("crowded").select("node"), "crowded")
    longer = long_lists(docs.join(crowded, F.col("doc_id") == F.col("node"), "left_semi").select("doc_id", "text"))
    longer = scratch.keep(longer.select("node", F.explode("tokens").alias("token")), "longer")
    # What stands in a longer list may be in one list only, and is no less a place to meet.
    places = busy.filter("not heavy").select("token").unionByName(longer.select("token").join(heavy, "token", "left_anti")).distinct()
    met = shown.join(places, "token", "left_semi").join(heavies, "node", "left")
    # At least so many of a class stand before a place in the order, where heavy ones are last.
    met = met.filter("crowded is null or not crowded").withColumn("rank", F.expr("greatest(pos - coalesce(k, 0), 0)").cast("int"))
    met = met.select("node", "token", "rank").unionByName(longer.withColumn("rank", F.lit(-1)))
    met = scratch.keep(met.groupBy("node", "token").agg(F.min("rank").alias("rank")), "met")

    labels, links, tried = None, None, None
    for _ in range(STAR_ROUNDS):
        stands = _labelled(met, labels).groupBy("token", "label").agg(F.min("node").alias("node"))
        hub = stands.groupBy("token").agg(F.min(F.struct("label", "node")).alias("hub"), F.count("*").alias("k"))
        pairs = stands.join(hub.filter("k > 1"), "token").filter("label <> hub.label")
        pairs = pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.keep(_bounded(pairs, listed), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = scratch.keep(_linked(pairs, docs, scratch), "links")
        links = new if links is None else links.unionByName(new)
        labels = scratch.keep(components(scratch, links), "labels")

    rows = _labelled(met, labels)
    size = rows.groupBy("token", "label").agg(F.count("*").alias("k")).groupBy("token").agg(
        F.sum("k").alias("k"), F.count("*").alias("labels")
    ).filter("labels > 1").select("token", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(size, "token").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(listed.select("node", "n"), "node").select(
        "token", "node", "label", "n", "rank", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    # Counts are long: they come along only where sizes and ranks leave a partner.
    rows = scratch.keep(_with_partner(_by_place(rows)), "rows")
    # A class with fewer places repeats its last one.
    early = rows.groupBy("node").agg(F.sort_array(F.collect_set("token")).alias("early")).select(
        "node", F.transform(F.sequence(F.lit(1), F.lit(EARLY)), lambda i: F.element_at("early", F.least(i, F.size("early")))).alias("early")
    )
    rows = _by_place(rows.join(early, "node").join(listed.select("node", "n", "vec", "short"), ["node", "n"]))
    pairs = scratch.keep(_bounded(_survivors(rows).join(tried, ["a", "b"], "left_anti"), listed), "pairs")
    new = scratch.keep(_linked(pairs, docs, scratch), "links")
    labels = scratch.keep(components(scratch, links.unionByName(new)), "labels")
    return keys, labels


def similar(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the least id reachable by links."""
    scratch = Scratch(docs.sparkSession, batch_bytes=BATCH_BYTES)
    keys, labels = classes_and_links(docs, scratch)
    of = keys.select("s1", "s2", "node").distinct().join(labels, "node", "left").select("s1", "s2", F.coalesce("label", "node").alias("component"))
    of = of.filter("component is not null")
    return keys.drop("node").join(of, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
