"""Ranked lexical search by hashed max-sketches.

An index row stands for one document: its number of terms and a sketch, a vector in which
each distinct term's frequency is folded by maximum into the coordinate of the term's hash.
Within a document a higher frequency never has a lower impact, so the impact of a coordinate's
frequency is at least that of every term there, and the sum over a query's terms bounds the
document's score from above. A sketch has ``WIDTH`` coordinates and more for each distinct
term (a power of two, ``NARROW`` at least) and is stored by those that are not zero; frequencies
past 255 count as unlimited.

A block of queries is looked up in all sketches at once, twice. The first time, each query's
``FIRST`` documents of highest bounds are scored exactly, which gives a threshold that the last of its
results reaches at least. The second time, every document whose bound reaches a threshold is
scored exactly from its whole text, highest bounds first; what a task has found raises its
thresholds until no further bound reaches them. Sketches only say what need not be scored.

Terms are maximal runs of ASCII letters (A-Z lower-cased), digits and characters past ASCII.
The score of a term is ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 25 + (75 * n * N) div L``.

A null or empty text has no terms and is no result. Every row is a document of its own; rows
without an id come last among equal scores, and equal rows have ranks next to each other.
Queries with equal id and text are one; a query without terms has no results. Columns other
than those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxlake.llm.common import Scratch, chunks, text_of, word_hashes, words_of

#: Bytes that are in no term.
GAPS = np.ones(256, bool)
GAPS[0x30:0x3A] = GAPS[0x41:0x5B] = GAPS[0x61:0x7B] = GAPS[0x80:] = False
WIDTH, NARROW = 64, 256
UNLIMITED = 255
#: Queries of one block, whose terms every task has.
QUERIES = 2_000
#: Documents, and coordinates of their sketches, of one step.
STEP, COORDINATES = 128, 1 << 22
FIRST = 50
#: Terms that a task counts before it passes them on.
HELD = 500_000
SALT = 32


def frequencies(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text the number of its terms, its distinct term hashes in order, and their frequencies."""
    data, starts, ends, first = words_of(texts, gaps=GAPS)
    hashes = word_hashes(data, starts, ends)
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield b - a, *np.unique(hashes[a:b], return_counts=True)


def sketch(terms: np.ndarray, tf: np.ndarray) -> tuple[int, bytes, bytes]:
    """Number of coordinates, and those that are not zero with their maxima."""
    size = max(NARROW, 1 << (WIDTH * len(terms)).bit_length())
    order = np.argsort(tf, kind="stable")  # of those that share a coordinate, the most frequent is written last
    place = (terms[order] & np.uint64(size - 1)).astype("<u4")
    return size, place.tobytes(), np.minimum(tf[order], UNLIMITED).astype(np.uint8).tobytes()


def scanned(docs: DataFrame) -> DataFrame:
    """Rows of documents (``doc_id, n, size, places, maxima``) and rows of terms (``term, df``), these summed within a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            term, place = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return term, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

        def given(term: np.ndarray, df: np.ndarray) -> Iterator[pd.DataFrame]:
            for a in range(0, len(term), 100_000):
                yield pd.DataFrame({"doc_id": None, "n": None, "size": None, "places": None, "maxima": None, "term": term[a : a + 100_000].view(np.int64), "df": df[a : a + 100_000]})

        for pdf in batches:
            texts, ids = [t.encode() for t in pdf["text"]], pdf["doc_id"].astype("Int64")
            for a, b in chunks(texts):
                rows, seen = [], []
                for n, terms, tf in frequencies(texts[a:b]):
                    rows.append((n, *(sketch(terms, tf) if n else (0, None, None))))
                    seen.append(terms)
                out = pd.DataFrame(rows, columns=["n", "size", "places", "maxima"])
                out.insert(0, "doc_id", ids.iloc[a:b].values)
                yield out.assign(term=None, df=None)
                held.append(np.unique(np.concatenate(seen), return_counts=True))
                if sum(len(t) for t, _ in held) > HELD:
                    term, df = merged()
                    held[:] = [(term, df)]
                    if len(term) > HELD // 2:  # else what follows is merged with it
                        held.clear()
                        yield from given(term, df)
        if held:
            yield from given(*merged())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(run, "doc_id long, n long, size long, places binary, maxima binary, term long, df long")


class Queries:
    """Terms of a block of queries: ``terms`` in order, their weights, and each query's entries in them."""

    def __init__(self, numbers: list[int], texts: list[bytes]):
        self.numbers, entries, times, terms = [], [], [], []
        for number, (n, own, tf) in zip(numbers, frequencies(texts) if texts else [], strict=True):
            if n:
                self.numbers.append(number)
                terms.append(own)
                times.append(tf)
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms]))
        entries = [np.searchsorted(self.terms, own) for own in terms]
        self.starts = np.cumsum([0, *map(len, entries)])[:-1].astype(np.int64)
        self.entries = np.concatenate([np.zeros(0, np.int64), *entries])
        self.times = np.concatenate([np.zeros(0, np.int64), *times])
        self.weights = np.zeros(len(self.terms), np.int64)
        self.docs = self.all_terms = 0

    def weigh(self, docs: int, all_terms: int, df: dict[int, int]) -> None:
        self.docs, self.all_terms = docs, all_terms
        for i, term in enumerate(self.terms.view(np.int64).tolist()):
            self.weights[i] = math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(term, 0) + 1)))

    def scores(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Score of each document (row; ``tf`` by term) for each query (column)."""
        length = 25 + 75 * n * self.docs // max(self.all_terms, 1)
        doc, term = np.nonzero(tf)
        many = tf[doc, term].astype(np.int64)
        value = 1_000_000_000 * many // (1000 * many + 8 * length[doc])
        if tf.dtype == np.uint8:
            value[many == UNLIMITED] = 1_000_000
        impact = np.zeros(tf.shape, np.int64)
        impact[doc, term] = self.weights[term] * value
        return np.add.reduceat(impact[:, self.entries] * self.times, self.starts, axis=1)

    def bounds(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of index rows, and their documents' bounds, some at a time."""
        width, n = pdf["size"].values, pdf["n"].values
        places, maxima = list(pdf["places"]), list(pdf["maxima"])
        for size in np.unique(width):
            wanted, at = (self.terms & np.uint64(size - 1)).astype(np.int64), np.flatnonzero(width == size)
            step = max(1, min(STEP, COORDINATES // int(size)))
            for a in range(0, len(at), step):
                part = at[a : a + step]
                full = np.zeros((len(part), size), np.uint8)
                for i, k in enumerate(part):
                    full[i, np.frombuffer(places[k], "<u4")] = np.frombuffer(maxima[k], np.uint8)
                yield part, self.scores(full[:, wanted], n[part])

    def exact(self, texts: list[bytes]) -> np.ndarray:
        """Scores of whole texts; equal to the definition, without any bound."""
        tf, n = np.zeros((len(texts), len(self.terms)), np.int64), np.zeros(len(texts), np.int64)
        for i, (size, own, many) in enumerate(frequencies(texts)):
            n[i] = size
            at = np.minimum(np.searchsorted(self.terms, own), len(self.terms) - 1)
            hit = self.terms[at] == own
            tf[i, at[hit]] = many[hit]
        return self.scores(tf, n)


def _best(rows: DataFrame, value: str, most: int) -> DataFrame:
    """Each query's ``most`` rows of highest ``value``, first within parts of a query's rows."""
    order = [F.col(value).desc(), F.col("doc_id").asc_nulls_last()]
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALT)))
    part = Window.partitionBy("query", "salt").orderBy(*order)
    salted = salted.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= most).drop("rank", "salt")
    return salted.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= most)


def _highest_bounds(index: DataFrame, model, most: int) -> DataFrame:
    """``query, doc_id, bound`` of each task's ``most`` highest bounds of each query, also in the form of ``_reaching``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, held = model.value, None
        for pdf in batches:
            ids = pdf["doc_id"].astype("Int64")
            lone, ids = ids.isna().values, ids.fillna(0).values.astype(np.int64)
            for at, found in queries.bounds(pdf):
                new = [found, np.broadcast_to(ids[at][:, None], found.shape), np.broadcast_to(lone[at][:, None], found.shape)]
                held = new if held is None else [np.concatenate(pair) for pair in zip(held, new, strict=True)]
                if len(held[0]) > most:
                    top = np.argpartition(held[0], len(held[0]) - most, axis=0)[-most:]
                    held = [np.take_along_axis(x, top, 0) for x in held]
        if held is not None:
            at = np.broadcast_to(np.arange(len(queries.numbers)), held[0].shape)
            some = held[0] > 0
            out = pd.DataFrame({"query": np.array(queries.numbers)[at[some]], "doc_id": held[1][some], "bound": held[0][some]})
            out["queries"] = [x.tobytes() for x in at[some].astype("<u4")]
            out["bounds"] = [x.tobytes() for x in held[0][some].astype("<i8")]
            yield out.assign(doc_id=out["doc_id"].astype("Int64").mask(held[2][some]))

    return index.mapInPandas(run, "query long, doc_id long, bound long, queries binary, bounds binary")


def _reaching(index: DataFrame, model, thresholds) -> DataFrame:
    """``doc_id, highest, queries, bounds``: the queries whose threshold a document's bound reaches.

    The last two are numbers of queries in their block (32 bits) and bounds (64 bits).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, least = model.value, thresholds.value
        for pdf in batches:
            ids = pdf["doc_id"].astype("Int64")
            for at, found in queries.bounds(pdf):
                reach = found >= least
                some = np.flatnonzero(reach.any(1))
                rows = [(np.flatnonzero(reach[i]).astype("<u4").tobytes(), found[i, reach[i]].astype("<i8").tobytes()) for i in some]
                out = pd.DataFrame(rows, columns=["queries", "bounds"])
                out.insert(0, "highest", np.where(reach, found, 0)[some].max(1) if len(some) else np.zeros(0, np.int64))
                out.insert(0, "doc_id", ids.iloc[at[some]].values)
                yield out

    return index.mapInPandas(run, "doc_id long, highest long, queries binary, bounds binary")


def _rescored(docs: DataFrame, wanted: DataFrame, model, thresholds, most: int) -> DataFrame:
    """``query, doc_id, score`` of the ``wanted`` documents and queries that may be among the ``most`` best."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, least = model.value, thresholds.value.copy()
        numbers = np.array(queries.numbers)
        best = np.zeros((most, len(least)), np.int64)
        for pdf in batches:
            texts, ids = pdf["text"], pdf["doc_id"].astype("Int64")
            for a in range(0, len(pdf), STEP):
                rows, asked = [], []
                for i in range(a, min(a + STEP, len(pdf))):
                    # Rows that share an id are asked for what any of them was wanted for.
                    query = np.frombuffer(b"".join(pdf["queries"].iloc[i]), "<u4").astype(np.int64)
                    bound = np.frombuffer(b"".join(pdf["bounds"].iloc[i]), "<i8")
                    query = np.unique(query[bound >= least[query]])
                    if len(query):
                        rows.append(i)
                        asked.append(query)
                if not rows:
                    continue
                found = queries.exact([texts.iloc[i].encode() for i in rows])
                place, query = np.repeat(np.arange(len(rows)), list(map(len, asked))), np.concatenate(asked)
                own = np.zeros(found.shape, np.int64)
                own[place, query] = found[place, query]
                best = np.sort(np.concatenate([best, own]), axis=0)[-most:]
                np.maximum(least, best[0], out=least)
                value = found[place, query]
                keep = (value > 0) & (value >= least[query])
                yield pd.DataFrame({
                    "query": numbers[query[keep]], "doc_id": ids.iloc[np.array(rows)[place[keep]]].values, "score": value[keep],
                })

    wanted = wanted.groupBy("doc_id").agg(
        F.max("highest").alias("highest"), F.collect_list("queries").alias("queries"), F.collect_list("bounds").alias("bounds")
    ).withColumnRenamed("doc_id", "_doc")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc"))).sortWithinPartitions(F.desc("highest"))
    return rows.select("doc_id", "text", "queries", "bounds").mapInPandas(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, scratch: Scratch, most: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: each query's ``most`` documents of highest scores above 0.

    ``queries`` has ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    scan = scratch.keep(scanned(docs), "scan")
    index = scan.filter("n > 0").select("doc_id", "n", "size", "places", "maxima")
    all_docs, all_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = scratch.keep(scan.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "terms")

    queries = queries.select("item_id", text_of().alias("text")).distinct().withColumn("query", F.xxhash64("item_id", "text"))
    queries = scratch.keep(queries, "queries")
    blocks = max(1, -(-queries.count() // QUERIES))
    parts = []
    for block in range(blocks):
        rows = queries.filter(F.pmod("query", F.lit(blocks)) == block).select("query", "text").collect()
        made = Queries([r["query"] for r in rows], [r["text"].encode() for r in rows])
        if not len(made.terms) or not all_docs:
            continue
        terms = spark.createDataFrame(pd.DataFrame({"term": made.terms.view(np.int64)}))
        made.weigh(all_docs, all_terms, {r["term"]: r["df"] for r in df.join(F.broadcast(terms), "term").collect()})
        model = spark.sparkContext.broadcast(made)
        none = spark.sparkContext.broadcast(np.ones(len(made.numbers), np.int64))
        first = _best(_highest_bounds(index, model, max(FIRST, most)), "bound", max(FIRST, most))
        first = scratch.keep(first.select("doc_id", F.col("bound").alias("highest"), "queries", "bounds"), "bounds")
        found = _best(_rescored(docs, first, model, none, most), "score", most).filter(F.col("rank") == most)
        found = {r["query"]: r["score"] for r in found.select("query", "score").collect()}
        least = spark.sparkContext.broadcast(np.array([max(1, found.get(q, 1)) for q in made.numbers], np.int64))
        wanted = scratch.keep(_reaching(index, model, least), "wanted")
        parts.append(scratch.keep(_rescored(docs, wanted, model, least, most), "scores"))
    empty = "query long, doc_id long, score long"
    scores = spark.createDataFrame([], empty)
    for part in parts:
        scores = scores.unionByName(part)
    return _best(scores, "score", most).join(queries.select("query", "item_id"), "query").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )
