"""Alignment of two tokenizers' tokens by the byte ends that they share.

Tokenizer A is a byte-level BPE over a blank and the text, B a piece model that puts a blank
in front by itself. Tokens are ranges of the same bytes, so each is known by where it ends.
Of the two lists of ends, the shorter drives: each of its ends gallops into the longer one,
from its proportional place in steps of 1, 2, 4, … until it is passed, and a binary search
within the last step gives its rank there. Ends of equal value cut both lists into groups.
Ranks give all overlaps: merged by rank, two neighbouring ends bound one stretch of bytes,
which lies in one token of A and one of B, and each overlapping pair has one such stretch.

Links are counted by pair of ids over all documents. The counts of the ``HEAD_PAIRS`` most
frequent pairs are sent to every task; rarer ones are joined, with the same result.

Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no
tokens. Strings of special tokens in a text are ordinary text. Repeated rows, with or without
an id, are rows of their own with equal results. Columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import Scratch, chunks, reach, text_of

HEAD_PAIRS = 1 << 20
#: Pairs that a task counts before it merges equal ones.
HELD = 1_000_000
TEXT_BYTES = 1 << 18
COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable Latin-1, else one from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, byte_json: bytes, pattern: str, piece_model: bytes):
        own = byte_alphabet()
        found = json.loads(byte_json)["model"]["vocab"]
        ranks = {bytes(own[c] for c in token): i for token, i in found.items()}
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.byte_level = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.b_bytes = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of A and B, or nothing where one of them does not give the text back."""
        whole = " " + text
        a, b = self.byte_level.encode_ordinary(whole), self.pieces.encode(text)
        same = whole.encode() == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if same else None


_LOADED: dict[tuple, Tokenizers] = {}


def loaded(*files) -> Tokenizers:
    if files not in _LOADED:
        _LOADED.clear()
        _LOADED[files] = Tokenizers(*files)
    return _LOADED[files]


def gallop(values: np.ndarray, into: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of ``into`` (in order) are less than each value, searched outwards from ``start``."""
    low, high = start.copy(), start.copy()
    up = np.flatnonzero(into[start] < values)
    step = 1
    while len(up):  # what stands before low is less
        low[up] = high[up] + 1
        high[up] = np.minimum(low[up] + step, len(into))
        up = up[(high[up] < len(into)) & (into[np.minimum(high[up], len(into) - 1)] < values[up])]
        step *= 2
    down = np.flatnonzero((low == start) & (into[start] >= values))
    step = 1
    while len(down):  # what stands at high and after is not less
        high[down] = low[down]
        low[down] = np.maximum(high[down] - step, 0)
        down = down[into[low[down]] >= values[down]]
        down = down[low[down] > 0]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = into[middle] < values[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def _shown(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of all numbers below ``most``, joined, with places and sizes."""
    texts = [str(i).encode() for i in range(most)]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


_DIGITS: list = []


def digits(most: int):
    if not _DIGITS or len(_DIGITS[0][1]) < most:
        _DIGITS[:] = [_shown(most)]
    return _DIGITS[0]


def align(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For two lists of ends of the same bytes: for each group its last token in either, for each link its token in either."""
    rank = gallop(short, long, start)
    common = long[rank] == short  # the last end of all is in both
    place = rank + np.arange(len(short)) - (np.cumsum(common) - common)
    total = len(short) + len(long) - int(common.sum())
    of_short, of_long = np.zeros(total, np.int64), np.ones(total, np.int64)
    of_short[place] = 1
    of_long[place[~common]] = 0
    return np.flatnonzero(common), rank[common], np.cumsum(of_short) - of_short, np.cumsum(of_long) - of_long


def _grouped(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal text of all groups, each ended by ``;``, and where each group's text ends."""
    both = np.empty(len(a) + len(b), np.int64)
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)
    at_b = np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)
    both[at_a], both[at_b] = a, b
    shown, places, sizes = digits(int(both.max()) + 1)
    size = sizes[both] + 1
    ends = np.cumsum(size)
    text = shown[np.minimum(np.repeat(places[both] - ends + size, size) + np.arange(ends[-1]), len(shown) - 1)]
    text[ends - 1] = ord(",")
    text[ends[at_a[last_a]] - 1] = ord("|")
    text[ends[at_b[last_b]] - 1] = ord(";")
    return text, ends[at_b[last_b]]


def _aligned(models: Tokenizers, ids: list[tuple[list[int], list[int]]], swap: bool) -> Iterator[tuple]:
    """Counts, digest and links of each text, of texts whose shorter list is A's (or B's, if swapped)."""
    lists = [(np.fromiter((x for pair in ids for x in pair[side]), np.int64), np.array([len(pair[side]) for pair in ids])) for side in (0, 1)]
    (a, n_a), (b, n_b) = lists
    end_a, end_b = np.cumsum(models.a_sizes[a]), np.cumsum(models.b_sizes[b])
    (short, n_short), (long, n_long) = ((end_b, n_b), (end_a, n_a)) if swap else ((end_a, n_a), (end_b, n_b))
    within = np.arange(len(short)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
    start = np.repeat(np.cumsum(n_long) - n_long, n_short) + within * np.repeat(n_long, n_short) // np.repeat(n_short, n_short)
    last_a, last_b, link_a, link_b = align(short, long, start)
    if swap:
        last_a, last_b, link_a, link_b = last_b, last_a, link_b, link_a
    text, group_ends = _grouped(a, b, last_a, last_b)
    links = (a[link_a] * len(models.b_bytes) + b[link_b]).astype("<u8" if len(models.a_bytes) * len(models.b_bytes) > 1 << 32 else "<u4")
    cut_group = np.searchsorted(last_a, np.cumsum(n_a) - 1) + 1  # a text ends where both end
    n_groups = np.diff(cut_group, prepend=0)
    n_links = n_a + n_b - n_groups
    cut_text = group_ends[cut_group - 1]
    place, link = 0, 0
    for i in range(len(ids)):
        digest = hashlib.sha256(text[place : cut_text[i] - 1].tobytes()).hexdigest()
        yield n_a[i], n_b[i], n_groups[i], n_links[i], digest, links[link : link + n_links[i]].tobytes()
        place, link = cut_text[i], link + n_links[i]


def aligned(docs: DataFrame, byte_file: str, pattern: str, piece_file: str) -> DataFrame:
    """``COLUMNS`` of every row; ``links``: A's id times the number of B's ids plus B's id, in order of bytes."""
    files = []
    for path in (byte_file, piece_file):
        with open(path, "rb") as file:
            files.append(file.read())  # bounded files; executors get their content, not their place
    key = (files[0], pattern, files[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = loaded(*key)
        for pdf in batches:
            texts, names = pdf["text"].tolist(), pdf["doc_id"].astype("Int64")
            for x, y in chunks(texts, TEXT_BYTES):
                rows = [(0, 0, 0, 0, "", b"")] * (y - x)
                ids = [models.encode(text) if text else None for text in texts[x:y]]
                for swap in (False, True):
                    some = [i for i, pair in enumerate(ids) if pair and (len(pair[0]) > len(pair[1])) == swap]
                    if some:
                        for i, row in zip(some, _aligned(models, [ids[i] for i in some], swap), strict=True):
                            rows[i] = row
                out = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])
                out.insert(0, "doc_id", names.iloc[x:y].values)
                yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(run, COLUMNS)


def _each(column: pd.Series, wide: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows, their links joined, and where each row's begin."""
    blobs = list(column)
    for a, b in chunks(blobs):
        joined = np.frombuffer(b"".join(blobs[a:b]), "<u8" if wide else "<u4").astype(np.int64)
        yield a, b, joined, np.concatenate([[0], np.cumsum([len(x) // (8 if wide else 4) for x in blobs[a:b]])])


def pair_counts(rows: DataFrame, wide: bool = False) -> DataFrame:
    """``pair, n``: links that hold each pair of ids, summed within each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> tuple[np.ndarray, np.ndarray]:
            pair, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pair, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

        for pdf in batches:
            for _, _, links, _ in _each(pdf["links"], wide):
                held.append(np.unique(links, return_counts=True))
                if sum(len(p) for p, _ in held) > HELD:
                    held[:] = [merge()]
                    if len(held[0][0]) > HELD // 2:
                        yield pd.DataFrame({"pair": held[0][0], "n": held[0][1]})
                        held.clear()
        if held:
            pair, n = merge()
            yield pd.DataFrame({"pair": pair, "n": n})

    return rows.select("links").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored(docs: DataFrame, byte_file: str, pattern: str, piece_file: str, scratch: Scratch) -> DataFrame:
    """``COLUMNS`` with ``n_best`` and ``count_sum``: links whose count is the highest of their B id, and all counts summed."""
    spark = docs.sparkSession
    with open(byte_file, "rb") as a_file, open(piece_file, "rb") as b_file:
        models = Tokenizers(a_file.read(), pattern, b_file.read())
    number, wide = len(models.b_bytes), len(models.a_bytes) * len(models.b_bytes) > 1 << 32
    # The written key tells rows of equal ids and texts apart.
    rows = scratch.keep(aligned(docs, byte_file, pattern, piece_file).withColumn("row", F.expr("uuid()")), "aligned")
    counts = scratch.keep(pair_counts(rows, wide).withColumn("b", F.col("pair") % number), "pairs")
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = scratch.keep(counts.join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    least = reach(counts, F.col("n"), HEAD_PAIRS)
    head = counts.filter(F.col("n") >= least).toArrow()
    order = np.argsort(head["pair"].to_numpy())
    head = spark.sparkContext.broadcast(tuple(head[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, n, is_best = head.value
        for pdf in batches:
            for a, b, links, cut in _each(pdf["links"], wide):
                at = np.minimum(np.searchsorted(pairs, links), max(len(pairs) - 1, 0))
                hit = pairs[at] == links if len(pairs) else np.zeros(len(links), bool)
                sums = np.concatenate([[0], np.cumsum(np.where(hit, n[at], 0) if len(pairs) else hit)])
                bests = np.concatenate([[0], np.cumsum(hit & is_best[at] if len(pairs) else hit)])
                out = pdf.iloc[a:b].drop(columns="links")
                out["count_sum"], out["n_best"] = np.diff(sums[cut]), np.diff(bests[cut])
                out["rare"] = [links[x:y][~hit[x:y]] for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield out[["row", "count_sum", "n_best", "rare"]]

    found = rows.select("row", "links").mapInPandas(run, "row string, count_sum long, n_best long, rare array<long>")
    found = scratch.keep(found, "scored")
    rare = found.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    rare = rare.join(counts.filter(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    found = found.drop("rare").join(rare, "row", "left")
    return rows.join(found, "row").select(
        *rows.drop("row").columns, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
    )
