"""Repeated strings by merging Burrows-Wheeler transforms of shards.

Every ``LENGTH``-byte string that also starts in a document of a smaller id is covered and
removed. A string's least ``K``-byte piece by hash is an anchor of each text that has the
string, so strings repeat only where anchors do. What repeats around an anchor is decided
on its context, the bytes that such strings can reach:

1. Anchors of one document are dropped; of the rest, equal contexts become one.
2. Contexts that differ at one anchor and share most of what a string has beside it are the
   texts of shards, with two symbols for the anchor itself. Each shard's suffixes are
   ordered by prefix doubling, which gives its transform. The transforms are merged by
   refining their interleave, one symbol of prefix at a time (``DEPTH`` rounds); a border
   that shows in round ``k`` has common prefix ``k - 1``. Intervals of common prefix
   ``DEPTH`` with a smaller id tell which strings of a context repeat.
3. An anchor with more than ``MANY`` contexts would not fit one task: its strings are
   grouped by 128-bit hashes instead, with partial aggregates.

Null and empty texts, and texts shorter than ``LENGTH``, lose nothing. Rows that share an id
are one document for each other: neither removes from the other. Rows without an id come
last. Identical rows get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import ROLLING, Scratch, chunks, mix, text_of

LENGTH = 50
K = 24
REACH = LENGTH - K  # bytes of a context on either side of its anchor
WIDE = K + 2 * REACH
MANY = 20_000
#: Contexts of one merge, and of one shard of it: few enough for the caches of a core.
MERGED = 2_000
SHARD = 500
#: Bytes of UTF-8 are at most 0xF4; as symbols they stand behind the end and the padding, and
#: the first of an anchor's two symbols behind them.
FIRST_ANCHOR = 0xF4 + 3
ANCHORS = (256 - FIRST_ANCHOR) * 255  # 0 is the end of a string only
#: Symbols of a context and of a string, whose anchor counts as two.
COLUMNS = 2 * REACH + 2
DEPTH = REACH + 2
#: Bytes of texts that are looked at at once.
CHUNK = 1 << 18
#: A string's bytes before its anchor, by steps that ``promising`` tells apart.
STEP = 7
LAST = (1 << 63) - 1
ALL = (1 << (REACH + 1)) - 1


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each ``width`` neighbours, by doubling."""
    step, out = 1, x
    while step * 2 <= width:
        out = best(out[:-step], out[step:])
        step *= 2
    return best(out[: len(x) - width + 1], out[width - step :][: len(x) - width + 1]) if width > step else out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes; text, position in them, hash and context hash of each anchor; text begins."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts) + bytes(WIDE), np.uint8)
    sums = ROLLING.sums(data)
    piece = mix(ROLLING.windows(sums, K))
    width = REACH + 1
    least = _slide(piece, width, np.minimum)
    # An anchor is the least of some window that holds it: compare with the largest of those.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, width, np.maximum)[: len(piece)] == piece)
    text = np.searchsorted(begins, at, "right") - 1
    fits = at + K <= begins[np.minimum(text + 1, len(texts))]
    fits &= (text < len(texts)) & (sizes[np.minimum(text, len(texts) - 1)] >= LENGTH)
    at, text = at[fits], text[fits]
    low = np.maximum(at - REACH, begins[text])
    high = np.minimum(at + K + REACH, begins[text + 1])
    shape = ((at - low) * 64 + (high - at)).astype(np.uint64)
    context = mix(ROLLING.ranges(sums, low, high) + shape * np.uint64(0x9E3779B97F4A7C15))
    return data, text, at, piece[at], context, begins


def _each(pdf: pd.DataFrame) -> Iterator[tuple]:
    texts, ids = [t.encode() for t in pdf["text"]], pdf["doc"].values
    for a, b in chunks(texts, CHUNK):
        yield ids[a:b], texts[a:b], *anchors(texts[a:b])


def _listed(docs: DataFrame) -> DataFrame:
    """``h, c, doc``: each anchor of a document with its context, once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, _, _, text, _, h, c, _ in _each(pdf):
                if not len(h):
                    continue
                order = np.lexsort((c, text))
                text, h, c = text[order], h[order], c[order]
                new = np.concatenate([[True], (text[1:] != text[:-1]) | (c[1:] != c[:-1])])
                yield pd.DataFrame({"h": h[new].view(np.int64), "c": c[new].view(np.int64), "doc": ids[text[new]]})

    return docs.mapInPandas(run, "h long, c long, doc long")


def _found(text: np.ndarray, c: np.ndarray, given: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors whose context is among those given for their text, and its place in all of these."""
    sizes = [len(g) for g in given]
    flat = np.concatenate(given).astype(np.int64)
    names, rank = np.unique(flat, return_inverse=True)
    key = np.repeat(np.arange(len(given)), sizes) * len(names) + rank
    order = np.argsort(key)
    place = np.minimum(np.searchsorted(names, c.view(np.int64)), len(names) - 1)
    known = np.flatnonzero(names[place] == c.view(np.int64))
    wanted = text[known] * len(names) + place[known]
    at = np.minimum(np.searchsorted(key[order], wanted), len(key) - 1)
    hit = key[order][at] == wanted
    return known[hit], order[at[hit]]


def _contexts(docs: DataFrame) -> DataFrame:
    """``h, c, doc, low, context`` (for each row): bytes of the wanted contexts, ``low`` of them before the anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            wanted, row = pdf["wanted"].values, 0
            for ids, texts, data, text, at, h, c, begins in _each(pdf):
                found, place = _found(text, c, list(wanted[row : row + len(texts)]))
                row += len(texts)
                # The first anchor of each context of a text.
                _, first = np.unique(place, return_index=True)
                one = found[first]
                text, at = text[one], at[one]
                low, high = np.maximum(at - REACH, begins[text]), np.minimum(at + K + REACH, begins[text + 1])
                joined = data.tobytes()
                yield pd.DataFrame({
                    "h": h[one].view(np.int64), "c": c[one].view(np.int64), "doc": ids[text], "low": (at - low).astype(np.int32),
                    "context": [joined[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)],
                })

    return docs.mapInPandas(run, "h long, c long, doc long, low int, context binary")


def suffixes(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of equally long strings (rows), by prefix doubling; equal ones by row."""
    rows, width = symbols.shape
    rank, step = symbols.astype(np.int64), 1
    while step < width:
        ahead = np.zeros_like(rank)
        ahead[:, :-step] = rank[:, step:] + 1
        key = (rank * (rank.max() + 2) + ahead).ravel()
        order = np.argsort(key)  # equal keys get one rank in any order
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(rows * width, np.int64)
        rank[order] = new
        rank = rank.reshape(rows, width)
        if new[-1] + 1 == rows * width:
            break
        step *= 2
    return np.argsort(rank.ravel(), kind="stable")


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all shards' strings ordered by ``depth`` symbols, and each one's common prefix with the one before.

    A shard is a matrix of strings that end with the symbol 0. Suffixes are numbered as
    they stand, shard after shard. Equal prefixes of ``depth`` have that common prefix.
    """
    orders, transforms, steps, at = [], [], [], 0
    for strings in shards:
        order = suffixes(strings)
        before = np.roll(strings, 1, axis=1).ravel()[order]
        # Where the suffix that is one symbol longer stands in its shard.
        step = np.empty(len(order), np.int32)
        step[np.argsort(before, kind="stable")] = np.arange(at, at + len(order), dtype=np.int32)
        orders.append(order + at)
        transforms.append(before)
        steps.append(step)
        at += strings.size
    transform, step = np.concatenate(transforms), np.concatenate(steps)
    starts = np.cumsum([0, *[s.size for s in shards[:-1]]])
    ends = np.concatenate([np.arange(a, a + len(s), dtype=np.int32) for a, s in zip(starts, shards, strict=True)])
    # The interleave, as the next unread place of a shard for each position.
    unread, block = np.arange(at, dtype=np.int32), np.zeros(at, np.int32)
    common = np.full(at, -1, np.int16)
    for k in range(1, depth + 1):
        symbol = transform[unread]
        moved = np.argsort(symbol, kind="stable")
        unread, block, front = step[unread[moved]], block[moved], symbol[moved]
        # Ends of strings have no further symbol: they stay one block in their first order.
        unread[: len(ends)], block[: len(ends)] = ends, 0
        border = np.concatenate([[True], (front[1:] != front[:-1]) | (block[1:] != block[:-1])])
        common[border & (common < 0)] = k - 1
        block = np.cumsum(border, dtype=np.int32)
        if border.all():
            break
    common[common < 0] = depth
    return np.concatenate(orders)[unread], common


def promising(contexts: list[bytes], lows: np.ndarray) -> np.ndarray:
    """May a string around the anchor stand in another of the contexts?

    Of a string with ``a`` to ``a + STEP - 1`` bytes before the anchor, the ``a`` bytes before it
    and the least number behind it must be in another context too.
    """
    data = np.frombuffer(b"".join(contexts) + bytes(WIDE), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes) - sizes
    sums = ROLLING.sums(data)
    out = np.zeros(len(contexts), bool)
    for before in range(0, REACH + 1, STEP):
        width = before + K + max(REACH - before - STEP + 1, 0)
        fits = (lows >= before) & (sizes - lows >= width - before)
        start = (begin + lows - before)[fits]
        _, place, times = np.unique(ROLLING.ranges(sums, start, start + width), return_inverse=True, return_counts=True)
        out[fits] |= times[place] > 1
    return out


def repeats(contexts: list[bytes], lows: np.ndarray, docs: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """For each context, bits of the strings that start in a context of a smaller id.

    Bit ``j``: the string from ``j - REACH`` bytes off the anchor on. Contexts of one ``anchor``
    (a number below ``ANCHORS``) have the same bytes there. A string's least piece stands at one
    place in it wherever the string occurs, so strings are compared with equal bits only; that is
    what the anchor's symbols do, the first of which is no byte.
    """
    n = len(contexts)
    symbols = np.zeros((n, COLUMNS + 1), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    left = REACH - lows  # symbols missing in front
    flat = np.frombuffer(b"".join(contexts), np.uint8) + np.uint8(2)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left[row]
    symbols[:, :COLUMNS] = 1
    beside = (column < REACH) | (column >= REACH + K)
    row, column = row[beside], column[beside]
    symbols[row, np.where(column < REACH, column, column - K + 2)] = flat[beside]
    symbols[:, REACH], symbols[:, REACH + 1] = FIRST_ANCHOR + anchor // 255, 1 + anchor % 255
    place, common = merge([symbols[a : a + SHARD] for a in range(0, n, SHARD)], DEPTH)
    string, offset = place // (COLUMNS + 1), place % (COLUMNS + 1)
    valid = (offset >= left[string]) & (offset + LENGTH <= left[string] + sizes[string])
    start = np.flatnonzero(common < DEPTH)
    own = np.where(valid, docs[string], LAST)
    least = np.minimum.reduceat(own, start)[np.searchsorted(start, np.arange(len(place)), "right") - 1]
    hit = valid & (least < docs[string])
    bits = np.zeros(n, np.int64)
    np.bitwise_or.at(bits, string[hit], np.int64(1) << offset[hit])
    return bits


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[promising(list(pdf["context"]), pdf["low"].values)]
    if not len(pdf):
        return pd.DataFrame({"c": [], "bits": []}, dtype=np.int64)
    anchor = np.cumsum(np.concatenate([[0], pdf["h"].values[1:] != pdf["h"].values[:-1]]))
    cuts = np.searchsorted(anchor, np.arange(0, anchor[-1] + 1 + ANCHORS, ANCHORS))
    parts = [(pdf.iloc[a:b], anchor[a:b] % ANCHORS) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
    bits = [repeats(list(p["context"]), p["low"].values, p["doc"].values, n) for p, n in parts]
    return pd.DataFrame({"c": pdf["c"].values, "bits": np.concatenate(bits)})


def decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``c, bits`` of contexts (``h, c, doc, low, context``) that are sorted by anchor."""
    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        while len(held) >= MERGED:
            # Up to the last anchor that is complete.
            edge = np.flatnonzero(held["h"].values[1:] != held["h"].values[:-1]) + 1
            if not len(edge):
                break
            at = edge[edge <= 2 * MERGED][-1] if (edge <= 2 * MERGED).any() else edge[0]
            yield _merged(held.iloc[:at])
            held = held.iloc[at:].reset_index(drop=True)
    if held is not None and len(held):
        yield _merged(held)


def _decided(rows: DataFrame) -> DataFrame:
    """``c, bits`` of contexts, dealt by anchor."""
    return rows.repartition("h").sortWithinPartitions("h").mapInPandas(decided, "c long, bits long")


def _by_strings(rows: DataFrame) -> DataFrame:
    """``c, bits`` by a hash of every string, for anchors with very many contexts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for c, doc, low, context in zip(pdf["c"], pdf["doc"], pdf["low"], pdf["context"], strict=True):
                for j in range(len(context) - LENGTH + 1):
                    digest = hashlib.blake2b(context[j : j + LENGTH], digest_size=16).digest()
                    parts.append((c, doc, j + REACH - low, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
            yield pd.DataFrame(parts, columns=["c", "doc", "j", "s1", "s2"])

    strings = rows.mapInPandas(run, "c long, doc long, j int, s1 long, s2 long")
    first = strings.groupBy("s1", "s2").agg(F.min("doc").alias("first"))
    hits = strings.join(first, ["s1", "s2"]).filter("first < doc")
    return hits.select("c", "j").distinct().groupBy("c").agg(F.sum(F.expr("shiftleft(1L, j)")).alias("bits"))


def removals(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc`` with ``marks``: its contexts that hold repeats, and bits of the repeated strings."""
    found = _listed(docs)
    span = found.groupBy("h").agg(F.min("doc").alias("d1"), F.max("doc").alias("d2"), F.min("c").alias("c1"), F.max("c").alias("c2"))
    span = scratch.keep(span.filter("d1 < d2").select("h", (F.col("c1") != F.col("c2")).alias("mixed")), "anchors")
    met = scratch.keep(found.join(span, "h").select("c", "doc", "mixed"), "met")
    first = scratch.keep(met.groupBy("c").agg(F.min("doc").alias("first"), F.first("mixed").alias("mixed")), "contexts")
    wanted = first.filter("mixed").groupBy(F.col("first").alias("doc")).agg(F.collect_list("c").alias("wanted"))
    bytes_of = scratch.keep(_contexts(docs.join(wanted, "doc")), "bytes")
    many = bytes_of.groupBy("h").agg(F.count("*").alias("k")).filter(F.col("k") > MANY).select("h", F.lit(True).alias("many"))
    bytes_of = bytes_of.join(many, "h", "left")
    bits = _decided(bytes_of.filter("many is null").drop("many")).unionByName(_by_strings(bytes_of.filter("many").drop("many")))
    # Rows of one id and text give a context more than once.
    bits = scratch.keep(bits.filter("bits <> 0").groupBy("c").agg(F.bit_or("bits").alias("bits")), "bits")
    # A later copy of a whole context loses all its strings, the first one what its bits say.
    own = first.join(bits, "c", "left").select("c", "first", F.coalesce("bits", F.lit(0)).alias("bits"))
    marked = met.select("c", "doc").join(own, "c")
    marked = marked.select("doc", "c", F.when(F.col("doc") > F.col("first"), F.lit(ALL)).otherwise(F.col("bits")).alias("bits")).filter("bits <> 0")
    return marked.groupBy("doc").agg(F.collect_list("c").alias("cs"), F.collect_list("bits").alias("bs"))


def removed_bytes(texts: list[bytes], cs: list[np.ndarray], bs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Is each byte of the joined texts covered by a repeated string, and where texts begin."""
    _, text, at, _, c, begins = anchors(texts)
    cover = np.zeros(begins[-1] + 1, np.int32)
    found, place = _found(text, c, cs)
    at, text, bits = at[found], text[found], np.concatenate(bs).astype(np.int64)[place]
    for j in range(REACH + 1):
        start = at - REACH + j
        start = start[((bits >> j) & 1 == 1) & (start >= begins[text]) & (start + LENGTH <= begins[text + 1])]
        # Anchors are distinct, so no place is named twice.
        cover[start] += 1
        cover[start + LENGTH] -= 1
    return np.cumsum(cover)[:-1] > 0, begins


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def deduplicated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept``, the bytes that stay."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    marks = removals(rows.select("doc", "text"), scratch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, marked = [t.encode() for t in pdf["text"]], pdf["cs"].notna().values
            names = pdf["doc_id"].astype("Int64")
            for a, b in chunks(texts, CHUNK):
                out = [(name, len(text), 0, 0, text) for name, text in zip(names[a:b], texts[a:b], strict=True)]
                some = np.flatnonzero(marked[a:b])
                if len(some):
                    own = [texts[a + i] for i in some]
                    gone, begins = removed_bytes(own, list(pdf["cs"].values[some + a]), list(pdf["bs"].values[some + a]))
                    for i, text, start, end in zip(some, own, begins[:-1], begins[1:], strict=True):
                        part = gone[start:end]
                        runs = int(part[:1].sum() + (part[1:] & ~part[:-1]).sum())
                        out[i] = (out[i][0], len(text), int(part.sum()), runs, np.frombuffer(text, np.uint8)[~part].tobytes())
                yield _frame(out)

    def _frame(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    return rows.join(marks, "doc", "left").select("doc_id", "text", "cs", "bs").mapInPandas(run, RESULT)
