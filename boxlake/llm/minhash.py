"""MinHash near-duplicates with sequential Bayesian verification.

Texts of equal shingle sets are one class, and each class has a signature of ``HASHES``
minima, one byte of each kept. ``BANDS`` bands of ``ROWS`` bytes name the buckets in which
classes are candidates of each other: two sets of likeness 0.8 share none of them with
probability 3e-6. A pair of candidates is compared in batches that end at ``STEPS`` hashes: with a uniform
prior on the chance of equal bytes, the posterior after m of n matches is a beta
distribution, and the pair is dropped once it gives a likeness of 0.8 or more at most the
probability ``MISS``. Then the counts of their hashes by group, ``SHORT`` bits of each, show how
many stand in one set only at least; for a link these are few. What survives is verified on its
whole sets.

Rounds of candidates join most of a group first: the member of a bucket that meets most
others is its hub, and each class is compared with the hub of most of its buckets, one pair
for each class and round. Then all pairs of
different components in a bucket are compared, each pair only in the first bucket that it
shares; a bucket of more than ``BLOCK`` classes is cut into blocks, and every pair of blocks
is compared. No bucket, group or number of partners is capped.

A null or empty text, or one without words, has an empty set and is linked with nothing;
fewer words than ``WORDS`` are one shingle. Rows that share an id count as one document. Rows
without an id get no component and stay. Repeated rows get equal results; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from boxlake.llm.common import Scratch, chunks, least_apart, mix, packed_counts, text_of, word_hashes, words_of
from boxlake.llm.graph import components

WORDS = 4
#: Links need ``100 * shared >= PERCENT * together``.
PERCENT = 80
BANDS, ROWS = 32, 5
#: Hashes compared by the end of each batch; the first holds the bands.
STEPS = (BANDS * ROWS, 256, 384, 512)
HASHES = STEPS[-1]
MISS = 1e-6
#: Groups of a set's hashes, and the bits that are kept of how many are in each.
GROUPS, SHORT = 2048, 2
BLOCK = 2_000
ROUNDS = 1
FEW = 48
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32) | np.uint32(1)
_SHIFTS = mix(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def least_matches() -> list[int]:
    """For each batch, the fewest equal bytes so far that leave a pair in.

    Equal bytes have chance ``c = s + (1 - s) / 256`` at likeness ``s``. The posterior
    probability of ``c`` at or above a bound after ``m`` of ``n`` matches is the chance of at
    most ``m`` successes in ``n + 1`` trials at that bound.
    """
    bound = PERCENT / 100 + (1 - PERCENT / 100) / 256
    out = []
    for n in STEPS:
        total, m = 0.0, -1
        while total <= MISS:
            m += 1
            chance = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            total += math.exp(chance + m * math.log(bound) + (n + 1 - m) * math.log1p(-bound))
        out.append(m)
    return out


LEAST = least_matches()


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, with repeats, and where each text's begin (one entry more)."""
    data, starts, ends, first = words_of(texts)
    with np.errstate(over="ignore"):
        words = word_hashes(data, starts, ends)
        full = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for k in range(WORDS):
            full = full * _STEP + words[k : k + len(full)]
        full = mix(full)
        number = np.diff(first)
        keep = np.ones(len(words), bool)
        # The last places of a text begin no shingle, but a short text is one by itself.
        for k in range(1, WORDS):
            at = first[1:][number >= k] - k
            keep[at] = False
        short = np.flatnonzero((number > 0) & (number < WORDS))
        full = np.concatenate([full, np.zeros(len(words) - len(full), np.uint64)])
        for i in short:
            one = np.uint64(number[i])
            for word in words[first[i] : first[i + 1]]:
                one = one * _STEP + word
            full[first[i]] = mix(np.array([one], np.uint64))[0]
            keep[first[i]] = True
    size = np.where(number >= WORDS, number - WORDS + 1, np.minimum(number, 1))
    return full[keep], np.concatenate([[0], np.cumsum(size)])


def _sets(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Number of the row, and its distinct shingle hashes in order."""
    texts = [t.encode() for t in pdf["text"]]
    for a, b in chunks(texts):
        full, cut = shingles(texts[a:b])
        for i in range(b - a):
            yield a + i, np.unique(full[cut[i] : cut[i + 1]])


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, n, s1, s2``: set size and a 128-bit identity of the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            with np.errstate(over="ignore"):
                for _, own in _sets(pdf):
                    s1, s2 = int(mix(own + _STEP).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(own ^ _STEP), initial=0))
                    rows.append((len(own), s1 - (1 << 63), s2 - (1 << 63)))
            out = pd.DataFrame(rows, columns=["n", "s1", "s2"])
            out.insert(0, "doc_id", pdf["doc_id"].values)
            yield out

    return docs.mapInPandas(run, "doc_id long, n long, s1 long, s2 long")


def signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Size of each text's set, ``HASHES`` bytes (that mean nothing for an empty one), and counts by group."""
    full, cut = shingles(texts)
    sets = [np.unique(full[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    n = np.array([len(own) for own in sets], np.int64)
    some = np.flatnonzero(np.diff(cut))
    out = np.zeros((len(texts), HASHES), np.uint8)
    if len(some):
        x, begin = (full >> np.uint64(32)).astype(np.uint32), cut[some]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                least = np.minimum.reduceat(x * _FACTORS[k] + _SHIFTS[k], begin)
                out[some, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return n, out, [packed_counts(own, GROUPS, SHORT) for own in sets]


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One bucket for each band: its number and its bytes."""
    rows = signed[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.int64)
    key = np.broadcast_to(np.arange(BANDS), rows.shape[:2])
    for k in range(ROWS):
        key = (key << 8) | rows[:, :, k]
    return key


def signed(docs: DataFrame) -> DataFrame:
    """``node, n, sig, counts, keys`` of every row that has words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            for a, b in chunks(texts):
                n, found, counts = signatures(texts[a:b])
                sigs = [row.tobytes() for row in found]
                out = pd.DataFrame({"node": pdf["doc_id"].values[a:b], "n": n, "sig": sigs, "counts": counts, "keys": list(band_keys(found))})
                yield out[n > 0]

    return docs.mapInPandas(run, "node long, n long, sig binary, counts binary, keys array<long>")


def survive(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the pairs of signatures (rows) that no batch drops."""
    at, met, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for step, least in zip(STEPS, LEAST, strict=True):
        met = met + (left[at, done:step] == right[at, done:step]).sum(1)
        keep = met >= least
        at, met, done = at[keep], met[keep], step
    return at


@F.pandas_udf(BooleanType())
def _likely(left: pd.Series, right: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(v), np.uint8).reshape(-1, HASHES) for v in (left, right))
    out = np.zeros(len(left), bool)
    out[survive(x, y)] = True
    return pd.Series(out)


@F.pandas_udf(BooleanType())
def _linked_sets(left: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(left, right, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    return pd.Series(out, dtype=bool)


def whole_sets(docs: DataFrame) -> DataFrame:
    """``node, tokens``: the whole set of each row, as sorted 64-bit hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, rows, held = pdf["doc_id"].values, [], 0
            for i, own in _sets(pdf):
                rows.append((ids[i], own.tobytes()))
                held += len(own)
                if held > 500_000:
                    yield pd.DataFrame(rows, columns=["node", "tokens"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["node", "tokens"])

    return docs.mapInPandas(run, "node long, tokens binary")


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of ``pairs(a, b)`` whose whole sets are alike enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = scratch.keep(whole_sets(docs.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")), "sets")
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("tokens").alias(f"t{end}")), end)
    return scratch.keep(pairs.filter(_linked_sets("ta", "tb")).select("a", "b").distinct(), "links")


def _compared(rows: DataFrame) -> DataFrame:
    """Surviving pairs ``a, b`` of different labels, each from the first bucket that it shares.

    ``rows`` are dealt and sorted by ``key, low, high``; a bucket may go on in the next batch.
    """

    def close(group, labels, n, sig, band) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of small groups that the first batch leaves, one distance at a time."""
        for d in range(1, len(group)):
            x = np.flatnonzero(group[d:] == group[:-d])
            if not len(x):
                return
            x = x[(labels[x] != labels[x + d]) & (100 * np.minimum(n[x], n[x + d]) >= PERCENT * np.maximum(n[x], n[x + d]))]
            for a in range(0, len(x), 20_000):
                left = x[a : a + 20_000]
                same = sig[left, : STEPS[0]] == sig[left + d, : STEPS[0]]
                fits = (same.sum(1) >= LEAST[0]) & (same.reshape(-1, BANDS, ROWS).all(2).argmax(1) == band[left])
                yield left[fits], left[fits] + d

    def across(labels, own, both, n, sig, band) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for a large group; of two blocks, the pairs between them."""
        names, place, times = np.unique(labels, return_inverse=True, return_counts=True)
        # Of two labels one is not the most frequent, and of two such rows one comes later.
        rest = place != times.argmax()
        turned = np.ascontiguousarray(sig[:, : STEPS[0]].T)  # one hash of all rows after the other
        for i in np.flatnonzero(rest):
            fits = (labels != labels[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i]))
            fits &= (own != own[i]) | (not both)
            fits[: i + 1] &= ~rest[: i + 1]
            same = turned == turned[:, i : i + 1]
            j = np.flatnonzero(fits & (np.add.reduce(same.view(np.uint8), 0, np.uint8) >= LEAST[0]))
            j = j[same[:, j].reshape(BANDS, ROWS, -1).all(1).argmax(0) == band]
            yield np.full(len(j), i), j

    def search(pdf: pd.DataFrame, cut: np.ndarray) -> pd.DataFrame:
        sig, counts = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), -1) for c in ("sig", "counts"))
        n, labels, nodes, own, key = (pdf[c].values for c in ("n", "label", "node", "own", "key"))
        both, band = (pdf["low"] != pdf["high"]).values, key >> (8 * ROWS)
        lengths = np.diff(np.append(cut, len(pdf)))
        group = np.repeat(np.arange(len(cut)), lengths)
        few = np.flatnonzero(np.repeat(lengths <= FEW, lengths) & ~both)
        tries = [(few, close(group[few], labels[few], n[few], sig[few], band[few]))]
        for a, b in zip(cut, cut + lengths, strict=True):
            if b - a > FEW or both[a]:
                tries.append((np.arange(a, b), across(labels[a:b], own[a:b], both[a], n[a:b], sig[a:b], band[a])))
        found = [np.zeros((0, 2), np.int64)]
        for rows, tried in tries:
            for x, y in tried:
                x, y = rows[x], rows[y]
                keep = survive(sig[x], sig[y])
                x, y = x[keep], y[keep]
                keep = (100 + PERCENT) * least_apart(counts, x, y, SHORT) <= (100 - PERCENT) * (n[x] + n[y])
                x, y = nodes[x[keep]], nodes[y[keep]]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            place = pdf[["key", "low", "high"]].values
            cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(1)]))
            rest = pdf.iloc[cut[-1] :]
            if len(cut) > 1:
                yield search(pdf.iloc[: cut[-1]], cut[:-1])
        if rest is not None and len(rest):
            yield search(rest, np.zeros(1, np.int64))

    return rows.mapInPandas(run, "a long, b long")


def classes_and_labels(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, s1, s2, node`` of every row (``node``: the least id with that set), and
    ``node, label`` of every class that has links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sized = scratch.keep(sizes(docs), "sizes")
    first = sized.filter("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    first = scratch.keep(first, "classes")
    # Of rows that share an id, each has its own signature.
    listed = scratch.keep(signed(docs.join(first.select("node"), F.col("doc_id") == F.col("node"), "left_semi")), "signed")
    marks = listed.select("node", "n", "sig", "counts").distinct()

    shown = listed.select("node", F.explode("keys").alias("key")).distinct()
    met = shown.join(shown.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1"), "key")
    met = scratch.keep(met, "met")
    degree = met.groupBy("node").agg(F.sum("k").alias("degree"))
    met = scratch.keep(met.join(degree, "node").select("node", "key", F.struct("degree", (-F.col("node")).alias("node")).alias("rank")), "ranked")

    labels, links, tried = None, None, None
    for _ in range(ROUNDS):
        if labels is None:
            stands = met.select("key", F.col("node").alias("label"), "rank")
        else:
            stands = met.join(labels, "node", "left").groupBy("key", F.coalesce("label", "node").alias("label")).agg(F.max("rank").alias("rank"))
        hub = stands.groupBy("key").agg(F.max(F.struct("rank", "label")).alias("hub"), F.count("*").alias("k")).filter("k > 1")
        pairs = stands.join(hub, "key").filter("label <> hub.label")
        pairs = pairs.select((-F.col("rank.node")).alias("node"), (-F.col("hub.rank.node")).alias("hub"))
        pairs = pairs.groupBy("node", "hub").agg(F.count("*").alias("k"))
        if tried is not None:
            pairs = pairs.join(tried, ["node", "hub"], "left_anti")
        best = pairs.groupBy("node").agg(F.max(F.struct("k", (-F.col("hub")).alias("hub"))).alias("best"))
        best = scratch.keep(best.select("node", (-F.col("best.hub")).alias("hub")), "best")
        tried = best if tried is None else tried.unionByName(best)
        new = verified(scratch.keep(_tested(best, marks), "likely"), docs, scratch)
        links = new if links is None else links.unionByName(new)
        if labels is not None and new.isEmpty():
            break
        labels = scratch.keep(components(scratch, links), "labels")

    rows = _labelled(met, labels)
    size = rows.groupBy("key", "label").agg(F.count("*").alias("k")).groupBy("key").agg(
        F.sum("k").alias("k"), F.count("*").alias("labels")
    ).filter("labels > 1").select("key", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(size, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(marks, "node").select(
        "key", "node", "label", "n", "sig", "counts", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    pairs = scratch.keep(_compared(rows).distinct(), "pairs")
    links = links.unionByName(verified(pairs, docs, scratch))
    return sized.join(first, ["s1", "s2"], "left"), scratch.keep(components(scratch, links), "labels")


def _labelled(met: DataFrame, labels: DataFrame) -> DataFrame:
    return met.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))


def _tested(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Those of ``pairs(node, hub)`` that sizes and signatures leave possible, as ``a, b``."""
    for end in ("node", "hub"):
        pairs = pairs.join(marks.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"s_{end}")), end)
    pairs = pairs.filter(f"100 * least(n_node, n_hub) >= {PERCENT} * greatest(n_node, n_hub)")
    pairs = pairs.filter(_likely("s_node", "s_hub"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (least id reachable by links) and ``kept`` of every row."""
    keys, labels = classes_and_labels(docs, scratch)
    of = keys.select("s1", "s2", "node").distinct().join(labels, "node", "left")
    of = of.select("s1", "s2", F.coalesce("label", "node").alias("component")).filter("component is not null")
    found = keys.drop("node").join(of, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
