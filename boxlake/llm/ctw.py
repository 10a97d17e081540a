"""Language-model scoring by context-tree weighting over bytes.

A text is its words, A-Z lower-cased, each followed by a blank, the last by a line end. Every
byte is eight binary decisions; a node of the tree is the last ``d`` bytes (0 to ``DEPTH``)
and the bits of the next byte so far. Counts of training documents give each node a
Krichevsky-Trofimov estimate and, from the leaves up, the weight of stopping there against
going on; from the root down, these weights mix the estimates of all depths of a path. A
path ends at the last node that was visited. Score: log10 of the product of these decisions.

Counts of words and byte strings are summed over all training documents by Spark, and the
whole tree is built by one aggregate for each depth. Every distinct byte string of any
document gets its chance from that tree by joins, one for each depth that it needs. What
every task needs whole is bounded: the chances of the ``HEAD_GRAMS`` most frequent byte
strings and the counts of the ``HEAD_WORDS`` most frequent words, both chosen by a count
that all of them reach. Rarer ones get the same values by a join; the bounds change no score.

A null or empty text is the line end alone. Rows without an id are held out. Identical rows
get equal results and count as often as they stand there. Without training documents every
decision has probability 1/2, and the word score is that of empty counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import LOWER, Scratch, chunks, reach, text_of, word_hashes, words_of

DEPTH = 5
HEAD_GRAMS = 1 << 20
HEAD_WORDS = 1 << 17
#: Entries beside the merged ones that a task holds before it merges again, and merged ones that it passes on.
HELD, PASSED = 250_000, 1_000_000
#: Text of one vectorised step.
STEP_BYTES = 1 << 18
SLOTS = 21
END = 0x5EED_0F_E4D
_LINE = 10


def byte_sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word of each text, gram before and with each byte, first gram of each text.

    A gram is ``DEPTH`` bytes of context and the byte itself; before a text stand line ends.
    """
    data, starts, ends, first = words_of(texts, lower=False)
    data = LOWER[data]
    words = word_hashes(data, starts, ends)
    empty = np.diff(first) == 0
    begin = np.insert(starts, first[:-1], len(data))
    size = np.insert(ends - starts + 1, first[:-1], np.where(empty, DEPTH + 1, DEPTH))
    out = np.cumsum(size) - size
    where = np.repeat(begin - out, size) + np.arange(int(size.sum()))
    data = np.concatenate([data, np.full(DEPTH + 1, _LINE, np.uint8)])
    line = data[where]
    heads = first[:-1] + np.arange(len(texts))  # where each text's pad is among the segments
    tails = np.append(heads[1:], len(size)) - 1
    last = out + size - 1
    line[last[np.setdiff1d(np.arange(len(size)), heads)]] = 32
    line[last[tails]] = _LINE
    gram = np.zeros(len(line) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        gram = (gram << np.uint64(8)) | line[k : k + len(gram)]
    # Grams that end within a pad of the next text are not of any text.
    keep = np.ones(len(line), bool)
    for k in range(DEPTH):
        keep[out[heads] + k] = False
    number = np.cumsum(keep)
    bound = np.append(out[heads], len(line))
    return words, first, gram[keep[DEPTH:]], np.concatenate([[0], number[bound[1:] - 1]])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def counted(docs: DataFrame) -> DataFrame:
    """``kind, key, n``: words (0) and grams (1) of the texts, summed within each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[list, list]] = [([], []), ([], [])]
        merged = [0, 0]  # entries after the last merge

        def give(kind: int, final: bool) -> Iterator[pd.DataFrame]:
            keys, counts = held[kind]
            if keys and (final or sum(map(len, keys)) > 2 * merged[kind] + HELD):
                key, n = _merged(keys, counts)
                if final or len(key) > PASSED:
                    keys[:], counts[:], merged[kind] = [], [], 0
                    for a in range(0, len(key), 100_000):
                        yield pd.DataFrame({"kind": np.int32(kind), "key": key[a : a + 100_000].view(np.int64), "n": n[a : a + 100_000]})
                else:
                    keys[:], counts[:], merged[kind] = [key], [n], len(key)

        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            for a, b in chunks(texts, STEP_BYTES):
                words, _, grams, _ = byte_sequences(texts[a:b])
                words = np.append(words, np.full(b - a, END, np.uint64))
                for kind, found in ((0, words), (1, grams)):
                    key, n = np.unique(found, return_counts=True)
                    held[kind][0].append(key)
                    held[kind][1].append(n)
                    yield from give(kind, False)
        for kind in (0, 1):
            yield from give(kind, True)

    return docs.select("text").mapInPandas(run, "kind int, key long, n long")


def _log_gamma(x: Column) -> Column:
    """Stirling's series five steps up."""
    z = x + 5
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    return series - F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4))


def levels_of(grams: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """``node, p`` for each depth: all visited nodes, and their chance of a 1 mixed over the path."""
    bits = F.explode(F.sequence(F.lit(0), F.lit(7)))
    byte = F.col("key").bitwiseAND(F.lit(255))
    rows = grams.select("key", "n", byte.alias("byte"), bits.alias("j"))
    node = F.expr("shiftleft(1L, j) | shiftright(byte, 8 - j)")
    rows = rows.select(
        F.shiftleft(F.shiftright("key", 8), 8).bitwiseOR(node).alias("node"), "n", F.expr("shiftright(byte, 7 - j) & 1").alias("bit")
    )
    rows = rows.groupBy("node").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    levels = []
    for d in range(DEPTH, -1, -1):
        if levels:
            below = levels[-1]
            rows = below.groupBy(F.col("node").bitwiseAND(F.lit((1 << (8 * d + 8)) - 1)).alias("node")).agg(
                F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("split")
            )
        alone = _log_gamma(F.col("n0") + 0.5) + _log_gamma(F.col("n1") + 0.5) - math.log(math.pi) - _log_gamma(F.col("n0") + F.col("n1") + 1.0)
        rows = rows.withColumn("alone", alone)
        if levels:
            # Of the two, the larger logarithm is taken out of the sum.
            gap = F.col("split") - F.col("alone")
            rows = rows.withColumn("weighted", F.greatest("split", "alone") + F.log1p(F.exp(-F.abs(gap))) - math.log(2))
            rows = rows.withColumn("stop", F.lit(1.0) / (1.0 + F.exp(F.least(gap, F.lit(700.0)))))
        else:
            rows = rows.withColumn("weighted", F.col("alone")).withColumn("stop", F.lit(1.0))
        one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
        rows = rows.select("node", "n0", "n1", "weighted", "stop", one.alias("one"))
        levels.append(scratch.keep(rows, f"tree-{d}"))
    levels.reverse()

    out, mixed = [], None
    for d, level in enumerate(levels):
        if mixed is None:
            level = level.withColumn("mix", F.lit(0.0)).withColumn("left", F.lit(1.0))
        else:
            parent = mixed.select(F.col("node").alias("parent"), "mix", "left")
            level = level.withColumn("parent", F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1))).join(parent, "parent")
        p = F.col("mix") + F.col("left") * F.col("one")
        if d == DEPTH:
            out.append(level.select("node", p.alias("p")))
            break
        mixed = level.select(
            "node", p.alias("p"), (F.col("mix") + F.col("left") * F.col("stop") * F.col("one")).alias("mix"),
            (F.col("left") * (1 - F.col("stop"))).alias("left"),
        )
        mixed = scratch.keep(mixed, f"mixed-{d}")
        out.append(mixed.select("node", "p"))
    return out


def chances(grams: DataFrame, levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """``key, n, log``: log10 of the chance of each gram's byte after its context.

    ``done`` bits of a byte are settled by deeper nodes; the nodes that a shorter context
    has are the first ones of the path too, and at least as many.
    """
    byte = F.col("key").bitwiseAND(F.lit(255))
    rows = grams.select("key", "n", F.lit(0.0).alias("log"), F.lit(0).alias("done"))
    parts = []
    for d in range(DEPTH, -1, -1):
        context = F.shiftright("node", 8).alias("context")
        entry = F.struct(F.col("node").bitwiseAND(F.lit(255)).cast("int"), "p")
        known = levels[d].groupBy(context).agg(F.map_from_entries(F.collect_list(entry)).alias("nodes"))
        known = F.broadcast(known) if d < 2 else known  # 256 contexts at most
        rows = rows.withColumn("context", F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * d)) - 1)))
        rows = rows.join(known, "context", "left").withColumn("byte", byte.cast("int"))
        one = "try_element_at(nodes, shiftleft(1, j) | shiftright(byte, 8 - j))"
        bit = "shiftright(byte, 7 - j) & 1"
        rows = rows.withColumn("logs", F.expr(f"transform(sequence(0, 7), j -> log10(if({bit} = 1, {one}, 1 - {one})))"))
        new = F.expr("aggregate(slice(logs, done + 1, 8), 0D, (s, x) -> s + coalesce(x, 0D))")
        met = F.greatest("done", F.size(F.filter("logs", lambda x: x.isNotNull())))
        rows = scratch.keep(rows.select("key", "n", (F.col("log") + new).alias("log"), met.alias("done")), f"path-{d}")
        parts.append(rows.filter("done = 8").select("key", "n", "log"))
        rows = rows.filter("done < 8")
    parts.append(rows.select("key", "n", (F.col("log") + (8 - F.col("done")) * math.log10(0.5)).alias("log")))
    return reduce(DataFrame.unionByName, parts)


def tree(grams: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """For ``Scorer``, all nodes in this process: keys in order (depth, context, bits), and their chance of a 1."""
    levels = levels_of(grams, scratch)
    got = reduce(DataFrame.unionByName, [level.select((F.col("node") + (d << 50)).alias("key"), "p") for d, level in enumerate(levels)]).toArrow()
    key, p = got["key"].to_numpy(), got["p"].to_numpy()
    order = np.argsort(key)
    return key[order], p[order].astype(np.float32)


def _slots(gram: np.ndarray) -> np.ndarray:
    return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)


class Head:
    """Log10 chances of the most frequent grams; made once, and sent to the tasks as it is."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], logs[order]
        self.slot = np.zeros(1 << SLOTS, np.int32)
        often = np.argsort(n[order], kind="stable")  # of grams that share a slot, the most frequent has it
        self.slot[_slots(self.keys[often])] = often

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log chances, 0 for grams outside the head, and which are in it."""
        if not len(self.keys):
            return np.zeros(len(gram)), np.zeros(len(gram), bool)
        at = self.slot[_slots(gram)]
        miss = np.flatnonzero(self.keys[at] != gram)
        at[miss] = np.minimum(np.searchsorted(self.keys, gram[miss]), len(self.keys) - 1)
        hit = self.keys[at] == gram
        return np.where(hit, self.logs[at], 0.0), hit


class Scorer:
    """The plain version of ``chances`` over a tree in one process; no query uses it."""

    def __init__(self, keys: np.ndarray, chances: np.ndarray):
        self.keys, self.chances = keys, chances
        self.seen = np.full(1 << SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self.known = np.zeros(1 << SLOTS, np.float32)

    def _find(self, depth: np.ndarray, gram: np.ndarray, node: np.ndarray) -> np.ndarray:
        context = (gram >> np.uint64(8)).astype(np.int64) & ((1 << (8 * depth)) - 1)
        key = (depth << 50) + (context << 8) + node
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def fresh(self, gram: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gram))
        if not len(self.keys):
            return total + 8 * math.log10(0.5)
        depth, node = np.full(len(gram), DEPTH, np.int64), np.ones(len(gram), np.int64)
        byte = (gram & np.uint64(255)).astype(np.int64)
        for j in range(7, -1, -1):
            at = self._find(depth, gram, node)
            while True:
                up = np.flatnonzero((at < 0) & (depth > 0))
                if not len(up):
                    break
                depth[up] -= 1
                at[up] = self._find(depth[up], gram[up], node[up])
            bit = (byte >> j) & 1
            one = np.where(at < 0, 0.5, self.chances[at].astype(np.float64))
            total += np.log10(np.where(bit == 1, one, 1 - one))
            node = node * 2 + bit
        return total

    def score(self, gram: np.ndarray) -> np.ndarray:
        slot = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)
        out, miss = self.known[slot].astype(np.float64), np.flatnonzero(self.seen[slot] != gram)
        if len(miss):
            new, place = np.unique(gram[miss], return_inverse=True)
            value = self.fresh(new)
            out[miss] = value.astype(np.float32)[place]
            slot = ((new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)
            self.seen[slot], self.known[slot] = new, value
        return out


def scored(docs: DataFrame, training: Column, scratch: Scratch) -> DataFrame:
    """Every row's ``doc_id, training, n_tokens, n_known, train_tokens, base_score, score``.

    ``training`` says, by columns of ``docs``, whether a row is learned from.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    # Held-out documents only say which grams are wanted, and how often.
    seen = counted(rows.filter("training")).select("kind", "key", "n", F.col("n").alias("wanted"))
    seen = seen.unionByName(counted(rows.filter("not training")).filter("kind = 1").select("kind", "key", F.lit(0).cast("long").alias("n"), F.col("n").alias("wanted")))
    counts = scratch.keep(seen.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("wanted").alias("wanted")), "counts")
    words = counts.filter("kind = 0").select("key", "n")
    all_tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = reach(words, F.col("n"), HEAD_WORDS)
    head = words.filter(F.col("n") >= least).toArrow()
    head_key, head_n = head["key"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(head_key)
    grams = counts.filter("kind = 1")
    levels = levels_of(grams.filter("n > 0").select("key", "n"), scratch)
    paths = chances(grams.select("key", F.col("wanted").alias("n")), levels, scratch)
    often = reach(paths, F.col("n"), HEAD_GRAMS)
    top = paths.filter(F.col("n") >= often).toArrow()
    top = Head(top["key"].to_numpy().view(np.uint64), top["log"].to_numpy(), top["n"].to_numpy())
    model = spark.sparkContext.broadcast((head_key[order], head_n[order], top))
    floor = all_tokens + distinct + 1  # N + 1 * (V + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, frequent = model.value
        value = np.log10((n + 1) / floor)
        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            for a, b in chunks(texts, STEP_BYTES):
                words, first, grams, cut = byte_sequences(texts[a:b])
                at = np.minimum(np.searchsorted(key, words), max(len(key) - 1, 0))
                hit = key[at] == words if len(key) else np.zeros(len(words), bool)
                sums = np.concatenate([[0.0], np.cumsum(np.where(hit, value[at], 0.0) if len(key) else np.zeros(len(words)))])
                hits = np.concatenate([[0], np.cumsum(hit)])
                logs, known = frequent.find(grams)
                total = np.concatenate([[0.0], np.cumsum(logs)])
                # The other grams of each text, and how often they stand there.
                lone = np.flatnonzero(~known)
                owner, gram = np.searchsorted(cut, lone, "right") - 1, grams[lone]
                by = np.lexsort((gram, owner))
                owner, gram = owner[by], gram[by]
                new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1]))[: len(gram)])
                times, part = np.diff(np.append(new, len(gram))), np.searchsorted(owner[new], np.arange(b - a + 1))
                gram = gram[new].view(np.int64)
                rare = words.view(np.int64)
                out = pd.DataFrame({
                    "n_tokens": np.diff(first) + 1, "head_known": hits[first[1:]] - hits[first[:-1]],
                    "head_score": sums[first[1:]] - sums[first[:-1]], "gram_score": total[cut[1:]] - total[cut[:-1]],
                })
                out["rare"] = [rare[x:y][~hit[x:y]] for x, y in zip(first[:-1], first[1:], strict=True)]
                out["grams"] = [gram[x:y] for x, y in zip(part[:-1], part[1:], strict=True)]
                out["times"] = [times[x:y] for x, y in zip(part[:-1], part[1:], strict=True)]
                for name in ("doc_id", "training", "tk"):
                    out[name] = pdf[name].values[a:b]
                yield out

    kinds = "n_tokens long, head_known long, head_score double, gram_score double, rare array<long>, grams array<long>, times array<long>, doc_id long, training boolean, tk long"
    table = scratch.keep(rows.withColumn("tk", F.xxhash64("text")).mapInPandas(run, kinds), "scored")
    # Rows of one id and text are alike: their rare words and grams are summed together and divided.
    lone = table.select("doc_id", "tk", F.explode("rare").alias("key"))
    lone = lone.join(words.filter(F.col("n") < least), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    lone = lone.groupBy("doc_id", "tk").agg(
        F.sum(F.log10((F.col("n") + 1) / F.lit(float(floor)))).alias("rare_score"), F.count_if(F.col("n") > 0).alias("rare_known")
    )
    lone = lone.withColumnsRenamed({"doc_id": "_doc", "tk": "_tk"})
    apart = table.select("doc_id", "tk", F.inline(F.arrays_zip(F.col("grams").alias("key"), F.col("times").alias("times"))))
    apart = apart.join(paths.filter(F.col("n") < often).select("key", "log"), "key")
    apart = apart.groupBy("doc_id", "tk").agg(F.sum(F.col("log") * F.col("times")).alias("path_score"))
    apart = apart.withColumnsRenamed({"doc_id": "_id", "tk": "_text"})
    times = table.groupBy("doc_id", "tk").agg(F.count("*").alias("times")).withColumnsRenamed({"doc_id": "_d", "tk": "_t"})
    table = table.drop("rare", "grams", "times").join(lone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tk") == F.col("_tk")), "left")
    table = table.join(apart, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_text")), "left")
    table = table.join(times, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tk") == F.col("_t")))
    end = words.filter(F.col("key") == END).select(F.max("n")).first()[0] or 0
    return table.select(
        "doc_id", "training", "n_tokens",
        (F.col("head_known") + F.coalesce(F.col("rare_known") / F.col("times"), F.lit(0)) + (1 if end else 0)).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce(F.col("rare_score") / F.col("times"), F.lit(0.0)) + math.log10((end + 1) / floor)).alias("base_score"),
        (F.col("gram_score") + F.coalesce(F.col("path_score") / F.col("times"), F.lit(0.0))).alias("score"),
    )
