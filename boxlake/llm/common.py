"""Helpers that the text operators share: written intermediate tables and byte batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.sources.files import Working

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
READ = "spark.sql.parquet.columnarReaderBatchSize"
# Text that one vectorised step holds at once; a longer text is a step of its own.
CHUNK_BYTES = 1 << 20
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Scratch(Working):
    """Intermediate tables in the shared folder; a table's shuffle files go once it is written.

    With ``batch_bytes``, the batches that Python gets while a table is written are bounded by
    size and not only by rows. With ``read_rows``, so many rows of a file are columns at once.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, batch_bytes: str | None = None, read_rows: int | None = None):
        super().__init__(spark, root)
        self.settings = {CLEANUP: "true"} | ({BATCH: batch_bytes} if batch_bytes else {}) | ({READ: str(read_rows)} if read_rows else {})

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        before = {key: self.spark.conf.get(key, None) for key in self.settings}
        for key, value in self.settings.items():
            self.spark.conf.set(key, value)
        try:
            return super().keep(df, name)
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; a null is an empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once for each place that names it."""
    return F.transform(F.array(value), use)[0]


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Is ``crc32`` of the id as text in the part that models do not see? Null ids are held out."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(True))


def spans(sizes: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of these sizes that have about ``limit`` together."""
    start, end, total = 0, 0, 0
    for size in sizes:
        if end > start and total + size > limit:
            yield start, end
            start, total = end, 0
        total += size + 1
        end += 1
    if start < end:
        yield start, end


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    return spans(map(len, texts), limit)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def packed_counts(hashes: np.ndarray, groups: int, bits: int) -> bytes:
    """How many hashes have each value of their low bits, modulo ``2**bits``, packed into bytes."""
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups) % (1 << bits)
    return (counts.reshape(-1, 8 // bits) << np.arange(0, 8, bits)).sum(1).astype(np.uint8).tobytes()


def _steps_apart(bits: int) -> np.ndarray:
    """Least steps, one up or down modulo ``2**bits`` each, between the counts in any two bytes."""
    fields = (np.arange(256)[:, None] >> np.arange(0, 8, bits)) % (1 << bits)
    up = (fields[:, None] - fields) % (1 << bits)
    return np.minimum(up, (1 << bits) - up).sum(-1).astype(np.uint8).ravel()


_STEPS_APART = {bits: _steps_apart(bits) for bits in (2, 4)}


def least_apart(packed: np.ndarray, x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """For rows ``x`` and ``y`` of packed counts, a number that the hashes in one set only reach.

    Each such hash changes one count by one, so the bound is sure whatever the counts left out.
    """
    out = np.zeros(len(x), np.int64)
    for a in range(0, len(x), 4096):
        part = slice(a, a + 4096)
        both = (packed[x[part]].astype(np.uint16) << 8) | packed[y[part]]
        out[part] = _STEPS_APART[bits][both].sum(1, dtype=np.uint32)
    return out


class Rolling:
    """Hashes of byte ranges from one running sum, equal wherever equal bytes stand."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, seed: int = 7):
        self.codes = np.random.RandomState(seed).randint(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(n, self.BASE, np.uint64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n, self.INVERSE, np.uint64))])

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.down[starts]

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """A hash for each start of ``width`` bytes."""
        n = len(sums) - width
        return (sums[width:] - sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, np.uint64)


ROLLING = Rolling()


def words_of(texts: list[bytes], lower: bool = True, gaps: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, starts and ends of words, and for each text its first word's number.

    Words are maximal runs of bytes other than ``gaps`` (space, tab, line ends, VT and FF);
    A-Z are lower-cased if asked for. The last array has one entry more than there are texts.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    gap = gaps[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(ROLLING.ranges(ROLLING.sums(data), starts, ends))


def reach(rows: DataFrame, count: Column, most: int) -> int:
    """The least power of two that at most ``most`` rows' counts reach."""
    found = {r["p"]: r["k"] for r in rows.groupBy(F.floor(F.log2(count.cast("double"))).alias("p")).agg(F.count("*").alias("k")).collect()}
    total, power = 0, max(found, default=0) + 1
    while power > 0 and total + found.get(power - 1, 0) <= most:
        power -= 1
        total += found.get(power, 0)
    return 1 << power
