"""Document fingerprints from closed syncmers.

A ``K``-byte piece of a text is an anchor if the least of its ``S``-byte inner strings (by
hash) is its first or its last one. That depends on the piece alone, so equal passages have
equal anchors at equal distances wherever they stand. The fingerprint of a text holds the
``SKETCH`` least distinct anchor hashes of the whole text; the likeness of two fingerprints
is the share of the least hashes of both that both have, an estimate of the Jaccard likeness
of the anchor sets, exact where they are small.

A null or empty text has no anchors and an empty fingerprint: its likeness is 1 to another
empty one and 0 to all others. A text without a syncmer has one anchor, its whole content.
For neighbours, rows are in descending order of id, then of a hash of the text; rows
without an id come last. Repeated rows are neighbours of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import CHUNK_BYTES, ROLLING, Scratch, chunks, mix, text_of

K = 24
S = 9  # K - S + 1 is a power of two
SKETCH = 64


def _starts(data: np.ndarray, sums: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Starts of all anchors that lie within one text of the joined bytes."""
    width = K - S + 1
    inner = mix(ROLLING.windows(sums, S))
    if len(inner) < width:
        return np.zeros(0, np.int64)
    least, step = inner, 1
    while step < width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    n = len(least)
    at = np.flatnonzero((least == inner[:n]) | (least == inner[width - 1 : width - 1 + n]))
    text = np.searchsorted(begins, at, "right") - 1
    return at[at + K <= begins[text] + sizes[text]]


def anchors(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Byte positions and hashes of each text's anchors."""
    data = np.frombuffer(b"".join(texts) or b" ", np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    sums = ROLLING.sums(data)
    # Empty texts begin where the next one does; the last of them is found, and it is the full one.
    at = _starts(data, sums, begins, sizes)
    hashes = mix(ROLLING.ranges(sums, at, at + K))
    cut = np.searchsorted(at, np.append(begins, sizes.sum()))
    out = []
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if a == b and sizes[i]:
            whole = mix(ROLLING.ranges(sums, begins[i : i + 1], begins[i : i + 1] + sizes[i]) + np.uint64(sizes[i]))
            out.append((np.zeros(1, np.int64), whole))
        else:
            out.append((at[a:b] - begins[i], hashes[a:b]))
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:SKETCH]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    both = np.union1d(one, two)[:SKETCH]
    if not len(both):
        return 1.0
    return float((np.isin(both, one) & np.isin(both, two)).sum() / len(both))


def shown(own: np.ndarray) -> bytes:
    return own.astype(">u4").tobytes()


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    return [sketch(hashes) for a, b in chunks(texts) for _, hashes in anchors(texts[a:b])]


def syncmers(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the byte positions and hashes of its anchors, for positional matching."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            for a, b in chunks(texts):
                found = [(p, h.view(np.int64)) for p, h in anchors(texts[a:b])]
                out = pd.DataFrame(found, columns=["positions", "hashes"])
                out.insert(0, "doc_id", pdf["doc_id"].values[a:b])
                yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(run, "doc_id long, positions array<long>, hashes array<long>")


# Digests stay binary until they are returned: as text they take twice the room.
RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


def edited(text: str, following: str) -> str:
    """The second half replaced by as much of the next text's begin."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], owned: list[np.ndarray]) -> list[tuple]:
    """Result rows of all but the last of neighbouring texts."""
    changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    blobs = [t.encode() for t in changed]
    rows = []
    for i, (blob, own) in enumerate(zip(blobs, sketches(blobs), strict=True)):
        rows.append((
            ids[i], len(texts[i]), hashlib.sha256(blob).digest(), shown(owned[i]), shown(own),
            likeness(owned[i], own), likeness(owned[i], owned[i + 1]),
        ))
    return rows


def neighbours(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and both likenesses.

    Texts are dealt by ranges of ids and sorted once; a task streams through its range and
    holds a chunk at a time. Only the first and last text of each range are kept besides the
    results, to compare the ends of neighbouring ranges: two rows for each task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = TaskContext.get().partitionId()
        ids: list = []
        texts: list[str] = []
        owned: list[np.ndarray] = []
        size, begun = 0, False

        def end(role: str, i: int) -> pd.DataFrame:
            return pd.DataFrame({"doc_id": pd.array([ids[i]], "Int64"), "role": [role], "place": [place], "text": [texts[i]]})

        def emit() -> pd.DataFrame:
            own = sketches([t.encode() for t in texts[len(owned) :]])
            owned.extend(own)
            out = pd.DataFrame(_compare(ids, texts, owned), columns=_COLUMNS)
            return out.assign(doc_id=out["doc_id"].astype("Int64"), role="row", place=place)

        for pdf in batches:
            for name, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                ids.append(name)
                texts.append(text)
                size += len(text)
                if not begun:
                    begun = True
                    yield _full(end("first", 0))
                if size >= CHUNK_BYTES and len(texts) > 1:
                    yield _full(emit())
                    ids, texts, owned = ids[-1:], texts[-1:], owned[-1:]
                    size = len(texts[0])
        if len(texts) > 1:
            yield _full(emit())
        if begun:
            yield _full(end("last", -1))

    def _full(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reindex(columns=[*_COLUMNS, "role", "place", "text"]).astype({"doc_id": "Int64", "n_chars": "Int64"})
        for name in ("edited_sha256", "fingerprint", "edited_fingerprint", "role", "text"):
            pdf[name] = pdf[name].astype(object).where(pdf[name].notna(), None)
        return pdf

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("tk"))
    order = [F.desc("doc_id"), F.asc("tk")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tk")
    table = scratch.keep(dealt.mapInPandas(run, RESULT + ", role string, place int, text string"), "neighbours")

    places = table.filter("role = 'first'").select("place")
    following = places.withColumn("next", F.lead("place").over(W.orderBy("place")))
    following = following.withColumn("next", F.coalesce("next", F.min("place").over(W.partitionBy())))
    last = table.filter("role = 'last'").select("doc_id", "place", "text").join(following, "place")
    first = table.filter("role = 'first'").select(F.col("place").alias("next"), F.col("text").alias("following"))

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, text, other in zip(pdf["doc_id"].astype("Int64"), pdf["text"], pdf["following"], strict=True):
                out += _compare([name], [text, other], sketches([text.encode(), other.encode()]))
            out = pd.DataFrame(out, columns=_COLUMNS)
            yield out.astype({"doc_id": "Int64", "n_chars": "Int64"})

    joined = last.join(first, "next").select("doc_id", "text", "following").mapInPandas(ends, RESULT)
    rows = table.filter("role = 'row'").select(*_COLUMNS).unionByName(joined)
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
