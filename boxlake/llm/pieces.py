"""SentencePiece encoding and decoding that keeps the source position of every piece.

A text is normalised by longest prefixes through the model's compiled character map; each
normalised byte remembers the source byte it came from. The normalised text falls into
segments that no piece can cross (the start of a run of word marks, and characters that no
piece has); each segment is merged by piece scores, and pieces that are missing from the
vocabulary become byte pieces. Piece lengths then project every piece back to a range of
source bytes. Decoding joins pieces, drops the mark in front and turns marks into blanks.

Null and empty texts have the begin and end ids only and decode to an empty text. Repeated
rows get equal results; very long segments are merged with a heap in n log n steps.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from boxlake.llm.common import spans, text_of

MARK = "▁"
#: Segments that a task remembers at most; it starts anew when they are more.
REMEMBERED = 300_000
LONG = 48


class CharMap:
    """Longest-prefix rewriting by a compiled map: a double-array trie and its texts."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :] if blob else b""

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix at ``at``, and its length."""
        if not self.units:
            return None
        units, found, node = self.units, None, self._offset(self.units[0])
        for i in range(at, len(data)):
            byte = data[i]
            if byte == 0:
                break
            node ^= byte
            unit = units[node]
            if (unit & 0x800000FF) != byte:
                break
            node ^= self._offset(unit)
            if (unit >> 8) & 1:
                found = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]


class Pieces:
    """A piece model read from its serialised form."""

    def __init__(self, blob: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("a BPE model with byte pieces and word marks in front is needed")
        if any(p.type in (4, 5) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.ids = normal
        score = {i: p.score for i, p in enumerate(proto.pieces)}
        # Rank of the piece that two neighbours make: better scores first.
        order = {i: r for r, i in enumerate(sorted(normal.values(), key=lambda i: (-score[i], i)))}
        ties: dict[float, int] = {}
        self.rank = {p: ties.setdefault(score[i], order[i]) for p, i in normal.items()}
        self.byte_ids = [0] * 256
        shown = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                shown[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 1:
                shown[i] = p.piece.encode()
            elif p.type == 2:
                shown[i] = trainer.unk_surface.encode()
        self.sizes = np.array([len(b) for b in shown], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(shown), np.uint8)
        own = {c for p in normal for c in p}
        closed = not any(MARK in p.lstrip(MARK) for p in normal)
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in own)
        self.segments = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "") if closed else "(?s).+").findall
        self.by_line = closed and "\n" not in own
        self.known: dict[str, dict[str, bytes]] = {"": {}, MARK: {}}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source byte of each (with one entry for the end)."""
        source, mark = text.encode(), MARK.encode()
        if not source:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            data = np.frombuffer(source, np.uint8)
            origin = np.repeat(np.arange(len(data)), np.where(data == 32, 3, 1))
            out = source.replace(b" ", mark)
            if self.dummy:
                out, origin = mark + out, np.concatenate([[0, 0, 0], origin])
            return out, np.append(origin, len(source))
        parts: list[tuple[bytes, int]] = []
        at, blank = 0, self.squeeze
        while at < len(source):
            found = self.map.longest(source, at)
            if found is None:
                lead = source[at]
                found = source[at : at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)], 0
                found = found[0], len(found[0])
            new, size = found
            while blank and new.startswith(b" "):
                new = new[1:]
            if new:
                parts.append((new, at))
                blank = self.squeeze and new.endswith(b" ")
            at += size
        end = len(source)
        if self.squeeze:
            while parts and parts[-1][0].endswith(b" "):
                new, end = parts[-1][0][:-1], parts[-1][1]
                parts[-1:] = [(new, end)] if new else []
        if not parts:
            return b"", np.zeros(1, np.int64)
        out, origin = bytearray(), []
        if self.dummy:
            out += mark
            origin += [parts[0][1]] * 3
        for new, where in parts:
            new = new.replace(b" ", mark)
            out += new
            origin += [where] * len(new)
        return bytes(out), np.array([*origin, end], np.int64)

    def _short(self, segment: str) -> list[str]:
        rank, parts = self.rank.get, list(segment)
        ranks = [rank(parts[i] + parts[i + 1], 1 << 30) for i in range(len(parts) - 1)]
        while ranks:
            best = min(ranks)
            if best == 1 << 30:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], 1 << 30)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], 1 << 30)
        return parts

    def _long(self, segment: str) -> list[str]:
        rank, parts = self.rank.get, list(segment)
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, made = heapq.heappop(heap)
            j = after[i]
            if j < 0 or not parts[i] or parts[i] + parts[j] != made:
                continue
            parts[i], parts[j] = made, ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def _segment(self, segment: str) -> bytes:
        out = array("I")
        for part in self._short(segment) if len(segment) <= LONG else self._long(segment):
            if (i := self.ids.get(part)) is not None:
                out.append(i)
            else:
                out.extend([self.byte_ids[b] for b in part.encode()])
        return out.tobytes()

    def _ids(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of each segment ``lead + word``."""
        known = self.known[lead]
        got = list(map(known.get, words))
        if None in got:
            if len(known) > REMEMBERED:
                known.clear()
            for i, one in enumerate(got):
                if one is None:
                    word = words[i]
                    got[i] = one = known.get(word) or self._segment(lead + word)
                    if len(word) <= LONG:
                        known[word] = one
        return got

    def encode(self, normalised: bytes) -> np.ndarray:
        """Ids of a normalised text, with the begin and end ids."""
        text, got = normalised.decode(), []
        if not self.by_line:
            got = self._ids(self.segments(text), "")
        else:
            for n, line in enumerate(text.split("\n")):
                if n:
                    got += self._ids(["\n"], "")
                words = line.split(MARK)
                if "" in words[1:]:  # several marks in a row
                    got += self._ids(self.segments(line), "")
                    continue
                if words[0]:
                    got += self._ids(words[:1], "")
                got += self._ids(words[1:], MARK)
        return np.frombuffer(struct.pack("<I", self.begin) + b"".join(got) + struct.pack("<I", self.end), "<u4")

    def spans(self, ids: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte range of each id; the begin and end ids have empty ones."""
        ends = np.cumsum(self.sizes[ids])
        return origin[ends - self.sizes[ids]], origin[ends]

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        where = np.repeat(self.places[ids] - ends + sizes, sizes)
        joined = self.joined[where + np.arange(len(where))].tobytes().decode(errors="replace")
        if joined.startswith(MARK) and self.dummy:
            joined = joined[1:]
        return joined.replace(MARK, " ")


_LOADED: dict[bytes, Pieces] = {}


def loaded(blob: bytes) -> Pieces:
    if blob not in _LOADED:
        _LOADED.clear()
        _LOADED[blob] = Pieces(blob)
    return _LOADED[blob]


def encoded(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id``, ids, first and end source bytes of each id (little-endian unsigned 32-bit
    integers in binary columns), and the text decoded from the ids."""
    with open(model_file, "rb") as file:
        blob = file.read()  # a bounded file; executors get its content, not its place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(blob)
        for batch in batches:
            texts = batch.column(1)
            # Only one chunk's texts are Python objects at a time.
            for a, b in spans(pc.binary_length(texts).to_pylist()):
                rows = []
                for text in texts.slice(a, b - a).to_pylist():
                    normalised, origin = model.normalise(text)
                    ids = model.encode(normalised)
                    begins, ends = model.spans(ids, origin)
                    rows.append((ids.tobytes(), begins.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), model.decode(ids)))
                made = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), [pa.binary()] * 3 + [pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *made], ["doc_id", "ids", "begins", "ends", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, begins binary, ends binary, decoded string")
