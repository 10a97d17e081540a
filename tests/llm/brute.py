"""Plain versions of the text operators' results, document by document."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text: str | None) -> frozenset:
    words = WORDS.findall(lowered(text))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(docs: list[tuple]) -> dict:
    """Least id reachable, of rows ``(id, text)`` with an id."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def repeats(docs: list[tuple], length: int = 50) -> dict:
    """Bytes, removed bytes, runs and what is kept, of rows ``(id, text)``."""
    blobs = [(i, (t or "").encode()) for i, t in docs]
    key = lambda i: (i is None, i or 0)
    first: dict[bytes, tuple] = {}
    for i, blob in sorted(blobs, key=lambda x: key(x[0])):
        for k in range(len(blob) - length + 1):
            first.setdefault(blob[k : k + length], key(i))
    out = {}
    for i, blob in blobs:
        gone = bytearray(len(blob))
        for k in range(len(blob) - length + 1):
            if first[blob[k : k + length]] < key(i):
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i, blob.decode()] = (len(blob), sum(gone), runs, bytes(x for x, g in zip(blob, gone, strict=True) if not g))
    return out


def token_counts(docs: list[tuple]) -> Counter:
    """Words and one end (``None``) for each training row."""
    counts: Counter = Counter()
    for _, text in docs:
        counts.update([*WORDS.findall(lowered(text)), None])
    return counts


def byte_lines(text: str | None) -> list[tuple[bytes, int]]:
    """Five bytes of context and the byte after them, for each byte of the words' line."""
    line = b"\n" * 5 + b" ".join(WORDS.findall(lowered(text))) + b"\n"
    return [(line[i - 5 : i], line[i]) for i in range(5, len(line))]


def tree_scores(training: list[str | None], texts: list[str | None]) -> list[float]:
    """Log10 chances by the whole context tree."""
    counts: dict[tuple, list[int]] = {}
    for t in training:
        for context, byte in byte_lines(t):
            for j in range(8):
                for d in range(6):
                    counts.setdefault((context[5 - d :], (1 << j) | byte >> (8 - j)), [0, 0])[byte >> (7 - j) & 1] += 1
    alone = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for k, (a, b) in counts.items()}
    split: dict[tuple, float] = {}
    stop = {}
    for k in sorted(counts, key=lambda k: -len(k[0])):
        weighted, stop[k] = alone[k], 1.0
        if len(k[0]) < 5:
            weighted = math.log(0.5) + max(split[k], alone[k]) + math.log1p(math.exp(-abs(split[k] - alone[k])))
            stop[k] = math.exp(math.log(0.5) + alone[k] - weighted)
        if k[0]:
            split[k[0][1:], k[1]] = split.get((k[0][1:], k[1]), 0.0) + weighted
    out = []
    for t in texts:
        score = 0.0
        for context, byte in byte_lines(t):
            for j in range(8):
                path = [k for d in range(6) if (k := (context[5 - d :], (1 << j) | byte >> (8 - j))) in counts]
                one, left = 0.0 if path else 0.5, 1.0
                for k in path:
                    n0, n1 = counts[k]
                    one += left * (1.0 if k == path[-1] else stop[k]) * (n1 + 0.5) / (n0 + n1 + 1)
                    left *= 1 - stop[k]
                score += math.log10(one if byte >> (7 - j) & 1 else 1 - one)
        out.append(score)
    return out


def personal(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the four basic kinds."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def groups(docs: list[tuple], width: int) -> dict:
    """Set size, least id reachable and whether the row stays, of rows ``(id, text)`` with an id of its own."""
    sets = {}
    for i, text in docs:
        words = WORDS.findall(lowered(text))
        sets[i] = {tuple(words[k : k + width]) for k in range(max(len(words) - width, 0) + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def ranked(docs: list[tuple], items: list[tuple], most: int = 10) -> list[tuple]:
    """``item_id, rank, doc_id, score`` by scoring every document for every item."""
    counts = [(i, Counter(TERMS.findall((t or "").translate(UPPER)))) for i, t in docs]
    total, terms = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item, text in items:
        scores = []
        for i, own in counts:
            m = 25 + 75 * own.total() * total // max(terms, 1)
            score = 0
            for term in TERMS.findall((text or "").translate(UPPER)):
                if own[term]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * own[term] // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scores)[:most], 1)]
    return out


def alignments(docs: list[tuple], encode_a, encode_b, bytes_a, bytes_b) -> list[tuple]:
    """Per row the counts and digest, every overlap being looked for pair by pair within reach."""
    found, links = [], Counter()
    for i, text in docs:
        whole = (" " + (text or "")).encode()
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        if b"".join(bytes_a[x] for x in a) != whole or b"".join(bytes_b[x] for x in b) != whole:
            found.append((i, [], [], [], ""))
            continue
        spans = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(table[x])))
                at += len(table[x])
            spans.append(out)
        own, first = [], 0
        for k, (x, y) in enumerate(spans[0]):
            while spans[1][first][1] <= x:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < y:
                own.append((a[k], b[j]))
                j += 1
        links.update(own)
        ends = [{y for _, y in s} for s in spans]
        shared, parts, p, q = ends[0] & ends[1], [], 0, 0
        for end in sorted(shared):
            left, right = [], []
            while p < len(a) and spans[0][p][1] <= end:
                left.append(str(a[p]))
                p += 1
            while q < len(b) and spans[1][q][1] <= end:
                right.append(str(b[q]))
                q += 1
            parts.append(",".join(left) + "|" + ",".join(right))
        found.append((i, a, b, own, ";".join(parts)))
    best: dict[int, int] = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (i, len(a), len(b), text.count("|"), len(own), sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own), sha(text) if a else "")
        for i, a, b, own, text in found
    ]
