"""Tokenizer alignment, ranked search and MinHash groups against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from boxlake.llm import alignment, jaccard, minhash, sketches
from boxlake.llm.common import Scratch, least_apart, packed_counts
from tests.llm import brute
from tests.llm.test_operators import ROWS, SCHEMA

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _frame(spark, rows):
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", 1, 2, 0, "z", 3, "no") for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return _frame(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, unique=True), st.lists(st.integers(1, 400), unique=True), st.randoms())
def test_gallop_is_the_left_rank(values, into, rng):
    values, into = np.array(sorted(values)), np.array(sorted({*into, 401}))
    start = np.array([rng.randrange(len(into)) for _ in values])
    assert (alignment.gallop(values, into, start) == np.searchsorted(into, values)).all()


@pytest.mark.parametrize("head", [1 << 20, 1])
def test_alignment(spark, docs, head, monkeypatch):
    """With a head of one power of counts only, almost all pairs go through the join."""
    monkeypatch.setattr(alignment, "HEAD_PAIRS", head)
    byte_level = Tokenizer.from_file(BYTES)
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tables = alignment.Tokenizers(open(BYTES, "rb").read(), public_tokenizers.PATTERN, open(PIECES, "rb").read())
    found = alignment.scored(docs, BYTES, public_tokenizers.PATTERN, PIECES, Scratch(spark))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = brute.alignments(ROWS, lambda t: byte_level.encode(t, add_special_tokens=False).ids, pieces.encode, tables.a_bytes, tables.b_bytes)
    assert Counter(tuple(r) for r in found.select(names).collect()) == Counter(wanted)
    assert sum(r[1] > 0 for r in wanted) > 50


def test_byte_levels_agree():
    """The fast encoder and the vocabulary's own library, also on strings of special tokens."""
    byte_level = Tokenizer.from_file(BYTES)
    byte_level.encode_special_tokens = True
    tables = alignment.Tokenizers(open(BYTES, "rb").read(), public_tokenizers.PATTERN, open(PIECES, "rb").read())
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x1F300, 0x1F700), 32, 10])) for _ in range(40)) for _ in range(300)]
    for text in [*texts, " <|endoftext|> a", "a" * 20_000]:
        assert tables.byte_level.encode_ordinary(text) == byte_level.encode(text, add_special_tokens=False).ids


def test_alignment_of_nothing(spark, empty):
    assert alignment.scored(empty, BYTES, public_tokenizers.PATTERN, PIECES, Scratch(spark)).count() == 0


ITEMS = [
    (1, ROWS[0][1][:300]), (2, ROWS[3][1]), (3, None), (4, ""), (5, "zzz unknown"), (6, "the the of 1 né"), (6, "the the of 1 né"),
    (7, "a@b.co 4111"), (None, ROWS[1][1][:100]), (8, "X" * 30_000),
]


def _items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 0, 0, "q") for i, t in rows], "item_id long, text string, query int, rank int, doc_id string")


def _ranks(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("most,block", [(10, 2_000), (3, 2)])
def test_ranked_search(spark, docs, most, block, monkeypatch):
    monkeypatch.setattr(sketches, "QUERIES", block)
    monkeypatch.setattr(sketches, "STEP", 7)
    wanted = brute.ranked(ROWS, list(dict.fromkeys(ITEMS)), most)
    assert _ranks(sketches.search(docs, _items(spark), Scratch(spark), most)) == Counter(wanted)


def test_ranked_search_with_narrow_sketches(spark, docs, monkeypatch):
    """Loose bounds cost work, never results."""
    every = np.arange(256, dtype="<u4").tobytes()
    monkeypatch.setattr(sketches, "sketch", lambda terms, tf: (256, every, np.full(256, min(tf.max(), 255), np.uint8).tobytes()))
    monkeypatch.setattr(sketches, "FIRST", 1)
    assert _ranks(sketches.search(docs, _items(spark), Scratch(spark))) == Counter(brute.ranked(ROWS, list(dict.fromkeys(ITEMS))))


def test_ranked_search_of_nothing(spark, docs, empty):
    assert sketches.search(empty, _items(spark), Scratch(spark)).count() == 0
    assert sketches.search(docs, _items(spark, []), Scratch(spark)).count() == 0
    assert sketches.search(docs, _items(spark, [(1, None)]), Scratch(spark)).count() == 0


def _grouped(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("rounds,block,few", [(4, 2_000, 48), (1, 5, 2)])
def test_minhash_groups(spark, rounds, block, few, monkeypatch):
    """Also with one round of links, small blocks and the search of large buckets."""
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "FEW", few)
    rng = random.Random(3)
    base = [ROWS[k][1].split(" ") for k in range(3)]
    rows = [(i, t) for i, t in ROWS if i is not None and i != 91]
    for i in range(60):
        words = list(base[i % 3])
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"new{i}"
        rows.append((200 + i, " ".join(words)))
    assert _grouped(minhash.near_duplicates(_frame(spark, rows), Scratch(spark))) == brute.groups(rows, 4)


def test_minhash_rows_without_or_with_shared_ids(spark, docs, empty):
    found = minhash.near_duplicates(docs, Scratch(spark)).collect()
    assert len(found) == len(ROWS)
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert len({tuple(r) for r in found if r.doc_id == 91}) == 1
    assert minhash.near_duplicates(empty, Scratch(spark)).count() == 0


def test_pairs_that_cannot_link_are_dropped_where_they_meet(spark):
    """Near copies of a likeness below the threshold: no pair of them is made, at however many places they meet."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(400)]
    # Sets of 396 shingles of four words, or five; 90 go in each copy, so that two copies have likeness 0.63 at most.
    texts = []
    for i in range(40):
        words, start = list(base), rng.randrange(5)
        for k in range(18):
            words[start + 22 * k] = f"new{i}x{k}"
        texts.append(" ".join(words))
    sets = [np.unique(minhash.shingles([t.encode()])[0]) for t in texts]
    for x, y in ((0, 1), (2, 3)):
        packed = np.stack([np.frombuffer(packed_counts(sets[k], minhash.GROUPS, minhash.SHORT), np.uint8) for k in (x, y)])
        apart = len(np.setxor1d(sets[x], sets[y]))
        assert 0.9 * apart <= least_apart(packed, np.array([0]), np.array([1]), minhash.SHORT)[0] <= apart
    rows = [(1, i, i, len(sets[i]), bytes(minhash.HASHES), packed_counts(sets[i], minhash.GROUPS, minhash.SHORT), 0, 0, 0) for i in range(40)]
    met = spark.createDataFrame(rows, "key long, node long, label long, n long, sig binary, counts binary, own int, low int, high int")
    # Equal signatures leave every pair in; the counts alone tell that none can link.
    met = met.withColumn("key", F.lit(0).cast("long")).coalesce(1)
    assert minhash._compared(met).count() == 0
    with np.errstate(over="ignore"):
        fives = jaccard.shingle_sets([t.encode() for t in texts])
    few = np.zeros(jaccard.GROUPS, np.uint8).tobytes()  # no bound by groups
    rows = [(k, i, i, len(s), bytes([255]) * len(few), packed_counts(s, jaccard.FINE, jaccard.SHORT), list(range(8)), 0, 0, 0) for k in range(20) for i, s in enumerate(fives)]
    schema = "token long, node long, label long, n long, vec binary, short binary, early array<long>, own int, low int, high int"
    assert jaccard._survivors(spark.createDataFrame(rows, schema).coalesce(1)).count() == 0


def test_a_pair_is_told_once(spark):
    """Two equal sets meet at 30 places and are told at the first of them; without early places in common, at each."""
    own = np.arange(500, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    vec, short = bytes([255]) * jaccard.GROUPS, packed_counts(own, jaccard.FINE, jaccard.SHORT)
    schema = "token long, node long, label long, n long, vec binary, short binary, early array<long>, own int, low int, high int"
    told = []
    for early in ([list(range(8))] * 2, [list(range(8)), list(range(8, 16))]):
        rows = [(t, node, node, 500, vec, short, early[node], 0, 0, 0) for t in range(30) for node in (0, 1)]
        for parts in (1, 30):
            frame = spark.createDataFrame(rows, schema).repartition(parts, "token").sortWithinPartitions("token")
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(type(frame), "distinct", lambda self: self)
                told.append([tuple(r) for r in jaccard._survivors(frame).collect()])
    assert told[0] == told[1] == [(0, 1)] and set(told[3]) == {(0, 1)} and len(told[3]) > 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), unique=True), st.lists(st.integers(0, (1 << 64) - 1), unique=True), st.integers(0, 400), st.sampled_from([2, 4]))
def test_counts_never_say_too_much(left, right, shared, bits):
    both = [k * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(shared)]
    sets = [np.unique(np.array(both + own, np.uint64)) for own in (left, right)]
    packed = np.stack([np.frombuffer(packed_counts(s, 64, bits), np.uint8) for s in sets])
    assert least_apart(packed, np.array([0]), np.array([1]), bits)[0] <= len(np.setxor1d(*sets))


def test_posterior_bounds():
    """Fewer matches than the bound give likeness 0.8 at most the chosen probability."""
    rng, c = np.random.default_rng(1), 0.8 + 0.2 / 256
    for n, least in zip(minhash.STEPS, minhash.LEAST, strict=True):
        assert (rng.beta(least, n - least + 2, 200_000) >= c).mean() < 1e-4  # one match fewer than the bound
        assert least <= n * c
    # At likeness 0.8 signatures of independent bytes survive.
    left = rng.integers(0, 256, (20_000, minhash.HASHES), np.uint8)
    right = np.where(rng.random(left.shape) < 0.8, left, rng.integers(0, 256, left.shape, np.uint8)).astype(np.uint8)
    assert len(minhash.survive(left, right)) == len(left)


def test_jaccard_rows_without_partner(spark, monkeypatch):
    schema = "token long, node long, label long, n long, rank int, own int, low int, high int"
    rows = [
        (1, 1, 1, 100, 0, 0, 0, 0), (1, 2, 2, 81, 0, 0, 0, 0), (1, 3, 3, 60, 0, 0, 0, 0),  # 3 is too small
        (2, 1, 1, 100, 11, 0, 0, 0), (2, 4, 4, 100, 12, 0, 0, 0), (2, 5, 5, 100, 11, 0, 0, 0),  # 89 are needed, 88 left
        (3, 1, 1, 100, 15, 0, 0, 0), (3, 6, 6, 100, -1, 0, 0, 0),  # met by another order
        (4, 1, 1, 100, 0, 0, 0, 0), (4, 7, 1, 100, 0, 0, 0, 0),  # one component
        (5, 1, 1, 100, 50, 0, 0, 1), (5, 2, 2, 100, 50, 1, 0, 1),  # two blocks: all stay
    ]
    frame = spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions("token", "low", "high")
    kept = {(r.token, r.node) for r in jaccard._with_partner(frame).collect()}
    assert kept == {(1, 1), (1, 2), (2, 1), (2, 5), (3, 1), (3, 6), (5, 1), (5, 2)}


def test_jaccard_counts_only_where_partners_are(spark, monkeypatch):
    """Texts that share a phrase, of sizes that allow no link, come to no place with their counts."""
    texts = [" ".join(["a phrase of five words", *(f"w{i}x{j}" for j in range(8 << i))]) for i in range(8)]
    seen, searched = [], jaccard._survivors
    monkeypatch.setattr(jaccard, "_survivors", lambda rows: seen.append(rows.count()) or searched(rows))
    got = jaccard.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert seen == [0] and all(r.component_id == r.doc_id for r in got)
