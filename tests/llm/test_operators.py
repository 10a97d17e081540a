"""Every text operator on a small corpus with nulls, empty texts, copies and odd columns."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

import corpus_pipeline
import public_tokenizers
from boxlake.llm import bwt, ctw, jaccard, line_runs, pieces, pii, quality, syncmers, templates, url_lists
from boxlake.llm.common import Scratch, chunks, spans
from boxlake.sources.files import Working
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, tk string, n int, node long, label int, h string, key int, training string"
VOCABULARY = ["ba", "ko", "Lu", "mi", "né", "ra", "so", "tu", "wé", "xi", "yo", "zu", "the", "of", "and"]


def _corpus() -> list[tuple]:
    rng = random.Random(5)

    def text(n):
        return " ".join("".join(rng.choices(VOCABULARY, k=rng.randint(1, 3))) for _ in range(n))

    base = [text(n) for n in (120, 80, 60, 300, 40)]
    passage = text(70)
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(30):
        words = rng.choice(base[:3]).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "edit" + str(i)
        rows.append((10 + i, " ".join(words)))
    rows += [(60 + i, f"{text(30)}\n{passage}\n{text(20)}") for i in range(8)]
    rows += [(80, None), (81, ""), (82, " \t\n"), (83, "one two"), (84, "one two"), (85, "ONE  two\n"), (86, "a" * 400), (87, "a" * 130)]
    rows += [(88, "x" * 30_000), (89, "né " * 5_000), (90, "🙂 ▁ <s> \x00 ﻿ end"), (91, base[4]), (91, base[4])]
    rows += [(None, base[0]), (None, None), (92, "call a@b.co, 10.0.0.300 1.2.3.4.5 4111 1111 1111 1111 or +1 (555) 010-9999 x@y"), (93, "a@b.c_d@e.f.g +12 +++ 4111-1111-1111-1112")]
    return rows


ROWS = _corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", 1, 2, 0, "z", 3, "no") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _seen(df):
    return Counter(tuple(r) for r in df.collect())


def test_fingerprints(spark, docs, empty):
    found = syncmers.neighbours(docs, Scratch(spark)).collect()
    assert len(found) == len(ROWS)
    by_text: dict = {}
    for i, t in ROWS:
        if [x for x, _ in ROWS].count(i) == 1:
            by_text.setdefault(t or "", set()).add(next(r.fingerprint for r in found if r.doc_id == i))
    assert all(len(v) == 1 for v in by_text.values())
    ids = sorted({i for i, _ in ROWS if i is not None}, reverse=True)
    own = dict(ROWS)
    got = {r.doc_id: r for r in found}
    for a, b in zip(ids, ids[1:], strict=False):
        if 91 not in (a, b):
            want = syncmers.edited(own[a] or "", own[b] or "")
            assert got[a].edited_sha256 == brute.sha(want) and got[a].n_chars == len(own[a] or "")
    assert got[81].near_next == 1.0 and got[81].fingerprint == "" and got[83].near_edited < 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert syncmers.neighbours(empty, Scratch(spark)).count() == 0
    lone = syncmers.neighbours(docs.filter("doc_id = 0"), Scratch(spark)).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def test_anchors_do_not_depend_on_their_place():
    text = ROWS[3][1].encode()
    (alone, _), (moved, _) = syncmers.anchors([text, b"other words before " + text])
    shift = len(b"other words before ")
    assert set(alone + shift) <= set(moved)
    assert len(syncmers.anchors([b""])[0][0]) == 0 and len(syncmers.anchors([b"", b"ab", b""])[1][0]) == 1


def test_line_dedup(spark, empty):
    texts = {
        1: "first line of the whole corpus, quite long indeed\nshort\nalso short\nend", 2: "x\nshort\nalso short\nlast",
        3: "first line of the whole corpus, quite long indeed\nnew", 4: "aaaaaaaaaaaaaaaaaaaa\nbbbbbbbbbbbbbbbbbbbb\nccccccc\n",
        5: "q\naaaaaaaaaaaaaaaaaaaa\nbbbbbbbbbbbbbbbbbbbb\nccccccc\nr", 6: None, 7: "", 8: "ccccccc\nbbbbbbbbbbbbbbbbbbbb",
        9: "\n".join(["the same line over and over, forty characters"] * 4),
    }
    rows = spark.createDataFrame([(i, t, "own") for i, t in texts.items()] + [(9, texts[9], "own")], "doc_id long, text string, doc string")
    got = {r.doc_id: r for r in line_runs.deduplicated(rows, Scratch(spark)).collect()}
    assert got[1].text == texts[1] and got[2].text == texts[2] and got[3].text == "new" and got[4].text == texts[4]
    assert got[5].text == "q\nr" and got[5]["_runs"] == 1 and got[6].text is None and got[8].text == texts[8]
    assert got[9].text == texts[9].split("\n")[0] and got[9]["_deleted"] == [1, 2, 3] and got[9].doc == "own"
    assert line_runs.deduplicated(empty, Scratch(spark)).count() == 0


def test_names_that_operators_use(spark):
    """Columns of the input with the operators' own names change nothing."""
    line = "the same line over and over, forty characters and more"
    rows = spark.createDataFrame(
        [(1, line, 1, "a", 5, "x", "y"), (2, f"{line}\nnew", 2, "b", 6, "x", "y")],
        "doc_id long, text string, _deleted int, _runs string, _lines int, _gone string, row string",
    ).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: r for r in line_runs.deduplicated(rows, Scratch(spark)).collect()}
    assert got[2].text == "new" and got[2]["_deleted"] == [0] and got[2]["row"] == "y"
    kept = corpus_pipeline.line_dedup(spark, rows, "")
    assert kept.columns == rows.columns
    assert {(r.doc_id, r.text, r["_deleted"], r["_runs"], r.n_chars) for r in kept.collect()} == {(1, line, 1, "a", len(line)), (2, "new", 2, "b", 3)}
    assert [r["_gone"] for r in corpus_pipeline.ngram_jaccard_join(spark, rows, "").collect()] == ["x"]  # six of seven shingles
    entries = spark.createDataFrame([("ads", "d:bad.com", 1, "add")], "list string, key string, at int, action string")
    captures = spark.createDataFrame([("http://bad.com", 2, "u", "f", "k")], "url string, fetched int, _url string, _fetched string, _key string")
    found = url_lists.judged(captures, entries).first()
    assert (found.lists, found["_url"], found["_fetched"]) == (["ads"], "u", "f")


def test_long_runs_double(spark):
    lines = [f"line {i}" for i in range(100)]
    rows = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["z", *lines[10:90], "z"])), (3, "\n".join(lines[40:44]))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_runs.deduplicated(rows, Scratch(spark)).collect()}
    assert got[2] == "z\nz" and got[3] == "\n".join(lines[40:44])


def test_url_lists(spark):
    entries = spark.createDataFrame([
        ("ads", "d:bad.com", 10, "add"), ("ads", "d:bad.com", 20, "remove"), ("ads", "d:bad.com", 20, "add"), ("ads", "d:bad.com", 30, "add"),
        ("dirs", "p:ok.com/x/", 5, "add"), ("dirs", None, 5, "add"), ("dirs", "d:ok.com", None, "add"), ("dirs", "d:ok.com", 1, "note"),
    ], "list string, key string, at int, action string")
    captures = [
        ("http://www.bad.com/", 9, []), ("http://www.bad.com/", 10, ["ads"]), ("https://u:p@BAD.com:80?x#y", 19, ["ads"]), ("http://bad.com", 20, []),
        ("http://bad.com", 30, ["ads"]), ("http://notbad.com", 30, []), ("http://ok.com/x/y/z?q", 5, ["dirs"]), ("http://ok.com/x", 9, []),
        ("http://ok.com/xx/", 9, []), (None, 9, []), ("", 9, []), ("no url", 9, []), ("http://bad.com", None, []), ("http://bad.com", 30, ["ads"]),
    ]
    rows = spark.createDataFrame([(u, t, "mine") for u, t, _ in captures], "url string, fetched int, key string")
    got = Counter((r.url, r.fetched, tuple(r.lists)) for r in url_lists.judged(rows, entries).collect())
    assert got == Counter((u, t, tuple(x)) for u, t, x in captures)
    assert url_lists.judged(rows, entries.limit(0)).filter("size(lists) > 0").count() == 0
    assert url_lists.judged(rows.limit(0), entries).count() == 0


def test_pieces(docs, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = pieces.encoded(docs, MODEL).collect()
    texts: dict = {}
    for i, t in ROWS:
        texts.setdefault(i, []).append(t or "")
    assert len(found) == len(ROWS)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        match = [t for t in texts[r.doc_id] if library.encode(t, add_bos=True, add_eos=True) == ids]
        assert match and r.decoded == library.decode(ids)
        begins, ends, blob = np.frombuffer(r.begins, "<u4"), np.frombuffer(r.ends, "<u4"), match[0].encode()
        assert (begins <= ends).all() and (begins[2:] == ends[1:-1]).all() and (not len(blob) or ends[-1] == len(blob))
    assert pieces.encoded(empty, MODEL).count() == 0


def test_normalisation_agrees_with_the_library():
    blob = open(MODEL, "rb").read()
    alphabet = ["a", " ", "  ", "Å", "①", "ｱﾞ", "　", "㍿", "ſ", "́", "🙂", "\t", "\n", " ", "x" * 60]
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf"):
        normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(normalizer.serialized_model_proto())
        model, spec, rng = pieces.Pieces(blob), proto.normalizer_spec, random.Random(3)
        model.map, model.dummy, model.squeeze = pieces.CharMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces
        for _ in range(300):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 20)))
            out, origin = model.normalise(text)
            assert out.decode().replace("▁", " ") == normalizer.Normalize(text).replace("▁", " ")
            assert len(origin) == len(out) + 1 and (np.diff(origin) >= 0).all()


def test_repeated_strings(spark, docs, empty):
    want = brute.repeats(ROWS)
    got = bwt.deduplicated(docs, Scratch(spark)).collect()
    assert len(got) == len(ROWS)
    by_id: dict = {}
    for (i, _), v in want.items():
        by_id.setdefault(i, []).append(v)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) in by_id[r.doc_id]
    assert bwt.deduplicated(empty, Scratch(spark)).count() == 0


def test_repeated_strings_by_hash(spark, docs, monkeypatch):
    """The way beyond the bound of one task gives the same bytes."""
    want = _seen(bwt.deduplicated(docs, Scratch(spark)))
    monkeypatch.setattr(bwt, "MANY", 1)
    assert _seen(bwt.deduplicated(docs, Scratch(spark))) == want


def test_contexts_of_many_anchors_and_repeated_anchors():
    """A merge has more anchors than its symbols name, and anchors that stand twice in a string; as by plain comparison."""
    rng = random.Random(5)
    rows = []
    for n in range(bwt.ANCHORS + 40):
        piece = f"{n:024d}".encode()
        for doc in rng.sample(range(9), 2):
            left = "".join(rng.choices("ab", k=rng.choice([3, 20, 26]))) if n % 3 else "b" * 26
            rows.append((n, rng.choice([left.encode(), piece + b"zz"]), piece, rng.choice([b"b" * 26, piece + b"bc", b"b" * 24 + b"cc", b"b" * 9]), doc))
    contexts, lows = [a + k + b for _, a, k, b, _ in rows], np.array([len(r[1]) for r in rows])
    docs = np.array([r[4] for r in rows])
    kept = bwt.promising(contexts, lows)
    pdf = pd.DataFrame({"h": [r[0] for r in rows], "c": range(len(rows)), "doc": docs, "low": lows, "context": contexts})
    found = pd.concat(bwt.decided([pdf])).set_index("c")["bits"]
    least: dict = {}
    for n, (context, low) in enumerate(zip(contexts, lows)):
        for j in range(len(context) - bwt.LENGTH + 1):
            at = (rows[n][0], j - low, context[j : j + bwt.LENGTH])
            least[at] = min(least.get(at, 99), docs[n])
    for n, (context, low) in enumerate(zip(contexts, lows)):
        want = sum(1 << int(j + bwt.REACH - low) for j in range(len(context) - bwt.LENGTH + 1)
                   if least[rows[n][0], j - low, context[j : j + bwt.LENGTH]] < docs[n])
        assert found.get(n, 0) == want and (kept[n] or not want)
    assert kept.any() and (found > 0).any()


def test_merged_transforms_are_ordered():
    rng = np.random.RandomState(2)
    shards = [np.concatenate([rng.randint(1, 4, (n, 20)), np.zeros((n, 1), int)], 1).astype(np.uint16) for n in (5, 1, 7)]
    strings = np.concatenate([s for s in shards])
    place, common = bwt.merge(shards, 6)
    prefix = [tuple(strings[p // 21, p % 21 :][:6]) for p in place]
    assert prefix == sorted(prefix) and sorted(place) == list(range(strings.size))
    for a, b, k in zip(prefix, prefix[1:], common[1:], strict=False):
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert min(same, 6) <= k or k == same or 0 in a[:k]


def test_templates(spark, empty):
    item = "A farmer sold 12 apples to Ann Lee for 3 dollars each and then he bought 12 pears from Ann Lee on the way home"
    texts = {
        1: "Intro words here. " + item + " more words after it.", 2: item.replace("12", "40").replace("Ann Lee", "Bo"),
        3: item.replace("12", "40", 1), 4: "nothing of that kind", 5: None, 6: "", 7: "short one", 10: item.upper(),
        # Of two equal numbers one is changed, and hardly more than its windows are left.
        11: "and then he bought 12 pears from Ann Lee 3 on", 12: item.replace("Ann Lee", "Bo"),
    }
    rows = spark.createDataFrame([(i, t, "k") for i, t in texts.items()] + [(1, texts[1], "k")], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    got = Counter(tuple(r) for r in templates.judged(rows, benchmark).collect())
    assert got[(1, 1, 1, "7")] == 2 and got[(2, 1, 0, "7")] == 1
    # A slot with a second value leaves the windows of its first one.
    assert got[(3, 1, 0, "7")] == 1 and got[(10, 1, 1, "7")] == 1 and got[(12, 1, 0, "7")] == 1
    assert all(got[(i, 0, 0, "")] == 1 for i in (4, 5, 6, 7))
    assert sorted(r.doc_id for r in templates.clean(rows, benchmark).collect()) == [4, 5, 6, 7, 11]
    assert templates.judged(rows, benchmark.limit(0)).filter("n_items > 0").count() == 0
    assert templates.clean(rows, benchmark.limit(0)).count() == len(texts) + 1
    assert templates.judged(empty, benchmark).count() == 0


def test_clean_ignores_case(spark):
    item = "A farmer from the long straße near Bad Ems sold 12 apples to Ann Lee for 3 km of rope and then went home"
    texts = {
        1: item.upper(), 2: item.title(), 3: "Before it. " + item.upper() + " AFTER IT.", 4: item.upper().replace("12", "40"),
        5: "NOTHING OF THAT KIND STANDS IN THIS TEXT AT ALL, NOT EVEN 12 APPLES", 6: item, 7: None,
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item), (8, None)], "item_id long, text string")
    assert sorted(r.doc_id for r in templates.clean(rows, benchmark).collect()) == [5, 7]


def test_batches_are_bounded_by_size(spark):
    """What a Python worker gets at once does not grow with the length of texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(0, 40, 1, 1).select(F.col("id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sized = rows.mapInPandas(lambda batches: (p[["id"]].iloc[:1].assign(id=len(p)) for p in batches), "id long")
    sizes = [r.id for r in Scratch(spark, batch_bytes=jaccard.BATCH_BYTES).keep(sized, "sizes").collect()]
    assert sum(sizes) == 40 and max(sizes) <= 5 and spark.conf.get(key) == before


def test_templates_are_made_once(spark):
    """What the steps behind the search read is a written table: none of them makes templates anew."""
    rows = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, None)], "doc_id long, text string")
    benchmark = rows.withColumnRenamed("doc_id", "item_id")
    found = templates.leaks(rows, benchmark)
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.doc, r.item_id, r.cover, r.exact) for r in found.collect()] == [(1, 1, 1.0, True)]


def test_templates_in_blocks(spark, monkeypatch):
    item = " ".join(f"word{chr(97 + i)}" for i in range(20))
    rows = spark.createDataFrame([(1, "x " + item), (2, "y")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(templates, "BLOCK_ROWS", 3)
    assert [r.doc_id for r in templates.clean(rows, benchmark).collect()] == [2]


def test_jaccard(spark, docs, empty, monkeypatch):
    want = brute.components(ROWS)
    for heavy, block, star in ((64, 2000, 2), (2, 3, 1), (2, 3, 0)):
        monkeypatch.setattr(jaccard, "HEAVY", heavy)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "LEAF", 2 if star < 2 else 32)
        monkeypatch.setattr(jaccard, "STAR_ROUNDS", max(star, 1))
        got = jaccard.similar(docs).collect()
        assert len(got) == len(ROWS)
        for r in got:
            assert r.component_id == want.get(r.doc_id)
        sizes = {i: len(brute.shingles(t)) for i, t in ROWS if i is not None}
        assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)
    assert jaccard.similar(empty).count() == 0


def test_bound_is_never_too_low():
    rng = np.random.RandomState(4)
    vecs = rng.poisson(3, (300, 16)).astype("<u2")
    vecs[0, 0] = np.iinfo("u2").max
    sizes = vecs.astype(np.int64).sum(1)
    tree = jaccard.CountTree(vecs, sizes)
    for i in range(0, 300, 7):
        fits = jaccard.overlaps(vecs, vecs[i]) >= jaccard.needed(sizes, sizes[i])
        fits &= 5 * np.minimum(sizes, sizes[i]) >= 4 * np.maximum(sizes, sizes[i])
        assert sorted(tree.near(vecs[i], sizes[i])) == list(np.flatnonzero(fits))


def test_quality(spark, docs, empty):
    rng = random.Random(1)
    good = [" ".join(rng.choices(VOCABULARY, k=50)) + "." for _ in range(120)]
    bad = ["BUY!! NOW!! " * 20 + str(i) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(0, 180, 2)] + [(None, 1, 0), (4, None, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(frame, labels)
    got = frame.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()
    assert all((r.s >= quality.ACCEPT) == (r.doc_id < 120) for r in got)
    odd = docs.select(quality.score(model, F.coalesce("text", F.lit(""))).alias("s")).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.s <= 1 for r in odd)
    none = quality.fit(frame, labels.limit(0))
    assert {r.s for r in frame.select(quality.score(none, F.col("text")).alias("s")).collect()} == {0.5}
    assert empty.select(quality.score(none, F.col("text"))).count() == 0


def test_quality_collects_repeated_rows_once(spark, monkeypatch):
    texts = [(1, "a good text of words"), (2, "zzz qqq xxx"), (2, "another text under the same id")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    plain = quality.fit(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    many = spark.createDataFrame(texts + texts[:1] * 50, "doc_id long, text string").repartition(4)
    sizes, collect = [], type(many).collect
    monkeypatch.setattr(type(many), "collect", lambda self: (out := collect(self), sizes.append(len(out)))[0])
    fitted = quality.fit(many, labels)
    assert sizes and max(sizes) == 3
    assert fitted.bias == plain.bias and np.array_equal(fitted.weights, plain.weights)


def test_identity_of_squares():
    """The linear form equals the sum over all pairs of features."""
    rng = np.random.RandomState(0)
    weights = rng.normal(0, 1, (quality.BUCKETS + len(quality.STATISTICS), 3)).astype(np.float32)
    model = quality.Model(0.3, weights, np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    text, bucket, value, stats = quality.features([b"some words some", b"more of them here"])
    got = model.margin(text, bucket, value, stats)
    for t in range(2):
        index = [*bucket[text == t], *range(quality.BUCKETS, len(weights))]
        x = np.array([*value[text == t], *stats[t]])
        pairs = sum(weights[i, 1:] @ weights[j, 1:] * x[a] * x[b] for a, i in enumerate(index) for b, j in enumerate(index) if a < b)
        assert got[t] == pytest.approx(0.3 + weights[index, 0] @ x + pairs, rel=1e-3)


def test_language_model(spark, docs, empty):
    training = F.col("doc_id") % 3 != 0
    got = ctw.scored(docs, training, Scratch(spark)).collect()
    counts = brute.token_counts([(i, t) for i, t in ROWS if i is not None and i % 3 != 0])
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == len(ROWS) and {r.train_tokens for r in got} == {total}
    for r in got:
        if r.doc_id is None or r.doc_id == 91:
            continue
        tokens = [*brute.WORDS.findall(brute.lowered(dict(ROWS)[r.doc_id])), None]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(counts[t] > 0 for t in tokens))
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0
    assert ctw.scored(empty, training, Scratch(spark)).count() == 0
    unseen = ctw.scored(docs, F.lit(False), Scratch(spark)).filter("doc_id = 83").first()
    assert unseen.score == pytest.approx(8 * 8 * math.log10(0.5)) and unseen.n_known == 0


@pytest.mark.parametrize("bound", [0, 40, 1 << 20])
def test_language_model_uses_the_whole_tree(spark, docs, monkeypatch, bound):
    for name in ("HEAD_GRAMS", "MAX_NODES"):
        monkeypatch.setattr(ctw, name, bound, raising=False)
    rows = [(i, t) for i, t in ROWS if i is None or not 88 <= i <= 89]
    got = ctw.scored(docs.filter("doc_id is null or doc_id not in (88, 89)"), F.col("doc_id") % 3 != 0, Scratch(spark)).collect()
    scores = brute.tree_scores([t for i, t in rows if i is not None and i % 3], [t for _, t in rows])
    wanted = sorted((-1 if i is None else i, s) for (i, _), s in zip(rows, scores, strict=True))
    for (i, score), (j, s) in zip(wanted, sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got), strict=True):
        assert i == j and s == pytest.approx(score, rel=1e-6)


def test_byte_chances_add_up_to_one(spark, docs):
    texts = docs.filter("doc_id < 60").select("text")
    grams = ctw.counted(texts).filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    scorer = ctw.Scorer(*ctw.tree(grams, Scratch(spark)))
    for context in (b"\n\n\n\n\n", b"he of", b"qqqqq", b"\xff\x00\x01zz"):
        gram = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert (10.0 ** scorer.fresh(gram)).sum() == pytest.approx(1, abs=1e-4)
        assert scorer.score(gram) == pytest.approx(scorer.fresh(gram), abs=1e-5)


def test_personal_data(spark, docs, empty):
    texts = {1: "IBAN DE89 3704 0044 0532 0130 00 ok", 2: "DE89370400440532013001", 3: "my ssn is 123-45-6789", 4: "123-45-6789", 5: "SSN 000-45-6789", 6: "social security: 123-45-67890"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.found(rows).collect()}
    assert ("iban", 5, 32) in got[1] and not [k for k, *_ in got[2] if k == "iban"]
    assert got[3] == [("ssn", 10, 21)] and got[4] == [] and got[5] == [] and got[6] == []
    texts = {}
    for i, t in ROWS:
        texts.setdefault(i, []).append(t)
    for r in pii.found(docs).collect():
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind not in ("iban", "ssn")]
        assert base in [brute.personal(t) for t in texts[r.doc_id]]
    assert pii.found(empty).count() == 0


def test_personal_data_in_odd_texts(spark):
    rng = random.Random(9)
    parts = ["a", "b.c", "@", ".", "_", "%", "1", "22", "255", "256", " ", "-", "+", "(", ")", "4111", "1111", "é", "🙂", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(400)] + ["a" * 20_000 + "@", "1." * 9_000, "+" + "(" * 9_000, "x@y.z " * 700]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.found(rows).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind not in ("iban", "ssn")] == brute.personal(texts[r.doc_id])


def test_contract_held_out(spark):
    from boxlake.llm.common import held_out

    rows = spark.range(200).select("id", held_out("id", 5, 0).alias("a"), held_out("id", 7, 2).alias("b")).collect()
    for r in rows:
        rest = zlib.crc32(str(r.id).encode())
        assert (r.a, r.b) == (rest % 5 == 0, rest % 7 == 2)


LEAKED = "Ann had 12 apples and gave 5 of them to her brother before the long walk home with the others"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_templates_neither_sort_nor_shuffle_beside_the_search(spark, monkeypatch):
    """What reads texts is a task without sorts and exchanges that reads few rows at once; few ids that leaked move no documents."""
    texts = [(1, f"first {LEAKED} and on"), (1, f"first {LEAKED} and on"), (1, "nothing of it"), (2, None), (None, LEAKED), (None, "clean")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(5, LEAKED), (5, LEAKED), (6, None)], "item_id long, text string")
    plans, keep = {}, Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: (plans.setdefault(name, []).append(_plan(df)), keep(self, df, name))[1])
    for most, moved in ((200_000, False), (1, True)):
        monkeypatch.setattr(templates, "BLOCK_ROWS", most)
        plans.clear()
        clean = templates.clean(rows, benchmark)
        assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == [(0, "clean"), (1, "nothing of it"), (2, "")]
        assert len(plans["found"]) == 2 and not any("Sort" in p or "Exchange hashpartitioning" in p for p in plans["found"])
        joined = _plan(clean)
        assert "Sort" not in joined and ("Exchange hashpartitioning" in joined) == moved


def test_rows_read_at_once_are_bounded(spark, monkeypatch):
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    before, write = spark.conf.get(key), Working.keep
    monkeypatch.setattr(Working, "keep", lambda self, df, name: (seen.append((name, spark.conf.get(key))), write(self, df, name))[1])
    rows = spark.createDataFrame([(1, LEAKED)], "doc_id long, text string")
    templates.leaks(rows, rows.withColumnRenamed("doc_id", "item_id"))
    assert {r for n, r in seen if n == "found"} == {str(templates.READ_ROWS)} and spark.conf.get(key) == before


def test_pieces_of_many_chunks(spark):
    """Texts become Python objects a chunk at a time; every row comes back, long texts and empty ones too."""
    texts = [None, "", "né 🙂 " * 90_000, "x", *[f"row {i} " * 40_000 for i in range(6)], "end"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = pieces.encoded(rows, MODEL)
    assert "MapInArrow" in _plan(found)
    assert {r.doc_id: r.decoded for r in found.collect()} == {i: t or "" for i, t in enumerate(texts)}
    sizes = [len(t or "") for t in texts]
    assert list(spans(sizes, 300_000)) == list(chunks([t or "" for t in texts], 300_000)) and list(spans([])) == []
