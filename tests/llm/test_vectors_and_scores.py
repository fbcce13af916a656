"""Exact top-k against all pairs; language-model scores against counts and held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from routepulse.llm import lm_scoring, mixing_model, similar_vectors
from routepulse.llm.common import Powers, lowered, text_bytes, word_hashes, word_spans
from routepulse.llm.queries import QUERIES, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def best(rows, queries, k):
    out = []
    for q, v in queries:
        found = {}
        for i, w in rows:
            if i != q and len(v) == len(w) and len(v):
                score = sum(a * b for a, b in zip(v, w, strict=True))
                found[i] = max(score, found.get(i, score))
        for n, (score, i) in enumerate(sorted((-s, i) for i, s in found.items())[:k]):
            out.append((q, n + 1, i, -score))
    return sorted(out)


@pytest.mark.parametrize("span", [0, 1, 3, 200, 5000])
def test_index_block_equals_all_pairs(span):
    dice = np.random.default_rng(span)
    rows = dice.integers(-span, span + 1, (150, 9))
    ids = dice.permutation(1000)[:150]
    found = similar_vectors.Slices(ids, rows).top(rows[:40], ids[:40], 5)
    want = best(list(zip(ids.tolist(), rows.tolist(), strict=True)), list(zip(ids[:40].tolist(), rows[:40].tolist(), strict=True)), 5)
    got = sorted((int(ids[q]), n + 1, int(i), int(s)) for q, (found_ids, scores) in enumerate(found) for n, (i, s) in enumerate(zip(found_ids, scores, strict=True)))
    assert got == want


@pytest.mark.parametrize("block", [3, 4096])
def test_top_k_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(similar_vectors, "BLOCK_ROWS", 70)
    dice = random.Random(2)
    vectors = [(i, [dice.choice([-0.5, 0.25, 0.1, 0.004, dice.random()]) for _ in range(6)]) for i in range(200)]
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [math.nan] * 6), (303, [math.inf] + [0.0] * 5), (None, [1.0] * 6), (304, [1.0, 2.0]), (350, [0.5, 0.5]), (400, []), (7, vectors[7][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, rank int")
    rows = frame.select("vec_id", similar_vectors.quantised(F.col("embedding")).alias("vector"), F.lit(0).alias("score")).repartition(3)
    got = similar_vectors.top_k(rows, rows.where("vec_id % 50 = 0"), 5, block_queries=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert sorted(map(tuple, got.collect())) == best(whole, [(i, v) for i, v in whole if i % 50 == 0], 5)
    assert similar_vectors.top_k(rows, rows.where("false")).collect() == []
    assert similar_vectors.top_k(rows.where("false"), rows).collect() == []
    assert similar_vectors.top_k(rows.where("vec_id < 3"), rows.where("vec_id = 0")).count() == 2


def test_large_components(spark):
    """Components beyond 32 bits, scores beyond 64, and components beyond 64."""
    dice = random.Random(8)
    vectors = [(i, [dice.choice([9.0e6, -9.0e6, 3e14, 0.25, dice.random(), -1e15]) for _ in range(5)]) for i in range(120)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = frame.select("vec_id", similar_vectors.quantised(F.col("embedding")).alias("vector")).repartition(2)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    long = (1 << 63) - 1
    want = [(q, n, i, max(-long, min(long, s))) for q, n, i, s in best(whole, whole[::50], 5)]
    got = sorted(map(tuple, similar_vectors.top_k(rows, rows.where("vec_id % 50 = 0"), 5).collect()))
    assert [r[3] for r in got] == [r[3] for r in want]
    exact = [(g, w) for g, w in zip(got, want, strict=True) if abs(w[3]) < long]
    assert all(g == w for g, w in exact)
    huge = spark.createDataFrame([(0, [1e30, 0.0]), (1, [1e30, 1.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    huge = huge.select("vec_id", similar_vectors.quantised(F.col("embedding")).alias("vector"))
    assert [tuple(r) for r in similar_vectors.top_k(huge, huge.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1, long), (0, 2, 3, 0), (0, 3, 2, -long)]


@pytest.mark.parametrize("repeats", [6, 10, 60])
def test_rows_repeated_under_one_id_take_one_place(spark, repeats):
    dice = random.Random(repeats)
    vectors = [(i, [dice.randint(-200, 200) for _ in range(6)]) for i in range(80)]
    query = vectors[0][1]
    # the best rows of query 0: many of id 90, equal and different ones, and many of its own id
    vectors += [(90, [3 * x for x in query])] * repeats + [(90, [2 * x + n for x in query]) for n in range(repeats)]
    vectors += [(0, [4 * x + n for x in query]) for n in range(repeats)]
    rows = spark.createDataFrame(vectors, "vec_id long, vector array<int>").coalesce(1)
    one = rows.where("vec_id = 7").unionAll(rows.where("vec_id = 0").limit(1))
    got = similar_vectors.top_k(rows, one, 5).collect()
    first = best(vectors, [vectors[0], vectors[7]], 5)
    assert sorted(map(tuple, got)) == first
    assert len(first) == 10
    index = similar_vectors.Slices(np.array([i for i, _ in vectors]), np.array([v for _, v in vectors]))
    (ids, scores), *_ = index.top(np.array([query]), np.array([0]), 5)
    assert [(0, n + 1, i, s) for n, (i, s) in enumerate(zip(ids.tolist(), scores.tolist(), strict=True))] == [r for r in first if r[0] == 0]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("frequent", [3, 1 << 18])
def test_base_score_equals_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    texts = ["The cat the CAT", "a dog\tand a cat", None, "", " ", "unseen zebra the", "été ÉTÉ Été", "x" * 5000, "The cat the CAT", "the " * 3000]
    rows = [(i, t, 1.0, 5) for i, t in enumerate(texts)] + [(0, texts[0], 2.0, 6), (None, "the end", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, key int").repartition(3)
    train = docs.where("doc_id <> 5 or doc_id is null")
    got = lm_scoring.score_texts(docs, train).collect()
    assert len(got) == len(rows)
    counts = {}
    for i, t, *_ in rows:
        if i != 5:
            for w in [*words(t), None]:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        tokens = [*words("the end" if r.doc_id is None else texts[r.doc_id]), None]
        want = sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), total)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
        assert r.score < 0 and r.bits_per_byte > 0
    equal = [r for r in got if r.doc_id in (0, 8)]
    assert len({(r.base_score, r.score) for r in equal}) == 1


def test_nothing_to_learn_or_score(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    untaught = lm_scoring.score_texts(docs, docs.where("false")).first()
    assert (untaught.n_tokens, untaught.n_known, untaught.train_tokens) == (3, 0, 0)
    assert untaught.score < 0
    assert lm_scoring.score_texts(docs.where("false"), docs).collect() == []


def test_held_out_texts_score_better_than_by_counts(spark):
    found = QUERIES["op7_lm_scoring"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.held_out for r in found} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.bits_per_byte for r in held) / len(held) < 3


def test_model_is_a_probability():
    """All words of one byte over the whole alphabet of bytes have at most the probability 1 together."""
    text = [b"ab", b"abc", b"b", b"", b"ca"] * 3
    counts, classes, bits = np.arange(1.0, 16), np.ones(15, np.int64), mixing_model.layout(15)
    tables = np.zeros((mixing_model.slots_of(bits), 2), np.float32)
    mixing_model.learn_tables(text, classes, counts, tables, bits)
    tables = mixing_model.compact(tables)
    mixer = mixing_model.Mixer()
    for _ in range(3):
        mixer = mixer.after(mixer.sums(text, classes, counts, tables, bits))
    ready = mixing_model.ready_tables(tables)
    every = [bytes([i]) for i in range(256)]
    scores = mixer.log10([*every, b""], np.ones(257, np.int64), ready, bits)
    assert 0 < (10**scores).sum() <= 1 + 1e-9
    assert mixer.log10([b"b"], np.ones(1, np.int64), ready, bits) > mixer.log10([b"q"], np.ones(1, np.int64), ready, bits)


def test_sums_do_not_depend_on_how_words_are_dealt():
    """Shared beginnings, order and blocks change neither tables nor a round's sums."""
    dice = random.Random(4)
    text = sorted({bytes(dice.choices(b"abc", k=dice.randint(1, 9))) for _ in range(400)})
    counts, classes, bits = np.arange(1.0, len(text) + 1), np.arange(len(text)) % 3, mixing_model.layout(len(text))
    tables, parts = (np.zeros((mixing_model.slots_of(bits), 2), np.float32) for _ in range(2))
    mixing_model.learn_tables(text, classes, counts, tables, bits)
    order = np.array(dice.sample(range(len(text)), len(text)))
    for at in np.array_split(order, 7):
        mixing_model.learn_tables([text[i] for i in at], classes[at], counts[at], parts, bits)
    assert (tables == parts).all()
    tables = mixing_model.compact(tables)
    mixer = mixing_model.Mixer()
    whole = mixer.sums(text, classes, counts, tables, bits)
    assert np.allclose(whole, sum(mixer.sums([text[i] for i in at], classes[at], counts[at], tables, bits) for at in np.array_split(order, 5)))
    mixer = mixer.after(whole)
    ready = mixing_model.ready_tables(tables)
    together = mixer.log10(text, classes, ready, bits)
    assert np.allclose(together, np.concatenate([mixer.log10([w], classes[i : i + 1], ready, bits) for i, w in enumerate(text)]))
    # more rounds code the words they learn from better
    assert (together * counts).sum() > (mixing_model.Mixer().log10(text, classes, ready, bits) * counts).sum()


def test_followers_are_a_probability():
    before, word = np.array([0, 0, 1, 3]), np.array([1, 2, 0, 0])
    found = mixing_model.Followers(3, before, word, np.array([0, 1, 0, 0]), np.array([50, 20, 9, 40]), np.array([100, 100, 10, 80]))
    for at in range(4):
        said, spelled = found.log10(np.full(4, at), np.arange(4))
        missed, also = found.log10(np.array([at]), np.array([-1]))
        assert also.all()
        assert math.isclose((10 ** said[~spelled]).sum() + 10 ** missed[0], 1)
    assert 0.4 < 10 ** found.log10(np.array([0]), np.array([1]))[0][0] < 0.6
    assert found.log10(np.array([-1]), np.array([1]))[0][0] == 0


def test_scores_depend_on_the_order_of_words_not_on_tasks(spark, monkeypatch):
    whole = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    texts = [(r.doc_id, r.text) for r in whole.collect()]
    dice = random.Random(1)
    mixed = [(10_000 + i, " ".join(dice.sample(words(t), len(words(t))))) for i, t in texts if len(words(t)) > 50]
    docs = spark.createDataFrame(texts + mixed, "doc_id long, text string")
    first = {r.doc_id: r for r in lm_scoring.score_texts(docs, whole).collect()}
    held = [i for i, _ in mixed]
    assert sum(first[i].score < first[i - 10_000].score for i in held) >= 0.95 * len(held)
    monkeypatch.setattr(lm_scoring, "LEARNER_WORDS", 900)
    monkeypatch.setattr(lm_scoring, "ROUND_WORDS", 100)
    monkeypatch.setattr(lm_scoring, "FAN", 3)
    monkeypatch.setattr(lm_scoring, "FREQUENT", 500)
    monkeypatch.setattr(lm_scoring, "HELD_PAIRS", 50)
    again = lm_scoring.score_texts(docs.repartition(9), whole.repartition(5)).collect()
    assert all(math.isclose(r.score, first[r.doc_id].score, rel_tol=1e-6) for r in again)
    assert {(r.doc_id, r.n_known) for r in again} == {(r.doc_id, r.n_known) for r in first.values()}


def test_words_of_a_slice_are_told_apart(monkeypatch):
    dice = random.Random(3)
    texts = [" ".join("".join(dice.choices("abAB\0é", k=dice.choice((1, 2, 8, 9, 16, 40, 64, 65, 200)))) for _ in range(dice.randint(0, 60))) for _ in range(40)]
    texts += [None, "", " ", "x" * 5000 + " y", "x" * 4999 + "z a a\0 A"]
    texts += texts[:9]
    tokens = lm_scoring.Tokens(pa.array(texts), Powers())
    want = [w.encode() for t in texts for w in words(t)]
    spelling = tokens.spelling.to_pylist()
    assert [spelling[i] for i in tokens.of] == want
    assert len(set(spelling)) == len(spelling) == len(set(want)) and (np.diff(tokens.distinct) > 0).all()
    assert tokens.counts.tolist() == [len(words(t)) for t in texts]
    # the hashes are those of the words where they stand
    data, offsets = text_bytes(pa.array(texts))
    data = lowered(data)
    starts, ends, _ = word_spans(data, offsets)
    assert (tokens.distinct[tokens.of] == (word_hashes(data, starts, ends, Powers()) & ~np.uint64(1)).view(np.int64)).all()
    assert dict(zip(spelling, tokens.times().tolist(), strict=True)) == Counter(want)
    assert len(lm_scoring.Tokens(pa.array([], pa.string()), Powers()).distinct) == 0


@pytest.mark.parametrize("named, held", [(1 << 12, 1 << 20), (400, 1), (20, 300)])
def test_frequent_words_are_those_of_all_counts(spark, monkeypatch, named, held):
    train = table(spark, "/root/testdata/sf0.001", "documents").select("text").repartition(6)
    counts = Counter(w for r in train.collect() for w in words(r.text))
    total, calls = sum(counts.values()), []
    monkeypatch.setattr(lm_scoring, "NAMED", named)
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", held)
    monkeypatch.setattr(lm_scoring, "SLICE", 20_000)
    whole = lm_scoring._all_anchors
    monkeypatch.setattr(lm_scoring, "_all_anchors", lambda t: calls.append(1) or whole(t))
    got = lm_scoring._anchors(train)
    assert (got == whole(train)).all() and len(got) == lm_scoring.ANCHORS
    assert bool(calls) == (named < 1 << 12)  # bounds settle it unless too few words are named
    least = sorted(counts.values())[-lm_scoring.ANCHORS]
    assert least >= lm_scoring.ANCHOR_SHARE * total
    tokens = lm_scoring.Tokens(pa.array([" ".join(counts)]), Powers())
    known = dict(zip(tokens.distinct.tolist(), tokens.spelling.to_pylist(), strict=True))
    assert sorted(counts[known[h].decode()] for h in got.tolist()) == sorted(counts.values())[-lm_scoring.ANCHORS :]


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_a_task_hands_on_each_word_of_a_class_once(spark, monkeypatch, held):
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", held)
    monkeypatch.setattr(lm_scoring, "SLICE", 50)
    train = spark.createDataFrame([("a b a " * 20,), ("b c",), (None,), ("",), ("a " * 30,)], "text string").coalesce(1)
    shared = type("Shared", (), {"value": (np.zeros(0, np.int64), np.zeros(0, np.int64))})()
    got = {(r["class"], r.word): r.n for r in lm_scoring._word_counts(train, shared).collect()}
    assert got == {(0, b"a"): 70, (0, b"b"): 21, (0, b"c"): 1, (0, b""): 5}
