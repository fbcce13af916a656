"""Packing: tokens against the library, sequences against their definition."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from routepulse.llm import packing
from routepulse.llm.queries import PADDING, QUERIES, table, vocabulary

PARTS = [
    *"aBéÉß×÷ÀÞþÿŸ12 \n\t'.!<日🎉İΣς_-０Ⅷﬀ￥", "'s", "'LL", "<|startoftext|>", "<|endoftext|>", "́", "̧", "\x1c", "\x85", "\xa0", " ", "　", "\x00",
    "\x7f", "Å", "\xad", "​", "é", "the", "ing", "|>",
]
DOCS = "doc_id long, text string, start string, key int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def tokens(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def checked(rows, capacity, padding, want):
    """The pieces make up the documents, and fill sequences without gaps."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity and (at & (at - 1) == 0 or capacity - at <= padding)
    got = Counter()
    for key, pieces in documents.items():
        pieces.sort(key=lambda r: r.start)
        at, ids = 0, b""
        for r in pieces:  # repeated rows have pieces at the same places
            if r.start == at:
                ids, at = ids + bytes(r.ids), at + r.length
            assert r.doc_tokens * 4 == len(want[key]) * 4 and len(r.ids) == 4 * r.length
            assert bytes(r.ids) == np.array(want[key][r.start : r.start + r.length], "<u4").tobytes()
            got[key] += r.length
        assert at == len(want[key])
    return got


def test_tokens_equal_the_library(library):
    rng = random.Random(2)
    encoder = packing.WordTokens(vocabulary("word_bpe_49k.json").decode(), 1)
    for _ in range(60):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(40)] + [None, "", " ", "z" * 5_000]
        ids, n = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tokens(library, t) for t in texts]


@pytest.mark.parametrize("capacity, padding", [(2048, 0), (32, 0), (30, 3), (8, 0), (1, 0)])
def test_pieces_make_up_the_documents(spark, library, capacity, padding):
    rng = random.Random(capacity)
    texts = [" ".join(rng.choice(["the", "of", "Straße", "x9", "thlyouble"]) for _ in range(rng.choice([0, 1, 3, 9, 40]))) for _ in range(150)]
    texts += [None, "", " \n ", "w " * 5_000, "a " * (3 * capacity - 1)]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    out = packing.pack_documents(docs, vocabulary("word_bpe_49k.json").decode(), capacity, 1, padding)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    want = {i: tokens(library, t) for i, t in enumerate(texts)}
    got = checked(out.collect(), capacity, padding, want)
    assert got == {i: len(ids) for i, ids in want.items()}


def test_repeated_rows_missing_ids_and_no_rows(spark, library):
    rows = [(1, "one two three", None, 1), (1, "one two three", None, 1), (None, "no id", None, 1), (None, None, None, 1)] + [(7, None, None, 1)] * 500
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    definition = vocabulary("word_bpe_49k.json").decode()
    out = packing.pack_documents(docs, definition, 16).collect()
    assert Counter(r.doc_id for r in out) == {1: 2, None: 2, 7: 500}
    ends = Counter()
    for r in out:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert sum(ends.values()) == sum(r.length for r in out) and all(n & (n - 1) == 0 for n in ends.values())
    assert packing.pack_documents(docs.where("false"), definition).count() == 0


def test_place_does_not_depend_on_how_offsets_are_joined(spark, monkeypatch):
    rows = [(i, "x " * (i % 37), None, 1) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4, "doc_id")
    definition = vocabulary("word_bpe_49k.json").decode()
    first = sorted(map(tuple, packing.pack_documents(docs, definition, 64).collect()))
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, packing.pack_documents(docs, definition, 64).collect())) == first


def test_patterns_hold_every_length_and_little_is_free():
    rng = random.Random(4)
    for histogram in ({}, {1: 10**9}, {2047: 5}, {1025: 7, 1023: 6, 2: 1}, {i: rng.randint(1, 10**6) for i in range(1, 2048)}, {100: 10**8, 2000: 3}):
        patterns = packing.shortest_pack_first(histogram, 2048)
        held, free = Counter(), 0
        for used, count, content in patterns:
            assert used == sum(a * b for a, b in content) <= 2048
            free += (2048 - used) * count
            for length, times in content:
                held[length] += times * count
        assert held == histogram and len(patterns) <= 3 * len(histogram)
        if len(histogram) > 100:
            assert free < 0.01 * sum(a * b for a, b in histogram.items())


def test_query(spark, library):
    rows = QUERIES["op12_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    total, ends = Counter(), Counter()
    for r in rows:
        ids = tokens(library, texts[r.doc_id])
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        total[r.doc_id] += r.length
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert set(total) == set(texts) and sum(total.values()) == sum(ends.values())
    assert all(n & (n - 1) == 0 or 2048 - n <= PADDING for n in ends.values())
    assert list(rows[0].asDict()) == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
