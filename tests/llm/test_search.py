"""Ranked lexical search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from routepulse.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "doc_id long, text string, score string, item_id string", "item_id long, text string, rank string"
WORDS = ["the", "The", "of", "x9", "é", "É", "日本", "a-b", "semi;colon", "z\x00z", "ThIs", "١", "\x7f", "end.", "🎉", "q" * 300, *(f"w{i}" for i in range(40))]


def cut(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    held = [(i, Counter(cut(t))) for i, t, *_ in docs if i is not None]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    holding = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t, *_ in items:
        if i is not None:
            asked.setdefault(i, set()).update(cut(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for (doc, c), n in zip(held, sizes, strict=True):
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // total))) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc))
        out += [(i, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def texts(rng, n, most):
    return [rng.choice([" ", "", "\n", ", "]).join(rng.choice(WORDS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_scoring(spark, monkeypatch, small):
    if small:  # many grids a task, several passes, small steps
        for name, value in {"RANGE": 7, "CELLS": 60, "BLOCK_TERMS": 40, "FIRST_STEP": 1, "LAST_STEP": 2, "SLICE_BYTES": 500}.items():
            monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(small)
    docs = [(i, t, "clash", "x") for i, t in enumerate(texts(rng, 300, 25))]
    docs += [(1000, None, None, None), (1001, "", None, None), (1002, "...", None, None), (None, "the of x9", None, None), (-4, "w1 " * 20_000 + "end", None, None)]
    docs += [docs[5], docs[5]] + [(2000 + i, "w1 w2 w3", None, None) for i in range(40)]  # repeated rows, ties
    items = [(i, t, "clash") for i, t in enumerate(texts(rng, 20, 12))] + [(50, None, None), (51, " .", None), (None, "the", None), (3, "w1 w2 w3", None), (60, "nowhere", None), (61, "w1 W1 w2 w3", None)]
    found = lexical_search.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), 9)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect())) == plain(docs, items, 9)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", None, None)], DOCS), spark.createDataFrame([(1, "a", None)], ITEMS)
    assert lexical_search.search(docs.where("false"), items).count() == 0
    assert lexical_search.search(docs, items.where("false")).count() == 0
    assert [tuple(r) for r in lexical_search.search(docs, items).collect()] == plain([(1, "a b")], [(1, "a")], 50)


def test_treap_cells_are_the_largest_below_them():
    rng = np.random.default_rng(1)
    grid = np.where(rng.random((16, 16)) < 0.2, rng.integers(1, 1000, (16, 16)), 0)
    row, column = np.nonzero(grid)
    treap = lexical_search.Treap(row, column, grid[row, column], 4)
    for r in range(16):
        node = np.zeros((1, 1), np.int64)
        for c in range(16):
            node = np.zeros((1, 1), np.int64)
            for level in range(4):
                size = 16 >> level
                low, left = r // size * size, c // size * size
                largest = grid[low : low + size, left : left + size].max()
                assert (treap.best[node[0, 0]] if node[0, 0] >= 0 else 0) == largest
                child = np.array([2 * (r >> (3 - level) & 1) + (c >> (3 - level) & 1)])
                node = treap.children(node, child)
            assert (treap.best[node[0, 0]] if node[0, 0] >= 0 else 0) == grid[r, c]


def test_descent_leaves_ranges_out():
    """Of many documents only those near the best are looked at."""
    rng = np.random.default_rng(2)
    row, column = np.repeat(np.arange(8), 4096), np.tile(np.arange(4096), 8)
    impact = rng.integers(1, 100, 8 * 4096)
    impact[column == 77] = 1000
    treap, seen = lexical_search.Treap(row, column, impact, 12), []
    children = treap.children
    treap.children = lambda node, child: seen.append(len(node)) or children(node, child)
    at, score = treap.search(np.arange(8), np.ones(8, np.int64), 0, 1)
    assert at.tolist() == [77] and score.tolist() == [8000] and sum(seen) < 1000
