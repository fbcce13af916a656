"""Periodic runs against a plain search over all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from routepulse.llm import periodic_runs
from routepulse.llm.queries import QUERIES

DOCS = "doc_id long, text string, runs string, key int"


def plain(words):
    """All runs, and the words that stay."""
    n, runs = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            shorter = any(words[start : start + length - p] == words[start + p : start + length] for p in range(1, q))
            if length >= max(12, 2 * q) and not shorter:
                runs.append((start, length, q))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return sorted(runs, key=lambda r: (r[0], r[2])), " ".join(w for i, w in enumerate(words) if i not in gone)


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_text(rng):
    letters = "abcdefgh"[: rng.choice([1, 2, 3, 8])]
    words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
    if rng.random() < 0.7:
        part = [rng.choice("xyzé") + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 70))]
        if rng.random() < 0.3:
            part = ["a"] * rng.randint(1, 40) + ["b"] + part[:5]
        words[len(words) // 2 : len(words) // 2] = (part * rng.randint(2, 5))[: rng.randint(1, 400)]
    return rng.choice([" ", "\n", " \t "]).join(words)


def test_runs_equal_a_plain_search(spark):
    rng = random.Random(11)
    texts = [odd_text(rng) for _ in range(300)] + [None, "", " \n", "a", "a " * 11, "a " * 12, "a b c d e f " * 2, "a b c d e f" * 2]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, texts[3], "again", 2), (None, "no id " * 9, None, None)]
    got = periodic_runs.find_runs(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        words = cut("no id " * 9 if r.doc_id is None else texts[r.doc_id])
        assert r.n_words == len(words)
        assert ([tuple(x) for x in r.runs], r.collapsed) == plain(words), words
    assert periodic_runs.find_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_very_long_texts():
    once = [f"w{i}" for i in range(200_000)]
    for words, want in (
        (["a"] * 1_000_000, [(0, 1_000_000, 1)]),
        (once * 3 + ["end"], [(0, 600_000, 200_000)]),
        (once, []),
        ((["a"] * 100 + ["b"]) * 500, [(0, 50_500, 101)] + [(i * 101, 100, 1) for i in range(500)]),
    ):
        found = periodic_runs._found(pa.array([None, " ".join(words), "x"]))
        assert [tuple(r.values()) for r in found["runs"].to_pylist()[1]] == sorted(want, key=lambda r: (r[0], r[2]))


def test_segments_hold_no_rare_word():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3_000, 5_000)
    edges = np.array([0, 1_000, 1_000, 5_000])
    low, high = periodic_runs.settled_segments(words, edges)
    for a, b in zip(low, high, strict=True):
        assert b - a >= 12 and np.unique(words[a:b], return_counts=True)[1].min() >= 2
        assert any(x <= a and b <= y for x, y in zip(edges[:-1], edges[1:], strict=True))


def test_query_equals_a_plain_search_over_planted_documents(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 4)) for _ in range(rng.randint(0, 150)))) for i in range(400)] + [(900, None), (-5, "x y " * 20), (None, "q " * 15)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        words, h = cut(text), 1 if key is None else zlib.crc32(str(key).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, kept = plain(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), kept)]
        assert tuple(got[key]) == (key, len(runs), start, length, period, 1000 * length // period if runs else None, *sha)


def test_query_types_and_rows(spark):
    got = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == dict.fromkeys(("doc_id", "n_runs", "start", "length", "period", "exponent_milli"), "bigint") | dict.fromkeys(("runs_sha256", "collapsed_sha256"), "string")
    assert got.count() == 200 and got.where(F.col("n_runs") > 0).count() > 10
